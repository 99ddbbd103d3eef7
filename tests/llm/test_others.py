"""Sentence spans, ranking, WARC, token scan, mixing and chat formatting on small and odd tables."""

import base64
import gzip
import hashlib
import json
import random
import time

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from corvane.llm import chat, mixing, queries, ranker, sentence_dedup, sql, token_scan, warc


def ask(text, **tables):
    con = duckdb.connect()
    for name, (ddl, rows) in tables.items():
        con.execute(f"CREATE TABLE {name} ({ddl})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    cur = con.execute(text)
    names = [x[0] for x in cur.description]
    return sorted((tuple(dict(zip(names, r))[n] for n in sorted(names)) for r in cur.fetchall()), key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


# ---- sentence spans ----


def sentence_rows(seed):
    r = random.Random(seed)
    s = lambda: " ".join(r.choice(["Foo", "bar", "BAZ", "é", "qux"]) for _ in range(r.randint(1, 9))) + r.choice([". ", "! ", "\n", "?! ", "...\n\n"])
    shared = ["".join(s() for _ in range(6)) for _ in range(4)]
    rows = [(d, "".join(s() for _ in range(r.randint(0, 8))) + r.choice([*shared, ""]) + "".join(s() for _ in range(r.randint(0, 3)))) for d in range(50)]
    return rows + [(60, ""), (61, None), (62, "..!\n "), (63, shared[0] * 3), (64, " . a. b. c " + shared[1])]


def spans_query(spark, tmp_path, rows, ddl="doc_id long, text string"):
    spark.createDataFrame(rows, ddl).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return queries.QUERIES["op3_sentence_spans"](spark, str(tmp_path))


def plain(r, n):
    """Words without marks, of which every tenth has some."""
    return " ".join("".join(r.choice("abcdé") for _ in range(r.randint(1, 7))) + r.choice(["", "", "", "", "", "", "", "", ",", ".\v" if r.random() < 0.5 else ""]) for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_sentence_spans_equal_sql(spark, tmp_path, seed):
    r = random.Random(seed)
    passage = plain(r, 90)
    rows = sentence_rows(seed) + [(d, plain(r, r.randint(0, 80)) + r.choice(["", " " + passage, passage + "\n" + passage])) for d in range(100, 130)]
    rows += [(200, " \n "), (201, " la" * 40 + "\n" + "A b\v c. " * 3 + "..!" + "né " * 9), (202, " . a"), (203, "x" * 100_000 + " " + "y. " * 20_000)]
    got = spans_query(spark, tmp_path, [(d, t, "h") for d, t in rows], "doc_id long, text string, kept string")
    assert rows_of(got) == ask(sql.OP3, documents=("doc_id BIGINT, text VARCHAR", rows))


def test_sentence_spans_of_odd_tables(spark):
    t = "one two three four five. six seven eight nine ten. eleven twelve thirteen. "
    df = spark.createDataFrame([(None, t), (None, t), (4, t), (4, t), (2, t.upper()), (9, t + t)], "doc_id long, text string")
    got = {(r.doc_id, r.n_sentences, r.n_removed) for r in sentence_dedup.sentence_dedup(df).collect()}
    assert got == {(None, 3, 0), (4, 3, 3), (2, 3, 0), (9, 6, 6)}
    assert sentence_dedup.sentence_dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("turned", [False, True])
def test_rows_of_a_doc_id_lose_their_own_spans_only(spark, turned):
    p, q = ("".join(f"{x}{i} b{i}. " for i in range(6)) for x in "pq")
    rows = [(1, p), (2, p + "tail. "), (2, q), (3, q), (2, q + p), (5, p + p)]
    got = {(r.doc_id, bytes(r.kept).decode()) for r in sentence_dedup.sentence_dedup(spark.createDataFrame(rows[::-1] if turned else rows, "doc_id long, text string")).collect()}
    assert got == {(1, p), (2, "tail. "), (2, q), (3, ""), (5, "")}


def test_one_text_differing_only_later_keeps_what_is_its_own(spark):
    head = " ".join(f"w{i}" for i in range(20))
    rows = [(1, head + " one."), (2, head + " two.")]
    assert {r.n_removed for r in sentence_dedup.sentence_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}


def brute_spans(rows, p):
    """(doc_id, n_sentences, n_removed) by comparing the words of all runs, without hashes."""
    keys = {}
    for d, t in rows:
        flat, at = sentence_dedup.sentences((t or "").encode(), p)
        keys[d] = [tuple(flat[a:z]) for a, z in zip([0, *at.tolist()], at.tolist())]
    seen, go = set(), {d: set() for d in keys}
    for d in sorted(keys):
        for i in range(len(keys[d]) - 2):
            run = tuple(keys[d][i : i + 3])
            if run in seen:
                go[d] |= {i, i + 1, i + 2}
            seen.add(run)
    return {(d, len(keys[d]), len(go[d])) for d in keys}


@pytest.mark.parametrize("unit", [" ", "\n", "!", ". ", "\t.?"])
def test_long_texts_without_words_take_no_time(unit):
    text = (unit * 1_000_000)[:1_000_000].encode()
    began = time.time()
    for t in (text, b"a" + text, text + b"a", text + b"a" + text):
        assert b"".join(sentence_dedup.uncut(t)) == t
        sentence_dedup.sentences(t, sentence_dedup.Params())
    assert time.time() - began < 4


def test_spans_of_short_lines_are_found(spark, tmp_path):
    lines = "".join(f"a{i} b{i} c{i}\n" for i in range(60))
    rows = [(1, lines), (2, lines), (3, "Yes.\nNo.\nOh!\nyes.\nno.\noh!\n"), *sentence_rows(3)[10:]]
    got = {(r.doc_id, r.n_sentences, r.n_removed) for r in spans_query(spark, tmp_path, rows).collect()}
    assert (2, 60, 60) in got and (1, 60, 0) in got and (3, 6, 3) in got
    assert got == brute_spans(rows, sentence_dedup.Params())


def test_copies_without_marks_are_cut_alike():
    r, p = random.Random(7), sentence_dedup.Params(longest=8)
    for k in range(300):
        passage = plain(r, 46).replace(".", "")
        texts = [" ".join([plain(r, r.randint(1, 12)).replace(".", ""), passage, plain(r, r.randint(1, 12)).replace(".", "")]).encode() for _ in range(2)]
        runs = []
        for t in texts:
            flat, at = sentence_dedup.sentences(t, p)
            assert b"".join(sentence_dedup.uncut(t)) == t and max(np.diff(at, prepend=0)) <= 8
            keys = [tuple(flat[a:z]) for a, z in zip([0, *at.tolist()], at.tolist())]
            runs.append({tuple(keys[i : i + 3]) for i in range(len(keys) - 2)})
        assert runs[0] & runs[1], texts


# ---- ranking ----


def test_ranking_learns_and_is_held_out(spark):
    r = random.Random(4)
    docs, labels = [], []
    for d in range(1200):
        good = r.random() < 0.7
        w = [r.choice(["the", "of", "stone", "river", "and", "light", "moves"]) for _ in range(r.randint(30, 90))]
        if not good:
            w = [x.upper() + "!!" if r.random() < 0.5 else x for x in w]
        docs.append((d, " ".join(w)))
        labels.append((d, int(good)))
    df = spark.createDataFrame(docs + [(None, "x"), (5000, None), (5001, ""), (3, docs[3][1])], "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(7, 0), (7, 1), (None, 1), (8, None)], "doc_id long, quality int")
    got = ranker.quality_scores(df, lab).collect()
    truth = dict(labels)
    held = [(x.score, truth[x.doc_id]) for x in got if x.held_out and x.doc_id in truth]
    pos, neg = np.array([s for s, y in held if y]), np.array([s for s, y in held if not y])
    assert len(got) == 1204 and len(held) > 150
    assert (pos[:, None] > neg).mean() > 0.98
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got)
    assert not any(x.held_out for x in got if x.doc_id is None)
    # what is held out has no influence
    flipped = lab.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    assert [(x.doc_id, x.score) for x in ranker.quality_scores(df, flipped).collect()] == [(x.doc_id, x.score) for x in got]
    assert {round(x.score, 3) for x in ranker.quality_scores(df.limit(3), lab.limit(0)).collect()} == {0.5}
    assert ranker.quality_scores(df.limit(0), lab).count() == 0


def test_the_fit_is_bradley_terry_s_optimum():
    """Against the loss written out pair by pair: its gradient is 0 there, and no step from there lowers it."""
    r = np.random.default_rng(3)
    x = r.normal(size=(60, 4))
    good = (x @ [1.0, -2.0, 0.5, 0.0] + r.logistic(size=60) > 0).astype(int)
    pairs = [(i, j) for i in np.flatnonzero(good == 1) for j in np.flatnonzero(good == 0)]
    loss = lambda w: sum(np.log1p(np.exp(-(x[i] - x[j]) @ w)) for i, j in pairs) / len(pairs) + 0.01 * (w @ w) / 2
    d = np.array([x[i] - x[j] for i, j in pairs])
    w = ranker.newton(d, np.ones(len(d)), np.full(4, 0.01))
    for k in range(4):
        e = np.eye(4)[k] * 1e-5
        assert abs(loss(w + e) - loss(w - e)) / 2e-5 < 1e-6
        assert loss(w) < min(loss(w + 100 * e), loss(w - 100 * e))
    # scores rank as the weights over the differences of all pairs do
    model = ranker.fit(x, good, ranker.Params(pairs=20_000))
    s = model.score(x)
    assert np.corrcoef(model.raw(x), x @ w)[0, 1] > 0.99 and ((s[:, None] > s) == (model.raw(x)[:, None] > model.raw(x))).all()
    assert abs(s.mean() - good.mean()) < 0.02


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 1.0])
def test_threshold_is_the_quantile_of_all_scores(spark, share):
    r = random.Random(1)
    scores = sorted([r.random() for _ in range(500)] + [0.25] * 300 + [0.0, 1.0])
    got = ranker.quantile(spark.createDataFrame([(s,) for s in scores], "score double"), share)
    reach = [s for s in scores if s >= got]
    if share:
        assert len(reach) >= share * len(scores) and sum(s >= got + 2**-32 for s in scores) < share * len(scores)
    assert ranker.quantile(spark.createDataFrame([], "score double"), 0.5) == 1.0


def test_repeated_labelled_documents_stay_within_the_sample(spark, monkeypatch):
    seen = []
    fit = ranker.fit
    monkeypatch.setattr(ranker, "fit", lambda x, good, p: seen.append(len(x)) or fit(x, good, p))
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(3, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, quality int")
    assert ranker.quality_scores(docs, labels, ranker.Params(sample=6)).count() == 51 and seen == [6]


# ---- WARC ----


def page_rows():
    r = random.Random(3)
    same = "<p>same</p>" * 3
    rows = [(i, f"http://h/{i}", same if r.random() < 0.4 else None if r.random() < 0.1 else f"<p>{r.random()}é</p>\r\n\r\nx" * r.randint(0, 30)) for i in range(300)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("p", [warc.Params(), warc.Params(shard_bytes=2000, roll_bytes=900, head_bytes=0)])
def test_warc_round_trip_equals_sql(spark, p):
    rows = page_rows()
    got = warc.round_trip(spark.createDataFrame([(*x, 1) for x in rows], "page_id long, url string, html string, shard int"), p)
    assert rows_of(got) == ask(sql.OP6, pages=("page_id BIGINT, url VARCHAR, html VARCHAR", rows))


def test_warc_is_deterministic_and_standard(spark, tmp_path):
    rows = page_rows()
    p = warc.Params(shard_bytes=4000, roll_bytes=1500, head_bytes=0)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    a = warc.write(df, str(tmp_path / "a"), p)
    b = warc.write(df.repartition(7), str(tmp_path / "b"), p)
    assert rows_of(a) == rows_of(b) and a.count() > 3
    for r in a.collect():
        data = (tmp_path / "a" / r.file).read_bytes()
        assert data == (tmp_path / "b" / r.file).read_bytes() and len(data) == r.bytes and hashlib.sha256(data).hexdigest() == r.sha256
        recs = list(warc.members(open(tmp_path / "a" / r.file, "rb"), hashlib.sha256()))
        assert len(recs) == r.records + 1 and all(x.startswith(b"WARC/1.1\r\n") and x.endswith(b"\r\n\r\n") for x in recs)
    assert not [x for x in (tmp_path / "a").iterdir() if x.name.startswith("_")]
    assert warc.read(spark, str(tmp_path / "a")).count() == len(rows)
    (tmp_path / "a" / "part-999999-0000.warc.gz").write_bytes(b"left by a lost attempt, in no manifest")
    assert warc.read(spark, str(tmp_path / "a")).count() == len(rows)
    broken = next((tmp_path / "b").glob("part-000001-*.warc.gz"))
    data = broken.read_bytes()
    # one more member: records and their digests are right, the file's isn't
    broken.write_bytes(data + gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
    with pytest.raises(Exception, match="doesn't match its digest in the manifest"):
        warc.read(spark, str(tmp_path / "b")).collect()
    broken.write_bytes(data[:-9])
    with pytest.raises(Exception):
        warc.read(spark, str(tmp_path / "b")).collect()


def test_warc_ranges_have_no_cap(spark):
    """Ids in 250 clusters far apart, each of them heavy: every page is a shard of its own, and one task writes several."""
    rows = [(i * 10**15 + j, "u", f"{i}.{j}") for i in range(-100, 150) for j in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    p = warc.Params(shard_bytes=1, tasks=7, head_bytes=0)
    assert warc.ranges(warc.sized(df), p).tolist() == [x for x, _, _ in rows]
    got = warc.round_trip(df, p)
    assert sorted(r.page_id for r in got.collect()) == [x for x, _, _ in rows]
    big = warc.Params(shard_bytes=40, head_bytes=0)
    begins = warc.ranges(warc.sized(df), big)
    ends = [*begins[1:], 10**18]
    assert max(sum(len(h) for x, _, h in rows if a <= x < z) for a, z in zip(begins, ends)) < 40 + max(len(h) for _, _, h in rows) and len(begins) < 120


def test_warc_has_a_million_shards_in_seconds(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("page_id"), F.lit(1).alias("bytes"))
    began = time.time()
    assert (warc.ranges(df, warc.Params(shard_bytes=1, head_bytes=0)) == np.arange(1_000_000)).all() and time.time() - began < 60
    few = warc.ranges(df.withColumn("bytes", F.lit(0)), warc.Params())  # empty payloads have headers too
    assert len(few) == -(-1_000_000 * 512 // (64 << 20))


@pytest.mark.parametrize("alike", [False, True])
def test_pages_without_id_are_spread(spark, tmp_path, alike):
    rows = [(None if i % 2 else i, "u", "same payload" if alike else f"payload {i}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    m = warc.write(df, str(tmp_path / "w"), warc.Params(shard_bytes=1 << 20)).groupBy("shard").agg(F.sum("records").alias("n")).collect()
    assert sum(r.n for r in m) == 20_000 and len(m) >= 10 and max(r.n for r in m) < 5000
    got = warc.read(spark, str(tmp_path / "w"))
    assert got.where("page_id is null and record_type = 'response'").count() == 10_000
    assert got.where("record_type = 'revisit'").count() == (9_999 if alike else 0)


def test_warc_of_odd_tables(spark):
    rows = [(None, "u", "a"), (1, None, "a"), (2, "u\nv", "a"), (2, "w", "a"), (3, "u", "a"), (5, "u", None), (4, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()]
    assert sorted(got, key=str) == sorted([(None, "response", None), (1, "revisit", 3), (2, "revisit", 3), (2, "revisit", 3), (3, "response", None), (5, "response", None), (4, "revisit", 5)], key=str)
    assert {r.record_type for r in warc.round_trip(df, warc.Params(least_bytes=2)).collect()} == {"response"}
    assert warc.round_trip(df.limit(0)).count() == 0
    assert warc.bare_digest(b"") == base64.b32encode(hashlib.sha1(b"").digest()).decode()


# ---- token scan ----


def test_scan_stitches_any_blocks(spark, tmp_path):
    r = random.Random(8)
    end, want, files = 7, [], []
    for f in range(4):
        counts = [r.choice([0, 0, 1, 3, 40, 200]) for _ in range(r.randint(1, 30))]
        last = r.choice([0, 5])
        ids = [x for c in counts for x in [1] * c + [end]] + [1] * last
        np.array(ids, "<u2").tofile(tmp_path / f"f{f}")
        files.append((f"f{f}", len(ids) * 2))
        want += [(f"f{f}", c, i) for i, c in enumerate(counts + [last] * (last > 0))]
    for block in (2, 6, 50, 1000, 1 << 20):
        got = token_scan.scan(spark, str(tmp_path), spark.createDataFrame(files, "file string, bytes long"), token_scan.Params(end=end, block=block))
        assert sorted((x.file, x.n_tokens, x.ordinal) for x in got.collect()) == sorted(want), block


def test_token_counts_equal_the_tokenizer(spark):
    texts = [(1, "Hello, world!"), (2, None), (3, ""), (None, "don't <|endoftext|> stop"), (4, "ünï " * 500), (4, "twice"), (5, "\n\n x")]
    got = token_scan.token_counts(spark.createDataFrame([(d, t, "f") for d, t in texts], "doc_id long, text string, file string"), token_scan.Params(block=64))
    enc = token_scan.encoding(token_scan.Params().vocabulary)
    assert sorted(((x.doc_id, x.n_tokens) for x in got.collect()), key=str) == sorted(((d, len(enc.encode_ordinary(t or ""))) for d, t in texts), key=str)
    assert token_scan.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_runs_of_white_space(spark):
    r = random.Random(12)
    enc, p = token_scan.encoding(token_scan.Params().vocabulary), token_scan.Params(run=4)
    for _ in range(2000):
        t = "".join(r.choice([" ", "\n", "\t", "\u3000", "\xa0", "\x1c", "a", "é!", "'s", "7"]) * r.choice([1, 1, 1, 3, 4, 9]) for _ in range(r.randint(0, 9)))
        assert token_scan.encoded(t, p) == enc.encode_ordinary(t), repr(t)
    rows = [(1, " " * 1_000_000), (2, "a" + "\n" * 500_000 + "b"), (3, "a" * 300_000)]
    got = {x.doc_id: x.n_tokens for x in token_scan.token_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {1, 2, 3} and min(got.values()) > 1000


def test_identifiers_that_do_not_fit_are_refused(tmp_path):
    for n, p in ((70_000, {"width": 2, "end": 5}), (300, {"width": 2, "end": 299}), (10, {"width": 2, "end": 65_536})):
        v = tmp_path / f"v{n}{p['end']}"
        v.write_bytes(b"".join(base64.b64encode(i.to_bytes(3, "big")) + b" %d\n" % i for i in range(n)))
        with pytest.raises(ValueError):
            token_scan.encoded("x", token_scan.Params(vocabulary=str(v), **p))


# ---- mixing ----


def mix_rows(n=400):
    r = random.Random(6)
    w = lambda: r.choice(["word", "###", "42", "é", "Court", "team", "SCORE", "server;", "plain", "text", "more"])
    return [(d, " ".join(w() for _ in range(r.choice([0, 1, 5, 150, 1200]))), r.choice(["en", "de", None]), r.choice(["a"] * 6 + ["b", "c", None])) for d in range(n)]


@pytest.mark.parametrize("share", [0.2, 0.8, 1.0])
def test_mixture_equals_sql_and_draws_its_share(spark, share):
    rows, p = mix_rows(), mixing.Params(share=share)
    df = spark.createDataFrame([(*x, 1.0) for x in rows], "doc_id long, text string, lang string, source string, weight double")
    got = mixing.mixture(df, p)
    q = "WITH " + mixing.sql("documents", p) + " SELECT doc_id, _source AS source, _lang AS lang, _topic AS topic, _tokens AS n_tokens, weight, prob, kept FROM mixture"
    assert rows_of(got) == ask(q, documents=("doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR", rows))
    assert len({x.topic for x in got.collect()}) > 4
    expected = sum(x.n_tokens * x.prob for x in got.collect()) / sum(x.n_tokens for x in got.collect())
    assert abs(expected - share) < 0.01


@pytest.mark.parametrize("share,held", [(0.05, 50_000), (0.3, 50_000), (0.3, 0)])
def test_margins_meet_their_targets(spark, share, held):
    r = random.Random(2)
    rows = [(d, "w " * r.randint(1, 300), r.choice(["en"] * 5 + ["de"]), r.choice(["a"] * 9 + ["b", "c"]), r.choice("xyz")) for d in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    p = mixing.Params(share=share, held=held)
    docs = mixing.mixture(df, p).toPandas()
    docs["drawn"] = docs.n_tokens * docs.prob
    got = {(x.dimension, x.value): x for x in mixing.margins(df, p).collect()}
    for d in mixing.DIMS:
        had, drawn = docs.groupby(d).n_tokens.sum() / docs.n_tokens.sum(), docs.groupby(d).drawn.sum() / docs.drawn.sum()
        want = had ** p.power[d] / (had ** p.power[d]).sum()
        for v in had.index:
            assert np.allclose([got[d, v].had, got[d, v].drawn], [had[v], drawn[v]], atol=1e-4)
            assert abs(got[d, v].drawn - got[d, v].target) < 1e-3
            if (want * share < had).all():  # nobody has to give all
                assert abs(got[d, v].target - want[v]) < 1e-6
    assert len(got) == sum(docs[d].nunique() for d in mixing.DIMS) and mixing.margins(df.limit(0), p).count() == 0


def test_no_target_is_over_what_there_is(spark):
    rows = [(d, "w " * 100, "en", "a" if d < 980 else "b") for d in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x.value: x for x in mixing.margins(df, mixing.Params(share=0.5, power={"source": 0, "lang": 1, "topic": 1})).collect()}
    assert abs(got["b"].target - 0.04) < 1e-6 and abs(got["b"].drawn - 0.04) < 1e-6 and abs(got["a"].drawn - 0.96) < 1e-6


def test_topics_come_from_keywords(spark):
    texts = ["The COURT held the contract void, said the team", "team, player; coach", "nothing here", "### ** $ % ok", "12 34 56", None, "", "courts teams", "patient/doctor data"]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {x.doc_id: x.topic for x in mixing.mixture(df).collect()}
    assert [got[i] for i in range(9)] == ["law", "sport", "general", "listing", "figures", "general", "general", "general", "health"]


def test_mixture_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "a", "en", "s"), (1, "a", "en", "s"), (None, None, None, None)], "doc_id long, text string, lang string, source string")
    assert mixing.mixture(df).count() == 3 and mixing.mixed(df, mixing.Params(share=1.0)).columns == df.columns
    assert mixing.mixed(df, mixing.Params(share=1.0)).count() == 3
    assert mixing.mixture(df.limit(0)).count() == 0
    given = mixing.Params(share=0.5, targets={"source": {"s": 1.0}})
    assert {x.doc_id: x.prob for x in mixing.mixture(df, given).collect()}[None] == 0
    assert rows_of(mixing.mixture(df, mixing.Params(held=0))) == rows_of(mixing.mixture(df))


def test_any_column_names_pass_through_the_stages(spark):
    from corvane.llm import bwt_dedup, decontam, near_dedup, quality_rules

    text = " ".join(f"word{i}" for i in range(60))
    names = ["doc_id", "text", "lang", "source", "mix_source", "_mix_tokens", "row_", "a.b", "c0", "_g", "n`x", "Mix_prob", "_kept", "topic2"]
    rows = [(1, text, "en", "s", *["v"] * 10), (2, text.replace("word7 ", "other "), "en", "s", *["w"] * 10)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n.replace('`', '``')}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for got in (mixing.mixed(df, mixing.Params(share=1.0)), quality_rules.passing(df), decontam.clean(df, bench), decontam.clean(df, bench, decontam.Params(held_words=0)), near_dedup.representatives(df), bwt_dedup.without_repeats(df)):
        assert got.columns == names and (1, text, "en", "s", *["v"] * 10) in [tuple(r) for r in got.collect()]


# ---- chat ----


def test_chats_equal_sql(spark):
    r = random.Random(9)
    rows = [(c, k, r.choice(["user", "assistant", "system", "tool"]), r.choice(["hi", 'é "q"\n\\', "", None])) for c in range(30) for k in range(r.randint(1, 40))]
    rows += [(2, 0, "user", "again"), (99, 5, "assistant", "alone")]
    got = chat.format_chats(chat.as_messages(spark.createDataFrame([(*x, "k") for x in rows], "conv_id long, turn long, role string, text string, kind string")), chat.ASK)
    assert rows_of(got) == ask(sql.OP1, conversations=("conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", rows))


SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", False), "c": ("array", False)}, "say": {"t": ("string", True), "o": ("object", False), "f": ("boolean", False)}}


def test_arguments_and_canonical_json(spark):
    cases = [("add", '{"b": 1.5, "a": 2}', None), ("add", '{"a": "2"}', "a is no integer"), ("add", '{"b": 1}', "a is missing"), ("add", '{"a": null}', "a is missing"), ("add", '{"a": 1, "z": 1}', "unknown field"), ("add", "[1]", "not a JSON object"), ("add", "{bad", "not a JSON object"), ("add", None, "no arguments"), ("say", '{"t": "x", "o": {"y": 1, "b": [2]}, "f": true}', None), ("say", '{"t": "x", "f": 1}', "f is no boolean"), ("add", '{"a": 1, "c": 3}', "c is no array"), ("fly", "{}", "unknown tool"), (None, "{}", "unknown tool")]
    rows = []
    for i, (tool, args, _) in enumerate(cases):
        rows += [(1, 2 * i, "assistant", None, "call", f"c{i}", tool, args, None), (1, 2 * i + 1, "tool", "done", "result", f"c{i}", None, None, None)]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kind string, call_id string, tool string, arguments string, after string")
    got = {r.turn: r for r in chat.format_chats(m, SCHEMAS).collect()}
    assert [got[2 * i].error for i in range(len(cases))] == [e for _, _, e in cases]
    assert got[0].json == '{"arguments":{"a":2,"b":1.5},"call_id":"c0","role":"assistant","tool":"add"}'
    for r in got.values():
        assert list(json.loads(r.json)) == sorted(json.loads(r.json))


def test_equal_numbers_are_written_alike(spark):
    alike = [["100", "1e2", "100.0", "1E+2", "1.00e2", "10000e-2"], ["10000000000000000000000000", "1e25", "1.0e25"], ["0.1", "1e-1", "0.10"], ["0", "-0", "0e5", "-0.0", "0.0"], ["0.00000000000000000001", "1e-20"], ["-1500", "-1.5e3"], ["1" + "0" * 40, "1e40"]]
    texts = [f'{{"b":[{x},"1e2 \\" 3e1"],"a":{x}}}' for group in alike for x in group] + ["01e2", '{"a":1e2', '{"a":"1e2}', '{"a":1e2e3}', "1e400", "-1" + "0" * 400, None, '{"a":"' + r"\\\"" * 50_000 + '1e2"}']
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, j string").coalesce(1).select(chat.canonical(F.col("j")), "i").orderBy("i").collect()]
    for group in alike:
        mine, got = got[: len(group)], got[len(group) :]
        assert len(set(mine)) == 1 and float(json.loads(mine[0])["a"]) == float(group[0]) and json.loads(mine[0])["b"][1] == '1e2 " 3e1', (group, mine)
    assert got[:7] == [None] * 7 and json.loads(got[7]) == json.loads(texts[-1])
    cases = [("1e2", None, "100"), ("100.0", None, "100"), ("12345678901234567890", None, "12345678901234567890"), ("1.5", "a is no integer", "1.5"), ("15e-1", "a is no integer", "1.5"), ("1e400", "a number is out of range", None)]
    rows = [x for i, (a, _, _) in enumerate(cases) for x in ((1, 2 * i, "assistant", None, "call", f"c{i}", "add", f'{{"a": {a}}}', None), (1, 2 * i + 1, "tool", None, "result", f"c{i}", None, None, None))]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kind string, call_id string, tool string, arguments string, after string")
    out = {r.turn: r for r in chat.format_chats(m, SCHEMAS).collect()}
    for i, (_, error, written) in enumerate(cases):
        assert out[2 * i].error == error and out[2 * i].json.startswith(f'{{"arguments":{{"a":{written}}},' if written else '{"call_id"'), out[2 * i]


def test_order_follows_dependencies_and_marks_circles(spark):
    call = lambda t, i, after=None: (1, t, "assistant", "", "call", i, "add", '{"a": 1}', after)
    result = lambda t, i: (1, t, "tool", "", "result", i, None, None, None)
    n = 50
    rows = [x for i in range(n) for x in (call(1000 - 10 * i, f"k{i}", f"k{i - 1}" if i else None), result(1001 - 10 * i, f"k{i}"))]
    rows += [call(1, "p", "q"), result(2, "p"), call(3, "q", "p"), result(4, "q"), call(5, "r", "gone"), result(6, "z"), (None, 1, "user", "x", "call", "n", "add", None, None), call(7, "self", "self"), result(8, "self")]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kind string, call_id string, tool string, arguments string, after string")
    got = chat.format_chats(m, SCHEMAS).collect()
    depth = {(r.call_id, r.kind): r.depth for r in got if r.call_id}
    assert all(depth[f"k{i}", "call"] == 2 * i and depth[f"k{i}", "result"] == 2 * i + 1 for i in range(n))
    errors = {(r.call_id, r.kind): r.error for r in got if r.call_id}
    assert {errors[x, "call"] for x in "pq"} == {"circular"} and errors["self", "call"] == "circular"
    assert errors["r", "call"] == "no result" and errors["z", "result"] == "no call" and errors["k0", "call"] is None
    assert chat.format_chats(m.limit(0), SCHEMAS).count() == 0
    # positions: every message after all it depends on, those without depth last, and no gap, though several tasks hold the conversation
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)
    assert [r.position for r in one] == list(range(len(one))) and [r.depth is None for r in one] == sorted(r.depth is None for r in one)
    at = {(r.call_id, r.kind): r.position for r in one if r.depth is not None}
    assert all(at[f"k{i}", "call"] < at[f"k{i}", "result"] for i in range(n)) and all(at[f"k{i}", "result"] < at[f"k{i + 1}", "call"] for i in range(n - 1))


def test_turns_keep_their_order_where_they_fulfil_dependencies(spark):
    schema = "conv_id long, turn long, role string, text string, kind string, call_id string, tool string, arguments string, after string"
    call = lambda t, i, after=None: (1, t, "assistant", "", "call", i, "add", '{"a": 1}', after)
    result = lambda t, i: (1, t, "tool", "", "result", i, None, None, None)
    plain = lambda t, role: (1, t, role, "x", None, None, None, None, None)
    rows = [plain(0, "user"), call(1, "a"), result(2, "a"), plain(3, "assistant"), plain(4, "user"), call(5, "b"), result(6, "b")]
    order = lambda rows: [r.turn for r in sorted(chat.format_chats(spark.createDataFrame(rows, schema), SCHEMAS).collect(), key=lambda r: r.position)]
    assert order(rows) == [0, 1, 2, 3, 4, 5, 6]
    # a result before its call moves behind it, what depends on it too, and nothing else moves
    assert order([plain(0, "user"), result(1, "a"), plain(2, "user"), call(3, "a"), call(2, "b", "a"), result(4, "b"), plain(5, "user")]) == [0, 2, 3, 1, 2, 4, 5]


def test_fields_with_odd_names_are_checked(spark):
    schema = {"t": {"a.b": ("integer", True), "it's": ("string", True)}}
    rows = [(1, 0, "", "", "call", "x", "t", '{"a.b": 1, "it\'s": "y"}', None), (1, 1, "", "", "result", "x", None, None, None), (1, 2, "", "", "call", "y", "t", '{"a": {"b": 1}, "it\'s": "y"}', None), (1, 3, "", "", "result", "y", None, None, None)]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kind string, call_id string, tool string, arguments string, after string")
    assert {r.turn: r.error for r in chat.format_chats(m, schema).collect()} == {0: None, 1: None, 2: "a.b is missing", 3: None}


def test_the_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch, tmp_path):
    from types import SimpleNamespace

    from corvane.llm import common

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://x:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(fake)
    with common.passing() as folders:
        a, b = common.new_folder(spark, "a"), common.new_folder(spark, "b")
        for x in (a, b):
            spark.range(1).write.parquet(x)
        folders.remove(b)
    assert spark.read.parquet(b).count() == 1
    with pytest.raises(Exception):
        spark.read.parquet(a)


def test_passing_leaves_what_others_read(spark):
    from corvane.llm import bwt_dedup, common

    docs = spark.createDataFrame([(i, f"a text of its own, number {i}, and a passage that comes again in every text of this table, word for word") for i in range(40)], "doc_id long, text string")
    lazy = bwt_dedup.substring_dedup(docs)
    before = sorted(map(tuple, lazy.collect()))
    with common.passing():
        assert bwt_dedup.substring_dedup(docs).count() == 40
    assert sorted(map(tuple, lazy.collect())) == before


def test_very_long_texts(spark):
    from corvane.llm import decontam, near_dedup, quality_rules

    r = random.Random(21)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(120_000)]
    long = " ".join(words)
    rows = [(1, long, "en", "s"), (2, long + " more", "en", "s"), (3, "short text", "en", "s"), (4, "x" * 2_000_000, "en", "s"), (5, ". " * 300_000, "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    near = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dedup.near_duplicates(df).collect()}
    assert near == {1: (119_998, 1), 2: (119_999, 1), 3: (1, 3), 4: (1, 4), 5: (1, 5)}
    bench = spark.createDataFrame([(7, " ".join(words[100_000:106_500]))], "item_id long, text string")
    for p in (decontam.Params(), decontam.Params(held_words=0)):
        got = {x.doc_id: (x.n_words, x.n_hit, x.contaminated) for x in decontam.decontaminate(df, bench, p).collect()}
        assert got == {1: (120_000, 6500, True), 2: (120_001, 6500, True), 3: (2, 0, False), 4: (1, 0, False), 5: (0, 0, False)}
    assert ranker.quality_scores(df, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")).where("score between 0 and 1").count() == 5
    assert {x.doc_id: x.n_tokens for x in mixing.mixture(df).collect()} == {1: 120_000, 2: 120_001, 3: 2, 4: 1, 5: 300_000}
    spans = {x.doc_id: (x.n_words, x.n_words_removed) for x in sentence_dedup.sentence_dedup(df).collect()}
    assert {d: n for d, (n, _) in spans.items()} == {1: 120_000, 2: 120_001, 3: 2, 4: 1, 5: 300_000}
    assert spans[2][1] > 119_900 and [spans[d][1] for d in (1, 3, 4)] == [0, 0, 0] and spans[5][1] > 299_000
    assert {x.doc_id: x.kept for x in quality_rules.quality_rules(df).collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    pages = df.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    assert {x.page_id: x.payload_bytes for x in warc.round_trip(pages, warc.Params(shard_bytes=1000, roll_bytes=500)).collect()} == {d: len(t) for d, t, *_ in rows}
    chats = df.select(F.lit(1).cast("bigint").alias("conv_id"), F.col("doc_id").alias("turn"), F.when(F.col("doc_id") % 2 == 1, "user").otherwise("assistant").alias("role"), "text")
    assert chat.format_chats(chat.as_messages(chats), chat.ASK).where("linked and length(json) >= 10").count() == 4
