"""The pipeline's stages against brute force, one after another on what the one before kept."""

import random

import duckdb
import pytest

import corpus_pipeline
from corvane.llm import mixing
from tests.llm.test_decontam import brute as contamination
from tests.llm.test_near_dedup import brute as components
from tests.llm.test_quality_rules import brute as judged


def tables(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghé") for _ in range(r.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, text(30)) for i in range(8)]
    passage = text(40)
    docs = []
    for d in range(120):
        t = text(r.randint(15, 120))
        kind = r.random()
        if kind < 0.15:
            t += " " + r.choice(bench)[1]
        elif kind < 0.3:
            t += "\n" + passage
        elif kind < 0.45 and docs:
            w = r.choice(docs)[1].split(" ")
            w[r.randrange(len(w))] = word()
            t = " ".join(w)
        elif kind < 0.5:
            t = (word() + " ") * 60
        docs.append((d, t, r.choice(["en", "de", "fr"]), r.choice(["a", "a", "a", "b", "c"]), len(t)))
    return docs + [(200, None, "en", "a", None), (201, "", "en", None, 0), (202, docs[0][1], None, "b", 1)], bench


def cut_out(docs, width=50):
    least = {}
    for d, t, *_ in docs:
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            least[b[i : i + width]] = min(d, least.get(b[i : i + width], d))
    out = []
    for d, t, lang, source, n in docs:
        b = (t or "").encode()
        go = [False] * len(b)
        for i in range(len(b) - width + 1):
            if least[b[i : i + width]] < d:
                go[i : i + width] = [True] * width
        if any(go):
            t = bytes(x for x, g in zip(b, go) if not g).decode("utf-8", "ignore")
            n = len(t)
            if not t:
                continue
        out.append((d, t, lang, source, n))
    return out


@pytest.mark.parametrize("seed", [1])
def test_stages_equal_brute_force(spark, tmp_path, seed):
    docs, bench = tables(seed)
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, ddl).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = [[x for x in docs if judged(x[1])[6]]]
    keep = {c[0] for c in components([(x[0], x[1]) for x in want[-1]], 5, 80) if c[3]}
    want.append([x for x in want[-1] if x[0] in keep])
    want.append(cut_out(want[-1]))
    bad = {c[0] for c in contamination([(x[0], x[1]) for x in want[-1]], bench) if c[-1]}
    want.append([x for x in want[-1] if x[0] not in bad])
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", want[-1])
    drawn = {x[0] for x in con.execute("WITH " + mixing.sql("documents", mixing.Params(share=0.8)) + " SELECT doc_id FROM mixture WHERE kept").fetchall()}
    want.append([x for x in want[-1] if x[0] in drawn])
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, stage), rows in zip(corpus_pipeline.STAGES, want):
        out = str(tmp_path / name)
        stage(spark, df, str(tmp_path)).write.parquet(out)
        df = spark.read.parquet(out)
        assert sorted(map(tuple, df.collect()), key=str) == sorted(rows, key=str), name
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [len(x) for x in want] == sorted((len(x) for x in want), reverse=True) and 10 < len(want[-1]) < len(docs) - 30
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str) == sorted(want[-1], key=str)


def test_empty_documents(spark, tmp_path):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], ddl).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
