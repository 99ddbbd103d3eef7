import hashlib
import random

import numpy as np
import pytest

from corvane.llm import bwt_dedup as B

SMALL = B.Params(shard_bytes=300, bucket_bytes=2000, piece=64)


def brute(rows, width=50):
    least = {}
    data = [(i, d, (t or "").encode()) for i, (d, t) in enumerate(rows)]
    for _, d, b in data:
        if d is not None:
            for i in range(len(b) - width + 1):
                w = b[i : i + width]
                least[w] = min(d, least.get(w, d))
    out = []
    for _, d, b in data:
        go = [False] * len(b)
        if d is not None:
            for i in range(len(b) - width + 1):
                if least[b[i : i + width]] < d:
                    go[i : i + width] = [True] * width
        kept = bytes(x for x, g in zip(b, go) if not g)
        spans = sum(g and not (i and go[i - 1]) for i, g in enumerate(go))
        out.append((d, len(b), sum(go), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randint(2, 7)))
    passages = ["".join(word() + " " for _ in range(r.randint(8, 30))) for _ in range(5)]
    rows = []
    for d in range(n):
        t = "".join(word() + " " for _ in range(r.randint(0, 40)))
        if r.random() < 0.6:
            x = r.choice(passages)
            a = r.randint(0, len(x) // 2)
            t = t[: len(t) // 2] + x[a:] + t[len(t) // 2 :]
        if r.random() < 0.2 and rows:
            t = list(r.choice(rows)[1] or "")
            for _ in range(r.randint(0, 2)):
                if t:
                    t[r.randrange(len(t))] = "#"
            t = "".join(t)
        if r.random() < 0.1:
            t = "ab" * r.randint(20, 300)
        rows.append((d, t))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_window_minima_equal_brute_force(seed):
    r = random.Random(seed)
    base = bytes(r.choice(b"ab") for _ in range(400))
    contexts = list({base[a : a + 50 + r.randint(0, 40)] for a in (r.randint(0, 300) for _ in range(60))} | {bytes(r.choice(b"abc") for _ in range(60)) for _ in range(5)})
    windows = np.array([len(c) - 49 for c in contexts])
    docs = np.array([r.randint(0, 9) for _ in contexts])
    got = B.window_minima(contexts, windows, docs, SMALL)
    least = {}
    for c, d in zip(contexts, docs):
        for i in range(len(c) - 49):
            least[c[i : i + 50]] = min(d, least.get(c[i : i + 50], 99))
    assert got.tolist() == [least[c[i : i + 50]] for c in contexts for i in range(len(c) - 49)]


def test_merged_transform_is_the_sorted_one():
    r = random.Random(3)
    contexts = sorted({bytes(r.choice(b"ab") for _ in range(r.randint(50, 70))) for _ in range(40)})
    parts = [B.Shard(contexts[i::3]) for i in range(3)]
    z, lcp = B.interleaved([s.bwt for s in parts], 50)
    names = [[contexts[i::3][s][o:] for s, o in zip(p.string, p.offset)] for i, p in enumerate(parts)]
    at = [iter(x) for x in names]
    merged = [next(at[k]) + bytes([255]) * 50 for k in z]
    assert [x[:50] for x in merged] == sorted(x[:50] for x in merged)
    for i in range(1, len(merged)):
        if 255 in merged[i][:50] or 255 in merged[i - 1][:50]:
            continue
        common = next((j for j in range(50) if merged[i][j] != merged[i - 1][j]), 50)
        assert lcp[i] == (common if common == 50 else common // 4 * 4)


@pytest.mark.parametrize("seed,params", [(1, SMALL), (2, SMALL), (3, B.Params(hot=2, shard_bytes=500)), (4, B.Params()), (5, B.Params(hot=12, bucket_bytes=500, most=3))])
def test_whole_operator_equals_brute_force(spark, seed, params):
    rows = corpus(seed)
    got = B.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), params)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_nulls_ties_empties_and_clashing_columns(spark):
    x = "a passage that is long enough to be removed wherever it occurs again, whatever"
    rows = [(1, x), (1, x), (2, x + "!"), (3, None), (None, x), (4, ""), (5, "ünïcödé " + x[:60]), (2, x + "!"), (6, "ab" * 80)]
    df = spark.createDataFrame([(d, t, 0, "b", 7, "c") for d, t in rows], "doc_id long, text string, spans int, sha string, bucket int, copy string")
    got = B.substring_dedup(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert B.substring_dedup(df.limit(0)).count() == 0
    left = B.without_repeats(df.select("doc_id", "text", "sha"))
    assert left.columns == ["doc_id", "text", "sha"]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(1, x), (1, x), (2, "!"), (2, "!"), (3, None), (None, x), (4, ""), (5, "ünïcödé "), (6, "ab" * 80)], key=str) 


@pytest.mark.parametrize("params", [B.Params(), B.Params(hot=2, bucket_bytes=200, most=2)])
def test_rows_of_a_doc_id_lose_their_own_bytes_only(spark, params):
    r = random.Random(9)
    p, q, x = ("".join(r.choice("abcdefgh ") for _ in range(120)) for _ in range(3))
    rows = [(1, p), (2, p + " tail"), (2, q), (2, q + p), (3, q), (3, x + p[:70]), (3, p[:70] + x), (4, x), (4, x), (5, p), (5, q[:60] + x)]
    for t in (rows, rows[::-1]):
        got = B.substring_dedup(spark.createDataFrame(t, "doc_id long, text string"), params)
        assert sorted((tuple(y) for y in got.collect()), key=str) == brute(t)


def test_more_buckets_than_a_table_can_have(spark):
    """100,000 is the most that bucketBy takes."""
    rows = corpus(6, 12)
    got = B.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), B.Params(bucket_bytes=1, groups=40, most=4)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("corvane_")]


def test_long_texts(spark):
    r = random.Random(11)
    long = "".join(r.choice("abcdefghijk \n") for _ in range(400_000))
    rows = [(1, long), (2, "x" * 200_000), (3, long[1000:1200] + "é" * 100), (4, "y" + long[:300_000])]
    got = {x.doc_id: x.n_removed for x in B.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), B.Params(piece=50_000)).collect()}
    assert got == {1: 0, 2: 0, 3: 200, 4: 300_000}


def test_summaries_keep_what_is_frequent():
    r = np.random.default_rng(1)
    parts = [r.integers(0, 10**6, 300_000).astype(np.uint64) for _ in range(30)] + [np.full(50_000, 7, np.uint64)] * 4
    r.shuffle(parts)
    f, n = B.summary(iter(parts), 10_000)
    total = sum(map(len, parts))
    assert len(f) <= 10_000 and 200_000 - total / 5000 <= int(n[f == 7][0]) <= 200_100
