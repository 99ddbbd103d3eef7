"""Importance resampling against a plain version of its definition."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from corvane.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, rank string, score string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text, grams):
    w = WORD.findall(lower(text))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, grams + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, p):
    bucket = lambda f: zlib.crc32(f.encode()) % p.buckets
    src, aim = Counter(), Counter()
    for _, text in docs:
        src.update(map(bucket, features(text, p.grams)[1]))
    for text in target:
        aim.update(map(bucket, features(text, p.grams)[1]))
    s_all, t_all = sum(src.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + p.buckets) / ((src[b] + 1) * (t_all + p.buckets))))
    rows = []
    for doc, text in docs:
        n, f = features(text, p.grams)
        weight = sum(gain(bucket(x)) for x in f)
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"{p.seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, n, len(f), weight, score, None])
    able = sorted((r for r in rows if r[1] >= p.min_words and r[4] is not None), key=lambda r: (-r[4], r[0]))
    for i, r in enumerate(able[: p.pct * len(able) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, rows), key=repr)


DOCS = [(i, " ".join(f"Word{(i * j) % 37} é{j % 5}" for j in range(i % 40))) for i in range(300)] + [
    (900, None), (901, ""), (902, "!!! ---"), (None, "some words " * 30), (903, "LONG tail, " * 40_000), (904, "0aZ ÀÉ\x00b " * 20), (5, "again " * 25), (5, "again " * 25),
]
TARGET = ["Word1 word2 é1 again", None, "", "Word7 " * 50]


@pytest.mark.parametrize("p", [importance.Params(), importance.Params(grams=2, buckets=97, min_words=3, pct=40)])
def test_as_defined(spark, p):
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in DOCS], SCHEMA).repartition(5)
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, doc_id int")
    got = sorted((tuple(r) for r in importance.resample(docs, target, p).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)
    want = plain(DOCS, TARGET, p)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    # the copies of doc_id 5 may stand in either order
    assert sorted((x for x in got if x[5]), key=lambda x: x[5]) == sorted((x for x in want if x[5]), key=lambda x: x[5])


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(DOCS[:50], "doc_id bigint, text string"), spark.createDataFrame([], "doc_id bigint, text string")
    assert importance.resample(none, docs).collect() == []
    assert importance.resample(docs, none).count() == 50
    assert importance.sample(none, none).count() == 0


def test_sample_keeps_columns(spark):
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in DOCS], SCHEMA)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    drawn = importance.sample(docs, target)
    ids = {r["doc_id"] for r in importance.resample(docs, target).where("rank is not null").collect()}
    assert drawn.columns == docs.columns and {r["doc_id"] for r in drawn.collect()} == ids
