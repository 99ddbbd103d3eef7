"""Language identification: held-out accuracy and calibration, sparsity, odd inputs."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from corvane.llm import langid

LARGER = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(LARGER)
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.97
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]
    assert got.score.between(0, 1).all() and abs(held.score.mean() - (held.lang == held.lang_pred).mean()) < 0.05


def test_labels_of_the_held_out_dont_matter(spark):
    docs = spark.read.parquet(LARGER).limit(300).cache()
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "xx").otherwise(F.col("lang")))
    rows = lambda d: sorted(map(tuple, langid.identify(d).collect()))
    assert rows(docs) == rows(other.repartition(3))
    assert "xx" not in {r[2] for r in rows(other)}
    docs.unpersist()


def test_odd_inputs(spark):
    words = {"aa": "dolor amet lirum larum ", "bb": "kjxq zzyk qqwx vvkz "}
    rows = [(i, words["aa" if i % 2 else "bb"] * 3, "aa" if i % 2 else "bb", 0.5) for i in range(60)]
    odd = [(100, None, "aa", 0.0), (101, "", None, 0.0), (102, "123 --- ²", "bb", 0.0), (None, "dolor amet", "cc", 0.0), (103, "LARUM Dolor", None, 0.0), (104, "zzyk " * 300_000, "bb", 0.0), (105, "é", None, 0.0), (105, "é", None, 0.0)]
    out = langid.identify(spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score double").repartition(4))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert len(got) == len(rows) + len(odd)
    of = {r[0]: r for r in got}
    assert [of[i][2:] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert of[None][1:3] == (False, "aa") and of[103][2] == "aa" and of[104][2] == "bb" and of[105][2] in ("aa", "bb")
    assert all(of[i][2] == ("aa" if i % 2 else "bb") for i in range(60))


def test_nothing_to_learn(spark):
    schema = "doc_id bigint, text string, lang string"
    assert langid.identify(spark.createDataFrame([], schema)).collect() == []
    alone = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5]
    assert {(r[2], r[3]) for r in langid.identify(spark.createDataFrame([(i, "words", None) for i in alone], schema)).collect()} == {("und", 0.0)}
    assert {(r[2], r[3]) for r in langid.identify(spark.createDataFrame([(i, "words", "zz") for i in alone], schema)).collect()} == {("zz", 1.0)}


def test_blocks_dont_change_counts(monkeypatch):
    p, text = langid.Params(), langid.letters("Ein Satz, 12 Wörter; ещё слова " * 50)
    whole = langid.counts(text, p)
    for size in (1, 2, 3, 7, 100):
        monkeypatch.setattr(langid, "BLOCK", size)
        assert (langid.counts(text, p) == whole).all()
    assert whole.sum() == 3 * len(text) - 3


def test_ngrams_by_hand():
    assert "".join(map(chr, langid.letters("  ÀB-c1d\t²!"))) in (" àb c d ", " àb c d ² ")
    assert len(langid.letters("12 .,²")) == 0 and len(langid.letters(None)) == 0


def test_elastic_net_makes_weights_sparse():
    r = np.random.default_rng(1)
    p = langid.Params(buckets=1 << 10)
    rows = [(np.sort(r.choice(1024, 40, replace=False)), np.full(40, 40**-0.5)) for _ in range(300)]
    y = np.array([int((at < 512).sum() > 20) for at, _ in rows])
    free, _ = langid.ftrl(rows, y, 2, langid.Params(buckets=1 << 10, l1=0.0, l2=0.0))
    w, _ = langid.ftrl(rows, y, 2, langid.Params(buckets=1 << 10, l1=1.0))
    assert (w != 0).mean() < (free != 0).mean() / 2
    assert np.abs(langid.ftrl(rows, y, 2, langid.Params(buckets=1 << 10, l1=0.0, l2=10.0))[0]).sum() < np.abs(free).sum()
    assert p.buckets == 1024


def test_temperature_recovers_a_known_one():
    r = np.random.default_rng(2)
    logits = r.standard_normal((20_000, 3)) * 2
    y = np.array([r.choice(3, p=q) for q in langid.softmax(logits)])
    assert abs(langid.temperature(logits * 3, y, np.ones(len(y))) - 3) < 0.15
    assert langid.temperature(np.zeros((0, 3)), np.zeros(0, int), np.zeros(0)) == 1.0
