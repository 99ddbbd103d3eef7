"""Importance resampling towards a target distribution: hashed n-gram counts, gains by bucket, a draw without replacement by Gumbel keys.

Two passes in Arrow batches over the documents:

1. Each task counts its features by bucket (np.bincount) in one vector of `buckets` numbers; treeReduce merges the vectors. The target's
   texts are counted likewise. Nothing but such vectors reaches the driver.
2. The gain of a bucket, a floored log ratio of both smoothed distributions, goes to the tasks as a broadcast vector (of fixed size). A
   document's weight is the sum of its features' gains: they are gathered, and summed by document with np.bincount's weights.

A document's key is its weight plus Gumbel noise from a hash of seed and doc_id, so the highest keys are a sample without replacement with
probabilities proportional to exp(weight / scale). The draw takes the highest `pct` percent of the documents with `min_words` words or more;
their ranks come from ranges of the sorted keys and counts by range, not from one task.

Null texts have no words: no features, weight 0, not drawn. Equal scores are ranked by smaller doc_id; rows that repeat a doc_id are documents
of their own, in any order among equals. A row without doc_id has features and weight, but no key: score and rank are null and it is not
among those drawn from. An empty table gives an empty result; an empty target has gains of the corpus alone. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import CACHE, arrow_map, cut, vector_total
from corvane.llm.decontam import words_of
from corvane.operators.numbering import numbered

SCHEMA = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"
#: Bytes of text whose features are summed together.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Params:
    """grams: features are all runs of 1 to that many words. buckets: that features are hashed to. scale: of the integers that weights and keys
    are floored to. pct: of the documents with min_words words or more, to be drawn. seed: of the draw."""

    grams: int = 1
    buckets: int = 10_000
    scale: int = 1000
    min_words: int = 20
    pct: int = 10
    seed: int = 2024


class Buckets(dict):
    """feature (bytes) -> bucket; those already seen stay in C."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[feature] = b = zlib.crc32(feature) % self.n
        return b

    def of(self, words: list[bytes], grams: int) -> np.ndarray:
        """The bucket of each feature of a text."""
        runs = [words if k == 1 else [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] for k in range(1, grams + 1)]
        return np.fromiter((self[x] for r in runs for x in r) if grams > 1 else map(self.__getitem__, words), np.int64, sum(map(len, runs)))


def bucket_counts(texts: DataFrame, p: Params = Params()) -> np.ndarray:
    """How many features of texts(text) are in each bucket, repeats counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(p.buckets), np.zeros(p.buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(known.of(words_of(text), p.grams), minlength=p.buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    return vector_total(texts.select(F.col("text").cast("binary")).mapInArrow(run, "v binary"), p.buckets)


def gains(source: np.ndarray, target: np.ndarray, p: Params = Params()) -> np.ndarray:
    """floor(scale * ln of the ratio of the smoothed shares) of each bucket."""
    s_all, t_all = float(source.sum() + p.buckets), float(target.sum() + p.buckets)
    return np.array([math.floor(p.scale * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())], np.float64)


def noise(doc_id: int, p: Params) -> int:
    """floor(scale * a Gumbel number) of a document."""
    h = int(hashlib.sha256(f"{p.seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-p.scale * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, p: Params = Params()) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of docs(doc_id, text)."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def blocks(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
        block, size = [], 0
        for t in texts:
            block.append(t)
            size += len(t or b"")
            if size >= BLOCK:
                yield block
                block, size = [], 0
        if block:
            yield block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, g = Buckets(p.buckets), held.value
        for batch in batches:
            words, features, weight = [], [], []
            for block in blocks(batch.column(1).to_pylist()):
                split = [words_of(t) for t in block]
                found = [known.of(w, p.grams) for w in split]
                n = np.fromiter(map(len, found), np.int64, len(found))
                words += map(len, split)
                features.append(n)
                # sums of integers far under 2**53: exact in doubles
                weight.append(np.bincount(np.repeat(np.arange(len(n)), n), weights=g[np.concatenate(found)], minlength=len(n)).astype(np.int64))
            if words:
                w = np.concatenate(weight)
                score = [None if d is None else x + noise(d, p) for d, x in zip(batch.column(0).to_pylist(), w.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(words, pa.int64()), pa.array(np.concatenate(features)), pa.array(w), pa.array(score, pa.int64())],
                    names=[x.split(" ")[0] for x in SCHEMA.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, SCHEMA)


def resample(docs: DataFrame, target: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each row of docs(doc_id, text): doc_id, n_words, n_features, weight, score, rank (from 1, of those drawn; null otherwise).
    target(text) has the texts whose distribution is aimed at."""
    gain = gains(bucket_counts(docs, p), bucket_counts(target, p), p)
    rows = cut(weighted(docs, gain, p))
    able = F.coalesce((F.col("n_words") >= p.min_words) & F.col("score").isNotNull(), F.lit(False))
    drawn = p.pct * rows.where(able).count() // 100
    ranked = numbered(rows.where(able), [F.desc("score"), F.asc("doc_id")], name="rank", first=1)
    rest = rows.where(~able).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rest)


def sample(docs: DataFrame, target: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs that are drawn, with all their columns. Rows that repeat a doc_id are drawn if any of them is."""
    ids = resample(docs, target, p).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, docs["doc_id"].cast("bigint") == ids["_drawn"], "left_semi")
