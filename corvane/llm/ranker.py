"""Quality classifier: Bradley-Terry ranking by pairs.

From labelled documents, pairs (one marked good, one marked bad) say which of two is better; the probability that a beats b is
sigmoid(w . (f(a) - f(b))), and w minimises the logistic loss over pairs, by Newton steps with a ridge. What makes w . f(x) a
score from 0 to 1 is a monotone map fitted on the same documents (Platt's), so that documents
above the cut at `cut_at` are expected to be good with that probability or more. Documents are selected by a threshold at a quantile of
the scores of all documents, found exactly (to 2**-32) from counts by score in two steps.

Labels come only from rows whose crc32(doc_id as text) mod `folds` isn't 0. Inputs of a score are counts over the whole text, never
doc_id, labels, lang or source. The fit uses at most `sample` labelled documents, those with the least hashes of doc_id (the
bound keeps the driver's memory fixed; documents are read and scored in full at every size). Scoring is one pass over all
documents without a shuffle; each task gets the weights (a few hundred numbers).

Null texts score as empty ones. Rows that repeat a doc_id are scored each on their own text; a null doc_id is not held out.
Labels that repeat a doc_id, or are null, are left out of the fit if they contradict each other. Without labels of both kinds
all scores are the share of good labels (0.5 without any). Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import arrow_map, cut

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"
STEP = 1 << 16
#: Characters counted one by one.
MARKS = b"|#*$%&<>!?.,;:-_/\\@{}()[]=+~^\"'`"


@dataclass(frozen=True)
class Params:
    """sample: labelled documents used for the fit, at most. pairs: made of them. cut_at: least score of a document predicted good. hashed:
    buckets of word endings and shapes. ridge: of the loss. folds: every document whose remainder is 0 is held out. share: of the
    documents, to be selected by score."""

    sample: int = 20_000
    pairs: int = 200_000
    cut_at: float = 0.3
    hashed: int = 64
    ridge: float = 1e-3
    folds: int = 5
    share: float = 0.7


def features(text: bytes | None, p: Params) -> np.ndarray:
    """Of the whole text; shares rather than counts, so long and short texts compare."""
    text = text or b""
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, size = len(words), len(text)
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if size else np.zeros(256)
    upper, digit, lower = by_byte[65:91].sum(), by_byte[48:58].sum(), by_byte[97:123].sum()
    counts = Counter(words)
    top = max(counts.values(), default=0)
    same = sum(a == b for a, b in zip(words, words[1:]))
    lengths = np.fromiter(map(len, words), np.float64, n)
    sentences = by_byte[33] + by_byte[46] + by_byte[63]
    starts = Counter(x[:8] for x in lines)
    s, w, ln = max(size, 1), max(n, 1), max(len(lines), 1)
    base = [
        np.log1p(n), np.log1p(size), n < 20, upper / s, digit / s, lower / s, by_byte[128:].sum() / s, len(counts) / w, top / w, same / w,
        lengths.mean() if n else 0, lengths.std() if n else 0, (lengths.max() if n else 0) / 50, np.log1p(len(lines)), n / ln / 50,
        (len(lines) - len(set(lines))) / ln, max(starts.values(), default=0) / ln, sentences / w, n / (sentences + 1) / 50,
        sum(c == 1 for c in counts.values()) / w, sum(x.isupper() for x in counts) / w, len(Counter(zip(words, words[1:]))) / w,
    ]
    hashed = np.zeros(p.hashed)
    for x, c in counts.items():
        hashed[xxhash.xxh3_64_intdigest(x[-3:]) % p.hashed] += c
    marks = by_byte[np.frombuffer(MARKS, np.uint8)]
    return np.concatenate([base, np.sqrt(marks / w), np.sqrt(hashed / w)]).astype(np.float64)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    a: float
    b: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.w

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.raw(x) + self.b, -500, 500)))


def newton(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, steps: int = 30) -> np.ndarray:
    """The minimum of the mean logistic loss of labels y (0 or 1) under x @ w, plus ridge * w**2 / 2."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        g = x.T @ (q - y) / len(y) + ridge * w
        h = (x * (q * (1 - q))[:, None]).T @ x / len(y) + np.diag(ridge + 1e-9)
        d = np.linalg.solve(h, g)
        w -= d * min(1.0, 5 / max(np.abs(d).max(), 1e-12))
        if np.abs(d).max() < 1e-7:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, p: Params) -> Model:
    """Weights from pairs of rows of x, one of each kind; then the map to probabilities."""
    d = x.shape[1]
    share = float(good.mean()) if len(good) else 0.5
    pos, neg = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(pos) or not len(neg):
        return Model(np.zeros(d), np.ones(d), np.zeros(d), 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(0)
    m = min(p.pairs, 20 * len(good))
    i, j = pos[rng.integers(len(pos), size=m)], neg[rng.integers(len(neg), size=m)]
    flip = np.where(rng.random(m) < 0.5, 1.0, -1.0)
    w = newton((z[i] - z[j]) * flip[:, None], (flip > 0).astype(float), np.full(d, p.ridge))
    r = z @ w
    unit = max(float(r.std()), 1e-9)
    a, b = newton(np.stack([r / unit, np.ones(len(r))], 1), good.astype(float), np.full(2, 1e-6))
    return Model(mean, scale, w, max(float(a), 1e-9) / unit, float(b))


def held_out(doc_id: int | None, p: Params) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % p.folds == 0


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """Fit on the sample of labels(doc_id, quality) outside the held-out fold, joined with their texts."""
    doc = F.col("doc_id").cast("bigint")
    clean = labels.where("doc_id is not null and quality in (0, 1)").groupBy(doc.alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("_other")).where("quality = _other")
    inner = clean.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % p.folds != 0)
    chosen = inner.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample).select("doc_id", "quality")
    rows = docs.select(doc.alias("doc_id"), F.col("text").cast("binary")).join(F.broadcast(chosen), "doc_id")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        x = [features(t, p) for t in batch.column(1).to_pylist()]
        yield {"doc_id": batch.column(0), "quality": batch.column(2), "x": pa.array([v.tobytes() for v in x], pa.binary())}

    got = arrow_map(rows.select("doc_id", "text", F.col("quality").cast("int")), run, "doc_id bigint, quality int, x binary")
    # rows that repeat an id don't raise the number that comes to the driver
    got = got.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(p.sample).collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    x = np.stack([np.frombuffer(r["x"], np.float64) for r in got]) if got else np.zeros((0, len(features(b"", p))))
    return fit(x, np.array([r["quality"] for r in got]), p)


def quantile(scores: DataFrame, share: float) -> float:
    """The largest multiple of 2**-32 that a share of the scores (0 to 1), or more, reach. Two passes: the
    first one's counts also give how many there are. The driver holds at most 2**16 counts at once."""
    n, lo, above = None, 0, 0  # lo and above in units of 2**-32; scores beyond the bin looked at
    for width in (STEP, 1):
        unit = F.least(F.floor(F.col("score") * float(STEP * STEP)), F.lit(STEP * STEP - 1)).cast("bigint")
        part = scores.select(F.floor((unit - lo) / width).cast("bigint").alias("bin")).where(F.col("bin").between(0, STEP - 1))
        counts = sorted(part.groupBy("bin").agg(F.count("*").alias("n")).collect(), reverse=True)
        n = sum(m for _, m in counts) if n is None else n
        if share * n <= 0:
            return 1.0
        for b, m in counts:
            if above + m >= share * n:
                lo += b * width
                break
            above += m
    return lo / float(STEP * STEP)


def quality_scores(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each row of docs(doc_id, text): held_out, score, predicted (1 if score >= cut_at), selected (score at or over the quantile that
    p.share of all documents reach)."""
    scores = cut(scored(docs, train(docs, labels, p), p))
    return scores.withColumn("selected", F.col("score") >= quantile(scores, p.share))


def scored(docs: DataFrame, model: Model, p: Params) -> DataFrame:
    """held_out, score and predicted of docs by a model."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        if not ids:
            return
        s = model.score(np.stack([features(t, p) for t in texts]))
        yield {"doc_id": batch.column(0), "held_out": pa.array([held_out(i, p) for i in ids]), "score": pa.array(s), "predicted": pa.array((s >= p.cut_at).astype(np.int32))}

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")), run, SCHEMA)
