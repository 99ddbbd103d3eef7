"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

A text is lower-cased, runs of anything but letters become one space, and the n-grams of 1 to `grams` characters of the whole text are hashed
into `buckets`. A feature is (1 + ln count) * idf, a text's features have length 1.

1. Document frequencies come from all learnable texts: each task adds up one vector, treeReduce merges them.
2. The weights are fitted on a bounded sample of these, evenly by language, by follow-the-regularised-leader (per-coordinate rates, elastic
   net: l1 makes the weights sparse, l2 keeps them small), in a fixed order. Since languages are sampled evenly, each one's intercept is
   corrected by the log ratio of its share of all learnable texts and of the sample.
3. A part of the sample that isn't trained on sets the temperature: the divisor of all logits under which its likelihood is greatest.
4. One pass over the documents scores whole texts. Each task gets the weights, an array of buckets by languages.

Learned from are rows whose crc32(doc_id as text) mod `folds` isn't 0, with a doc_id and a lang. Neither lang nor source nor doc_id is an
input of a prediction. The languages must be few enough for the weights to be held (buckets * languages * 8 bytes in a task).

Null texts and texts without a letter are `und` with score 0. Without anything to learn from all are. Rows that repeat a doc_id are
predicted each on its own text; a null doc_id is not held out. Ties go to the language that sorts first. Other columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import vector_total

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"
UNKNOWN = "und"
#: Characters whose n-grams are hashed together.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Params:
    """grams: longest n-gram. buckets: a power of 2. sample: texts that the weights and the temperature are fitted on, at most, but for `least` of each language.
    terms: features of a text in that sample, at most (those of the greatest value). holdout: one in that many of the sample sets the temperature. epochs: over
    the rest. alpha, beta: learning rates. l1, l2: penalties. folds: rows of remainder 0 are held out."""

    grams: int = 3
    buckets: int = 1 << 15
    sample: int = 4000
    least: int = 50
    terms: int = 4096
    holdout: int = 5
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.01
    folds: int = 5


@functools.cache
def lower_letters() -> np.ndarray:
    """For each code point its letter in lower case, where that is one character, or a space for what isn't a letter. Made once a worker."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        if chr(i).isalpha():
            low = chr(i).lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def letters(text: str | None) -> np.ndarray:
    """Code points of the text's letters in lower case, with one space for whatever is between and around; empty without any letter."""
    c = lower_letters()[np.frombuffer(f" {text or ''} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    gap = c == 32
    c = c[~(gap & np.append(False, gap[:-1]))]
    return c if len(c) > 1 else c[:0]


def counts(clean: np.ndarray, p: Params) -> np.ndarray:
    """How often each bucket is hit by n-grams of a text, as letters() gives it."""
    out, shift = np.zeros(0, np.int64), np.uint32(32 - (p.buckets.bit_length() - 1))
    with np.errstate(over="ignore"):
        for i in range(0, max(len(clean), 1), BLOCK):
            c = clean[i : i + BLOCK + p.grams - 1]
            h, found = c, np.empty(p.grams * min(len(c), BLOCK), np.int64)
            z = 0
            for n in range(1, p.grams + 1):
                if n > 1:
                    h = h[: max(len(c) - n + 1, 0)] * np.uint32(0x01000193)
                    h ^= c[n - 1 :]
                starts = h[:BLOCK] + np.uint32(n)  # the others belong to the next block
                starts *= np.uint32(0x9E3779B1)
                starts >>= shift
                found[z : z + len(starts)] = starts
                z += len(starts)
            more = np.bincount(found[:z], minlength=p.buckets)
            out = out + more if len(out) else more
    return out


def features(clean: np.ndarray, idf: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's features."""
    n = counts(clean, p)
    at = np.flatnonzero(n)
    v = (1 + np.log(n[at])) * idf[at]
    return at, v / max(float(np.sqrt(v @ v)), 1e-12)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    w: np.ndarray
    b: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        return v @ self.w[at] + self.b


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Weights [buckets, k] and intercepts. z and n are the sums of gradients and of their squares; a weight is nonzero only where |z| > l1."""
    z, n = np.zeros((p.buckets, k)), np.zeros((p.buckets, k))
    b, bn = np.zeros(k), np.zeros(k)
    order = np.random.default_rng(0)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - p.l1, 0) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)

    for _ in range(p.epochs):
        for i in order.permutation(len(rows)).tolist():
            at, v = rows[i]
            w, n_at = weights(z[at], n[at]), n[at]
            err = softmax(v @ w + b)
            err[y[i]] -= 1
            g = v[:, None] * err
            more = n_at + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n_at)) / p.alpha * w
            n[at] = more
            bn += err * err
            b -= p.alpha / (p.beta + np.sqrt(bn)) * err
    return weights(z, n), b


def temperature(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The divisor from e**-4 to e**4 that makes the weighted likelihood of y greatest, by golden section (it has one maximum). Where n texts
    show no error, that doesn't prove that there is none: each target gives 1 / (n + 2) to the other languages."""
    if not len(y):
        return 1.0
    eps, k = 1 / (len(y) + 2), logits.shape[1]
    target = np.full((len(y), k), eps / (k - 1))
    target[np.arange(len(y)), y] = 1 - eps

    def loss(t: float) -> float:
        return -float(weight @ (target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum(1))

    lo, hi, r = -4.0, 4.0, (5**0.5 - 1) / 2
    a, b = hi - r * (hi - lo), lo + r * (hi - lo)
    fa, fb = loss(a), loss(b)
    for _ in range(40):
        if fa <= fb:
            hi, b, fb = b, a, fa
            a = hi - r * (hi - lo)
            fa = loss(a)
        else:
            lo, a, fa = a, b, fb
            b = lo + r * (hi - lo)
            fb = loss(b)
    return float(np.exp((lo + hi) / 2))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, langs: list[str], shares: np.ndarray, idf: np.ndarray, p: Params) -> Model:
    """rows: features; y: their languages' numbers; shares: of the languages among all learnable texts."""
    k = len(langs)
    if k < 2:
        return Model(langs, idf, np.zeros((p.buckets, k)), np.zeros(k), 1.0)
    held = np.arange(len(rows)) % p.holdout == p.holdout - 1
    train, rest = np.flatnonzero(~held).tolist(), np.flatnonzero(held).tolist()
    w, b = ftrl([rows[i] for i in train], y[train], k, p)
    seen = np.maximum(np.bincount(y[train], minlength=k), 1)
    b = b + np.log(shares) - np.log(seen / seen.sum())
    logits = np.array([v @ w[at] + b for at, v in (rows[i] for i in rest)]).reshape(len(rest), k)
    return Model(langs, idf, w, b, temperature(logits, y[rest], (shares / np.maximum(np.bincount(y[rest], minlength=k), 1))[y[rest]]))


def held_out(doc_id: int | None, p: Params) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % p.folds == 0


def train(docs: DataFrame, p: Params = Params()) -> Model:
    """Fit on docs(doc_id, text, lang)."""
    able = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string")).where("doc_id is not null and lang is not null and text is not null")
    able = able.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % p.folds != 0)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.buckets + 1, np.int64)  # the last counts the texts
        for batch in batches:
            for text in batch.column(0).to_pylist():
                clean = letters(text)
                if len(clean):
                    total[np.flatnonzero(counts(clean, p))] += 1
                    total[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    total = vector_total(able.select("text").mapInArrow(spread, "v binary"), p.buckets + 1)
    idf = np.log((1 + total[-1]) / (1 + total[:-1])) + 1
    by_lang = {r["lang"]: r["n"] for r in able.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(by_lang)
    if not langs:
        return Model([], idf, np.zeros((p.buckets, 0)), np.zeros(0), 1.0)
    each = max(p.least, p.sample // len(langs))
    # a hash under a language's share leaves about twice what is wanted of it, before anything is shuffled; copies have the same hash, one is kept
    share = F.create_map(*[F.lit(x) for lang, n in by_lang.items() for x in (lang, min(1.0, (2 * each + 50) / n))])
    h = F.xxhash64("doc_id", "lang", "text")
    near = able.withColumn("h", h).where(F.pmod("h", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).dropDuplicates(["h"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = near.withColumn("place", place).where(F.col("place") <= each).select("lang", "place", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, place, text in zip(*(c.to_pylist() for c in batch.columns)):
                clean = letters(text)
                if len(clean):
                    at, v = features(clean, idf, p)
                    if len(at) > p.terms:
                        most = np.sort(np.argsort(-v, kind="stable")[: p.terms])
                        at, v = at[most], v[most]
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([place], pa.int32()), pa.array([at.astype(np.int32).tobytes()]), pa.array([v.astype(np.float32).tobytes()])], names=["lang", "place", "at", "v"])

    got = sorted(chosen.mapInArrow(run, "lang string, place int, at binary, v binary").collect(), key=lambda r: (r["place"], r["lang"]))
    rows = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["v"], np.float32).astype(np.float64)) for r in got]
    n = np.array([by_lang[x] for x in langs], np.float64)
    return fit(rows, np.array([langs.index(r["lang"]) for r in got], np.int64), langs, n / n.sum(), idf, p)


def predicted(docs: DataFrame, model: Model, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, lang_pred, score of docs(doc_id, text) by a model."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            ids, lang, score = batch.column(0).to_pylist(), [], []
            for text in batch.column(1).to_pylist():
                clean = letters(text if m.langs else None)
                if len(clean):
                    q = softmax(m.logits(*features(clean, m.idf, p)) / m.temperature)
                    best = int(q.argmax())
                    lang.append(m.langs[best]), score.append(float(q[best]))
                else:
                    lang.append(UNKNOWN), score.append(0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([held_out(i, p) for i in ids], pa.bool_()), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[x.split(" ")[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def identify(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each row of docs(doc_id, text, lang): doc_id, held_out, lang_pred, score (the calibrated probability of lang_pred)."""
    return predicted(docs, train(docs, p), p)
