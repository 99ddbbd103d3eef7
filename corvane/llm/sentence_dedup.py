"""Substring dedup by sliding sentence spans.

A sentence ends after a run of `.`, `!` or `?`, or at a line feed. Texts without such marks would have no runs of sentences, so
a sentence of `longest` words or more is cut: after the greatest word (by bytes, then by order; the last of equals) of any `longest`
consecutive words. Such cuts depend on the words near them alone, so copies are cut alike whatever precedes them. The key of a
sentence is its lower-cased words (A-Z; white space apart). Every run of `sentences` consecutive sentences is hashed, to 128
bits. A run stays in the document of least doc_id that has it, where it comes first; sentences covered by a run anywhere else go.

1. One pass over the texts makes the distinct runs' hashes of each document, packed, a row a document.
2. The least doc_id of each hash is found, with partial minima before the shuffle; hashes of one document only are dropped.
3. What is left is joined with the documents' hashes (adaptive execution can split the join), and each document hears which of its
   runs a smaller doc_id has. A second pass over the texts finds these, and runs that come again within a text.

Null and empty texts have no sentences; a text with fewer than `sentences` sentences has no run. Rows that repeat a doc_id are
one document towards others, and each keeps the first of its own runs. A row without doc_id is passed on whole. Other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import arrow_map, cut, release, shingle_hashes

SCHEMA = "doc_id bigint, n_sentences bigint, n_removed bigint, n_words bigint, n_words_removed bigint, kept binary"
#: A sentence with a word, and the marks and white space up to the next; what precedes the first is part of it.
SENTENCE = re.compile(rb"[.!?\s]*[^.!?\s][^.!?\n]*(?:[.!?]+|\n|\Z)[.!?\s]*")
WORDLIKE = re.compile(rb"[^.!?\s]")
WORD = re.compile(rb"\s*\S+\s*")
#: A run's hash.
PAIR = np.dtype([("a", np.int64), ("b", np.int64)])


@dataclass(frozen=True)
class Params:
    """sentences: in a span. longest: words from which a sentence is cut."""

    sentences: int = 3
    longest: int = 24


def uncut(text: bytes | None) -> list[bytes]:
    """The sentences before long ones are cut; joined they are the text. A text without a word is one; the pattern, which would look for one from
    each of its bytes, isn't asked."""
    return SENTENCE.findall(text) if WORDLIKE.search(text or b"") else [text] if text else []


def ends(words: list[list[bytes]], p: Params) -> np.ndarray:
    """Where sentences end among all words, those that cut long ones included."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    at = np.cumsum(n)
    flat = list(chain.from_iterable(words))
    m = len(flat) - p.longest + 1
    if not len(n) or n.max() < p.longest:
        return at
    place = {w: i for i, w in enumerate(sorted(sorted(set(flat)), key=len))}
    rank = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
    most, cut_at = rank[p.longest - 1 :].copy(), np.full(m, p.longest)
    for k in range(p.longest - 1, 0, -1):
        x = rank[k - 1 : k - 1 + m]
        cut_at[x > most] = k
        np.maximum(x, most, out=most)
    of = np.repeat(np.arange(len(n)), n)
    i = np.flatnonzero(of[:m] == of[p.longest - 1 :])
    return np.union1d(i + cut_at[i], at)


def sentences(text: bytes | None, p: Params) -> tuple[list[bytes], np.ndarray]:
    """The lower-cased words of a text, and where its sentences end among them."""
    words = [x.lower().split() for x in uncut(text)]
    return list(chain.from_iterable(words)), ends(words, p)


def spans(flat: list[bytes], at: np.ndarray, p: Params) -> np.ndarray:
    """The hash of each run of sentences, in order."""
    z = at.tolist()
    m = len(z) - p.sentences + 1
    if m < 1:
        return np.zeros(0, PAIR)
    keys = np.frombuffer(b"".join([xxhash.xxh3_128_digest(b" ".join(flat[i:j])) for i, j in zip([0, *z], z)]), np.uint64).reshape(-1, 2)
    out = np.empty(m, PAIR)
    out["a"], out["b"] = (shingle_hashes(keys[:, c].copy(), p.sentences).view(np.int64) for c in (0, 1))
    return out


def repeated(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, and the hashes of its runs that a smaller doc_id has, for documents that have any."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        h = [np.unique(spans(*sentences(text, p), p)) for text in batch.column(1).to_pylist()]
        yield {"doc_id": batch.column(0)} | {k: pa.array([x[k] for x in h], pa.list_(pa.int64())) for k in "ab"}

    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    packed = cut(arrow_map(texts, run, "doc_id bigint, a array<bigint>, b array<bigint>").where("size(a) > 0"))
    rows = packed.select("doc_id", F.explode(F.arrays_zip("a", "b")).alias("s")).select("doc_id", "s.a", "s.b")
    first = rows.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").select("a", "b", "first")
    return rows.join(first, ["a", "b"]).where("doc_id > first").groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("runs"))


def going(h: np.ndarray, runs: np.ndarray, n: int, p: Params) -> np.ndarray:
    """Which of n sentences go: those covered by a run that is in runs or came before in h."""
    go = np.zeros(n, bool)
    if len(h):
        again = np.ones(len(h), bool)
        again[np.unique(h, return_index=True)[1]] = False
        for i in np.flatnonzero(again | np.isin(h, runs)).tolist():
            go[i : i + p.sentences] = True
    return go


def sentence_dedup(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each row of docs(doc_id, text): n_sentences, n_removed, n_words, n_words_removed, kept (the sentences that stay)."""
    found = cut(repeated(docs, p))
    release(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    both = texts.join(found.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", F.col("runs.a").alias("a"), F.col("runs.b").alias("b"))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = []
        for doc, text, a, b in zip(*(x.to_pylist() for x in batch.columns)):
            flat, at = sentences(text, p)
            runs = np.zeros(len(a or ()), PAIR)
            runs["a"], runs["b"] = a or (), b or ()
            go = going(spans(flat, at, p), runs, len(at), p) if doc is not None else np.zeros(len(at), bool)
            size = np.diff(at, prepend=0)
            kept = text or b""
            if go.any():
                raw = [w for x in uncut(text) for w in WORD.findall(x)]
                stays = np.repeat(~go, size).tolist()
                kept = b"".join([w for w, s in zip(raw, stays) if s])
            rows.append((len(at), int(go.sum()), len(flat), int(size[go].sum()), kept))
        c = list(zip(*rows)) or [()] * 5
        yield {"doc_id": batch.column(0)} | {f.split(" ")[0]: pa.array(v, pa.binary() if "kept" in f else pa.int64()) for f, v in zip(SCHEMA.split(", ")[1:], c)}

    return arrow_map(both, run, SCHEMA)
