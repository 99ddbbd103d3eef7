"""Quality rules: counts by document, and repetition by a suffix array over its words.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. The suffix array
comes from prefix doubling (ranks of 1, 2, 4, 8, ... words); longest common prefixes of neighbours in it bound the
maximal repeated word runs. Documents are independent of each other, so the operator is one pass without a shuffle.

Null texts have no words. Rows that repeat a doc_id are judged each on their own text; a null doc_id is passed on; other
columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import arrow_map, filtered

SYMBOLS = b"#*$%&|<>"
SCHEMA = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, covered_words bigint, longest_repeat bigint"


@dataclass(frozen=True)
class Rules:
    """Limits. A document passes with at least min_words words, at most repeat_pct percent of words in repeated windows of
    `window` words; and, by the suffix array: repeats of span words or more cover at most covered_pct percent of the words, and
    no repeat is longer than both longest_words words and longest_pct percent of the words (less than half of repeat_pct, else two copies of
    such a repeat would fail that limit first)."""

    min_words: int = 20
    window: int = 8
    repeat_pct: int = 30
    span: int = 5
    covered_pct: int = 40
    longest_words: int = 100
    longest_pct: int = 10


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of a sequence of integers from 0, and lcp[i]: the length of the common prefix of the suffixes at i - 1 and i
    (lcp[0] is 0). Prefix doubling: O(n log n) work for each doubling, until all ranks differ."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, k = [rank], 1
    while rank.max() + 1 < n:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1 if k < n else 0
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        k *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    # common prefixes of neighbours: from the widest level down, jump over 2**level words wherever these are equal
    lcp = np.zeros(n, np.int64)
    a, b = sa[:-1].copy(), sa[1:].copy()
    for j in range(len(levels) - 2, -1, -1):  # at the last level all differ
        w = 1 << j
        fits = np.flatnonzero((a + w <= n) & (b + w <= n))
        same = fits[levels[j][a[fits]] == levels[j][b[fits]]]
        lcp[same + 1] += w
        a[same] += w
        b[same] += w
    return sa, lcp


def repeats(ids: np.ndarray, span: int) -> tuple[np.ndarray, int]:
    """For each position the length of the longest repeated run that starts there (0 if under span), and the longest of all."""
    sa, lcp = suffix_array(ids)
    longest = np.maximum(lcp, np.append(lcp[1:], 0))
    at = np.zeros(len(ids), np.int64)
    at[sa] = longest
    return np.where(at >= span, at, 0), int(longest.max(initial=0))


def covered(at: np.ndarray) -> int:
    """How many positions lie in the union of the spans [i, i + at[i])."""
    n = len(at)
    step = np.zeros(n + 1, np.int64)
    i = np.flatnonzero(at)
    np.add.at(step, i, 1)
    np.add.at(step, i + at[i], -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def grams_repeat(ids: np.ndarray, k: int) -> bool:
    """If any run of k words occurs twice; by exact ranks."""
    n = len(ids)
    if n <= k:
        return False
    rank, have = ids, 1
    while have < k:
        step = min(have, k - have)
        m = len(rank) - step
        key = rank[:m] * (n + 1) + rank[step : step + m]
        rank = np.unique(key, return_inverse=True)[1]
        if rank.max(initial=-1) + 1 == len(rank):
            return False
        have += step
    return True


def judged(text: bytes | None, r: Rules) -> tuple:
    text = text or b""
    words = text.split()
    n = len(words)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    again = spans = longest = 0
    if len(seen) < n and grams_repeat(ids, min(r.span, r.window)):
        at, longest = repeats(ids, min(r.span, r.window))
        again, spans = covered(np.where(at >= r.window, at, 0)), covered(np.where(at >= r.span, at, 0))
    failed = n < r.min_words or 100 * again > r.repeat_pct * n
    bad = 100 * spans > r.covered_pct * n or (longest > r.longest_words and 100 * longest > r.longest_pct * n)
    return n, chars, symbols, len(lines) - len(set(lines)), again, failed, not (failed or bad), spans, longest


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """A row for each row of docs(doc_id, text): the counts, base_failed, kept (False if base_failed, else the suffix array's verdict),
    covered_words (in repeats of rules.span words or more) and longest_repeat (in words; 0 if none reaches the shorter span)."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = [judged(x, rules) for x in batch.column(1).to_pylist()]
        names = [x.split(" ")[0] for x in SCHEMA.split(", ")][1:]
        kinds = [pa.bool_() if x in ("base_failed", "kept") else pa.int64() for x in names]
        yield {"doc_id": batch.column(0)} | {x: pa.array([y[j] for y in rows], kinds[j]) for j, x in enumerate(names)}

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")), run, SCHEMA)


def passing(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns; one pass, no join."""
    return filtered(docs, "text", lambda x: judged(x, rules)[6])
