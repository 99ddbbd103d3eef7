"""Benchmark decontamination: a prefix-filtered join of benchmark windows with the texts of documents.

Words are runs of digits, ASCII letters (A-Z lower-cased) and bytes from 0x80. A window is `size` consecutive words of a
benchmark item, or all words of a shorter item. A window can only occur in a text that holds all its shingles, so it is
enough to look for its rarest one (its prefix: for full containment one token is necessary):

1. count in all texts how often each shingle of the benchmark occurs;
2. take for each window the rarest of its shingles (ties: the one that starts first);
3. find these in the texts; the shingle's place in the window gives the only place where the window can start there; drop
   those that would start before the text or end after it (position and length bounds);
4. compare all words of the window there.

The benchmark is held in each task, as arrays, only if its words are few (`held_words`); a larger one is joined by shuffles, with the
same steps, after a filter of fixed size has dropped the texts' shingles that no window has. Null texts have no words; a null doc_id is passed on. Rows that repeat a doc_id are judged each on their own
text in the held form; the joined form numbers rows, so it does likewise. Items without item_id mark words as hit but
aren't listed; rows that repeat an item_id are one item. Other columns of either table are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import C1, WordHash, arrow_map, cut, filtered, free, mixed, named, shingle_hashes

#: A-Z lower-cased; what isn't a word byte becomes a space.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


@dataclass(frozen=True)
class Params:
    """size: words in a window. shingle: words in a token of the join. pct: a text is contaminated with that share of words hit, and one
    at least. held_words: the largest benchmark, in words, that is sent to every task: a word takes under 400 bytes there, measured with words that are all
    different (under 200 with words as in texts), so 200 MB at most. filter_bits: the logarithm of the size, in bits, of the filter that the joined
    form sends to every task."""

    size: int = 13
    shingle: int = 5
    pct: int = 5
    held_words: int = 500_000
    filter_bits: int = 27


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    k = min(size, len(words))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def lengths(k: int, shingle: int) -> int:
    """Words in a token of a window of k words: windows under `shingle` words are one token."""
    return min(k, shingle)


class Index:
    """The windows of a benchmark by their rarest shingles. Words are numbers into a vocabulary, all items one array of them, and a window a place
    in it; what belongs to a window or a shingle lies in one array, with the ends of each part in another."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], p: Params):
        self.p = p
        number: dict[bytes, int] = {}
        texts = [np.fromiter((number.setdefault(w, len(number)) for w in words_of(text)), np.int32) for _, text in items]
        hashes = WordHash().of(list(number))
        self.vocabulary = list(number)
        self.flat = np.concatenate([*texts, np.zeros(0, np.int32)])
        begins = np.cumsum([0, *map(len, texts)])[:-1]
        length = np.array([min(p.size, len(t)) for t in texts], np.int64)
        # all windows: where they begin, and of which item they are
        place = np.concatenate([*(b + np.arange(len(t) - k + 1) for b, t, k in zip(begins, texts, length) if k), np.zeros(0, np.int64)]).astype(np.int64)
        of = np.repeat(np.arange(len(texts)), [len(t) - k + 1 if k else 0 for t, k in zip(texts, length)])
        self.start, self.size, self.shingles, owner, who = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        windows = 0
        for k in sorted(set(length.tolist()) - {0}):
            mine = np.flatnonzero(length[of] == k)
            words = self.flat[place[mine, None] + np.arange(k)]
            _, first, same = np.unique(words.view(np.dtype((np.void, 4 * k))).ravel(), return_index=True, return_inverse=True)
            self.start.append(place[mine[first]]), self.size.append(np.full(len(first), k))
            # every row of words is a text of its own to the hash of shingles: all at once, column by column
            self.shingles.append(np.stack([_shingle(hashes[words[first][:, i : i + lengths(k, p.shingle)]]) for i in range(k - lengths(k, p.shingle) + 1)], 1))
            owner.append(windows + same), who.append(of[mine])
            windows += len(first)
        self.start, self.size = np.concatenate(self.start), np.concatenate(self.size)
        owner, who = np.concatenate(owner), np.concatenate(who)
        # items of each window, once each, those without id left out
        ids = np.array([-1 if x is None else x for x, _ in items], np.int64)
        known = np.array([x is not None for x, _ in items], bool)
        owner, who = owner[known[who]], ids[who[known[who]]]
        o = np.lexsort((who, owner))
        owner, who = owner[o], who[o]
        new = np.ones(len(o), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (who[1:] != who[:-1])
        self.items, self.items_end = who[new], np.cumsum(np.bincount(owner[new], minlength=windows))
        self.kinds = sorted({lengths(int(k), p.shingle) for k in np.unique(self.size)})
        self.tokens = np.unique(np.concatenate([*(x.ravel() for x in self.shingles), np.zeros(0, np.uint64)]))

    def of_kind(self, h: np.ndarray, k: int) -> np.ndarray:
        """The k-word shingles of a text; none if it has fewer words."""
        return shingle_hashes(h, k) if len(h) >= k else np.zeros(0, np.uint64)

    def prefixes(self, counts: np.ndarray) -> None:
        """Choose each window's rarest shingle, the first of equals; counts: of each of tokens in all texts."""
        token, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        many = [np.zeros(0, np.int64)]
        for s in self.shingles:
            n = counts[np.searchsorted(self.tokens, s)]
            best = n.argmin(1)
            rows = np.arange(len(s))
            token.append(s[rows, best]), at.append(best), many.append(n[rows, best])
        token, at, many = np.concatenate(token), np.concatenate(at), np.concatenate(many)
        window = np.flatnonzero(many)  # a window that has a shingle in no text is in no text
        o = window[np.argsort(token[window], kind="stable")]
        self.prefix, n = np.unique(token[o], return_counts=True)
        self.window, self.at, self.ends = o, at[o], np.cumsum(n)
        del self.shingles, self.tokens  # not needed in a search

    def search(self, words: list[bytes], h: np.ndarray) -> tuple[int, set]:
        """The number of words hit, and the items of the windows found."""
        n, items = len(words), set()
        starts: dict[int, int] = {}
        for k in self.kinds if len(self.prefix) else []:
            s = self.of_kind(h, k)
            slot = np.minimum(np.searchsorted(self.prefix, s), len(self.prefix) - 1)
            for i in np.flatnonzero(self.prefix[slot] == s).tolist():
                j = slot[i]
                for x in range(self.ends[j - 1] if j else 0, self.ends[j]):
                    w, a = int(self.window[x]), i - int(self.at[x])
                    size, b = int(self.size[w]), int(self.start[w])
                    if lengths(size, self.p.shingle) == k and 0 <= a <= n - size and [self.vocabulary[v] for v in self.flat[b : b + size].tolist()] == words[a : a + size]:
                        starts[a] = max(starts.get(a, 0), size)
                        items.update(self.items[self.items_end[w - 1] if w else 0 : self.items_end[w]].tolist())
        step = np.zeros(n + 1, np.int64)
        for a, k in starts.items():
            step[a] += 1
            step[a + k] -= 1
        return int((np.cumsum(step[:n]) > 0).sum()), items


def _shingle(h: np.ndarray) -> np.ndarray:
    """The hash of each row of words' hashes, as shingle_hashes has it for a text of these words alone."""
    out = np.full(len(h), h.shape[1], np.uint64)
    with np.errstate(over="ignore"):
        for j in range(h.shape[1]):
            out = (out + h[:, j]) * C1
            out ^= out >> np.uint64(31)
        return mixed(out)


def digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def decontaminate(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each row of docs(doc_id, text): n_words, n_hit (words in any occurrence of a window of benchmark(item_id, text)),
    n_items, items_sha256 (of the sorted ids, comma-joined), contaminated (n_hit > 0 and 100 * n_hit >= pct * n_words)."""
    items, few = _items(benchmark, p)
    if not few:
        return _joined(docs, items, p).drop("row")
    search = _search(docs, items, p)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        n, hit, m, sha, bad = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            words, x, found, verdict = search(text)
            n.append(words), hit.append(x), m.append(len(found)), sha.append(digest(found)), bad.append(verdict)
        yield {"doc_id": batch.column(0), "n_words": pa.array(n, pa.int64()), "n_hit": pa.array(hit, pa.int64()), "n_items": pa.array(m, pa.int64()), "items_sha256": pa.array(sha, pa.string()), "contaminated": pa.array(bad, pa.bool_())}

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")), run, SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs that aren't contaminated, with all their columns."""
    items, few = _items(benchmark, p)
    if not few:
        row = free("row_", docs)
        rows = cut(docs.select("*", F.monotonically_increasing_id().alias(row)))
        bad = _joined(rows, items, p, row).where("contaminated").select(F.col("row").alias(row))
        return rows.join(bad, row, "left_anti").select(*map(named, docs.columns))
    search = _search(docs, items, p)
    return filtered(docs, "text", lambda t: not search(t)[3])


def _items(benchmark: DataFrame, p: Params) -> tuple[DataFrame, bool]:
    """The items, and if they are few enough to be held in each task."""
    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("binary"))
    # words are at most half the bytes and one; so this bounds the words without counting them
    bound = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    return items, bound <= p.held_words


def _search(docs: DataFrame, items: DataFrame, p: Params):
    """A function of a text: its words, words hit, items found, verdict. One pass over docs counts the benchmark's shingles first."""
    index = Index([(r[0], None if r[1] is None else bytes(r[1])) for r in items.collect()], p)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    spark = docs.sparkSession
    hashes = WordHash()
    tokens, kinds = spark.sparkContext.broadcast(index.tokens), index.kinds

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, cache = tokens.value, WordHash()
        total = np.zeros(len(t), np.int64)
        for batch in batches if len(t) else []:
            for text in batch.column(1).to_pylist():
                h = cache.of(words_of(text))
                for k in kinds:
                    if len(h) >= k:
                        s = shingle_hashes(h, k)
                        slot = np.minimum(np.searchsorted(t, s), len(t) - 1)
                        total += np.bincount(slot[t[slot] == s], minlength=len(t))
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(total[i])], names=["i", "n"])

    counts = texts.mapInArrow(count, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect() if len(index.tokens) else []
    total = np.zeros(len(index.tokens), np.int64)
    for r in counts:
        total[r["i"]] = r["n"]
    index.prefixes(total)
    held = spark.sparkContext.broadcast(index)

    def search(text: bytes | None) -> tuple[int, int, set, bool]:
        words = words_of(text)
        hit, found = held.value.search(words, hashes.of(words)) if words else (0, set())
        return len(words), hit, found, hit > 0 and 100 * hit >= p.pct * len(words)

    return search


def _joined(docs: DataFrame, items: DataFrame, p: Params, row: str | None = None) -> DataFrame:
    """The same by shuffles, with each row's number: both sides as rows of shingles; the benchmark's side can have any size."""
    spark = docs.sparkSession
    windows = cut(arrow_map(items, lambda b: _window_rows(b, p), "item_id bigint, win string, n int").groupBy("win", "n").agg(F.collect_set("item_id").alias("items")))
    tokens = arrow_map(windows.select("win"), lambda b: _token_rows(b, p), "win string, token bigint, at int, k int")
    tokens = cut(tokens)
    kinds = [r[0] for r in tokens.select("k").distinct().collect()]
    texts = cut(docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.col("doc_id").cast("bigint"), F.col("text").cast("binary")))
    held = spark.sparkContext.broadcast(_filter(tokens, p))
    places = arrow_map(texts, lambda b: _place_rows(b, kinds, held.value), "row bigint, n_words int, k int, places array<int>, tokens array<bigint>").select("row", "n_words", "k", F.explode(F.arrays_zip("places", "tokens")).alias("x")).select("row", "n_words", "k", F.col("x.places").alias("i"), F.col("x.tokens").alias("token"))
    wanted = tokens.select("token", "k").distinct()
    # one scan of the texts: the places of benchmark tokens are kept, then both counted and joined
    seen = cut(places.join(wanted, ["token", "k"], "left_semi"))
    counts = seen.groupBy("token", "k").agg(F.count("*").alias("n"))
    prefix = tokens.join(counts, ["token", "k"], "left").groupBy("win").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "token", "k")).alias("p")).where("p.n > 0").select("win", "p.at", "p.token", "p.k")
    starts = seen.join(prefix, ["token", "k"]).join(windows, "win").withColumn("a", F.col("i") - F.col("at")).where("a >= 0 and a + n <= n_words")
    found = starts.groupBy("row").agg(F.collect_set(F.struct("a", "win", F.to_json("items").alias("items"))).alias("starts"))
    both = texts.join(found.select("row", F.to_json("starts").alias("starts")), "row", "left").select("row", "doc_id", "text", "starts")
    return arrow_map(both, lambda b: _verified(b, p), f"row bigint, {SCHEMA}")


def _window_rows(batch: pa.RecordBatch, p: Params) -> Iterator[dict]:
    out: dict[str, list] = {"item_id": [], "win": [], "n": []}
    for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        for w in windows_of(words_of(text), p.size):
            out["item_id"].append(item), out["win"].append(b" ".join(w).decode("utf-8", "surrogateescape")), out["n"].append(len(w))
    yield {"item_id": pa.array(out["item_id"], pa.int64()), "win": pa.array(out["win"], pa.string()), "n": pa.array(out["n"], pa.int32())}


def _token_rows(batch: pa.RecordBatch, p: Params) -> Iterator[dict]:
    win, token, at, kinds = [], [], [], []
    for w in batch.column(0).to_pylist():
        h = WordHash().of(w.encode().split(b" "))
        k = lengths(len(h), p.shingle)
        s = shingle_hashes(h, k).view(np.int64).tolist()
        win += [w] * len(s)
        token += s
        at += range(len(s))
        kinds += [k] * len(s)
    yield {"win": pa.array(win, pa.string()), "token": pa.array(token, pa.int64()), "at": pa.array(at, pa.int32()), "k": pa.array(kinds, pa.int32())}


def _filter(tokens: DataFrame, p: Params) -> np.ndarray:
    """A bit for each remainder of a token, set if a token of the benchmark has it: 2**filter_bits bits, whatever the size of the benchmark."""
    slot = F.pmod(F.col("token"), F.lit(1 << p.filter_bits)) + 1
    found = tokens.groupBy(F.bitmap_bucket_number(slot).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(max(1 << p.filter_bits, 32768) // 8, np.uint8)
    for r in found:
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _place_rows(batch: pa.RecordBatch, kinds: list[int], known: np.ndarray) -> Iterator[dict]:
    """For each text and kind the places of tokens that the filter lets through; the rest is in no window."""
    hashes = WordHash()
    for row, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
        h = hashes.of(words_of(text))
        for k in kinds:
            if len(h) >= k:
                s = shingle_hashes(h, k)
                slot = (s & np.uint64(len(known) * 8 - 1)).astype(np.int64)
                at = np.flatnonzero(known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                if len(at):
                    yield {"row": pa.array([row]), "n_words": pa.array([len(h)], pa.int32()), "k": pa.array([k], pa.int32()), "places": pa.array([at], pa.list_(pa.int32())), "tokens": pa.array([s[at].view(np.int64)], pa.list_(pa.int64()))}


def _verified(batch: pa.RecordBatch, p: Params) -> Iterator[dict]:
    out: dict[str, list] = {x.split(" ")[0]: [] for x in SCHEMA.split(", ")[1:]}
    for text, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        words = words_of(text)
        step, items = np.zeros(len(words) + 1, np.int64), set()
        for s in json.loads(starts) if starts else []:
            w = s["win"].encode().split(b" ")
            if words[s["a"] : s["a"] + len(w)] == w:
                step[s["a"]] += 1
                step[s["a"] + len(w)] -= 1
                items.update(json.loads(s["items"]))
        hit = int((np.cumsum(step[:-1]) > 0).sum())
        for name, v in zip(out, (len(words), hit, len(items), digest(items), hit > 0 and 100 * hit >= p.pct * len(words))):
            out[name].append(v)
    kinds = {"items_sha256": pa.string(), "contaminated": pa.bool_()}
    yield {"row": batch.column(0), "doc_id": batch.column(1)} | {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()}
