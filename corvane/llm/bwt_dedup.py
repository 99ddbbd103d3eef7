"""Substring dedup by merged Burrows-Wheeler transforms.

A byte of a document goes if a `width`-byte string that covers it also starts in a document with a smaller doc_id. Strings
never cross documents and are judged on the input.

1. Documents with the same text as a document of smaller id are set aside: all their strings go.
2. Each string (window) has a fingerprint, the least hash of its `gram`-byte pieces, which neighbouring windows mostly share
   (a run). Equal windows have equal fingerprints, so only windows whose fingerprint occurs in several documents can repeat.
   Fingerprints, packed by bucket, are counted across all documents; a document hears back which of its own repeat.
3. The runs of these windows, with the bytes they span, are dealt into buckets by fingerprint. Equal runs are one context. If a
   fingerprint has one context only, all its windows occur in the same documents. Contexts of other fingerprints are cut
   into shards; the Burrows-Wheeler transform of each shard is built, and the shards' transforms are merged by refining their
   interleave (which shard the next suffix comes from) step by step, four bytes a step: the transform's symbols in the order
   of the interleave, sorted stably by symbol, give the next interleave. Blocks that a step splits bound the common prefixes;
   after the last step, for the full width, a block is a repeated interval: all suffixes with the same `width` first bytes. No suffix is sorted again.
   The least doc_id in a window's block decides.
4. A fingerprint of more than about `hot` documents isn't gathered in a bucket. Such ones are found first, from summaries of counts
   by task (those of no more than `kept` fingerprints, so counts can be too low by the share that this loses); their windows are
   grouped one by one instead, with partial minima before the shuffle and a join back that adaptive execution can split.
5. What goes is sent to its document, spans are united and cut out.

Tables and shuffles have at most `most` partitions at any size; a task works through its buckets and groups, which have a bounded
size each, one after another.

Null texts are empty. Rows that repeat a doc_id are one document towards others, and each is returned with its own cuts; a
row without doc_id neither causes nor suffers cuts. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import C1, C2, arrow_map, bucketed, cut, named, partitions, release, setting

SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
#: UTF-8 has no such byte; it ends a context.
END = 0xFF


@dataclass(frozen=True)
class Params:
    """width: bytes of a string, even. gram: bytes of a piece, a multiple of 8. hot: documents of a fingerprint beyond which its windows are
    grouped one by one (a task holds about 100 bytes for each; more for more than 4 TB of text, so that no more than a few million are hot); kept: fingerprints of a task's
    summary; held_windows: most hot windows that are broadcast. shard_bytes: of contexts. bucket_bytes: of text for each bucket, so that a
    bucket fits a task; groups: of documents for each bucket; most: partitions. piece: windows of a text at once. longest: windows of a run."""

    width: int = 50
    gram: int = 24
    hot: int = 500_000
    kept: int = 4_000_000
    held_windows: int = 100_000
    shard_bytes: int = 1 << 19
    bucket_bytes: int = 16 << 20
    groups: int = 4
    most: int = 20_000
    piece: int = 1 << 20
    longest: int = 64


# ---- fingerprints ----


def fingerprints(text: bytes, p: Params) -> np.ndarray:
    """Of each window of text, 48 bits."""
    n = len(text) - p.width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    a = np.frombuffer(text + bytes(8), np.uint8)
    words = np.ndarray((len(text),), np.uint64, a, strides=(1,))
    m = len(text) - p.gram + 1
    with np.errstate(over="ignore"):
        h = words[:m] * C1
        for o in range(8, p.gram, 8):
            h ^= h >> np.uint64(29)
            h += words[o : o + m]
            h *= C2
        h ^= h >> np.uint64(32)
    have, want = 1, p.width - p.gram + 1
    while have < want:  # the least of `want` neighbours
        step = min(have, want - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h >> np.uint64(16)


def runs(text: bytes, p: Params) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of a text's runs: fingerprint, first window, number of windows."""
    for at in range(0, max(0, len(text) - p.width + 1), p.piece):
        f = fingerprints(text[at : at + p.piece + p.width - 1], p)
        cuts = np.append(np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])), len(f))
        if np.diff(cuts).max() > p.longest:
            cuts = np.unique(np.concatenate([cuts, *(np.arange(a, z, p.longest) for a, z in zip(cuts[:-1], cuts[1:]) if z - a > p.longest)]))
        yield f[cuts[:-1]], cuts[:-1] + at, np.diff(cuts)


def packed(prints: np.ndarray) -> bytes:
    """48-bit numbers in 6 bytes each."""
    return (prints >> np.uint64(16)).astype(np.uint32).tobytes() + (prints & np.uint64(0xFFFF)).astype(np.uint16).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = len(data) // 6
    return np.frombuffer(data, np.uint32, n).astype(np.uint64) << np.uint64(16) | np.frombuffer(data, np.uint16, n, 4 * n).astype(np.uint64)


def ids_packed(ids: np.ndarray) -> bytes:
    """Ids as offsets from the least, in 4 bytes each if they fit."""
    base = int(ids.min())
    off = ids - base
    small = int(off.max()) < 1 << 32
    return struct.pack("<q?", base, small) + off.astype(np.uint32 if small else np.int64).tobytes()


def ids_unpacked(data: bytes) -> np.ndarray:
    base, small = struct.unpack_from("<q?", data)
    return np.frombuffer(data, np.uint32 if small else np.int64, -1, 9).astype(np.int64) + base


# ---- transforms ----


class Shard:
    """The sorted rotations of a set of different contexts, each ended by END bytes to an even length: `bwt` has, in sorted order, the four
    bytes before each; `string` and `offset` tell which rotation it is."""

    def __init__(self, contexts: list[bytes]):
        ended = [c + bytes([END]) * (2 + len(c) % 2) for c in contexts]
        sizes = np.array([len(e) for e in ended])
        width = int(sizes.max()) + 8
        flat = b"".join([*((e * (width // len(e) + 2)) for e in ended), bytes(8)])
        a = np.frombuffer(flat, np.uint8)
        lengths = np.array([len(e) * (width // len(e) + 2) for e in ended])
        base = np.cumsum(lengths) - lengths
        self.string = np.repeat(np.arange(len(ended)), sizes)
        self.offset = np.arange(len(self.string)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = base[self.string] + self.offset
        words = np.ndarray((len(flat) - 8,), np.uint64, a, strides=(1,))
        key = words[at].byteswap()
        order = np.argsort(key)
        k, t, g = key[order], np.arange(len(at)), np.zeros(len(at), np.int64)
        for depth in range(8, width, 8):  # sort again only where the bytes so far agree
            new = np.ones(len(t) + 1, bool)
            new[1:-1] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
            tied = np.flatnonzero(~(new[1:] & new[:-1]))
            if not len(tied):
                break
            t, g = t[tied], np.cumsum(new[:-1])[tied]
            k = words[at[order[t]] + depth].byteswap()
            o = np.lexsort((k, g))
            order[t], k = order[t][o], k[o]
        before = base[self.string] + np.where(self.offset >= 4, self.offset - 4, self.offset - 4 + sizes[self.string])
        bwt = words[before].astype(np.uint32).byteswap()
        self.bwt, self.string, self.offset = bwt[order], self.string[order], self.offset[order]


def interleaved(bwts: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms by refining their interleave. For each suffix in merged order its shard, and its common prefix with the one before,
    in steps of four bytes, up to width."""
    b = np.concatenate(bwts)
    z = np.repeat(np.arange(len(bwts), dtype=np.uint8 if len(bwts) < 256 else np.uint16), [len(x) for x in bwts])
    block, lcp, same = np.zeros(len(b), np.int32), np.zeros(len(b), np.uint16), np.zeros(len(b), bool)
    for depth in range(0, width, 4):
        step = min(4, width - depth)
        merged = np.empty_like(b)
        merged[np.argsort(z, kind="stable")] = b
        # stably by the last two of the symbol's bytes, then by the first two: 16 bits at a time are sorted in linear time
        order = np.argsort(merged.astype(np.uint16), kind="stable")
        if step == 4:
            order = order.take(np.argsort((merged >> np.uint32(16)).astype(np.uint16).take(order), kind="stable"))
        else:
            merged &= np.uint32(0xFFFF)
        c, before = merged.take(order), block.take(order)
        np.logical_and(c[1:] == c[:-1], before[1:] == before[:-1], out=same[1:])
        lcp += same * np.uint16(step)  # blocks are only ever split, so what is the same now was so before
        np.cumsum(~same, dtype=np.int32, out=block)
        z = z.take(order)
    return z, lcp


def window_minima(contexts: list[bytes], windows: np.ndarray, docs: np.ndarray, p: Params) -> np.ndarray:
    """For each window of each context (in order) the least of docs over all contexts that have the same string as a window."""
    shards, part, size = [], [], 0
    for i, c in enumerate(contexts):
        part.append(i)
        size += len(c)
        if size >= p.shard_bytes or i + 1 == len(contexts):
            shards.append(part)
            part, size = [], 0
    built = [Shard([contexts[i] for i in s]) for s in shards]
    z, lcp = interleaved([s.bwt for s in built], p.width)
    interval = np.cumsum(lcp < p.width) - 1  # a repeated interval: neighbours whose common prefix has the full width
    own = interval[np.argsort(z, kind="stable")]  # in the order of the shards again
    string = np.concatenate([s.string + part[0] for s, part in zip(built, shards)])
    offset = np.concatenate([s.offset for s in built])
    real = offset < windows[string]
    string, offset, own = string[real], offset[real], own[real]
    least = np.full(int(own.max(initial=-1)) + 1, np.iinfo(np.int64).max, np.int64)
    np.minimum.at(least, own, docs[string])
    out = np.empty(int(windows.sum()), np.int64)
    out[(np.cumsum(windows) - windows)[string] + offset] = least[own]
    return out


# ---- the stages on executors ----
# Documents are dealt into groups by a hash of doc_id. What is sent to or from a group is packed, a row for each bucket and group.


def _cuts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted arrays, and the end."""
    n = len(keys[0])
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.append(np.flatnonzero(new), n)


def _longs(values: np.ndarray) -> bytes:
    return values.astype(np.int64).tobytes()


def _joined(table: pa.Table, column: str, read) -> np.ndarray:
    """The unpacked values of all rows of a column."""
    parts = [read(x.as_py()) for x in table.column(column)]
    return np.concatenate(parts) if parts else read(b"")


def _slices(keys: np.ndarray, wanted: list) -> Iterator[slice | None]:
    """For each wanted key where it lies in sorted keys; None for a null."""
    at = np.array([0 if x is None else x for x in wanted], np.int64)
    for x, i, j in zip(wanted, np.searchsorted(keys, at), np.searchsorted(keys, at, side="right")):
        yield None if x is None else slice(i, j)


def _print_rows(batch: pa.RecordBatch, buckets: int, hot: np.ndarray, p: Params) -> Iterator[dict]:
    """Of a batch of documents(doc_id, text, g): for each group and bucket the (fingerprint, document) pairs, packed; without hot ones."""
    prints, docs, groups, held = [], [], [], 0

    def rows() -> Iterator[dict]:
        f, d, g = np.concatenate(prints), np.concatenate(docs), np.concatenate(groups)
        b = (f % np.uint64(buckets)).astype(np.int32)
        o = np.lexsort((f, g, b))
        f, d, g, b = f[o], d[o], g[o], b[o]
        c = _cuts(b, g)
        spans = list(zip(c[:-1], c[1:]))
        yield {"bucket": pa.array(b[c[:-1]], pa.int32()), "g": pa.array(g[c[:-1]], pa.int32()), "prints": pa.array([packed(f[i:j]) for i, j in spans], pa.binary()), "docs": pa.array([ids_packed(d[i:j]) for i, j in spans], pa.binary())}

    for doc, text, g in zip(*(batch.column(i).to_pylist() for i in range(3))):
        for f, _, _ in runs(text, p):
            f = np.unique(f)
            f = f[~_among(f, hot)]
            prints.append(f), docs.append(np.full(len(f), doc)), groups.append(np.full(len(f), g, np.int32))
            held += len(f)
        if held > 1_000_000:
            yield from rows()
            prints, docs, groups, held = [], [], [], 0
    if held:
        yield from rows()


def _repeated(table: pa.Table, hot: np.ndarray) -> pa.Table:
    """Of a bucket: for each group its documents' fingerprints that other documents have too; those in hot aside."""
    f = _joined(table, "prints", unpacked)
    d = _joined(table, "docs", ids_unpacked)
    g = np.repeat(np.array(table.column("g")), [len(x.as_py()) // 6 for x in table.column("prints")]).astype(np.int32)
    o = np.lexsort((d, f))
    f, d, g = f[o], d[o], g[o]
    first = np.concatenate([[True], f[1:] != f[:-1]])
    keep = first | np.concatenate([[True], d[1:] != d[:-1]])
    f, d, g, first = f[keep], d[keep], g[keep], first[keep]
    count = np.diff(np.append(np.flatnonzero(first), len(f)))
    many = np.repeat(count, count) > 1
    f, d, g = f[many], d[many], g[many]
    o = np.argsort(g, kind="stable")
    f, d, g = f[o], d[o], g[o]
    c = _cuts(g) if len(g) else np.zeros(1, np.int64)
    spans = list(zip(c[:-1], c[1:]))
    return pa.table({"g": pa.array(g[c[:-1]], pa.int32()), "docs": pa.array([ids_packed(d[i:j]) for i, j in spans], pa.binary()), "prints": pa.array([packed(f[i:j]) for i, j in spans], pa.binary())})


def summary(prints: Iterator[np.ndarray], kept: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of the numbers in prints, and counts that are at most too low by total / (kept / 2): whenever there are more than
    `kept` numbers, the count of the one in the middle is taken from all, and those without a rest go."""
    f, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    part: list[np.ndarray] = []
    held = 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        x, m = np.unique(np.concatenate(part), return_counts=True)
        every = np.concatenate([f, x])
        u, at = np.unique(every, return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, at, np.concatenate([n, m]))
        if len(u) > kept:
            total -= np.partition(total, -(kept // 2))[-(kept // 2)]
            u, total = u[total > 0], total[total > 0]
        return u, total

    for x in prints:
        part.append(x)
        held += len(x)
        if held > 2_000_000:
            f, n = joined()
            part, held = [], 0
    return joined() if part else (f, n)


def hot_prints(live: DataFrame, hot: int, p: Params) -> np.ndarray:
    """The sorted fingerprints of `hot` documents or more, and some of half as many. What comes to the driver is bounded: twice the number of
    fingerprints in all documents, divided by hot."""
    tasks = live.rdd.getNumPartitions()
    least = max(1, hot // (2 * tasks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (np.unique(np.concatenate([f for f, _, _ in runs(t, p)])) for b in batches for t in b.column(0).to_pylist() if len(t) >= p.width)
        f, n = summary(each, p.kept)
        f, n = f[n >= least], n[n >= least]
        yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(n)], names=["f", "n"])

    found = live.select("text").mapInArrow(run, "f bigint, n bigint").groupBy("f").agg(F.sum("n").alias("n")).where(F.col("n") * 2 >= hot).select("f").collect()
    return np.array(sorted(r["f"] for r in found), np.int64).view(np.uint64)


def _among(f: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of f are in the sorted array known."""
    return known[np.minimum(np.searchsorted(known, f), len(known) - 1)] == f if len(known) else np.zeros(len(f), bool)


def _tags(ids: list, texts: pa.ChunkedArray, live: list[bool]) -> list[int]:
    """What tells live rows with the same doc_id, which are all in one group, from each other: 0 where there is one only."""
    count: dict = {}
    for i, x in zip(ids, live):
        count[i] = count.get(i, 0) + x
    return [xxhash.xxh3_64_intdigest(t.as_py()) >> 1 if count[i] > 1 else 0 for i, t in zip(ids, texts)]


def _wanted(texts: pa.Table, told: pa.Table, p: Params) -> Iterator[tuple]:
    """Of a group: document, tag, text, and the runs (fingerprint, first window, number) that were told to it."""
    if not told.num_rows or not texts.num_rows:
        return
    d, f = _joined(told, "docs", ids_unpacked), _joined(told, "prints", unpacked)
    o = np.lexsort((f, d))
    d, f = d[o], f[o]
    ids = texts.column("doc_id").to_pylist()
    tags = _tags(ids, texts.column("text"), [True] * len(ids))
    for doc, tag, text, at in zip(ids, tags, texts.column("text"), _slices(d, ids)):
        mine = f[at]
        if len(mine):
            text = text.as_py()
            for x, start, n in runs(text, p):
                has = _among(x, mine)
                yield doc, tag, text, x[has], start[has], n[has]


RUNS = "bucket int, g int, runs binary"


def _run_rows(texts: pa.Table, told: pa.Table, buckets: int, p: Params) -> pa.Table:
    """Of a group: for each bucket the runs whose fingerprints repeat, with their bytes, packed and compressed."""
    fs, ds, ts, starts, ns, bytes_ = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for doc, tag, text, f, s, n in _wanted(texts, told, p):
        fs.append(f), ds.append(np.full(len(f), doc)), ts.append(np.full(len(f), tag)), starts.append(s), ns.append(n)
        bytes_ += [text[a : a + k] for a, k in zip(s.tolist(), (n + p.width - 1).tolist())]
    f, d, t, s, n = (np.concatenate(x) for x in (fs, ds, ts, starts, ns))
    b = (f % np.uint64(buckets)).astype(np.int32)
    o = np.lexsort((f, b))
    out: dict[str, list] = {"bucket": [], "runs": []}
    c = _cuts(b[o]) if len(o) else np.zeros(1, np.int64)
    for i, j in zip(c[:-1], c[1:]):
        k = o[i:j]
        raw = b"".join([struct.pack("<I", len(k)), packed(f[k]), s[k].astype(np.uint32).tobytes(), n[k].astype(np.uint8).tobytes(), _longs(t[k]), b"".join([bytes_[x] for x in k.tolist()]), ids_packed(d[k])])
        out["bucket"].append(int(b[k[0]]))
        out["runs"].append(struct.pack("<I", len(raw)) + pa.compress(raw, "zstd", asbytes=True))
    g = texts.column("g")[0].as_py() if texts.num_rows else 0
    return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "g": pa.array([g] * len(out["bucket"]), pa.int32()), "runs": pa.array(out["runs"], pa.binary())})


SPANS = "g int, docs binary, tags binary, firsts binary, ns binary"


def _decided(table: pa.Table, p: Params) -> pa.Table:
    """Of a bucket: for each group the windows of its documents that go, as (document, tag, first, number)."""
    fs, ds, ts, ss, ns, gs, cids = [], [], [], [], [], [], []
    number: dict[bytes, int] = {}
    contexts: list[bytes] = []
    for g, x in zip(table.column("g").to_pylist(), table.column("runs")):
        data = x.as_py()
        raw = pa.decompress(data[4:], struct.unpack_from("<I", data)[0], "zstd", asbytes=True)
        m = struct.unpack_from("<I", raw)[0]
        fs.append(unpacked(raw[4 : 4 + 6 * m]))
        ss.append(np.frombuffer(raw, np.uint32, m, 4 + 6 * m))
        n = np.frombuffer(raw, np.uint8, m, 4 + 10 * m)
        ns.append(n)
        ts.append(np.frombuffer(raw, np.int64, m, 4 + 11 * m))
        gs.append(np.full(m, g, np.int32))
        at = 4 + 19 * m
        ends = at + np.cumsum(n.astype(np.int64) + p.width - 1)
        ds.append(ids_unpacked(raw[int(ends[-1]) :]))
        mine = np.empty(m, np.int32)
        for k, z in enumerate(ends.tolist()):
            c = raw[at:z]
            i = number.setdefault(c, len(number))
            if i == len(contexts):
                contexts.append(c)
            mine[k] = i
            at = z
        cids.append(mine)
    f, d, t, s, n, g, cid = (np.concatenate(x) for x in (fs, ds, ts, ss, ns, gs, cids))
    del fs, ds, ts, ss, ns, gs, cids, number
    least = np.full(len(contexts), np.iinfo(np.int64).max)
    np.minimum.at(least, cid, d)
    cf, cn = np.empty(len(contexts), np.uint64), np.empty(len(contexts), np.int64)
    cf[cid], cn[cid] = f, n
    _, family, members = np.unique(cf, return_inverse=True, return_counts=True)
    hard = members[family] > 1
    # the minimum of each window of each context
    base = np.cumsum(cn) - cn
    minima = np.repeat(least, cn)
    which = np.flatnonzero(hard)
    if len(which):
        minima[np.repeat(hard, cn)] = window_minima([contexts[i] for i in which], cn[which], least[which], p)
    del contexts
    out: list[tuple] = []
    for i in range(0, len(d), 50_000):
        part = slice(i, i + 50_000)
        k = n[part].astype(np.int64)
        occ = np.repeat(np.arange(len(k)), k)
        j = np.arange(len(occ)) - np.repeat(np.cumsum(k) - k, k)
        go = d[part][occ] > minima[base[cid[part][occ]] + j]
        at = occ[go]
        out.append((g[part][at], d[part][at], t[part][at], s[part][at] + j[go]))
    return _span_rows(*(np.concatenate(x) for x in zip(*out)))


def _span_rows(g: np.ndarray, doc: np.ndarray, tag: np.ndarray, w: np.ndarray) -> pa.Table:
    """Windows that go, as runs, a row for each group. Tags are left out where all are 0."""
    if not len(w):
        return pa.table({"g": pa.array([], pa.int32())} | {k: pa.array([], pa.binary()) for k in ("docs", "tags", "firsts", "ns")})
    w = w.astype(np.int64)
    o = np.lexsort((w, tag, doc, g))
    g, doc, tag, w = g[o], doc[o], tag[o], w[o]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (w[1:] > w[:-1] + 1)
    a = np.flatnonzero(new)
    last = np.append(a[1:], len(doc)) - 1
    g, doc, tag, first, n = g[a], doc[a], tag[a], w[a], w[last] - w[a] + 1
    c = _cuts(g)
    spans = list(zip(c[:-1], c[1:]))
    tags = [_longs(tag[i:j]) if tag[i:j].any() else b"" for i, j in spans]
    return pa.table({"g": pa.array(g[c[:-1]], pa.int32()), "docs": pa.array([_longs(doc[i:j]) for i, j in spans], pa.binary()), "tags": pa.array(tags, pa.binary())} | {k: pa.array([_longs(v[i:j]) for i, j in spans], pa.binary()) for k, v in (("firsts", first), ("ns", n))})


def _hot_rows(texts: pa.Table, hot: np.ndarray, p: Params) -> pa.Table:
    """Of a group: the windows of hot fingerprints, one by one."""
    doc_, tag_, win, start = [], [], [], []
    ids = texts.column("doc_id").to_pylist()
    for doc, tag, text in zip(ids, _tags(ids, texts.column("text"), [True] * len(ids)), texts.column("text")):
        text = text.as_py()
        for f, s, n in runs(text, p):
            has = _among(f, hot)
            w = [x for a, k in zip(s[has].tolist(), n[has].tolist()) for x in range(a, a + k)]
            doc_ += [doc] * len(w)
            tag_ += [tag] * len(w)
            win += [text[x : x + p.width] for x in w]
            start += w
    return pa.table({"g": pa.array([texts.column("g")[0].as_py()] * len(win), pa.int32()), "doc_id": pa.array(doc_, pa.int64()), "tag": pa.array(tag_, pa.int64()), "win": pa.array(win, pa.binary()), "start": pa.array(start, pa.int64())})


def _going(texts: pa.Table, spans: pa.Table, p: Params) -> Iterator[np.ndarray]:
    """Of a group: for each text which of its bytes go."""
    read = lambda x: np.frombuffer(x, np.int64)
    d, first, n = (_joined(spans, k, read) for k in ("docs", "firsts", "ns"))
    tag = np.concatenate([np.zeros(0, np.int64), *(read(x.as_py() or bytes(len(y.as_py()))) for x, y in zip(spans.column("tags"), spans.column("docs")))])
    o = np.lexsort((tag, d))
    d, tag, first, end = d[o], tag[o], first[o], first[o] + n[o] + p.width - 1
    ids, copies = texts.column("_id").to_pylist(), texts.column("copy").to_pylist()
    tags = _tags(ids, texts.column("_text"), [not x for x in copies])
    for text, copy, mine, at in zip(texts.column("_text"), copies, tags, _slices(d, ids)):
        size = len(text.as_py())
        if copy and size >= p.width:
            yield np.ones(size, bool)
            continue
        step = np.zeros(size + 1, np.int32)
        if at is not None and at.stop > at.start:
            own = tag[at] == mine
            np.add.at(step, first[at][own], 1)
            np.add.at(step, end[at][own], -1)
        yield np.cumsum(step[:-1]) > 0


# ---- the operator ----


def removals(docs: DataFrame, p: Params, others: list[str]) -> tuple[DataFrame, DataFrame]:
    """A table of texts, bucketed by group: _g, _id, _text (binary, null: empty), copy (if a smaller id has the whole text), and the columns
    `others` as _o0, _o1, ...; and the spans that go, packed by bucket and group. Both are dealt alike."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ids = cut(docs.select(F.col("doc_id").cast("bigint"), F.unhex(F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)).alias("sha")).distinct())
    buckets = max(partitions(spark), -(-total // p.bucket_bytes))
    n = min(buckets, p.most)
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(p.groups * buckets)).cast("int")
    groups = ids.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last")
    copies = ids.join(groups, "sha").where("doc_id > first").select("doc_id", F.col("sha").alias("_sha"))
    # the one shuffle of the texts; the table it fills is bucketed, so what follows meets it where it is
    wide = docs.select(group(F.col("doc_id").cast("bigint")).alias("_g"), F.col("doc_id").cast("bigint").alias("_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("_text"), *[named(c).alias(f"_o{i}") for i, c in enumerate(others)])
    flags = copies.withColumn("_cg", group(F.col("doc_id"))).repartition(n, "_cg").hint("shuffle_hash")
    same = (F.col("_g") == F.col("_cg")) & (F.col("_id") == F.col("doc_id")) & (F.unhex(F.sha2("_text", 256)) == F.col("_sha"))
    dealt = wide.repartition(n, "_g").join(flags, same, "left").withColumn("copy", F.col("doc_id").isNotNull()).drop("doc_id", "_sha", "_cg")
    # both sides are dealt by _g, which is enough for a join on it and more; else Spark would deal the texts again by all keys
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        texts = bucketed(dealt, n, "_g", "texts")
    release(spark)
    live = texts.where("_id is not null and not copy").select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.col("_g").alias("g"))
    hot, most = np.zeros(0, np.uint64), max(p.hot, total >> 23)
    if ids.count() >= most:
        hot = hot_prints(live, most, p)
        release(spark)
    known = spark.sparkContext.broadcast(hot)
    prints = arrow_map(live, lambda b: _print_rows(b, buckets, known.value, p), "bucket int, g int, prints binary, docs binary")
    told = cut(prints.repartition(n, "bucket").groupBy("bucket").applyInArrow(lambda t: _repeated(t, known.value), "g int, docs binary, prints binary"))
    release(spark)
    found = live.groupBy("g").cogroup(told.repartition(n, "g").groupBy("g")).applyInArrow(lambda x, y: _run_rows(x, y, buckets, p), RUNS)
    spans = cut(found.repartition(n, "bucket").groupBy("bucket").applyInArrow(lambda t: _decided(t, p), SPANS))
    release(spark)
    if len(hot):
        windows = live.groupBy("g").applyInArrow(lambda x: _hot_rows(x, known.value, p), "g int, doc_id bigint, tag bigint, win binary, start bigint")
        least = cut(windows.groupBy("win").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least <> last").select("win", "least"))
        gone = windows.join(F.broadcast(least) if least.count() <= p.held_windows else least, "win").where("doc_id > least").select("g", "doc_id", "tag", "start")
        pack = lambda b: iter(_span_rows(*(np.array(b.column(i)) for i in range(4))).to_batches())
        spans = cut(spans.union(gone.mapInArrow(lambda batches: (y for b in batches for y in pack(b)), SPANS)))
        release(spark)
    return texts, spans.repartition(n, "g")


def _applied(docs: DataFrame, p: Params, others: list[str], f, schema) -> DataFrame:
    """f(texts, which of each one's bytes go) of each group."""
    texts, spans = removals(docs, p, others)
    return texts.groupBy("_g").cogroup(spans.groupBy("g")).applyInArrow(lambda x, y: f(x, _going(x, y, p)), schema)


def substring_dedup(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each row of docs(doc_id, text): n_bytes, n_removed, n_spans (maximal runs that go), kept_sha256 (of what stays)."""

    def run(texts: pa.Table, going: Iterator[np.ndarray]) -> pa.Table:
        out: list[tuple] = []
        for text, go in zip(texts.column("_text"), going):
            kept = np.frombuffer(text.as_py(), np.uint8)[~go].tobytes()
            out.append((len(go), int(go.sum()), int((go & ~np.concatenate([[False], go[:-1]])).sum()) if len(go) else 0, hashlib.sha256(kept).hexdigest()))
        c = list(zip(*out)) or [()] * 4
        return pa.table({"doc_id": texts.column("_id")} | {k: pa.array(v, t) for k, v, t in zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), c, (pa.int64(), pa.int64(), pa.int64(), pa.string()))})

    return _applied(docs, p, [], run, SCHEMA)


def without_repeats(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """docs with what goes cut out of text, and n_chars, if there is such a column, counted anew. Pieces of a character whose other bytes went
    go as well. Documents of which nothing stays are dropped, if they weren't empty before."""
    names, schema = docs.columns, docs.schema
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(table: pa.Table, going: Iterator[np.ndarray]) -> pa.Table:
        texts, sizes, stays = [], [], []
        for old, go in zip(table.column(f"_o{at}").to_pylist(), going):
            cuts = bool(go.any())
            new = np.frombuffer(old.encode(), np.uint8)[~go].tobytes().decode("utf-8", "ignore") if cuts else old
            texts.append(new), sizes.append(len(new) if cuts else None), stays.append(not cuts or new != "")
        cols = [table.column(f"_o{i}") for i in range(len(names))]
        cols[at] = pa.array(texts, cols[at].type)
        if chars is not None:
            cols[chars] = pa.array([o if n is None else n for n, o in zip(sizes, cols[chars].to_pylist())], cols[chars].type)
        return pa.table(dict(zip(names, cols))).filter(pa.array(stays, pa.bool_()))

    return _applied(docs, p, names, run, schema)
