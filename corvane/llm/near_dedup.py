"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct k-word shingles (A-Z lower-cased; of a text with fewer words, all of them as one).
Its sketch has `registers` values: register i is floor(1 - log_b x_i), x_i the least of exponentially distributed hashes of
the shingles. Registers of a union are the maxima of the parts' registers, and equal registers are the likelier the more
similar two sets are.

1. One pass over the texts makes sketch, set size and a 128-bit digest of each set. Equal sets are one class from there on.
2. `rows` registers in a row are a band; classes with an equal band share a bucket. In each bucket all are paired with its
   least member only.
3. Pairs are dropped if their sizes rule the threshold out, or if the joint likelihood of both sketches puts the similarity
   more than `slack` below it; the rest is verified on the full sets, as words, not as hashes.
4. Connected components of the links. Buckets that still hold several components can hide links between members that are
   not the least. Small ones give their pairs across components as rows, to be estimated and verified as before. Members of
   large ones are dealt into blocks, by number and by bytes of their sets; a task holds two blocks and counts intersections
   exactly: a member outside the largest component is compared with those that have one of its rarest shingles (its prefix,
   of which any partner must have one), and only links that join two components leave the task. So what is written grows
   with the members, not with their pairs, however many of them lie just under the threshold.

So the links missed are those whose bands all differ: with 32 bands of 4 registers (0.85: 1 - 0.85**4 = 0.48 for a band)
5 in 10**11, and those misjudged by 0.12 by the likelihood (over 5 standard errors of 0.022 at 256 registers).

Null texts and texts without words have empty sets and are linked with nothing. Rows that repeat a doc_id are one node, with
all links that any of its texts has; each is returned. A row without doc_id takes no part: its component is null and it is
kept. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import WordHash, arrow_map, cut, partitions, release, shingle_hashes
from corvane.llm.graph import components, joined

#: Tasks that the members of a bucket may be dealt to for a join with the bucket's row.
SALTS = 16
#: Shift of the registers, so that all sets from 1 to 2**60 shingles have registers in 16 bits.
SHIFT = 6000


@dataclass(frozen=True)
class Params:
    """shingle: words. pct: link with 100 * intersection >= pct * union. registers: of a sketch; the first bands * rows of them make bands.
    base: of the registers' logarithm. small: the largest bucket whose pairs are made as rows; block, block_shingles: members of larger ones, and
    shingles of theirs, in a block."""

    shingle: int = 3
    pct: int = 85
    registers: int = 256
    bands: int = 32
    rows: int = 4
    base: float = 1.001
    slack: float = 0.12
    small: int = 12
    block: int = 4096
    block_shingles: int = 1 << 21


def shingle_set(text: bytes | None, hashes: WordHash, p: Params) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(hashes.of((text or b"").lower().split()), p.shingle))


def word_set(text: bytes | None, p: Params) -> frozenset[bytes]:
    """The distinct shingles of a text, as its words."""
    w = (text or b"").lower().split()
    return frozenset(b" ".join(w[i : i + p.shingle]) for i in range(max(1, len(w) - p.shingle + 1))) if w else frozenset()


def factors(m: int) -> np.ndarray:
    """An odd 64-bit factor for each register."""
    return np.array([xxhash.xxh3_64_intdigest(b"register %d" % i) | 1 for i in range(m)], np.uint64)


def sketch(u: np.ndarray, a: np.ndarray, base: float) -> np.ndarray:
    """The registers of the non-empty set u of hashes."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(u), 512):
            np.minimum(least, (u[i : i + 512, None] * a).min(axis=0), out=least)
    x = -np.log1p(-np.minimum((least.astype(np.float64) + 1) * 2.0**-64, 1 - 2.0**-53))  # an exponential from a uniform
    return np.clip(np.floor(1 - np.log(x) / math.log(base)) + SHIFT, 0, 65535).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def likeliest(more: np.ndarray, less: np.ndarray, same: np.ndarray, n1: np.ndarray, n2: np.ndarray, base: float) -> np.ndarray:
    """The maximum-likelihood similarity of pairs of sets of n1 and n2 elements, of whose registers `more` are larger in the first,
    `less` in the second, `same` equal. Over a grid of 200 similarities up to the largest that the sizes allow."""
    u, v = n1 / (n1 + n2), n2 / (n1 + n2)
    top = np.minimum(u / v, v / u)
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    lp = lambda x: -np.log(np.maximum(1 - np.maximum(x, 0) * (base - 1) / base, 1e-300)) / math.log(base)
    for j in np.linspace(0, 1, 201):
        s = j * top
        p1, p2 = lp(u - v * s), lp(v - u * s)
        p0 = np.maximum(1 - p1 - p2, 1e-12)
        ll = more * np.log(np.maximum(p1, 1e-12)) + less * np.log(np.maximum(p2, 1e-12)) + same * np.log(p0)
        at, best = np.where(ll > best, s, at), np.maximum(ll, best)
    return at


def plausible(k1: np.ndarray, k2: np.ndarray, n1: np.ndarray, n2: np.ndarray, p: Params) -> np.ndarray:
    """Which pairs (rows of registers k1, k2 and set sizes) can reach the threshold."""
    sizes = 100 * np.minimum(n1, n2) >= p.pct * np.maximum(n1, n2)
    out = np.zeros(len(n1), bool)
    i = np.flatnonzero(sizes)
    # about J of the registers are equal, so far fewer equal ones need no likelihood (another 6 standard errors)
    i = i[(k1[i] == k2[i]).sum(1) >= (p.pct / 100 - p.slack - 0.15) * k1.shape[1]]
    if len(i):
        more, less = (k1[i] > k2[i]).sum(1), (k1[i] < k2[i]).sum(1)
        out[i] = likeliest(more, less, k1.shape[1] - more - less, n1[i].astype(float), n2[i].astype(float), p.base) >= p.pct / 100 - p.slack
    return out


def features(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, n (set size), digest of the set and registers (both null for an empty set), for each row."""
    a = factors(p.registers)
    hashes = WordHash()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        n, dig, reg = [], [], []
        for text in batch.column(1).to_pylist():
            u = shingle_set(text, hashes, p)
            n.append(len(u))
            dig.append(xxhash.xxh3_128_digest(u.tobytes()) if len(u) else None)
            reg.append(sketch(u, a, p.base).tobytes() if len(u) else None)
        yield {"doc_id": batch.column(0), "n": pa.array(n, pa.int64()), "digest": pa.array(dig, pa.binary()), "reg": pa.array(reg, pa.binary())}

    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")), run, "doc_id bigint, n bigint, digest binary, reg binary")


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each row of docs(doc_id, text): doc_id, n_shingles, component_id (the least doc_id linked, over any number of links),
    kept (doc_id = component_id)."""
    feats = cut(features(docs, p))
    classes = cut(feats.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("reg").alias("reg")))
    width = 2 * p.rows
    bands = F.transform(F.sequence(F.lit(0), F.lit(p.bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("reg"), i * width + 1, F.lit(width))))
    keys = classes.select("node", "n", F.explode(bands).alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("size")).where("size > 1")
    members = cut(keys.join(buckets, "key"))
    release(docs.sparkSession)
    texts_of = _Texts(docs, members.select("node").distinct())
    release(docs.sparkSession)
    first = members.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    links = _verified(_estimated(first, classes, p), texts_of, p)
    twice = _several(feats)
    if twice.take(1):
        links = links.union(_same_document(twice, feats, classes))
    comps = cut(components(cut(links)))
    open_ = cut(_open(members.where("size > 2").drop("least"), comps))
    release(docs.sparkSession)
    more = _verified(_estimated(_few(open_, p), classes, p), texts_of, p).union(_blocks(open_, texts_of, p))
    more = cut(more)
    if more.take(1):
        comps = cut(joined(comps, more))
    labels = classes.select("digest", F.col("node").alias("_node")).join(comps.withColumnRenamed("node", "_node"), "_node", "left")
    labels = labels.select("digest", F.coalesce("component", "_node").alias("component"))
    out = feats.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(labels, "digest", "left")
    comp = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == comp)).alias("kept"))


def representatives(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs that are kept, one document of each component, with all their columns. Rows that share a doc_id are one document:
    they stay or go together."""
    kept = near_duplicates(docs, p).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi")
    return named.unionByName(docs.where("doc_id is null"))


class _Texts:
    """The texts of classes in pairs, gathered once."""

    def __init__(self, docs: DataFrame, nodes: DataFrame):
        texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("binary").alias("text"))
        self.df = cut(texts.join(nodes, "node", "left_semi"))

    def on(self, pairs: DataFrame, node: str, to: str) -> DataFrame:
        return pairs.join(self.df.select(F.col("node").alias(node), F.col("text").alias(to)), node)


def _estimated(pairs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out. Nodes stand for classes; a doc_id of several texts for each of these."""
    side = lambda x, k: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{k}"), F.col("reg").alias(f"k{k}"))
    wide = pairs.join(side("a", 1), "a").join(side("b", 2), "b").where(f"100 * least(n1, n2) >= {p.pct} * greatest(n1, n2)")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        if not batch.num_rows:
            return
        k1, k2 = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in (3, 5))
        ok = pa.array(plausible(k1, k2, np.array(batch.column(2)), np.array(batch.column(4)), p))
        yield {"a": batch.column(0).filter(ok), "b": batch.column(1).filter(ok)}

    return arrow_map(wide.select("a", "b", "n1", "k1", "n2", "k2"), run, "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: _Texts, p: Params) -> DataFrame:
    """The pairs whose full sets are linked. Sets are of words here, not of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, frozenset())
        for batch in batches:
            ok = []
            for t1, t2 in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if last[0] != t1:
                    last = (t1, word_set(t1, p))
                s, t = last[1], word_set(t2, p)
                both = len(s & t)
                ok.append(both > 0 and 100 * both >= p.pct * (len(s) + len(t) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    wide = texts.on(texts.on(pairs, "b", "t2"), "a", "t1").select("a", "b", "t1", "t2")
    return wide.mapInArrow(run, "a bigint, b bigint")


def _several(feats: DataFrame) -> DataFrame:
    """The doc_ids that have texts of several classes."""
    ids = feats.where("digest is not null and doc_id is not null").select("doc_id", F.xxhash64("digest").alias("h"))
    return cut(ids.groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("doc_id"))


def _same_document(several: DataFrame, feats: DataFrame, classes: DataFrame) -> DataFrame:
    """Links that join these classes for each such doc_id."""
    nodes = feats.where("digest is not null").join(several, "doc_id", "left_semi").select("doc_id", "digest").distinct().join(classes.select("digest", "node"), "digest")
    least = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
    return nodes.join(least, "doc_id").where("a <> node").select("a", F.col("node").alias("b"))


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The members, with their components, of buckets that hold several."""
    named = members.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return named.join(several, "key")


def _few(open_: DataFrame, p: Params) -> DataFrame:
    """All pairs across components of small buckets: at most small**2 / 2 of each."""
    few = open_.where(F.col("size") <= p.small).groupBy("key").agg(F.collect_list(F.struct("node", "component")).alias("m"))
    few = few.select(F.explode("m").alias("x"), "m").select("x", F.explode("m").alias("y"))
    return few.where("x.node < y.node and x.component <> y.component").select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _blocks(open_: DataFrame, texts: _Texts, p: Params) -> DataFrame:
    """Links that join components within large buckets: members are dealt into blocks, and each two blocks of a bucket meet in one task."""
    many = open_.where(F.col("size") > p.small)
    hashes = WordHash()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"node": batch.column(0), "shingles": pa.array([shingle_set(t, hashes, p).tobytes() for t in batch.column(1).to_pylist()], pa.binary())}

    sets = cut(arrow_map(texts.df.join(many.select("node").distinct(), "node", "left_semi").select("node", "text"), run, "node bigint, shingles binary"))
    met = _dealt(many, p)

    def linked(t: pa.Table) -> pa.Table:
        node, comp, mine = (np.array(t.column(c)) for c in ("node", "component", "mine"))
        sets_ = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]
        a, b = joining(node, comp, mine, sets_, p.pct)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # the work is by pairs, not by bytes, so the number of tasks is given
    wide = met.join(sets, "node").repartition(4 * partitions(open_.sparkSession), "key", "lo", "hi")
    return wide.groupBy("key", "lo", "hi").applyInArrow(linked, "a bigint, b bigint")


def _dealt(many: DataFrame, p: Params) -> DataFrame:
    """key, node, component, mine, lo, hi: which members of many(key, node, n, component) meet in the task (key, lo, hi), and from which of its
    blocks (mine) each is. Blocks 0 and up have the members outside their bucket's largest component, those below 0 that component's. In a bucket
    of m of these and o others, dealt into b and c blocks, m * c + o * (b + c) rows."""
    of = many.groupBy("key", "component").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    per = of.groupBy("key").agg(F.max_by(F.struct("component", "m", "s"), F.struct("m", -F.col("component"))).alias("main"), F.sum("m").alias("m"), F.sum("s").alias("s"))
    blocks = lambda m, s: F.ceil(F.greatest(m / p.block, s / p.block_shingles, F.lit(1.0))).cast("int")
    per = per.select("key", F.col("main.component").alias("main"), blocks(F.col("main.m"), F.col("main.s")).alias("b"), blocks(F.col("m") - F.col("main.m"), F.col("s") - F.col("main.s")).alias("c"))
    # a bucket's row meets its members in SALTS tasks, so that a large bucket isn't one's alone
    h = F.xxhash64("node")
    salted = per.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = many.select("key", "node", "component", F.pmod(F.shiftrightunsigned(h, 40), F.lit(SALTS)).cast("int").alias("salt"))
    dealt = dealt.join(salted, ["key", "salt"]).withColumn("inside", F.col("component") == F.col("main"))
    dealt = dealt.withColumn("mine", F.when(F.col("inside"), -1 - F.pmod(h, F.col("b"))).otherwise(F.pmod(h, F.col("c"))).cast("int"))
    others = F.sequence(F.lit(0), F.col("c") - 1)
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("inside"), others).otherwise(F.concat(others, F.sequence(F.lit(-1), -F.col("b"), F.lit(-1))))))
    return dealt.select("key", "node", "component", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))


def joining(node: np.ndarray, comp: np.ndarray, mine: np.ndarray, sets: list[np.ndarray], pct: int) -> tuple[list[int], list[int]]:
    """Links that join the components of members of two blocks (mine tells which; pairs within a block count if there is one only); as few as
    join what can be joined. One of each pair lies outside the largest component, so only those members are looked up."""
    names, which, members = np.unique(comp, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return [], []
    root = list(range(len(names)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    size = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    o = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[o], owner[o]
    main = int(np.argmax(members))
    alone = bool((mine == mine[0]).all())
    a, b = [], []
    for i in np.flatnonzero(which != main).tolist():
        lo, hi = np.searchsorted(tokens, sets[i]), np.searchsorted(tokens, sets[i], side="right")
        many = hi - lo
        # any partner has pct percent of this set at least, so one of the rarest size - least + 1 shingles
        prefix = np.argsort(many, kind="stable")[: size[i] - -(-pct * size[i] // 100) + 1]
        if many[prefix].max(initial=0) < 2:
            continue
        met = np.unique(np.concatenate([owner[x:y] for x, y in zip(lo[prefix], hi[prefix])]))
        met = met[(which[met] != which[i]) & ((which[met] == main) | (met > i)) & (100 * np.minimum(size[met], size[i]) >= pct * np.maximum(size[met], size[i]))]
        if not alone:
            met = met[mine[met] != mine[i]]
        if not len(met):
            continue
        both = np.bincount(np.concatenate([owner[x:y] for x, y in zip(lo, hi)]), minlength=len(sets))[met]
        for j in met[100 * both >= pct * (size[met] + size[i] - both)].tolist():
            x, y = top(int(which[i])), top(int(which[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(int(node[i])), b.append(int(node[j]))
    return a, b
