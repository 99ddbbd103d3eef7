"""Connected components of an undirected graph of links, without gathering it anywhere.

Alternating large-star and small-star steps (the classic MapReduce algorithm): each step hangs the neighbours of a node on
the least of them, so every component ends as a star around its least node; the number of rounds is logarithmic in the
number of nodes. Each round is two grouped minima, which combine before they are shuffled, and two joins on a node, whose
skew adaptive execution can split. Each round is written to the shared folder, and is counted and summed while it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corvane.llm.common import cut


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (the least node reachable) for each node in links(a bigint, b bigint). Loops, repeated links and rows with a null
    are ignored. No rows without links. Raises if `rounds` rounds don't settle it (2**30 nodes in a chain do in fewer)."""
    e, now = _written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        if not now["n"] or now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
        before = now
        e, now = _written(_small(_large(e)))
    raise RuntimeError(f"the components are not settled after {rounds} rounds")


def joined(comps: DataFrame, more: DataFrame) -> DataFrame:
    """Components when the links more(a, b) come to a graph whose components are comps: only the components that these join are gone through."""
    name = lambda x: comps.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    named = more.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    moved = cut(components(named))
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    kept = comps.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return kept.union(moved.join(comps.select("node"), "node", "left_anti").select("node", "component"))


def _written(e: DataFrame) -> tuple[DataFrame, dict]:
    """e written, its number of rows and a sum of their hashes."""
    seen = Observation()
    return cut(e.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))), seen.get


def _large(e: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the least of its neighbours and itself."""
    both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.u", "x.v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return e.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(e: DataFrame) -> DataFrame:
    """Each node hangs its smaller neighbours, and itself, on the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()
