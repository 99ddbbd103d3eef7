"""Row numbers at any size: ranges of the order are sorted each on its own, and counts by range give each its first number.

No task holds more than one range, however the rows are grouped: a group that has a third of all rows lies in many ranges. The ranges are
drawn by sampling, which differs from run to run, so the dealt rows are written to the checkpoint folder once and numbered from there.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of monotonically_increasing_id that count rows within a partition (a fixed value).
WITHIN = 33


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset and all is on one machine an own folder does; on a
    cluster it must be set."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corvane-"))
    return sc.getCheckpointDir().rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, folder: str) -> DataFrame:
    """df written to a folder as a table and read from there: a fraction of what settled() takes, but rows come in any order."""
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused(name: str, df: DataFrame) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), name: str = "row_no", first: int = 0) -> DataFrame:
    """df with `name`: the number of each row, from `first`, in the given order, anew within each group (null is a group too). Rows that the
    order doesn't tell apart get different numbers in any order. One shuffle, one write, and a count by group and range."""
    at, part, n, shift = (unused(x, df) for x in ("_at", "_part", "_n", "_shift"))
    names = [F.col(f"`{g}`") for g in group]
    keys = [*[g.asc_nulls_first() for g in names], *order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settled(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id()))
    dealt = dealt.withColumn(part, F.shiftright(at, WITHIN))
    held = [f"_group{i}{at}" for i in range(len(group))]
    counts = dealt.groupBy(*[g.alias(h) for g, h in zip(names, held)], F.col(part).alias(f"_of{part}")).agg(F.min(at).alias(shift), F.count("*").alias(n))
    # a row for each range that a group lies in
    before = F.sum(n).over(Window.partitionBy(*held).orderBy(f"_of{part}").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*held, f"_of{part}", (F.coalesce(before, F.lit(0)) - F.col(shift) + first).alias(shift))
    match = F.col(part) == F.col(f"_of{part}")
    for g, h in zip(names, held):
        match &= g.eqNullSafe(F.col(h))
    return dealt.join(counts if group else F.broadcast(counts), match).select(*[F.col(f"`{c}`") for c in df.columns], (F.col(at) + F.col(shift)).alias(name))
