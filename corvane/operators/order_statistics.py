"""Exact order statistics of groups of any size.

A double becomes an integer that sorts alike, and its value at a rank is found 16 bits at a time: rows that share the bits found so far are
counted by the next 16, and the counts' running sum says which of these the rank falls into. So four passes find every rank of
every group, with partial counts before each shuffle; no task holds more than 65,536 counts of a group, however many rows it has.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.operators.numbering import kept, settled, shared_folder

#: Ranks, and groups, that are broadcast at most.
FEW = 100_000
#: Bits of a pass, and of a double (the latter a fixed value).
STEP, ALL = 16, 64


@F.pandas_udf(T.LongType())
def _bits(x: pd.Series) -> pd.Series:
    v = x.to_numpy(np.float64) + 0.0
    bits = np.where(np.isnan(v), np.nan, v).view(np.int64)
    return pd.Series(bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF)))


def sortable(x: Column) -> Column:
    """Integers in the order of the doubles; zeros of both signs are one, and what isn't a number comes last. Null stays null."""
    return F.when(x.isNotNull(), _bits(x))


@F.pandas_udf(T.DoubleType())
def unsortable(key: pd.Series) -> pd.Series:
    """The doubles of such integers (no nulls)."""
    k = key.to_numpy(np.int64)
    return pd.Series((k ^ ((k >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64))


def _same(left: DataFrame, right: DataFrame, on: Sequence[str], more: Column | None = None, how: str = "inner") -> DataFrame:
    """A join on columns of the same names, nulls equal; the right side's copies of them go."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    match = more
    for c in on:
        match = F.col(c).eqNullSafe(F.col(f"_r_{c}")) if match is None else match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, match, how).drop(*(f"_r_{c}" for c in on))


def at_ranks(values: DataFrame, ranks: DataFrame, group: Sequence[str]) -> DataFrame:
    """group, name, value for ranks(group, name, rank): the value at that rank (from 0) among values(group, value double) of its group. Null values
    are no values; ranks beyond a group's values give no row."""
    rows = values.where("value is not null").select(*group, sortable(F.col("value")).alias("_key"))
    return at_key_ranks(kept(rows, f"{shared_folder(values.sparkSession)}/corvane-{uuid.uuid4().hex}"), ranks, group)


def at_key_ranks(rows: DataFrame, ranks: DataFrame, group: Sequence[str]) -> DataFrame:
    """The same of rows(group, _key), a key being sortable() of a value. They are gone through four times, and only those that share a rank's
    bits are counted and go into a shuffle."""
    found = settled(ranks.select(*group, "name", F.col("rank").cast("bigint").alias("_rest"), F.lit(0).cast("bigint").alias("_prefix")))
    small = F.broadcast if found.count() <= FEW else lambda df: df  # it never grows: a row for each rank
    for shift in range(ALL - STEP, -1, -STEP):
        top = shift == ALL - STEP
        digit = F.shiftright("_key", shift) + (1 << (STEP - 1)) if top else F.shiftright("_key", shift).bitwiseAND(F.lit((1 << STEP) - 1))
        prefix = F.lit(0).cast("bigint") if top else F.shiftright("_key", shift + STEP)
        live = rows.select(*group, prefix.alias("_prefix"), digit.alias("_digit"))
        live = _same(live, small(found.select(*group, "_prefix").distinct()), [*group, "_prefix"], how="left_semi")
        n = live.groupBy(*group, "_prefix", "_digit").agg(F.count("*").alias("_n"))
        before = F.sum("_n").over(Window.partitionBy(*group, "_prefix").orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1))
        n = n.withColumn("_before", F.coalesce(before, F.lit(0)))
        hit = _same(small(found), n, [*group, "_prefix"], (F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_n")))
        grown = F.col("_digit") - (1 << (STEP - 1)) if top else F.shiftleft("_prefix", STEP).bitwiseOR(F.col("_digit"))
        found = settled(hit.select(*group, "name", (F.col("_rest") - F.col("_before")).alias("_rest"), grown.alias("_prefix")))
    return found.select(*group, "name", unsortable("_prefix").alias("value"))
