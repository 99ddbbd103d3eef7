"""Consecutive runs of integers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def longest_run(indices: Column) -> Column:
    """The longest run of an array in which each number follows the one before; 0 if it is empty or null, 1 after a repeated number.
    A fold over the sorted array, within code generation."""
    zero = F.struct(F.lit(0).alias("best"), F.lit(0).alias("run"), F.lit(None).cast("bigint").alias("last"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(x == s["last"] + 1, s["run"] + 1).otherwise(F.lit(1))
        return F.struct(F.greatest(s["best"], run).alias("best"), run.alias("run"), x.alias("last"))

    sorted_ = F.array_sort(F.transform(indices, lambda x: x.cast("bigint")))
    return F.coalesce(F.aggregate(sorted_, zero, step, lambda s: s["best"]), F.lit(0))
