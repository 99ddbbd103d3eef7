"""Gold manifests as a source."""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.config import SPLITS
from corvane.errors import ManifestError
from corvane.operators import manifest as M
from corvane.operators.numbering import numbered, unused


def raw(spark: SparkSession, path: str, split: str) -> DataFrame:
    """A manifest's rows as strings, with row_number (2 is the first row after the header) and expected_split. A file that Spark wouldn't divide
    is one partition in its order. A larger one is read in blocks and numbered by their places in it, unless quoted line feeds run
    through it, which can't be told from others within a block."""
    header = spark.read.text(path).limit(1).first()
    if header is None:
        raise ManifestError(f"{path} has no header")
    names = [x.strip().strip('"') for x in header[0].lstrip("﻿").split(",")]
    missing = sorted(set(M.MANIFEST_COLUMNS) - set(names))
    if missing:
        raise ManifestError(f"{path} lacks columns: {', '.join(missing)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    read = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option("escape", '"')
    if _divides(spark, path):
        at, within = unused("_at", spark.createDataFrame([], schema)), unused("_within", spark.createDataFrame([], schema))
        df = read.csv(path).select("*", F.col("_metadata.file_block_start").alias(at), F.monotonically_increasing_id().alias(within))
        df = numbered(df, [F.col(at), F.col(within)], name="row_number", first=2).drop(at, within)
    else:
        df = read.option("multiLine", True).csv(path).coalesce(1).withColumn("row_number", F.monotonically_increasing_id() + 2)
    return df.withColumn("expected_split", F.lit(split))


def _divides(spark: SparkSession, path: str) -> bool:
    """If a file is over a block, and each of its lines has quotes in pairs."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    block = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
    return size > block and not spark.read.text(path).where(F.length("value") % 2 != F.length(F.translate("value", '"', "")) % 2).take(1)


def load(spark: SparkSession, root: str, split: str, strict: bool = True, partial: str | None = None) -> DataFrame:
    """The manifest of a split below root, checked. strict raises on the first bad row; else rows come with their error."""
    return load_all(spark, root, (split,), strict, partial)


def load_all(spark: SparkSession, root: str, splits: tuple[str, ...] = SPLITS, strict: bool = True, partial: str | None = None) -> DataFrame:
    """The manifests of several splits as one plan: parsed, numbered within each split and checked together. Of bad rows the first one of the
    first split is named."""
    found = []
    for split in splits:
        if split not in SPLITS:
            raise ValueError(f"unknown split: {split!r}")
        path = f"{root}/gold/{split}_manifest{f'_{partial}' if partial else ''}.csv"
        if "://" not in path and not os.path.isfile(path):
            raise ManifestError(f"there is no manifest {path}")
        found.append(M.parsed(raw(spark, path, split)))
    rows = M.indexed(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found), "expected_split")
    return M.enforce(rows).drop("expected_split") if strict else rows.drop("expected_split")


def table(spark: SparkSession, path: str) -> DataFrame:
    """A manifest as it is, all strings, unchecked."""
    return spark.read.option("header", True).csv(path)
