"""Column functions on text and numbers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = " \t\r\n\f\x0b"


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends, not spaces only."""
    return F.btrim(c, F.lit(SPACE))


def to_int(c: Column) -> Column:
    """An int from text, null if it isn't one: digits with a sign, single underscores between digits allowed."""
    s = strip(c)
    return F.when(s.rlike(r"^[+-]?[0-9]+(_[0-9]+)*\z"), F.regexp_replace(s, "_", "").try_cast("int"))


def to_double(c: Column) -> Column:
    """A double from text, null if it isn't one; nan and infinities count."""
    s = F.lower(strip(c))
    number = s.rlike(r"^[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?\z")
    return F.when(number, F.regexp_replace(s, "_", "").try_cast("double")).when(s.rlike(r"^[+]?nan\z|^-nan\z"), F.lit(float("nan"))).when(s.rlike(r"^[+]?inf(inity)?\z"), F.lit(float("inf"))).when(s.rlike(r"^-inf(inity)?\z"), F.lit(float("-inf")))


def basename(c: Column) -> Column:
    """The last part of a path with either kind of slash, slashes at its end aside."""
    return F.regexp_extract(c, r"([^\\/]+)[\\/]*\z", 1)


def stem(c: Column) -> Column:
    """The lower-cased name of a path's file without its last extension."""
    return F.lower(F.regexp_replace(F.regexp_extract(c, r"([^/]+)/*\z", 1), r"(?<=.)\.[^.]*\z", ""))


def folder(c: Column) -> Column:
    """What stands before the last slash; empty without one."""
    return F.regexp_extract(c, r"^(.*)/[^/]*\z", 1)


def filename(c: Column) -> Column:
    """What stands after the last slash."""
    return F.substring_index(c, "/", -1)


@F.pandas_udf(T.StringType())
def human_bytes(n: pd.Series) -> pd.Series:
    """1152 as 1.12 KiB; up to PiB. Rounds half to even on the binary value, which Spark's own formatting doesn't."""

    def one(x):
        if x is None or x != x:
            return None
        for unit in ("B", "KiB", "MiB", "GiB", "TiB"):
            if x < 1024:
                return f"{x:.2f} {unit}"
            x /= 1024
        return f"{x:.2f} PiB"

    return n.map(one)


def fmt_size(n: Column) -> Column:
    """1536 as 1.5 KiB, thousands grouped; up to TiB."""
    x, out = n.cast("double"), None
    for i, unit in enumerate(("B", "KiB", "MiB", "GiB")):
        case = (x / 1024.0**i < 1024, F.concat(F.format_number(x / 1024.0**i, 1), F.lit(f" {unit}")))
        out = F.when(*case) if out is None else out.when(*case)
    return out.otherwise(F.concat(F.format_number(x / 1024.0**4, 1), F.lit(" TiB")))


@F.pandas_udf(T.DoubleType())
def round4(x: pd.Series) -> pd.Series:
    """To 4 places by the exact binary value, halves to even."""
    return x.map(lambda v: None if v is None or v != v else round(v, 4)).astype("float64")


def archive_kind(name: Column, head: Column) -> Column:
    """zip or tar by a file's extension; else by its first bytes."""
    low, magic = F.lower(name), F.hex(F.substring(head, 1, 4))
    return F.when(low.rlike(r"\.zip\z"), "zip").when(low.rlike(r"\.(tar|tgz|tar\.gz|tar\.bz2)\z"), "tar").when(magic == "504B0304", "zip").when(magic.startswith("1F8B") | magic.startswith("425A"), "tar").when(F.hex(F.substring(head, 258, 5)) == "7573746172", "tar")


def close(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    return F.abs(a - b) <= tolerance


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != float("inf"))


def exact_mean(c: Column) -> Column:
    """A mean that doesn't depend on the order of rows: summed as a decimal."""
    return F.sum(c.cast("decimal(28,9)")).cast("double") / F.count(c)
