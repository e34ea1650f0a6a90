"""Presence, gaps, rounding and ratios: the missing-value rules that consumers use, kept apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts shown as gaps.
GAP_WORDS = ("none", "null", "not-specified", "__missing__")
MISSING = "__missing__"


def is_gap(value: Column, kind: T.DataType) -> Column:
    """Null, empty text or list, or a word for missing; numbers and false are values."""
    if isinstance(kind, T.StringType):
        return value.isNull() | (value == "") | F.lower(F.trim(value)).isin(*GAP_WORDS)
    if isinstance(kind, T.ArrayType):
        return value.isNull() | (F.size(value) == 0)
    return value.isNull()


def has_value(value: Column, kind: T.DataType) -> Column:
    """Not null, blank or an empty container; zero and false are values."""
    if isinstance(kind, T.StringType):
        return value.isNotNull() & (F.trim(value) != "")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return value.isNotNull() & (F.size(value) > 0)
    return value.isNotNull()


def rate(part: Column, whole: Column) -> Column:
    """Share to six digits, 0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole, 6)).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """Share to six digits, 1 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole, 6)).otherwise(F.lit(1.0))


def mean(value: Column) -> Column:
    """Mean to six digits, 0 over no rows."""
    return F.coalesce(F.round(F.avg(value), 6), F.lit(0.0))


def mean_or_null(value: Column) -> Column:
    return F.round(F.avg(value), 6)


def text_list(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))))


def distinct_folded(values: Column) -> Column:
    """Trimmed texts, of those that differ in case alone the first, sorted without regard to case."""
    kept = F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != ""))
    low = F.transform(kept, lambda v: F.lower(v))
    firsts = F.filter(kept, lambda v, i: F.array_position(low, F.lower(v)) == i + 1)
    return F.transform(F.array_sort(F.transform(firsts, lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))), lambda x: x["v"])


def epoch_timestamp(value: Column) -> Column:
    """Epoch seconds, or milliseconds beyond ten billion, as a UTC timestamp."""
    return F.when(value > 10_000_000_000, F.timestamp_millis(value)).otherwise(F.timestamp_seconds(value))


def bbox_extent(points: Column) -> Column:
    """(west, south, east, north) of points (x, y); null if any lies off the globe."""
    valid = F.forall(points, lambda p: (F.abs(p["x"]) <= 180) & (F.abs(p["y"]) <= 90)) & (F.size(points) > 0)
    side = lambda f, c: f(F.transform(points, lambda p: p[c]))
    return F.when(valid, F.struct(side(F.array_min, "x").alias("west"), side(F.array_min, "y").alias("south"), side(F.array_max, "x").alias("east"), side(F.array_max, "y").alias("north")))
