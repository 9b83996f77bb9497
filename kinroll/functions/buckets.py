"""Declared buckets: named filters and ranges, which a result reports even where
no row entered them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_filters(column: str, ranges: Mapping[str, tuple]) -> dict[str, Column]:
    """Named ranges ``{name: (from, to)}`` as conditions, ``from`` included and
    ``to`` not; None leaves a side open. Ranges may overlap."""
    out = {}
    for name, (low, high) in ranges.items():
        c = F.col(column)
        inside = c.isNotNull()
        inside = inside if low is None else inside & (c >= F.lit(low))
        out[name] = inside if high is None else inside & (c < F.lit(high))
    return out


def filter_buckets(df: DataFrame, filters: Mapping[str, Column], out: str = "bucket") -> DataFrame:
    """One row per (row, named condition that it meets): buckets that are declared
    rather than found. A row may be in several, or in none and drop out."""
    if out in df.columns:
        raise ValueError(f"column {out!r} already exists")
    if not filters:
        raise ValueError("at least one named condition is needed")
    held = F.array(*[F.when(c, F.lit(n)) for n, c in filters.items()])
    return df.withColumn(out, F.explode(F.array_compact(held)))


def declared(result: DataFrame, names: Sequence[str], by: str, zero: Sequence[str] = ("doc_count",)) -> DataFrame:
    """A per-bucket result with one row for every declared bucket, in any order:
    buckets that no row entered have 0 in the ``zero`` columns, null elsewhere."""
    domain = result.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "__kr_name string")
    joined = domain.join(result, domain["__kr_name"] == result[by], "left")
    return joined.select(*[
        F.col("__kr_name").alias(c) if c == by else F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) if c in zero else F.col(f"`{c}`")
        for c in result.columns])
