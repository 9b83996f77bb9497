"""Term buckets on analysed text, and counts per bucket.

Text is analysed the simple way: lower-cased and split on every run of
characters that are neither letters nor digits; empty tokens are dropped. A
document enters each of its terms once, however often the term repeats.
Everything is a built-in expression (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator of the simple analyser: any run of non-letter, non-digit characters.
TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def terms(text, separator: str = TOKEN_SEPARATOR) -> Column:
    """Distinct lower-case tokens of ``text`` as ``array<string>``."""
    tokens = F.split(F.lower(_col(text)), separator)
    # array_remove stays in generated code; a lambda filter would not
    return F.array_remove(F.array_distinct(tokens), "")


def term_buckets(df: DataFrame, text: str, out: str = "term", separator: str = TOKEN_SEPARATOR) -> DataFrame:
    """One row per (row, distinct term of ``text``); rows without terms drop out.

    This is how a multi-valued bucket is formed: a child in several buckets is
    counted in each by a roll-up that groups by ``out``.
    """
    if out in df.columns:
        raise ValueError(f"column {out!r} already exists")
    return df.withColumn(out, F.explode(terms(text, separator)))


def bucket_counts(df: DataFrame, by: Sequence[str] | str, name: str = "doc_count") -> DataFrame:
    """Rows per bucket (the enclosing bucket's own doc count)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def side_by_side(left: DataFrame, right: DataFrame, by: Sequence[str] | str) -> DataFrame:
    """Join two per-bucket results on the bucket columns, null-safely.

    Both inputs hold one row per bucket, so the join is as small as the
    number of buckets. Buckets missing on the right get nulls.
    """
    by = [by] if isinstance(by, str) else list(by)
    alt = {b: f"__kr_r_{i}" for i, b in enumerate(by)}
    r = right.select(*[F.col(b).alias(alt[b]) for b in by], *[c for c in right.columns if c not in by])
    if not by:
        raise ValueError("side_by_side needs bucket columns")
    cond = None
    for b in by:
        c = left[b].eqNullSafe(r[alt[b]])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*alt.values())
