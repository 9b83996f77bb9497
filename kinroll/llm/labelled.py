"""A bounded sample of labelled documents, for fitting classifiers.

The fold rule of the contracts: rows whose ``crc32(doc_id as text) mod 5`` is 0
are held out and never seen by a fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinroll.llm.common import quoted


def held_out(id_col: str = "doc_id") -> Column:
    """Null ids are not held out (they carry no label either)."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """``docs`` columns and ``_label``, for at most ``rows`` labelled documents:
    the first in hash order, so that any table gives an even choice. Labels
    other than 0 and 1 are passed over. Rows that repeat an id count as one
    document, the largest row, and repeated labels as one. The ids are at most
    ``rows`` integers, so they are broadcast."""
    chosen = (
        labels.filter(~held_out(id_col) & F.col(quoted(id_col)).isNotNull() & F.col(quoted(label)).isin(0, 1))
        .select(F.col(quoted(id_col)).alias("_labelled"), F.col(quoted(label)).cast("int").alias("_label"))
        .distinct().orderBy(F.xxhash64("_labelled"), "_label").limit(rows)
    )
    found = docs.join(F.broadcast(chosen), F.col(quoted(id_col)) == F.col("_labelled"))
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns])
    return found.groupBy("_labelled", "_label").agg(F.max(row).alias("_row")).select("_row.*", "_label")
