"""Post-steps across the buckets of a finished result."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinroll.session import cut_lineage


def running(df: DataFrame, order: Sequence[str] | str, totals: Mapping[str, str] | None = None,
            steps: Mapping[str, str] | None = None) -> DataFrame:
    """Post-step over ordered buckets: ``totals`` ``{name: column}`` adds running
    totals, ``steps`` the differences from the bucket before (null for the first).

    ``order`` must tell all rows apart. No window holds all rows: the rows are
    dealt by ranges of ``order`` (and written once, so that both readings see the
    same ranges), summed up within each range, and each range starts from the sum
    of those before it. These sums go the same way: ranges are taken in blocks of
    about as many ranges as there are blocks, summed up within a block, and each
    block adds itself to the later ones (as many rows as there are ranges).
    """
    order = [order] if isinstance(order, str) else list(order)
    totals, steps = dict(totals or {}), dict(steps or {})
    if not order or not (totals or steps):
        raise ValueError("an order and at least one total or step are needed")
    named = [F.col(f"`{c}`") for c in order]
    ranged = cut_lineage(df.repartitionByRange(*named).withColumn("__kr_range", F.spark_partition_id()))
    inside = Window.partitionBy("__kr_range").orderBy(*named)
    last = F.struct(*named)
    ends = [F.sum(f"`{c}`").alias(f"__kr_t{i}") for i, c in enumerate(totals.values())]
    ends += [F.max_by(f"`{c}`", last).alias(f"__kr_s{i}") for i, c in enumerate(steps.values())]
    span = math.ceil(math.sqrt(ranged.rdd.getNumPartitions()))
    ranges = ranged.groupBy("__kr_range").agg(*ends).withColumn("__kr_block", F.floor(F.col("__kr_range") / span).cast("int"))
    before = Window.partitionBy("__kr_block").orderBy("__kr_range")
    blocks = ranges.groupBy("__kr_block").agg(
        *[F.sum(f"__kr_t{i}").alias(f"__kr_b{i}") for i in range(len(totals))],
        *[F.max_by(f"__kr_s{i}", "__kr_range").alias(f"__kr_c{i}") for i in range(len(steps))])
    carried = blocks.withColumn("__kr_later", F.explode(F.sequence(F.col("__kr_block") + 1, F.lit(span)))).groupBy("__kr_later").agg(
        *[F.sum(f"__kr_b{i}").alias(f"__kr_b{i}") for i in range(len(totals))],
        *[F.max_by(f"__kr_c{i}", "__kr_block").alias(f"__kr_c{i}") for i in range(len(steps))])
    within = ranges.select(
        F.col("__kr_range").alias("__kr_of"), "__kr_block", F.row_number().over(before).alias("__kr_place"),
        *[F.sum(f"__kr_t{i}").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias(f"__kr_t{i}") for i in range(len(totals))],
        *[F.lag(f"__kr_s{i}").over(before).alias(f"__kr_s{i}") for i in range(len(steps))])
    both = lambda a, b: F.when(F.col(a).isNull() & F.col(b).isNull(), None).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    starts = within.join(carried, within["__kr_block"] == carried["__kr_later"], "left").select(
        "__kr_of", *[both(f"__kr_t{i}", f"__kr_b{i}").alias(f"__kr_t{i}") for i in range(len(totals))],
        *[F.when(F.col("__kr_place") > 1, F.col(f"__kr_s{i}")).otherwise(F.col(f"__kr_c{i}")).alias(f"__kr_s{i}") for i in range(len(steps))])
    rows = ranged
    for i, c in enumerate(totals.values()):
        rows = rows.withColumn(f"__kr_r{i}", F.sum(f"`{c}`").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    for i, c in enumerate(steps.values()):
        rows = rows.withColumn(f"__kr_p{i}", F.lag(f"`{c}`").over(inside)).withColumn(f"__kr_f{i}", F.row_number().over(inside))
    joined = rows.join(starts, rows["__kr_range"] == starts["__kr_of"], "left")
    out = [both(f"__kr_r{i}", f"__kr_t{i}").alias(n) for i, n in enumerate(totals)]
    out += [(F.col(f"`{c}`") - F.when(F.col(f"__kr_f{i}") > 1, F.col(f"__kr_p{i}")).otherwise(F.col(f"__kr_s{i}"))).alias(n)
            for i, (n, c) in enumerate(steps.items())]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *out)
