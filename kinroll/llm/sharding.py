"""Two-pass external shuffle of records into shards.

Pass 1 scatters: a record's shard follows from its id, the seed and the number
of shards alone (see ``shard_of``), and seeded hashes spread every shard's
records uniformly over buckets sized to fit a task's memory. Pass 2 loads one
bucket at a time, shuffles it by Fisher-Yates and writes it out. A shard is the
run of its buckets, so a record's slot is its bucket's offset plus its place.

The law is ``key``: with one shard more, a record either stays or moves to the
new shard. The order is the same for the same rows and seed, however they were
partitioned: a bucket is put in hash order before it is shuffled.

A record's hash covers all its columns (maps apart). Records repeated in every
column are one record with a count; where their bytes exceed a bucket's share
(``HOT`` of it), each copy is hashed with its number, so that they spread like
others, and still by the rows alone (not in tables with map columns, which Spark
cannot group by).

Memory: one bucket at a time (``bucket_bytes`` of text); a task takes several
where there are more than ``TASKS``. The driver sees one row per shard; bucket
offsets are broadcast only up to ``BROADCAST_BUCKETS`` rows, and beyond that the
rows are put into slot order again after the join.

Defined cases: a null text has no bytes (size 1) and crc 0; a null id is a key
like any other; rows with equal values in all columns are interchangeable; an
empty table gives an empty result; input columns named ``shard``, ``slot``,
``bucket`` are replaced by the result's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinroll.llm.common import cut, extended, map_arrow, quoted, to_arrow

BUCKET_BYTES = 16 * 1024 * 1024
BROADCAST_BUCKETS = 500_000
TASKS = 20_000
HOT = 0.25


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """Consistent placement: growing to ``n + 1`` shards, a key moves to the
    new one with probability ``1 / (n + 1)`` and otherwise stays. The key's
    seeded hash for each size decides, so sizes are independent."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(max(1, shards - 1))), F.lit(0),
        lambda shard, n: F.when((n < shards) & (F.pmod(F.xxhash64(F.lit(seed), n, key), n + 1) == 0), n).otherwise(shard),
    )


def record_size(text_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(quoted(text_col))), F.lit(0)).cast("long") + 1


def _fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    order = np.arange(n)
    picks = rng.integers(0, np.arange(n, 0, -1)) if n else order  # pick i of the n - i records left
    for i, pick in enumerate(picks.tolist()):
        j = i + pick
        order[i], order[j] = order[j], order[i]
    return order


def _shuffler(seed: int, schema: pa.Schema):
    """Batches arrive bucket by bucket, each in hash order."""
    width = len(schema) - 1

    def write(bucket: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        order = _fisher_yates(table.num_rows, np.random.default_rng([seed & 0xFFFFFFFF, bucket]))
        places = np.arange(len(order), dtype=np.int64)
        for at in range(0, len(order), 4096):
            chunk = table.take(pa.array(order[at:at + 4096])).append_column("place", pa.array(places[at:at + 4096]))
            yield from chunk.rename_columns(schema.names).cast(schema).combine_chunks().to_batches()

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        open_bucket = None
        for batch in batches:
            buckets = batch.column(width - 1).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for start, end in zip(edges, edges[1:], strict=False):
                if start == end:
                    continue
                if buckets[start] != open_bucket and held:
                    yield from write(open_bucket, held)
                    held = []
                open_bucket = int(buckets[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield from write(open_bucket, held)

    return shuffle


def _spread(placed: DataFrame, columns: list[str], text: str, bucket_bytes: int, seed: int) -> DataFrame:
    """``placed`` with ``hash``: a seeded hash of each row's values, and of the
    copy's number where one row's copies would fill a good part of a bucket."""
    plain = [f.name for f in placed.schema.fields if f.name in columns and _hashable(f.dataType)]
    hashed = placed.withColumn("hash", F.xxhash64(F.lit(seed + 1), *plain))
    share = int(HOT * bucket_bytes)
    # at most (input bytes / share) hashes, and as few rows: no text is shuffled for them
    hot = hashed.groupBy("hash").agg(F.count("*").alias("copies"), F.sum(record_size(text)).alias("held")).filter(
        (F.col("copies") > 1) & (F.col("held") > share)).select("hash")
    if len(plain) < len(columns) or hot.isEmpty():
        return hashed
    hot = cut(hot)
    # counted, then dealt out in as many runs as a run has copies: no task writes all copies of a row
    runs = (
        hashed.join(hot, "hash", "left_semi").groupBy(*hashed.columns).agg(F.count("*").alias("copies"))
        .withColumn("span", F.ceil(F.sqrt("copies")))
        .withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), "copies", "span")))
        .repartition("hash", "first")
    )
    copies = (
        runs.withColumn("copy", F.explode(F.sequence("first", F.least("copies", F.col("first") + F.col("span") - 1))))
        .withColumn("hash", F.xxhash64(F.lit(seed + 1), "hash", "copy")).select(*hashed.columns)
    )
    return hashed.join(hot, "hash", "left_anti").select(*hashed.columns).unionByName(copies)


def _hashable(kind: T.DataType) -> bool:
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def shuffled_shards(docs: DataFrame, shards: int = 8, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The records with ``shard``, ``bucket`` (numbered through all shards) and
    ``slot`` (place in the shard, from 0), each bucket's rows in slot order."""
    names, docs = docs.columns, docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    placed = docs.withColumn("shard", shard_of(F.col(key), shards, seed))
    held = {r["shard"]: r["bytes"] for r in placed.groupBy("shard").agg(F.sum(record_size(text)).alias("bytes")).collect()}
    buckets = [max(1, math.ceil(held.get(s, 0) / bucket_bytes)) for s in range(shards)]
    first = np.concatenate([[0], np.cumsum(buckets)]).tolist()
    total = first[-1]

    by_shard = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("shard") + 1)
    scattered = _spread(placed, docs.columns, text, bucket_bytes, seed).withColumn(
        "bucket", (by_shard(first[:-1]) + F.pmod("hash", by_shard(buckets))).cast("int"))
    tasks = min(total, TASKS)
    ordered = scattered.repartitionById(tasks, (F.col("bucket") % tasks).cast("int")).sortWithinPartitions(
        "bucket", "hash", key, text).drop("hash")
    schema = extended(docs, "shard int, bucket int, place long")
    shuffled = map_arrow(ordered, _shuffler(seed, to_arrow(schema)), schema)

    counts = scattered.groupBy("shard", "bucket").count()
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("ahead"))
    few = total <= BROADCAST_BUCKETS
    if few:
        offsets = F.broadcast(offsets)
    kept = [F.col(c).alias(name) for c, name in zip(docs.columns, names, strict=True) if name.lower() not in ("shard", "bucket", "slot")]
    slots = shuffled.join(offsets, "bucket").select(*kept, "shard", "bucket", (F.col("ahead") + F.col("place")).alias("slot"))
    return slots if few else slots.sortWithinPartitions("shard", "bucket", "slot")


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write the shuffled records as Parquet, one folder per shard."""
    shuffled.write.mode("errorifexists").partitionBy("shard").parquet(path)
