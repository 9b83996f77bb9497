"""The parent roll-up over a stream of hits (Structured Streaming).

Hits arrive over time; the result is, after every micro-batch, the roll-up of
all hits seen so far. State is the set of distinct ``(bucket, parent key)``
pairs (``dropDuplicates``), the same pairs the batch plan shuffles; the
parents are a static table joined stream-to-static; the counts are a
streaming aggregation. Use output mode ``update`` or ``complete``.

A bucket's count only grows: a new pair either meets parents (count up) or
not (the bucket appears at 0). Parents themselves are read as a static table
at each micro-batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinroll.operators.rollup import (
    KEY,
    MARK,
    PKEY,
    _check_by,
    _parent_side,
    _per_key_outputs,
    _per_key_parents,
    _private,
    _restore_by,
    _splittable,
    _sub_agg,
)
from kinroll.plans.relation import Relation


def stream_parent_rollup(
    hits: DataFrame,
    relation: Relation,
    by: Sequence[str] | str = (),
    aggs: Mapping[str, str | tuple[str, str]] | None = None,
    *,
    count_name: str = "doc_count",
) -> DataFrame:
    """Streaming ``(by…, doc_count, aggs…)`` over every hit seen so far.

    ``hits`` is a streaming DataFrame; ``relation.parents`` a static one.
    Buckets without parents appear with 0, as in ``parent_rollup``. A pair
    meets the parents of the moment it first arrives; a parent added later is
    not counted for it. The state holds every distinct pair and has no bound.
    """
    if not hits.isStreaming:
        raise ValueError("hits must be a streaming DataFrame; use parent_rollup for a table")
    if relation.parents.isStreaming:
        raise ValueError("parents must be a static DataFrame")
    relation.check_hits(hits)
    by = _check_by(hits, by, allow_stream=True)
    aggs = dict(aggs or {})
    priv = _private(by)
    pairs = (
        hits.select(*[F.col(b).alias(p) for b, p in zip(by, priv)], relation.child_key.alias(KEY))
        .dropDuplicates([*priv, KEY])
    )
    if _splittable(aggs):
        # static side aggregated per key: unique keys, copies collapsed
        parents = _per_key_parents(relation, aggs)
        joined = pairs.join(parents, pairs[KEY] == parents[PKEY], "left")
        out = joined.groupBy(*priv).agg(*_per_key_outputs(relation, aggs, count_name, None))
    else:
        parents = _parent_side(relation, marker=True)
        joined = pairs.join(parents, pairs[KEY] == parents[PKEY], "left")
        out = joined.groupBy(*priv).agg(
            F.count(MARK).alias(count_name), *[_sub_agg(n, s) for n, s in aggs.items()]
        )
    return _restore_by(out, by)


def start_rollup_stream(
    rollup: DataFrame,
    name: str,
    *,
    sink: str,
    output_mode: str = "update",
    checkpoint: str | None = None,
    options: Mapping[str, str] | None = None,
):
    """Start a streaming roll-up; returns the ``StreamingQuery``.

    The state (the distinct pairs and the counts) is checkpointed under
    ``<spark.checkpoint.dir>/<name>`` unless ``checkpoint`` is given, so a
    restarted query resumes where it stopped.
    """
    if output_mode not in ("update", "complete"):
        raise ValueError("a roll-up's counts change: use output mode update or complete")
    from kinroll.session import ensure_checkpoint_dir

    if checkpoint is None:
        base = ensure_checkpoint_dir(rollup.sparkSession)
        checkpoint = base.rstrip("/") + "/" + name
    writer = (rollup.writeStream.outputMode(output_mode).format(sink)
              .option("checkpointLocation", checkpoint).queryName(name))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    return writer.start()
