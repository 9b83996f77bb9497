"""Session settings the library relies on, and where lineage gets cut.

The library never changes a running session's behaviour from inside an
operator; these helpers are for the programs that own the session
(``bench.py``, the tests, a job's main).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Broadcast joins are decided by AQE on *measured* shuffle output only: the
# static planner's estimate comes from compressed file sizes and is no bound.
# Below this many bytes of measured build side, AQE turns the sort-merge join
# into a broadcast hash join; above it the sort-merge join stays. The measure is
# of compressed shuffle output: the table in memory is a few times larger.
RUNTIME_BROADCAST_BYTES = 64 * 1024 * 1024

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce small shuffles only down to this size per task, so that post-
    # shuffle stages keep the cores busy (large shuffles are unaffected).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(RUNTIME_BROADCAST_BYTES),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app: str = "kinroll",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ``master`` is left to ``spark-submit`` when ``None``. On a session that
    already runs, ``getOrCreate`` applies the runtime SQL settings given here
    and leaves the rest. The checkpoint folder is set when something is first
    checkpointed (``ensure_checkpoint_dir``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    running = SparkSession.getActiveSession()
    spark = builder.getOrCreate()
    if running is None:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(
    input_bytes: int,
    total_cores: int,
    *,
    shuffle_ratio: float = 0.25,
    bytes_per_task: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input on
    ``total_cores`` executor cores (pass them as ``extra_conf``).

    Shuffle partitions follow the bytes expected in the largest shuffle
    (``shuffle_ratio`` of the input: the pair dedup and projection shrink it),
    one per ``bytes_per_task`` and at least three per core, at any size (map-output
    tracking grows with mappers x reducers: raise ``bytes_per_task`` to trade).
    AQE coalesces toward the advisory size rather than maximal parallelism,
    which on a busy cluster only adds tiny tasks; file splits stay at 128 MB
    so a task's input fits executor memory.
    """
    if input_bytes <= 0 or total_cores <= 0:
        raise ValueError("input_bytes and total_cores must be positive")
    wanted = int(input_bytes * shuffle_ratio // bytes_per_task) + 1
    partitions = max(3 * total_cores, wanted)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where unset.

    On a cluster the folder must be the shared one named by
    ``spark.checkpoint.dir``; a local master (tests, bench) without it gets a
    fresh folder under the temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a cluster needs a shared folder for checkpoints"
        )
    local = tempfile.mkdtemp(prefix="kinroll-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and return it.

    Survives executor loss (the data is in the shared folder, not on an
    executor) and keeps plans of long chains short.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
