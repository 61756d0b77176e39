"""Session settings and shared scratch locations."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 records the Python call site of every Column function call
    # (several Py4J round trips each); off, plan building is ~3x faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # checkpoint files (Gold rollups, merges) are removed from the shared
    # folder once their DataFrame is garbage-collected, not kept forever
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MiB = 1 << 20


def partition_conf(
    input_bytes: int,
    total_cores: int,
    scan_split_bytes: int = 512 * MiB,
    shuffle_target_bytes: int = 256 * MiB,
    shuffled_fraction: float = 0.5,
    max_shuffle_partitions: int = 100_000,
    min_coalesced_bytes: int = 128 * 1024,
) -> dict:
    """Partition sizing for a run over ``input_bytes`` on ``total_cores``.

    - Scan splits of ``scan_split_bytes`` (one task each): 100 TB at 512 MiB is
      ~200k map tasks, ~25 waves on 8,000 cores.
    - The first shuffle (Silver de-duplication) carries at most
      ``shuffled_fraction`` of the input after column pruning; it starts with
      enough partitions for ``shuffle_target_bytes`` each (at least two per
      core, at most ``max_shuffle_partitions`` to bound the driver's map-output
      statuses: with the defaults the target is exceeded beyond about 50 TB of
      input; raise the cap with the driver's memory) and AQE coalesces later, smaller shuffles (partial aggregates)
      down to the same target size.
    - A partition over 4x the target is split by AQE's skew-join handling.
    - ``min_coalesced_bytes`` is AQE's floor when it merges small shuffle
      partitions. It matters only when a whole shuffle is a few MB (then the
      default 1 MiB floor leaves 1-2 tasks for CPU-bound JSON work after it);
      at scale every partition is far above it.
    """
    if input_bytes < 0 or total_cores < 1:
        raise ValueError("input_bytes >= 0 and total_cores >= 1 required")
    wanted = math.ceil(input_bytes * shuffled_fraction / shuffle_target_bytes)
    n = min(max(wanted, 2 * total_cores), max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_target_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(min_coalesced_bytes),
    }


def get_session(
    app_name: str = "airlake",
    master: str | None = None,
    conf: dict | None = None,
    log_level: str | None = "WARN",
) -> SparkSession:
    """Build (or reuse) a session with UTC zone, ANSI and AQE on.

    Library code never stops a session; the caller that created it does."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if log_level:
        spark.sparkContext.setLogLevel(log_level)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or the
    one set on the SparkContext), if any."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - older PySpark / Connect
            root = None
    return root or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint root; only when none is configured and the session
    runs in local mode (tests) create a fresh local one and register it. On a
    cluster a machine-local folder would scatter checkpoint files over the
    executors' disks, so an unset ``spark.checkpoint.dir`` is an error there."""
    root = checkpoint_root(spark)
    if root:
        return root
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder (e.g. on the cluster's object store or HDFS)"
        )
    root = tempfile.mkdtemp(prefix="airlake-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # pragma: no cover - Spark Connect: no SparkContext on the client
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root (for stream
    checkpoints and hand-off tables). Never a machine-local temp folder when
    the cluster names a shared one. Nothing is created: the writer does that,
    on whatever file system the path names."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/airlake/{name}-{uuid.uuid4().hex[:12]}"
