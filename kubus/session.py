"""Session helpers.

The library never assumes it created the session: a cluster hands us a
configured one.  ``get_session`` is for tests, benches and scripts.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE re-plans joins from runtime sizes
# (a sort-merge join whose side turns out small becomes a broadcast) and
# splits skewed shuffle partitions; the session time zone is pinned so
# date parts never depend on the machine.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(shuffle_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Settings sized for a cluster run.

    ``shuffle_bytes`` is the expected size of the largest shuffle (the
    projected fact, e.g. tens of TB for a 100 TB input); the initial number
    of shuffle partitions keeps each partition near
    ``target_partition_bytes`` so aggregation and sort buffers fit executor
    memory, and AQE then coalesces small partitions by size.
    """
    parts = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    size = f"{target_partition_bytes // 1024 ** 2}m"
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kubus", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is respected as
    is.  Where it is unset, a scratch folder is chosen in local mode, in which
    all tasks share one machine; elsewhere that is an error, since executors
    would each write to a disk of their own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="kubus-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001 - a core setting may be read-only
            pass
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path.

    Only fills in a worker environment that names no path of its own; on a
    cluster the package is installed or shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage, gives later plans real sizes (the optimizer's own
    threshold then decides what is broadcast), and makes both sides of a join
    plain scans, which AQE can split when a key is hot.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df):
    """Reliable checkpoint into the shared checkpoint folder (eager).

    Cuts the lineage the way a written table would: later jobs read the
    checkpointed files, and the optimizer no longer rewrites across the
    cut (e.g. pushing an inferred predicate back into expensive parsing).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
