"""Session construction and shared scratch locations.

Everything in the library is zone-free (``timestamp_ntz`` end to end), so the
session time zone only matters for display; we still pin it to UTC in the
sessions we build ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Spark conf keys this library reads (all optional).
CONF_BROADCAST_MAX_ROWS = "parcelspark.broadcast.maxRows"
CONF_SKEW_ROWS_PER_TASK = "parcelspark.skew.rowsPerTask"
CONF_SKEW_SAMPLE_FRACTION = "parcelspark.skew.sampleFraction"
CONF_JSON_ROWS_PER_FILE = "parcelspark.export.rowsPerFile"


def build_session(
    master: str | None = None,
    app_name: str = "parcelspark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the library is designed for.

    On a cluster pass ``master=None`` and let the launcher decide; the shuffle
    partition count then stays whatever the cluster config says, and AQE
    coalesces/splits partitions at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(
    shuffle_bytes: int,
    executors: int,
    cores_per_executor: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Spark settings sized for a cluster run.

    ``shuffle_bytes`` is the largest expected shuffle (for the daily build:
    the projected event columns, ~60 bytes/event).  Initial shuffle
    partitions are sized so each holds about ``target_partition_bytes``
    (never fewer than two waves of cores); AQE coalesces small ones back and
    splits skewed ones above 4x the target.  Input splits use the same target.
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(2 * cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def conf_float(spark: SparkSession, key: str, default: float) -> float:
    return float(spark.conf.get(key, str(default)))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of our own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()  # the context's own folder
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="parcelspark-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_OWN_SCRATCH: set[str] = set()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root.

    All of an application's folders are below one that goes when the
    application's driver ends; one that is killed leaves it behind.
    """
    own = f"{checkpoint_root(spark)}/parcelspark/{spark.sparkContext.applicationId}"
    if own not in _OWN_SCRATCH:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _OWN_SCRATCH.add(own)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"
