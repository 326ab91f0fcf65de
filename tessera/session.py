"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes, splits
# skewed shuffle partitions and coalesces small ones; UTC keeps date parts
# independent of the host.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # independent table builds run as concurrent jobs in per-thread pools
    "spark.scheduler.mode": "FAIR",
}

_LOCAL_FALLBACK: dict[str, str] = {}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "tessera",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session. On a cluster the submitting environment supplies
    the session; library functions never call this."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "16g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, sinks and stream checkpoints.

    On a cluster this is the ``spark.checkpoint.dir`` the cluster names (a
    shared file system every executor can reach). Only when it is unset on a
    local master (tests, a laptop) is a private temporary folder created.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
        )
    app_id = spark.sparkContext.applicationId
    if app_id not in _LOCAL_FALLBACK:
        path = tempfile.mkdtemp(prefix="tessera-scratch-")
        spark.sparkContext.setCheckpointDir(path)
        _LOCAL_FALLBACK[app_id] = path
    return _LOCAL_FALLBACK[app_id]


# HotSpot compiles no method beyond 8,000 bytes of bytecode and interprets it for
# every row, while Spark's own limit for its generated methods is 65,535.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compile_methods(spark: SparkSession) -> None:
    """Let Spark split the code of wide projections into methods that HotSpot
    compiles. A smaller limit that the session has is kept."""
    if int(spark.conf.get(METHOD_LIMIT)) > 8_000:
        spark.conf.set(METHOD_LIMIT, "8000")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused location under the shared scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


MB = 1 << 20


def cluster_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Runtime SQL settings sized from the input volume and the cluster's
    task slots. Scan splits and shuffle partitions target a few hundred MB so
    a partition fits an executor core's memory share without spilling; AQE
    coalesces small partitions and splits skewed ones from these starting
    points; broadcasts stay behind an explicit size bound."""
    split = 512 * MB if input_bytes > (1 << 40) else 128 * MB
    shuffle = max(2 * total_cores, min(200_000, input_bytes // (256 * MB) + 1))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of a folder on the cluster's file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def tune(spark: SparkSession, tables_dir: str) -> dict[str, str]:
    """Apply ``cluster_settings`` for the tables under ``tables_dir``."""
    cores = spark.sparkContext.defaultParallelism
    conf = cluster_settings(input_bytes(spark, tables_dir), cores)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf
