"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the library depends on for correct results (UTC wall clock, ANSI
# errors surfaced through try_* functions) and for scale (AQE re-planning,
# skew splitting, partition coalescing).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's old default writes timestamps without statistics: no filter on time could skip anything
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # the JVM compiles no method above 8,000 bytes: a parsing stage fused into one would run interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app: str = "accesslake", cpus: int | str = "*", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster pass your own builder."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there).  Only when it is unset, as in local tests, a folder is chosen.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext handle
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = os.path.join(os.environ.get("ACCESSLAKE_LOCAL_SCRATCH", "/tmp"), "accesslake-ckpt")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/accesslake/{name}-{uuid.uuid4().hex[:12]}"


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder (and those above it) in whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(where)
