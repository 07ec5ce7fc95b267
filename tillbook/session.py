"""Session defaults and reliable materialisation."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tillbook") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is; only when it is unset (local tests) a scratch folder is created.
    Works with classic sessions and, through the configuration, with remote
    (Connect) sessions that have no SparkContext.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: no SparkContext on the client
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tillbook-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Cut lineage by writing a Parquet table in the shared checkpoint folder.

    One computation, a columnar file with statistics (later scans prune
    columns and push filters), and executor loss after this point re-reads
    the files instead of replaying the upstream plan. Never ``localCheckpoint``
    and never a machine-local folder: the path is under
    ``spark.checkpoint.dir``. ``compression``: a codec other than the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table path below the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", name)


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for a folder on whatever storage the cluster uses (listing/existence only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p
