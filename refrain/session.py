"""Session settings and the reliable checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "refrain", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with adaptive execution on; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; only a session in one process may fall back to a temp one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.partition("[")[0] == "local":  # not local-cluster
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="refrain-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder so that later reads see one fixed set of rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def training_set(df: DataFrame) -> DataFrame:
    """Pin the input of an iterative fit in partitions of the advised size.

    Every pass starts one task per partition and ships the lineage; adaptive execution deals the rows into as few
    partitions as their bytes are worth, on any amount of data.
    """
    return pin(df.hint("rebalance"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet below the checkpoint folder and read again, and where it lies."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def sweep(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of frames that are gone.

    It does so when the driver collects its garbage, which a driver that only starts passes may not do before the disk is
    full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
