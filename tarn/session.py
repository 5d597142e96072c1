"""Session settings shared by the whole package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """All hour and weekday rules are defined in UTC; tasks get this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so tasks can import it anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_tarn_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tarn-package-"), "tarn"), "zip", root, "tarn")
    sc.addPyFile(archive)
    sc._tarn_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Cut Arrow batches at 8 MB as well as by rows, unless the session says otherwise: of long texts, 10,000 rows are tens
    of megabytes, which a task holds twice and the JVM once more."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "8m")


def spread(df: DataFrame, *keys: str | Column, least: int = 0) -> DataFrame:
    """Hash-partition by key for compute-heavy grouped tasks, over ``least`` partitions if the session has fewer.

    Adaptive execution merges small partitions by bytes, which would put many
    expensive groups into one task; an explicit partition count is left alone.
    """
    return df.repartition(max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point the session at a checkpoint folder that every executor can reach.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one process, gets a scratch folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tarn-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # a local session's own scratch data ends with it
        sc.setCheckpointDir(folder)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a cached frame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the checkpoints, so it is shared by all executors."""
    import uuid

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
