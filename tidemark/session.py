"""Session defaults, the shared checkpoint folder and the size of a Python worker's batches."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", name: str = "tidemark", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes of an Arrow batch that a Python worker gets, where the session has Spark's default.
BATCH_BYTES, DEFAULT_BATCH_BYTES = "8m", ("64m", "64MB", "67108864", "67108864b")


def python_rows(rows: DataFrame) -> DataFrame:
    """Rows for a Python stage: batches are bounded in bytes, so a worker's memory doesn't follow the texts' length."""
    conf = rows.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", DEFAULT_BATCH_BYTES[0]) in DEFAULT_BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return rows


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder in spark.checkpoint.dir; only where it is unset (tests), make one."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tidemark-ckpt-"))


def cut(frame: DataFrame) -> DataFrame:
    """Materialise a frame in the shared checkpoint folder, so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)
