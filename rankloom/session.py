"""Session helpers: local session builder, durable intermediate tables, size checks."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sides up to this many rows may carry a broadcast hint; larger ones are left to
# the adaptive planner, which picks a shuffle join and splits skewed partitions.
BROADCAST_ROWS_CONF = "rankloom.broadcastRows"
BROADCAST_ROWS = 500_000

#: Bytes asked of the batches of rows that go to Python.
BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def local_session(cores: str = "*", app: str = "rankloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def setting(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when a session on one machine names none (a test) a folder of our own is made, and it
    goes when Python ends; a cluster must name a folder that all its machines see.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="rankloom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and cut its lineage.

    Used where a later step must see the very rows of this step (range partition
    ids, fixpoint state), so a lost executor must not lead to a different answer.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a new folder of the shared place; readers take the columns they need."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """Ask for batches of bounded bytes, so that many long texts don't meet in one."""
    spark = df.sparkSession
    current = str(spark.conf.get(BATCH_BYTES_CONF, None)).rstrip("bB")
    if not (current.isdigit() and 0 < int(current) <= BATCH_BYTES):
        spark.conf.set(BATCH_BYTES_CONF, str(BATCH_BYTES))
    return df


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Add a broadcast hint after counting that the side stays below the limit."""
    limit = setting(df.sparkSession, BROADCAST_ROWS_CONF, BROADCAST_ROWS)
    if df.limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df
