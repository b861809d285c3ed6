"""Session helpers.

The cluster decides where reliable checkpoints live (``spark.checkpoint.dir``);
we only read that setting.  A local default is set only when it is absent, as in
tests on a laptop.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "churnlens") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CHURNLENS_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Rows of the largest input for each partition of a shuffle; the bytes that adaptive execution
#: may put together in one, and those of a file that one task may read (a task aggregates, expands
#: for its three distinct counts or sorts the rows of one partition, at several hundred bytes each);
#: a partition of a join with more bytes is dealt over several tasks.
ROWS_PER_PARTITION = 250_000
MOST_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 32 << 20,
}


def sized_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session of the same application whose tasks do not grow with the input.

    It has the settings of ``spark`` (which stay as they are), but at least one shuffle
    partition for each ``ROWS_PER_PARTITION`` rows, and at most ``MOST_BYTES``.  So the
    rows of one task, and with them its memory, are bounded however large the input is.
    """
    own = spark.newSession()
    there = own.conf.getAll
    for key, value in spark.conf.getAll.items():
        if there.get(key) != value and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.shuffle.partitions", max(partitions, -(-rows // ROWS_PER_PARTITION)))
    for key, most in MOST_BYTES.items():
        own.conf.set(key, min(most, _bytes(spark.conf.get(key))))
    return own


def _bytes(text: str) -> int:
    """A size as Spark's settings write it (``64MB``, ``8m``, ``1024``)."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    A fresh local folder is made only when the session names none and runs in
    one process (``local[...]``, as in tests); elsewhere that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir names no folder that the executors share")
    return tempfile.mkdtemp(prefix="churnlens-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_dir(spark))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used before iterative work (profiling passes, model fits) so that a lost
    executor recomputes from the checkpoint, not from the raw tables.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    # persisted while the checkpoint is written, so the plan runs once (an
    # eager reliable checkpoint would otherwise compute it twice)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/churnlens/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    Cuts the lineage like ``materialize`` but keeps columns apart, so later
    readers prune them and push their filters down.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
