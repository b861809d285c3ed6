"""S4/S5 the scored report as a dated, partitioned table.

Each run writes one ``run_date=YYYY-MM-DD`` partition (dynamic partition
overwrite: re-running a day replaces only that day); reading a day prunes
the other partitions at planning time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(df: DataFrame, base_path: str, run_date: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """S4 write ``df`` as the ``run_date`` partition of the report table
    (``mode='append'`` adds to the partition)."""
    spark = df.sparkSession
    previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        (
            df.withColumn("run_date", F.lit(run_date))
            .write.mode(mode)
            .partitionBy("run_date")
            .format(fmt)
            .save(base_path)
        )
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)


def read_report(spark: SparkSession, base_path: str, run_date: str | None = None, fmt: str = "parquet") -> DataFrame:
    """S5 read the report; with ``run_date`` only that partition is scanned."""
    df = (
        spark.read.format(fmt)
        .option("basePath", base_path)
        .option("recursiveFileLookup", False)
        .load(base_path)
        .withColumn("run_date", F.col("run_date").cast("string"))
    )
    if run_date is not None:
        df = df.where(F.col("run_date") == F.lit(run_date))
    return df
