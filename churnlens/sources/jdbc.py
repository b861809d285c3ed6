"""S2 role tables over JDBC.

Connection settings come from five environment values (user, password, host,
port, database); four are required.  Zero dates become NULL at the driver
(``zeroDateTimeBehavior=CONVERT_TO_NULL``) so that they never reach an ANSI
cast.  Large tables are read in parallel on a numeric key range.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from churnlens.sources.roles import Roles

ENV_KEYS = ("DB_USER", "DB_PASS", "DB_HOST", "DB_PORT", "DB_NAME")
REQUIRED = ("DB_USER", "DB_PASS", "DB_HOST", "DB_NAME")


def jdbc_options(env: Mapping[str, str] | None = None, driver: str = "com.mysql.cj.jdbc.Driver") -> dict[str, str]:
    """JDBC reader options from the environment; raises when a required value is missing."""
    env = os.environ if env is None else env
    missing = [k for k in REQUIRED if not env.get(k)]
    if missing:
        raise ValueError(f"database settings missing or empty: {missing}")
    port = env.get("DB_PORT") or "3306"
    url = (
        f"jdbc:mysql://{env['DB_HOST']}:{port}/{env['DB_NAME']}"
        "?zeroDateTimeBehavior=CONVERT_TO_NULL&useCursorFetch=true"
    )
    return {"url": url, "user": env["DB_USER"], "password": env["DB_PASS"], "driver": driver, "fetchsize": "10000"}


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 64,
) -> DataFrame:
    """Read one table or ``(subquery) alias``; with a partition column and its
    bounds, ``num_partitions`` range queries run in parallel."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None and bounds is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def jdbc_roles(
    spark: SparkSession,
    options: Mapping[str, str],
    tables: Mapping[str, str],
    partitioning: Mapping[str, tuple[str, int, int]] | None = None,
) -> Roles:
    """Roles read over JDBC: ``tables`` maps role -> table (or subquery with the
    role's column names); ``partitioning`` maps role -> (column, low, high)."""
    partitioning = partitioning or {}

    def loader(role: str, table: str):
        def load() -> DataFrame:
            part = partitioning.get(role)
            if part:
                return read_table(spark, options, table, part[0], (part[1], part[2]))
            return read_table(spark, options, table)

        return load

    return Roles(spark, {role: loader(role, table) for role, table in tables.items()})
