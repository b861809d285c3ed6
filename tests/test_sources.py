"""Sources and sinks: JDBC options, dated report, CSV export."""

import pytest
from pyspark.sql import functions as F

from churnlens.operators import scoring
from churnlens.sources import csv as C
from churnlens.sources import report as Rp
from churnlens.sources.jdbc import jdbc_options


def test_jdbc_options_require_settings():
    env = {"DB_USER": "u", "DB_PASS": "p", "DB_HOST": "h", "DB_NAME": "db"}
    o = jdbc_options(env)
    assert o["url"].startswith("jdbc:mysql://h:3306/db?") and "zeroDateTimeBehavior=CONVERT_TO_NULL" in o["url"]
    with pytest.raises(ValueError, match="DB_PASS"):
        jdbc_options({**env, "DB_PASS": ""})


def test_report_partitions_round_trip(spark, tmp_path):
    base = str(tmp_path / "report")
    df = spark.createDataFrame([(1, 0.5), (2, 0.9)], "cod_cliente int, risco_churn_percentual double")
    Rp.write_report(df, base, "2024-01-01")
    Rp.write_report(df.limit(1), base, "2024-01-02")
    Rp.write_report(df.where("cod_cliente = 2"), base, "2024-01-01")  # re-run replaces the day only
    assert Rp.read_report(spark, base, "2024-01-01").count() == 1
    assert Rp.read_report(spark, base, "2024-01-02").count() == 1
    assert Rp.read_report(spark, base).count() == 2


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, 0.25, 3), (2, 1e-5, 4)], "cod_cliente long, perc_x double, qt_y long")
    C.write_decimal_comma_csv(df, path)
    raw = spark.read.option("sep", ";").option("header", True).csv(path)
    assert all("," in r["perc_x"] for r in raw.collect())
    back = C.read_decimal_comma_csv(spark, path, types={"cod_cliente": "long", "qt_y": "long"})
    assert sorted(tuple(r) for r in back.collect()) == [(1, 0.25, 3), (2, 1e-5, 4)]
