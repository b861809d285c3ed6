import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("churnlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="churnlens-test-ckpt-"))
    elif not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s


@pytest.fixture(scope="session")
def make_roles(spark):
    from churnlens.sources.roles import frame_roles

    def build(**rows):
        from decimal import Decimal

        from role_cases import ROLE_SCHEMAS

        frames = {}
        for role, schema in ROLE_SCHEMAS.items():
            data = rows.get(role, [])
            if role == "item":
                data = [(a, b, Decimal(str(q)), Decimal(str(v))) for a, b, q, v in data]
            frames[role] = spark.createDataFrame(data, schema)
        return frame_roles(spark, frames)

    return build
