"""The rows of one task do not grow with the input: sessions sized by it, no shuffle by a
column of few values, one feature table for several scorers."""

import numpy as np
import pyarrow as pa
import pytest

from churnlens import session
from churnlens.operators import histtrees, tasks
from churnlens.plans import catalog_analytics, customer, customer_product
from churnlens.rules import DRIVER_RULES
from churnlens.sources.roles import driver_roles, read_driver_table
from role_cases import SF0001


def test_partitions_follow_the_rows_and_the_callers_session_stays(spark):
    before = spark.conf.getAll
    few, many = session.sized_session(spark, 10), session.sized_session(spark, 10 * session.ROWS_PER_PARTITION + 1)
    assert few.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert many.conf.get("spark.sql.shuffle.partitions") == "11"
    assert many.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    for key, most in session.MOST_BYTES.items():
        assert session._bytes(many.conf.get(key)) <= most
    assert spark.conf.getAll == before


@pytest.mark.parametrize(("text", "size"), [("64MB", 64 << 20), ("67108864b", 64 << 20), ("8m", 8 << 20), ("1024", 1024), ("2 GiB", 2 << 30)])
def test_sizes_as_settings_write_them(text, size):
    assert session._bytes(text) == size


@pytest.mark.parametrize("query", [customer.customer_features, customer_product.customer_product_features])
def test_feature_queries_are_dealt_by_the_number_of_lines(spark, monkeypatch, query):
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 100)
    lines = read_driver_table(spark, SF0001, "lineitem").count()
    plan = query(driver_roles(spark, SF0001), DRIVER_RULES)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert dealt and all(f", {-(-lines // 100)})" in line for line in dealt)


def test_tasks_are_not_shuffled_by_their_few_status_codes(spark):
    roles = driver_roles(spark, SF0001)
    plan = tasks.join_task_status(roles.task, roles.status)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(stos" not in plan and "hashpartitioning(concat" not in plan


def test_both_scorers_rate_one_split(spark, monkeypatch):
    made = []
    plain = catalog_analytics.r4
    monkeypatch.setattr(catalog_analytics, "r4", lambda *where: made.append(where) or plain(*where))
    assert catalog_analytics.q_metric_comparison(spark, SF0001).count() == 10
    assert len(made) == 1


def test_matrices_pass_through_arrow_and_its_slices():
    rows = np.arange(60, dtype=np.float32).reshape(12, 5)
    values = histtrees._binary(rows)
    assert values.to_pylist() == [r.tobytes() for r in rows]
    assert (histtrees._matrix(values, np.float32) == rows).all()
    assert (histtrees._matrix(values.slice(3, 4), np.float32) == rows[3:7]).all()
    assert len(histtrees._matrix(values.slice(3, 0), np.float32)) == 0
    assert (histtrees._matrix(values.cast(pa.large_binary()).slice(3, 4), np.float32) == rows[3:7]).all()
    assert (histtrees._matrix(pa.array([b"ab", b"cd"], pa.binary()), np.uint8) == [[97, 98], [99, 100]]).all()
