"""Layer 1: registered queries against their DuckDB oracle on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from role_cases import SF0001  # noqa: E402

import __spark_entry__ as E  # noqa: E402

KEYS = [
    "customer_features",
    "customer_features_active",
    "customer_product_features",
    "customer_product_features_active",
    "join_customer_features",
    "agg_count_distinct3",
    "agg_customer_product",
    "agg_features_by_customer_product",
    "having_grouped_alias",
    "stratified_split",
    "class_stats",
    "iqr_outliers",
    "kde_peak",
    "histogram_density",
    "pr_curve",
    "roc_auc",
    "calibration",
    "risk_segments",
    "segment_means",
    "attribution",
]


@pytest.fixture(scope="module")
def duck():
    import oracle_check

    return oracle_check.duck(SF0001)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    import oracle_check

    assert oracle_check.compare(spark, duck, key, E.queries()[key], E.oracle_sql()[key], SF0001)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "cod_cliente" and df.columns[-1] == "churn"
    assert len(df.columns) == 29
    assert df.count() > 0
