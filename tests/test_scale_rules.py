"""Results that must not depend on the size, the partitions or missing values."""

import numpy as np
import pandas as pd
import pytest

from churnlens.operators import evaluate, profile
from churnlens.sources.roles import read_driver_table


def exact_auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = pd.Series(p).rank().to_numpy()
    pos = y.sum()
    assert len(order) == len(y)
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


@pytest.mark.parametrize(("partitions", "reuse"), [(8, "true"), (8, "false"), (40, "true")])
def test_curves_with_many_scores(spark, partitions, reuse):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 60_000)
    p = np.round(np.clip(rng.beta(2, 5, len(y)) + 0.1 * y, 0, 1), 7)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.exchange.reuse")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
        assert abs(evaluate.roc_auc(df).first()["roc_auc"] - exact_auc(y, p)) < 1e-12
        counts = evaluate.score_counts(df).toPandas().sort_values("p", ascending=False)
        assert (counts["cum_pos"].to_numpy() == counts["pos"].cumsum().to_numpy()).all()
        assert (counts["cum_neg"].to_numpy() == counts["neg"].cumsum().to_numpy()).all()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_correlation_with_missing_values(spark):
    rng = np.random.default_rng(6)
    frame = pd.DataFrame(rng.normal(size=(500, 4)), columns=list("abcd"))
    frame["b"] += frame["a"]
    frame["d"] = 7.3
    frame["c"] = frame["c"] * 1e-3 + 1e6
    frame.loc[rng.integers(0, 500, 60), "b"] = np.nan
    frame.loc[rng.integers(0, 500, 40), "c"] = np.nan
    rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in frame.to_numpy()]
    got = {(r.x, r.y): r.value for r in profile.corr_matrix(spark.createDataFrame(rows, "a double, b double, c double, d double"), list("abcd")).collect()}
    want = frame.assign(c=frame["c"] - 1e6).corr()  # the shift is exact; pandas itself is 3e-9 off the rational value without it
    for x in "abcd":
        for y in "abcd":
            if "d" in (x, y):
                assert got[x, y] is None
            else:
                assert abs(got[x, y] - want.loc[x, y]) < 1e-9, (x, y)


def test_tables_are_read_without_a_shuffle(spark):
    plan = read_driver_table(spark, "/root/testdata/sf0.001", "lineitem")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Repartition" not in plan
