"""Exact quantiles without one-task groups, and curves whose plan does not grow."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlens.operators import evaluate, prepare, profile
from churnlens.operators.quantiles import exact_quantiles, value_counts

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def quantiles(spark, frame, **kw):
    long = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in frame], "g string, value double")
    return {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(value_counts(long, ["g"]), ["g"], PROBS, **kw).collect()}


def test_million_distinct_values(spark):
    long = spark.range(1_000_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
        (F.exp((F.xxhash64("id") % 1_000_003) / 1e5) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1) + F.col("id") / 1e9).alias("value"),
    )
    whole = long.toPandas()
    assert whole["value"].nunique() > 990_000
    got = exact_quantiles(value_counts(long, ["g"]), ["g"], PROBS).collect()
    for r in got:
        want = np.quantile(whole.loc[whole["g"] == r["g"], "value"], PROBS)
        np.testing.assert_allclose(r["q"], want, rtol=1e-12)
    assert sorted(r["n"] for r in got) == sorted(whole["g"].value_counts())


@pytest.mark.parametrize("buckets", [4, 16])
def test_many_cuts_agree_with_numpy(spark, buckets):
    rng = np.random.default_rng(3)
    groups = {
        "normal": rng.normal(size=300),
        "ties": rng.integers(0, 5, 400) * 1.5,
        "powers": 2.0 ** rng.integers(-300, 300, 250),
        "one": np.array([7.25]),
        "same": np.full(90, -3.0),
        "two": np.array([1.0, 2.0]),
        "far": np.concatenate([rng.normal(size=120), [1e308, -1e308]]),
    }
    got = quantiles(spark, [(g, v) for g, vs in groups.items() for v in vs], buckets=buckets)
    for g, vs in groups.items():
        assert got[g][0] == len(vs)
        np.testing.assert_allclose(got[g][1], np.quantile(vs, PROBS), rtol=1e-12, err_msg=g)


def test_missing_and_infinite_values(spark):
    rows = [("a", None), ("a", float("nan")), ("a", 1.0), ("a", 3.0), (None, 5.0), ("none", None)]
    rows += [("inf", float("inf")), ("inf", 1.0), ("inf", 2.0), ("inf", float("-inf")), ("inf", 3.0)]
    got = quantiles(spark, rows, buckets=4)
    assert got["a"] == (2, [1.0, 1.5, 2.0, 2.5, pytest.approx(2.8), 3.0])
    assert got[None] == (1, [5.0] * 6)
    assert "none" not in got
    n, q = got["inf"]
    assert n == 5 and q[0] == float("-inf") and q[1:4] == [1.0, 2.0, 3.0] and q[5] == float("inf")
    assert quantiles(spark, []) == {}


def test_no_percentile_in_the_plans(spark):
    df = spark.createDataFrame([(i % 2, float(i), float(i * i % 7)) for i in range(40)], "churn int, a double, b double")
    for out in (profile.class_stats(df, ["a", "b"]), profile.iqr_outliers(df, ["a", "b"])):
        assert "percentile" not in out._jdf.queryExecution().toString().lower()
    frame = pd.DataFrame([(float(i), float(i * i % 7)) for i in range(40)], columns=["a", "b"])
    fit = prepare.robust_fit(df, ["a", "b"])
    for c in ("a", "b"):
        q1, q2, q3 = frame[c].quantile([0.25, 0.5, 0.75])
        assert fit[c] == (pytest.approx(q2), pytest.approx(q3 - q1))


def test_class_stats_as_pandas(spark):
    rng = np.random.default_rng(11)
    frame = pd.DataFrame({"churn": rng.integers(0, 2, 500), "a": rng.normal(1e6, 3, 500), "b": rng.integers(0, 9, 500).astype(float)})
    frame.loc[rng.integers(0, 500, 50), "b"] = np.nan
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in frame.itertuples(index=False)]
    got = {(r["feature"], r["churn"]): r for r in profile.class_stats(spark.createDataFrame(rows, "churn long, a double, b double"), ["a", "b"]).collect()}
    for c in (0, 1):
        for f in ("a", "b"):
            s = frame.loc[frame["churn"] == c, f]
            r = got[f, c]
            assert (r["mediana"], r["media"], r["desvio_padrao"]) == (pytest.approx(round(s.median(), 2)), pytest.approx(round(s.mean(), 2)), pytest.approx(round(s.std(), 2)))


def _nodes(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_curve_plan_does_not_grow_with_the_ranges(spark):
    rng = np.random.default_rng(8)
    y, p = rng.integers(0, 2, 9000), np.round(rng.random(9000), 6)
    scored = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    few, many = (evaluate.score_counts(scored, ranges=n) for n in (8, 4000))
    assert abs(_nodes(few) - _nodes(many)) < 400
    a, b = (x.select("p", "cum_pos", "cum_neg").orderBy("p").collect() for x in (few, many))
    assert a == b
    assert evaluate.score_ranges(scored, ranges=4000).select("r").distinct().count() > 3000


def test_models_rated_together_as_alone(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 800)
    frames = {m: pd.DataFrame({"y": y, "p": np.round(np.clip(s * y + rng.random(800), 0, 2) / 2, 3)}) for m, s in (("weak", 0.1), ("strong", 0.9))}
    frames["fixed"] = frames["strong"]
    rules = {"fixed": (0.5, True)}
    got = evaluate.rated_models(
        spark.createDataFrame(pd.concat([f.assign(modelo=m) for m, f in frames.items()])[["modelo", "y", "p"]]), rules
    ).collect()
    assert len(got) == 3
    for r in got:
        f = frames[r["modelo"]]
        if r["modelo"] == "fixed":
            hit = f["p"] > 0.5
        else:
            cuts = sorted(f["p"].unique())
            f1 = [2 * ((f["p"] >= t) & (f["y"] == 1)).sum() / ((f["p"] >= t).sum() + (f["y"] == 1).sum()) for t in cuts]
            hit = f["p"] >= cuts[int(np.argmax(f1))]
        tp = (hit & (f["y"] == 1)).sum()
        assert r["precisao"] == pytest.approx(tp / hit.sum()) and r["recall"] == pytest.approx(tp / (f["y"] == 1).sum())
        assert r["acuracia"] == pytest.approx((hit == (f["y"] == 1)).mean())
        pos, neg = f.loc[f["y"] == 1, "p"].to_numpy(), f.loc[f["y"] == 0, "p"].to_numpy()
        auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
        assert r["roc_auc"] == pytest.approx(auc, abs=1e-12)
