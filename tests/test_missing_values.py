"""Rows whose features are missing take part in fits, scores and attributions."""

import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlens.operators import explain, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(400):
        a, b = rng.random() * 10 - 5, rng.random()
        y = int(rng.random() < 1 / (1 + math.exp(-a)))
        a = None if i % 20 == 0 else float("nan") if i % 20 == 1 else a
        out.append((i, a, rng.randrange(5) if i % 7 else None, b, None, y))
    return spark.createDataFrame(out, "cod_cliente int, a double, k int, `b.c` double, never double, churn int")


def test_logit_takes_the_mean_for_a_missing_value(rows, tmp_path):
    model, table = models.logit_wald(rows, ["a", "k", "never"])
    there = rows.where("a is not null and not isnan(a)").agg(F.avg("a")).first()[0], rows.agg(F.avg("k")).first()[0]
    filled = rows.withColumn("a", F.when(F.col("a").isNull() | F.isnan("a"), there[0]).otherwise(F.col("a"))).withColumn("k", F.coalesce(F.col("k").cast("double"), F.lit(there[1])))
    _, same = models.logit_wald(filled, ["a", "k"])
    own, other = ({r["feature"]: r for r in t.collect()} for t in (table, same))
    assert own["never"]["significativo"] == models.COLLINEAR_TEXT
    for c in ("a", "k", "const"):
        assert own[c]["coefficient"] == pytest.approx(other[c]["coefficient"], rel=1e-6)
    models.save_model(model, str(tmp_path / "m"))
    ps = models.predict_proba(models.load_model(str(tmp_path / "m")), rows).collect()
    assert len(ps) == 400 and all(0 <= r["p"] <= 1 for r in ps)


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_trees_take_missing_for_the_least(spark, rows, kind, tmp_path):
    feats = ["a", "k", "b.c"]
    rows = rows.withColumn("churn", F.when(F.col("k").isNull(), 1).otherwise(F.col("churn")))
    if kind == "gbt":
        model, raw = models.gradient_boosting(rows, feats, 1.0, max_iter=4, max_depth=3), vector_to_array(F.col("rawPrediction"))[1] * 2.0
    else:
        model, raw = models.random_forest(rows, feats, num_trees=6, max_depth=4), vector_to_array(F.col("probability"))[1]
    scored = model.transform(rows).select("cod_cliente", raw.alias("raw"))
    p = {r["cod_cliente"]: r["p"] for r in models.predict_proba(model, rows).collect()}
    assert len(p) == 400 and min(p[i] for i in range(0, 400, 7)) > 0.5
    sums = explain.tree_attribution(rows, model, feats, str(tmp_path)).groupBy("cod_cliente").agg(F.sum("contribuicao").alias("s"))
    assert sums.join(scored, "cod_cliente").select(F.max(F.abs(F.col("s") - F.col("raw")))).first()[0] < 1e-9
