"""
2.9 M5-M12).

Model fits have no SQL twin: their keys have no oracle and are checked by
invariants in the tests (rows-only in the correctness gate).  Inputs are the
stratified train/test split of the whole customer feature table, with the
features kept by the selection step (M4); the split is checkpointed in the
shared checkpoint folder before fitting.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from churnlens.operators import evaluate as E
from churnlens.operators import explain, histtrees, models, profile, scoring, search
from churnlens.plans import comparison, oracle
from churnlens.plans.catalog import MODEL_FEATURES, R4_WITH
from churnlens.plans.catalog_analytics import (
    FEATS,
    R4_CTE,
    R5_CTE,
    REPORT_CTE,
    SCORED_CTE,
    r4,
    r5,
    report_spark,
    split_spark,
)
from churnlens.plans.registry import ONE_CUSTOMER, register
from churnlens.session import materialize, scratch_path
from churnlens.sources import csv as csv_source
from churnlens.sources import report as report_source

W = oracle.with_roles


def _train_test(spark, sf_dir):
    split = materialize(split_spark(spark, sf_dir))
    kept = profile.kept_features(profile.feature_selection(split, FEATS))
    return split.where(F.col("is_test") == 0), split.where(F.col("is_test") == 1), kept


@register("logit_wald")
def q_logit_wald(spark, sf_dir):
    train, _, kept = _train_test(spark, sf_dir)
    _, table = models.logit_wald(train, kept)
    return table


@register("drop_insignificant")
def q_drop_insignificant(spark, sf_dir):
    train, _, kept = _train_test(spark, sf_dir)
    return models.drop_insignificant(train, kept)


@register("random_forest")
def q_random_forest(spark, sf_dir):
    train, test, kept = _train_test(spark, sf_dir)
    model = models.random_forest(train, kept)
    return models.predict_proba(model, test)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    train, _, kept = _train_test(spark, sf_dir)
    return models.feature_importance(models.random_forest(train, kept), kept)


@register("gradient_boosting")
def q_gradient_boosting(spark, sf_dir):
    train, test, kept = _train_test(spark, sf_dir)
    ratio = models.class_weight_ratio(train.unionByName(test))  # whole target, as the reference
    model = models.gradient_boosting(train, kept, ratio)
    return models.predict_proba(model, test)


@register("rf_random_search")
def q_rf_random_search(spark, sf_dir):
    """M8 in full: 20 draws x 5 folds."""
    train, _, kept = _train_test(spark, sf_dir)
    return search.forest_search(train, kept)[1]


@register("second_order_boosting")
def q_second_order_boosting(spark, sf_dir):
    """M9 by gradient and hessian histograms: 100 rounds of depth 6."""
    train, test, kept = _train_test(spark, sf_dir)
    model = search.boosted(train, kept, models.class_weight_ratio(train.unionByName(test)))
    return histtrees.predict(test, model, ["cod_cliente", "churn"])


@register("model_store")
def q_model_store(spark, sf_dir):
    train, test, kept = _train_test(spark, sf_dir)
    model, _ = models.logit_wald(train, kept)
    path = scratch_path(spark, f"models/logit-{uuid.uuid4().hex}")
    models.save_model(model, path)
    models.save_feature_contract(spark, kept, path + "-features")
    loaded = models.load_model(path)
    feats = models.load_feature_contract(spark, path + "-features")
    return models.predict_proba(loaded, test.select("cod_cliente", "churn", *feats))


@register("batch_score_fitted")
def q_batch_score_fitted(spark, sf_dir):
    """R1 with a fitted pipeline: saved, loaded again, its features validated, the active customers scored."""
    train = materialize(split_spark(spark, sf_dir)).where(F.col("is_test") == 0)
    path = scratch_path(spark, f"models/forest-{uuid.uuid4().hex}")
    models.save_model(models.random_forest(train, list(MODEL_FEATURES)), path)
    models.save_feature_contract(spark, list(MODEL_FEATURES), path + "-features")
    return scoring.batch_score(r5(spark, sf_dir), models.load_model(path), models.load_feature_contract(spark, path + "-features"))


@register("feature_contract")
def q_feature_contract(spark, sf_dir):
    _, _, kept = _train_test(spark, sf_dir)
    path = scratch_path(spark, f"contracts/{uuid.uuid4().hex}")
    models.save_feature_contract(spark, kept, path)
    return spark.read.schema("pos int, feature string").json(path)


@register("calibration_forest")
def q_calibration_forest(spark, sf_dir):
    train, test, kept = _train_test(spark, sf_dir)
    model = models.random_forest(train, kept)
    scored = models.predict_proba(model, test)
    return E.calibration(E.scored_frame(scored, "churn", "p"))


# --------------------------------------------------------------------------- M12 linear


def _attribution_sql() -> str:
    s = scoring.DEMO_SCORER
    feats = s.features
    mu = ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS {c}" for c in feats)
    parts = [
        f"SELECT r.cod_cliente, '{c}' AS feature, {float(s.weights[c])!r} * (CAST(r.{c} AS DOUBLE) - m.{c}) AS contribuicao FROM r5 r CROSS JOIN mu m"
        for c in feats
    ]
    base = f"{float(s.intercept)!r}"
    for c in feats:
        base = f"({base} + {float(s.weights[c])!r} * m.{c})"
    parts.append(f"SELECT r.cod_cliente, '__base__' AS feature, {base} AS contribuicao FROM r5 r CROSS JOIN mu m")
    return W(*R4_WITH, R5_CTE, f"mu AS (SELECT {mu} FROM r5)", select=" UNION ALL ".join(parts))


@register("attribution", _attribution_sql())
def q_attribution(spark, sf_dir):
    return explain.linear_attribution(r5(spark, sf_dir), scoring.DEMO_SCORER)


@register(
    "attribution_global",
    f"SELECT feature, AVG(ABS(contribuicao)) AS media_abs_contribuicao FROM ({_attribution_sql()}) q WHERE feature <> '__base__' GROUP BY feature",
)
def q_attribution_global(spark, sf_dir):
    return explain.global_attribution(explain.linear_attribution(r5(spark, sf_dir), scoring.DEMO_SCORER))


@register("attribution_one", f"SELECT * FROM ({_attribution_sql()}) q WHERE cod_cliente = {ONE_CUSTOMER}")
def q_attribution_one(spark, sf_dir):
    return explain.explain_one(explain.linear_attribution(r5(spark, sf_dir), scoring.DEMO_SCORER), ONE_CUSTOMER)


# --------------------------------------------------------------------------- S3-S5 round trips

CSV_TYPES = {
    "cod_cliente": "long",
    "meses_vida_cliente": "int",
    "churn": "int",
    **{c: "long" for c in FEATS if c.startswith("qt_")},
}


def _csv_sql() -> str:
    cols = []
    for c in ["cod_cliente", *FEATS, "churn"]:
        if any(p in c for p in csv_source.DECIMAL_PATTERNS):
            cols.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            cols.append(c)
    return W(*R4_WITH, R4_CTE, select=f"SELECT {', '.join(cols)} FROM r4")


@register("csv_decimal_comma", _csv_sql())
def q_csv_decimal_comma(spark, sf_dir):
    path = scratch_path(spark, f"exports/features-{uuid.uuid4().hex}")
    csv_source.write_decimal_comma_csv(r4(spark, sf_dir), path)
    return csv_source.read_decimal_comma_csv(spark, path, types=CSV_TYPES)


@register("read_report", W(*R4_WITH, R5_CTE, SCORED_CTE, REPORT_CTE, select="SELECT * FROM report"))
def q_read_report(spark, sf_dir):
    base = scratch_path(spark, f"reports/risk-{uuid.uuid4().hex}")
    report_source.write_report(report_spark(spark, sf_dir), base, "2001-12-31")
    return report_source.read_report(spark, base, "2001-12-31").drop("run_date")


@register("tree_attribution")
def q_tree_attribution(spark, sf_dir):
    train, test, kept = _train_test(spark, sf_dir)
    rows = train.unionByName(test)
    model = models.gradient_boosting(train, kept, models.class_weight_ratio(rows))
    return explain.tree_attribution(rows, model, kept, scratch_path(spark, "ensembles"))


@register("gbt_random_search")
def q_gbt_random_search(spark, sf_dir):
    """M10 in full: 50 draws x 5 folds, F1 of class 1."""
    train, test, kept = _train_test(spark, sf_dir)
    return search.boosting_search(train, kept, models.class_weight_ratio(train.unionByName(test)))[1]


@register("metric_comparison_fitted")
def q_metric_comparison_fitted(spark, sf_dir):
    """E8 over the six fitted models, both searches in full."""
    train, test, kept = _train_test(spark, sf_dir)
    return comparison.compare_fitted(train, test, kept, models.class_weight_ratio(train.unionByName(test)))
