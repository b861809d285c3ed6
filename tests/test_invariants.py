"""Layer 3: invariants where no SQL oracle exists (models, split, folds)."""

import math

import pytest
from pyspark.sql import functions as F

from role_cases import SF0001
from churnlens.operators import evaluate as E
from churnlens.operators import explain, models, prepare, profile, scoring
from churnlens.plans import customer
from churnlens.plans.catalog_analytics import FEATS
from churnlens.rules import DRIVER_RULES
from churnlens.session import materialize
from churnlens.sources.roles import driver_roles


@pytest.fixture(scope="module")
def feats(spark):
    df = customer.customer_features(driver_roles(spark, SF0001), DRIVER_RULES, ordered=False)
    return materialize(df)


@pytest.fixture(scope="module")
def split(feats):
    return materialize(prepare.stratified_split(feats, 0.10, 42))


@pytest.fixture(scope="module")
def kept(feats):
    return profile.kept_features(profile.feature_selection(feats, FEATS))


def test_split_is_exact_and_stratified(feats, split):
    n = feats.count()
    counts = {(r["churn"], r["is_test"]): r["count"] for r in split.groupBy("churn", "is_test").count().collect()}
    n_test = sum(v for (c, t), v in counts.items() if t == 1)
    assert n_test == math.ceil(0.1 * n)
    for c in (0, 1):
        n_c = counts.get((c, 0), 0) + counts.get((c, 1), 0)
        assert abs(counts.get((c, 1), 0) - n_c * n_test / n) < 1
    assert split.count() == n and split.select("cod_cliente").distinct().count() == n


def test_split_is_deterministic(feats, split):
    again = prepare.stratified_split(feats, 0.10, 42).where("is_test = 1").select("cod_cliente")
    assert sorted(r[0] for r in again.collect()) == sorted(r[0] for r in split.where("is_test = 1").select("cod_cliente").collect())


def test_folds_disjoint_and_covering(feats):
    f = models.fold_column(feats, 3).select("cod_cliente", "fold")
    assert f.select("cod_cliente").distinct().count() == feats.count()
    assert {r[0] for r in f.select("fold").distinct().collect()} == {0, 1, 2}


def test_folds_are_stratified(feats):
    f = models.fold_column(feats, 3)
    n = {(r["churn"], r["fold"]): r["count"] for r in f.groupBy("churn", "fold").count().collect()}
    for c in (0, 1):
        own = [n.get((c, k), 0) for k in range(3)]
        assert max(own) - min(own) <= 1


def test_random_forest_refit_and_importances(split, kept):
    train, test = split.where("is_test = 0"), split.where("is_test = 1")
    m1 = models.random_forest(train, kept, num_trees=20, max_depth=4)
    m2 = models.random_forest(train, kept, num_trees=20, max_depth=4)
    p1 = {r["cod_cliente"]: r["p"] for r in models.predict_proba(m1, test).collect()}
    p2 = {r["cod_cliente"]: r["p"] for r in models.predict_proba(m2, test).collect()}
    assert p1 == p2 and all(0.0 <= v <= 1.0 for v in p1.values())
    imp = models.feature_importance(m1, kept).collect()
    assert sum(r["importancia_absoluta"] for r in imp) == pytest.approx(1.0)


def test_boosting_weights_and_scores(split, kept, feats):
    ratio = models.class_weight_ratio(feats)
    counts = {r["churn"]: r["count"] for r in feats.groupBy("churn").count().collect()}
    assert ratio == pytest.approx(counts[1] / counts[0])
    m = models.gradient_boosting(split.where("is_test = 0"), kept, ratio, max_iter=5, max_depth=3)
    ps = [r["p"] for r in models.predict_proba(m, split.where("is_test = 1")).collect()]
    assert ps and all(0.0 <= p <= 1.0 for p in ps)


def test_logit_on_two_by_two_table(spark):
    # odds of y=1: x=0 -> 10/30, x=1 -> 30/10; slope = log odds ratio
    rows = [(i, 0.0, 1) for i in range(10)] + [(100 + i, 0.0, 0) for i in range(30)]
    rows += [(200 + i, 1.0, 1) for i in range(30)] + [(300 + i, 1.0, 0) for i in range(10)]
    df = spark.createDataFrame(rows, "cod_cliente int, x double, churn int")
    _, table = models.logit_wald(df, ["x"], scale=False)
    t = {r["feature"]: r for r in table.collect()}
    assert t["x"]["coefficient"] == pytest.approx(math.log(9.0), rel=1e-6)
    assert t["const"]["coefficient"] == pytest.approx(math.log(1 / 3), rel=1e-6)
    assert t["x"]["p_value"] < 0.05


def _noisy(spark, slope):
    import random

    rng = random.Random(5)
    rows = []
    for i in range(600):
        a, b = rng.random(), rng.random()
        y = int(rng.random() < 1 / (1 + math.exp(-slope * (a - 0.5))))
        rows.append((i, a, b, 100.0 - a - b, 7.0, y))
    return spark.createDataFrame(rows, "cod_cliente int, a double, b double, c double, d double, churn int")


def test_collinear_and_constant_features_are_reported(spark):
    df = _noisy(spark, 4.0)
    assert models.independent_features(df, ["a", "b", "c", "d"]) == ["a", "b"]
    _, table = models.logit_wald(df, ["a", "b", "c", "d"])
    t = {r["feature"]: r for r in table.collect()}
    assert list(t) == ["a", "b", "c", "d", "const"]
    assert t["a"]["p_value"] < 0.05 and t["b"]["p_value"] is not None
    for name in "cd":
        assert t[name]["coefficient"] is None and t[name]["significativo"] == models.COLLINEAR_TEXT


def test_insignificant_features_go(spark):
    kept = [r["feature"] for r in models.drop_insignificant(_noisy(spark, 4.0), ["a", "d"]).collect()]
    assert kept == ["a", "const"]
    df = _noisy(spark, 0.0)
    p = {r["feature"]: r["p_value"] for r in models.logit_wald(df, ["b"])[1].collect()}
    alpha = p["b"] / 2
    only = models.drop_insignificant(df, ["b"], alpha=alpha).collect()
    pos, n = df.where("churn = 1").count(), df.count()
    assert [r["feature"] for r in only] == ["const"]
    assert only[0]["coefficient"] == pytest.approx(math.log(pos / (n - pos)))


def test_save_load_gives_equal_scores(spark, split, kept, tmp_path):
    train, test = split.where("is_test = 0"), split.where("is_test = 1")
    model, _ = models.logit_wald(train, kept[:4])
    path = str(tmp_path / "m")
    models.save_model(model, path)
    models.save_feature_contract(spark, kept[:4], path + "-f")
    assert models.load_feature_contract(spark, path + "-f") == kept[:4]
    a = {r["cod_cliente"]: r["p"] for r in models.predict_proba(model, test).collect()}
    b = {r["cod_cliente"]: r["p"] for r in models.predict_proba(models.load_model(path), test).collect()}
    assert a == b


def test_fitted_pipeline_scores_active_customers(spark, feats):
    from churnlens.plans.queries import QUERIES

    rows = QUERIES["batch_score_fitted"](spark, SF0001).collect()
    active = {r["cod_cliente"] for r in feats.where("churn = 0").collect()}
    risk = {r["cod_cliente"]: r[scoring.RISK] for r in rows}
    assert set(risk) == active and len(rows) == len(active)
    assert all(0.0 <= p <= 1.0 for p in risk.values()) and len(set(risk.values())) > 1


def test_attribution_adds_up_to_logit(feats):
    s = scoring.DEMO_SCORER
    att = explain.linear_attribution(feats, s)
    sums = att.groupBy("cod_cliente").agg(F.sum("contribuicao").alias("z"))
    z = feats.select("cod_cliente", s.logit().alias("logit"))
    worst = sums.join(z, "cod_cliente").select(F.max(F.abs(F.col("z") - F.col("logit")))).first()[0]
    assert worst < 1e-9


def test_random_search_small_space(split, kept):
    space = {"numTrees": ("choice", [5, 10]), "maxDepth": ("randint", 2, 4)}
    best, table = models.random_search(split.where("is_test = 0"), kept, "rf", n_iter=2, folds=2, space=space)
    assert table.count() == 2
    gspace = {"maxIter": ("choice", [3]), "maxDepth": ("choice", [2, 3])}
    best, table = models.random_search(split.where("is_test = 0"), kept, "gbt", n_iter=2, folds=2, space=gspace)
    assert table.count() == 2 and all(0 <= r["metrica"] <= 1 for r in table.collect())


def test_curves_are_consistent(split):
    ev = scoring.batch_score(split.where("is_test = 1"), scoring.LinearScorer(1.2, dict(scoring.DEMO_SCORER.weights), None))
    ev = E.scored_frame(ev, "churn", scoring.RISK)
    pts = E.roc_points(ev).collect()
    assert max(r["tpr"] for r in pts) == pytest.approx(1.0) and max(r["fpr"] for r in pts) == pytest.approx(1.0)
    auc = E.roc_auc(ev).first()[0]
    # trapezoid over the ROC points gives the same area
    xs = sorted((r["fpr"], r["tpr"]) for r in pts)
    trap = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(xs, xs[1:]))
    assert auc == pytest.approx(trap)


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_tree_attribution_adds_up_to_raw_score(spark, split, kept, kind, tmp_path):
    from pyspark.ml.functions import vector_to_array

    train, test = split.where("is_test = 0"), split.where("is_test = 1")
    if kind == "gbt":
        model = models.gradient_boosting(train, kept, 1.0, max_iter=5, max_depth=3)
        raw = vector_to_array(F.col("rawPrediction"))[1] * 2.0
    else:
        model = models.random_forest(train, kept, num_trees=5, max_depth=4)
        raw = vector_to_array(F.col("probability"))[1]
    att = explain.tree_attribution(test, model, kept, str(tmp_path))
    sums = att.groupBy("cod_cliente").agg(F.sum("contribuicao").alias("s"))
    scored = model.transform(test.withColumn("label", F.col("churn").cast("double"))).select("cod_cliente", raw.alias("raw"))
    worst = sums.join(scored, "cod_cliente").select(F.max(F.abs(F.col("s") - F.col("raw")))).first()[0]
    assert worst < 1e-9
    # a feature never used by the model gets no contribution
    assert att.where(F.col("feature") != "__base__").count() == test.count() * len(kept)


def test_tree_shap_matches_brute_force_shapley():
    """Path-dependent Shapley values against the definition on a small tree:
    v(S) follows x on features in S and averages by cover elsewhere."""
    import itertools

    import numpy as np

    # tree: split f0<=0.5 (cover 60/40); left: f1<=1.5 (30/30) leaves 1.0, 3.0;
    # right: f0<=2.5 (10/30) leaves -2.0, f2<=0.0 (15/15) leaves 4.0, 0.5
    leaves = [
        ([(0, [0.5], -1, True, 0.6), (1, [1.5], -1, True, 0.5)], 1.0),
        ([(0, [0.5], -1, True, 0.6), (1, [1.5], -1, False, 0.5)], 3.0),
        ([(0, [0.5], -1, False, 0.4), (0, [2.5], -1, True, 0.25)], -2.0),
        ([(0, [0.5], -1, False, 0.4), (0, [2.5], -1, False, 0.75), (2, [0.0], -1, True, 0.5)], 4.0),
        ([(0, [0.5], -1, False, 0.4), (0, [2.5], -1, False, 0.75), (2, [0.0], -1, False, 0.5)], 0.5),
    ]
    ens = {"trees": [leaves]}
    xs = np.array([[0.0, 2.0, 1.0], [3.0, 0.0, -1.0], [1.0, 1.0, 1.0], [3.0, 5.0, 1.0]])
    phi = explain.tree_shap(ens, xs)

    def value(x, S):
        total = 0.0
        for path, v in leaves:
            w = 1.0
            for f, thr, _, left, ratio in path:
                if f in S:
                    ok = (x[f] <= thr[0]) == left
                    w *= 1.0 if ok else 0.0
                else:
                    w *= ratio
            total += w * v
        return total

    n = 3
    for r, x in enumerate(xs):
        for i in range(n):
            others = [j for j in range(n) if j != i]
            exact = 0.0
            for k in range(n):
                for S in itertools.combinations(others, k):
                    wgt = math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n)
                    exact += wgt * (value(x, set(S) | {i}) - value(x, set(S)))
            assert phi[r, i] == pytest.approx(exact, abs=1e-12)


def test_registered_tree_attribution_is_the_whole_job(spark, monkeypatch):
    """The library's number of rounds, and every customer explained."""
    from churnlens.plans import catalog_models

    seen = {}
    monkeypatch.setattr(catalog_models.models, "gradient_boosting", lambda train, kept, ratio, **more: seen.update(more))
    monkeypatch.setattr(catalog_models.explain, "tree_attribution", lambda rows, model, kept, path: rows)
    rows = catalog_models.q_tree_attribution(spark, SF0001)
    assert seen.get("max_iter", 100) >= 100
    assert {r.is_test for r in rows.select("is_test").distinct().collect()} == {0, 1}
