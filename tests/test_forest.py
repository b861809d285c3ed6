"""The random forest: grown in a few jobs, the same by either way, read back from Spark ML's model."""

import numpy as np
import pandas as pd
import pytest

from churnlens.operators import histtrees as H
from churnlens.operators import models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(21)
    x = rng.normal(size=(500, 4))
    x[::9, 1] = np.nan
    frame = pd.DataFrame(x, columns=list("abcd"))
    frame["cod_cliente"], frame["churn"] = np.arange(500) // 2, (x[:, 0] + rng.normal(0, 1.0, 500) > 0).astype(int)
    return spark.createDataFrame(frame).repartition(3)


def saved_nodes(spark, model, path):
    models.save_model(model.stages[-1], path)
    return spark.read.parquet(path + "/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()


def test_deep_forest_takes_a_few_jobs(spark, rows):
    sc = spark.sparkContext
    sc.setJobGroup("deep-forest", "")
    model = models.random_forest(rows, list("abcd"), num_trees=30)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert model.stages[-1].getNumTrees == 30
    assert len(sc.statusTracker().getJobIdsForGroup("deep-forest")) < 25  # one and more a level before


def test_rows_dealt_or_sent_give_the_same_forest(spark, rows, monkeypatch, tmp_path):
    sent = saved_nodes(spark, models.random_forest(rows, list("abcd"), num_trees=5, max_depth=6), str(tmp_path / "a"))
    monkeypatch.setattr(H, "HELD", 0)
    dealt = saved_nodes(spark, models.random_forest(rows, list("abcd"), num_trees=5, max_depth=6), str(tmp_path / "b"))
    assert sent == dealt and {r["treeID"] for r in sent} == set(range(5))


def test_nodes_hold_the_counts_of_their_children(spark, rows, tmp_path):
    nodes = saved_nodes(spark, models.random_forest(rows, list("abcd"), num_trees=8), str(tmp_path / "f"))
    at = {(r["treeID"], r["id"]): r for r in nodes}
    gini = lambda s: 1 - sum((x / sum(s)) ** 2 for x in s)
    tried = set()
    for (tree, i), r in at.items():
        own = r["impurityStats"]
        assert r["impurity"] == pytest.approx(gini(own)) and r["prediction"] == float(own[1] > own[0])
        if r["leftChild"] < 0:
            assert r["rightChild"] == -1 and r["gain"] == -1
            continue
        left, right = (at[tree, r[c]]["impurityStats"] for c in ("leftChild", "rightChild"))
        assert own == [a + b for a, b in zip(left, right, strict=True)]
        fall = gini(own) - (sum(left) * gini(left) + sum(right) * gini(right)) / sum(own)
        assert r["gain"] == pytest.approx(fall, abs=1e-9) and fall > 0
        tried.add(r["split"]["featureIndex"])
    roots = [sum(at[t, 0]["impurityStats"]) for t in range(8)]
    assert tried == {0, 1, 2, 3} and len(set(roots)) > 1 and all(400 < n < 600 for n in roots)  # bootstraps of 500 rows


def test_saved_forest_scores_alike_and_its_importances_add_up(spark, rows, tmp_path):
    model = models.random_forest(rows, list("abcd"), num_trees=12)
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    keep = ["cod_cliente", "a"]
    one, two = ({(r[0], r[1]): r["p"] for r in models.predict_proba(m, rows, keep).collect()} for m in (model, again))
    assert one == two and len(one) == 500
    imp = {r["feature"]: r["importancia_absoluta"] for r in models.feature_importance(again, list("abcd")).collect()}
    assert sum(imp.values()) == pytest.approx(1.0) and max(imp, key=imp.get) == "a"
    # the mean over the trees of the share of class 1 in the leaf that a row reaches, walked by hand
    nodes = {(r["treeID"], r["id"]): r for r in saved_nodes(spark, again, str(tmp_path / "n"))}
    for r in rows.limit(20).collect():
        x, shares = [-1e300 if v is None or np.isnan(v) else v for v in (r["a"], r["b"], r["c"], r["d"])], []
        for tree in range(12):
            at = nodes[tree, 0]
            while at["leftChild"] >= 0:
                low = x[at["split"]["featureIndex"]] <= at["split"]["leftCategoriesOrThreshold"][0]
                at = nodes[tree, at["leftChild"] if low else at["rightChild"]]
            shares.append(at["impurityStats"][1] / sum(at["impurityStats"]))
        assert one[r["cod_cliente"], r["a"]] == pytest.approx(np.mean(shares))


def test_rare_values_of_a_feature_with_few_are_cut_apart(spark):
    """A value of one row in a thousand falls between the quantiles, but a feature of at most 32 values is cut behind each."""
    rows = spark.range(1000).selectExpr("id", "cast(if(id < 3, id + 1, 0) as double) AS a", "if(id % 5 = 0, null, cast(id as double)) AS b", "cast(id % 2 as int) AS y")
    plain, own = H.binned(rows, ["a", "b"], "y", "id"), H.binned(rows, ["a", "b"], "y", "id", missing=-1e300)
    assert plain.cuts[0].tolist() in ([], [0.0]) and own.cuts[0].tolist() == [0.0, 1.0, 2.0]
    assert own.cuts[1][0] == -1e300 and own.cuts[1][1:].tolist() == plain.cuts[1].tolist()
    empty = H.binned(rows.where("id < 0"), ["a", "b"], "y", "id", missing=-1e300)
    assert [len(c) for c in empty.cuts] == [0, 0]
