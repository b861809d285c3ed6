"""Models in a session that has counted rows by an observation."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from churnlens.operators import models


def test_forest_scores_after_an_observation(spark):
    """The forest's training summary holds the session, which no task can take once it has observed something."""
    rows = spark.range(200).select(F.col("id").alias("cod_cliente"), (F.col("id") % 2).cast("int").alias("churn"), (F.col("id") % 7 + F.col("id") % 2).cast("double").alias("a"))
    seen = Observation()
    assert rows.observe(seen, F.count(F.lit(1)).alias("n")).count() == 200 and seen.get == {"n": 200}
    model = models.random_forest(rows, ["a"], num_trees=2, max_depth=3)
    assert models.predict_proba(model, rows).count() == 200
    assert len(models.predict_proba(model, rows).collect()) == 200


def test_logit_after_an_observation(spark):
    rows = spark.range(200).select(F.col("id").alias("cod_cliente"), (F.col("id") % 2).cast("int").alias("churn"), (F.col("id") % 7 + F.col("id") % 2).cast("double").alias("a"))
    assert rows.observe(Observation(), F.count(F.lit(1)).alias("n")).count() == 200
    model, table = models.logit_wald(rows, ["a"])
    assert table.count() == 2 and len(models.predict_proba(model, rows).collect()) == 200


def test_forest_search_after_an_observation(spark):
    rows = spark.range(240).select(F.col("id").alias("cod_cliente"), (F.col("id") % 2).cast("int").alias("churn"), (F.col("id") % 7 + F.col("id") % 2).cast("double").alias("a"))
    assert rows.observe(Observation(), F.count(F.lit(1)).alias("n")).count() == 240
    forest = models.Forest(featuresCol="features", labelCol="label", numTrees=2, maxDepth=3, seed=1)
    data = models.Pipeline(stages=models.vector_stages(["a"])).fit(rows).transform(rows).withColumn("label", F.col("churn").cast("double"))
    for model in dict(forest.fitMultiple(data, [{forest.maxDepth: 1}, {forest.maxDepth: 2}])).values():
        assert not model.hasSummary and len(model.transform(data).select("prediction").collect()) == 240
