"""Models (M5-M11, M13; S6, S7) with Spark MLlib.

* logistic regression with Wald p-values: ``GeneralizedLinearRegression``
  (binomial/logit, no penalty), fitted by IRLS; its summary has standard
  errors and p-values (``LogisticRegression`` has none);
* random forest: the trees of ``RandomForestClassifier``, grown by ``histtrees`` and
  kept as a table (``forests``);
* gradient-boosted trees: ``GBTClassifier`` (the boosting class weight goes through ``weightCol``);
* random search: a seeded draw of parameter maps evaluated by
  ``CrossValidator`` on a fold column, candidates fitted in parallel.

Every fit reads a DataFrame that the caller has checkpointed (``session.materialize``),
so a lost executor re-reads the checkpoint, not the raw tables.  Tree models
also checkpoint their node caches every ``checkpointInterval`` iterations.

MLlib trees differ from scikit-learn/XGBoost (binning, split rule,
regularisation); results are compared by metrics, not values.  Depth "None"
(unlimited) maps to Spark's maximum depth 30; scikit-learn's minimum split
size has no MLlib twin and ``minInstancesPerNode`` stands for the minimum leaf
size; XGBoost's gamma maps to ``minInfoGain``.

Missing values (null or NaN) keep their rows, in fits and in scoring, by a stage
of the saved pipeline: for trees a missing value counts as the least, as in
``histtrees``; for the logistic model it is the feature's mean over the training rows.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.errors import UnsupportedOperationException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import functions as X
from churnlens.operators import forests, prepare, profile
from churnlens.session import materialize

LABEL = "churn"
KEY = "cod_cliente"
WEIGHT = "peso"


# --------------------------------------------------------------------------- M13


def class_weight_ratio(df: DataFrame, label: str = LABEL, inverted: bool = True) -> float:
    """M13 class weight from the class counts (one-row aggregate).

    The reference uses positives / negatives (``inverted=True``, the default,
    kept for comparable results); the usual rule is negatives / positives.
    """
    row = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    pos, neg = row["pos"], row["neg"]
    if inverted:
        return float(pos) / float(neg) if neg else 1.0
    return float(neg) / float(pos) if pos else 1.0


def with_class_weight(df: DataFrame, ratio: float, label: str = LABEL, out: str = WEIGHT) -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


# --------------------------------------------------------------------------- stages


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def vector_stages(features: Sequence[str], fill: Mapping[str, float] | None = None, out: str = "features") -> list:
    """Stages that put the features into one vector, a missing value as its ``fill`` (none given: the least value)."""
    fill = fill or dict.fromkeys(features, prepare.LEAST)
    columns = [f"{prepare.filled_sql(c, fill[c])} AS `_filled_{i}`" for i, c in enumerate(features)]
    return [SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__"), assembler([f"_filled_{i}" for i in range(len(features))], out)]


def feature_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """The mean of the values that are there, 0 where there is none; one aggregate."""
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features]
    row = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)]).first()
    return {c: 0.0 if row[i] is None else row[i] for i, c in enumerate(features)}


def fold_column(df: DataFrame, folds: int, seed: int = 42, key: str = KEY, label: str = LABEL, out: str = "fold") -> DataFrame:
    """Stratified fold id: rows of a class are ordered by a seeded hash and dealt
    in turn, so the folds of a class differ by at most one row.

    As in the split (M1) no window spans a class: the rows before a hash bucket
    come from the bucket counts (at most 65,536 for each class, so broadcast),
    and a row number is taken inside a bucket only.
    """
    h = prepare.hash_order(key, seed)
    rows = df.withColumn("_h", h).withColumn("_b", prepare.hash_bucket("_h"))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    buckets = buckets.select(F.col(label).alias("_c"), "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    dealt = rows.join(F.broadcast(buckets.withColumnRenamed("_b", "_b2")), F.col(label).eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_b2")))
    place = F.col("_before") + F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key)) - 1
    return dealt.select(*df.columns, F.pmod(place, F.lit(folds)).cast("int").alias(out))


def _labelled(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("label", F.col(label).cast("double"))


# --------------------------------------------------------------------------- M5/M6


#: A feature of which the kept ones before it leave less than this share of its variance is collinear.
COLLINEAR = 1e-6
COLLINEAR_TEXT = "Removida (colinear)"


def independent_features(df: DataFrame, features: Sequence[str], tolerance: float = COLLINEAR) -> list[str]:
    """The features, in their order, that the ones kept before them do not
    determine; constants go too.  One pass over the rows (the correlation
    matrix, k x k numbers), then elimination on the driver."""
    k = len(features)
    r = np.zeros((k, k))
    for row in profile.corr_matrix(df, features).collect():
        r[row["pos_x"], row["pos_y"]] = row["value"] or 0.0
    kept: list[int] = []
    for j in range(k):
        left = r[j, j]
        if kept:
            own = r[kept, j]
            left -= own @ np.linalg.solve(r[np.ix_(kept, kept)], own)
        if left > tolerance:
            kept.append(j)
    return [features[j] for j in kept]


def _constant_only(train: DataFrame, label: str) -> tuple[float, float, float]:
    """Coefficient, standard error and p-value of the model without features."""
    n, pos = train.agg(F.count(label), F.sum(label)).first()
    b, se = math.log(pos / (n - pos)), math.sqrt(n / (pos * (n - pos)))
    return b, se, math.erfc(abs(b / se) / math.sqrt(2.0))


def drop_insignificant(train: DataFrame, features: Sequence[str], label: str = LABEL, alpha: float = 0.05) -> DataFrame:
    """M6 the coefficient table after a refit on the features whose p-value is
    at most ``alpha``; where there is none, the constant alone."""
    _, table = logit_wald(train, features, label)
    kept = significant_features(table, alpha)
    if kept:
        return logit_wald(train, kept, label)[1]
    b, se, p = _constant_only(train, label)
    return train.sparkSession.createDataFrame([("const", b, se, p, _significance(p))], table.schema)


def _significance(p: float | None) -> str | None:
    if p is None:
        return None
    return "Sim (p < 0.05)" if p < 0.05 else "Não (Irrelevante)"


def logit_wald(
    train: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    scale: bool = True,
    max_iter: int = 100,
) -> tuple[PipelineModel, DataFrame]:
    """M5 unpenalised logistic regression with constant; coefficient table
    ``(feature, coefficient, std_error, p_value, significativo)``.

    With ``scale`` a min-max scaler is fitted on the training rows first, as
    the reference does.  The table has one row per feature (bounded), built
    from the fitted model's summary.  Features that others determine are left
    out of the fit, so that the rest have standard errors; their rows have no
    coefficient and say so.
    """
    named, means = list(features), feature_means(train, features)
    filled = train.select(*[F.expr(prepare.filled_sql(c, means[c])).alias(c) for c in named])
    features = independent_features(filled, named)
    if not features:
        raise ValueError("every feature is constant")
    stages = vector_stages(features, means, "raw" if scale else "features")
    if scale:
        stages.append(MinMaxScaler(inputCol="raw", outputCol="features"))
    glr = GeneralizedLinearRegression(
        family="binomial", link="logit", fitIntercept=True, regParam=0.0, maxIter=max_iter, featuresCol="features", labelCol="label"
    )
    model = Pipeline(stages=[*stages, glr]).fit(_labelled(train, label))
    fitted = model.stages[-1]
    s = fitted.summary
    k = len(features) + 1
    try:
        ses, pvals = [float(v) for v in s.coefficientStandardErrors], [float(v) for v in s.pValues]
    except UnsupportedOperationException:
        # the weights of the last step left a singular information matrix (classes
        # that the features separate): there are no standard errors to report
        ses, pvals = [None] * k, [None] * k

    place = {name: i for i, name in enumerate(features)}
    rows = [
        (name, float(fitted.coefficients[place[name]]), ses[place[name]], pvals[place[name]], _significance(pvals[place[name]]))
        if name in place
        else (name, None, None, None, COLLINEAR_TEXT)
        for name in named
    ]
    rows.append(("const", float(fitted.intercept), ses[-1], pvals[-1], _significance(pvals[-1])))
    schema = T.StructType(
        [
            T.StructField("feature", T.StringType()),
            T.StructField("coefficient", T.DoubleType()),
            T.StructField("std_error", T.DoubleType()),
            T.StructField("p_value", T.DoubleType()),
            T.StructField("significativo", T.StringType()),
        ]
    )
    return model, train.sparkSession.createDataFrame(rows, schema)


def significant_features(coef_table: DataFrame, alpha: float = 0.05) -> list[str]:
    """M6 features whose p-value is not above ``alpha`` (the constant excluded)."""
    rows = coef_table.where((F.col("feature") != "const") & ~(F.col("p_value") > alpha)).select("feature").collect()
    return [r["feature"] for r in rows]


def predict_proba(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (KEY, LABEL), out: str = "p") -> DataFrame:
    """Probability of class 1 next to the kept columns.

    Works for classifiers (probability vector) and the binomial GLM
    (prediction is the mean, i.e. the probability)."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(_labelled(df, LABEL) if LABEL in df.columns else df)
    if "probability" in scored.columns:
        p = vector_to_array(F.col("probability"))[1]
    else:
        p = F.col("prediction")
    return scored.select(*keep, p.alias(out))


# --------------------------------------------------------------------------- M7/M9


class Forest(RandomForestClassifier):
    """A random forest whose model keeps no training summary: that holds the
    session, which no task can take once it has observed something."""

    def _fit(self, dataset):
        return super()._fit(dataset).copy()


def random_forest(
    train: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    seed: int = 42,
    num_trees: int = 100,
    max_depth: int = 30,
    **params,
) -> PipelineModel:
    """M7 random forest on unscaled features (sqrt of the features per split).

    The trees grow by ``forests.grown`` under Spark ML's rules.  Further ``params`` are Spark ML's, whose
    own fit then takes place.
    """
    data = _labelled(train, label)
    if not params:
        forest = forests.grown(data, features, "label", num_trees, max_depth, seed)
        return PipelineModel([*Pipeline(stages=vector_stages(features)).fit(data).stages, forest])
    rf = Forest(
        featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth,
        featureSubsetStrategy="sqrt", seed=seed, checkpointInterval=10, **params,
    )
    return Pipeline(stages=[*vector_stages(features), rf]).fit(data)


def gradient_boosting(
    train: DataFrame,
    features: Sequence[str],
    ratio: float,
    label: str = LABEL,
    seed: int = 42,
    max_iter: int = 100,
    max_depth: int = 6,
    step_size: float = 0.3,
    **params,
) -> PipelineModel:
    """M9 boosted trees, positive class weighted by ``ratio``."""
    gbt = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol=WEIGHT, maxIter=max_iter, maxDepth=max_depth,
        stepSize=step_size, seed=seed, checkpointInterval=10, **params,
    )
    data = with_class_weight(_labelled(train, label), ratio)
    return Pipeline(stages=[*vector_stages(features), gbt]).fit(data)


# --------------------------------------------------------------------------- M8/M10

RF_SPACE = {
    "numTrees": ("randint", 100, 301),
    "maxDepth": ("choice", [30, 10, 20, 30]),
    "minInstancesPerNode": ("randint", 1, 6),
    "bootstrap": ("choice", [True, False]),
    "featureSubsetStrategy": ("choice", ["sqrt", "log2", "all"]),
}

GBT_SPACE = {
    "stepSize": ("choice", [0.01, 0.05, 0.1, 0.2]),
    "maxIter": ("randint", 100, 500),
    "maxDepth": ("randint", 3, 10),
    "subsamplingRate": ("choice", [0.6, 0.7, 0.8, 0.9, 1.0]),
    "featureSubsetStrategy": ("choice", ["0.6", "0.7", "0.8", "0.9", "1.0"]),
    "minInfoGain": ("choice", [0.0, 0.1, 0.2, 0.5]),
}


def draw_params(space: Mapping[str, tuple], n_iter: int, seed: int = 42) -> list[dict]:
    """Seeded random draws from a parameter space (``randint`` high exclusive)."""
    rng = random.Random(seed)
    out = []
    for _ in range(n_iter):
        d = {}
        for name, spec in space.items():
            if spec[0] == "randint":
                d[name] = rng.randrange(spec[1], spec[2])
            else:
                d[name] = rng.choice(spec[1])
        out.append(d)
    return out


def random_search(
    train: DataFrame,
    features: Sequence[str],
    kind: str = "rf",
    n_iter: int = 20,
    folds: int = 5,
    seed: int = 42,
    parallelism: int = 4,
    ratio: float | None = None,
    label: str = LABEL,
    space: Mapping[str, tuple] | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """M8 (``kind='rf'``, accuracy) / M10 (``kind='gbt'``, F1 of class 1):
    seeded random search with k-fold cross-validation; the best candidate is
    refitted on all training rows.  Returns the best pipeline and the
    candidate table ``(candidato, params, metrica)``.
    """
    data = materialize(fold_column(_labelled(train, label), folds, seed))
    if kind == "rf":
        est = Forest(featuresCol="features", labelCol="label", seed=seed, checkpointInterval=10)
        space, evaluator = space or RF_SPACE, MulticlassClassificationEvaluator(metricName="accuracy")
    else:
        data = with_class_weight(data, ratio if ratio is not None else class_weight_ratio(train, label))
        est = GBTClassifier(featuresCol="features", labelCol="label", weightCol=WEIGHT, seed=seed, checkpointInterval=10)
        space = space or GBT_SPACE
        evaluator = MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0)
    draws = draw_params(space, n_iter, seed)
    maps = [{getattr(est, k): v for k, v in d.items()} for d in draws]
    pipe = Pipeline(stages=[*vector_stages(features), est])
    # parameters of the last stage, addressed through the pipeline
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, foldCol="fold",
        parallelism=parallelism, seed=seed,
    )
    assembled = Pipeline(stages=vector_stages(features)).fit(data).transform(data)
    cv_model = cv.fit(assembled)
    metrics = list(cv_model.avgMetrics)
    best = max(range(len(metrics)), key=lambda i: (metrics[i], -i))
    best_model = pipe.copy({getattr(est, k): v for k, v in draws[best].items()}).fit(data)
    rows = [(i, str(draws[i]), float(metrics[i])) for i in range(len(draws))]
    schema = "candidato int, params string, metrica double"
    return best_model, train.sparkSession.createDataFrame(rows, schema)


# --------------------------------------------------------------------------- M11


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M11 ``(feature, importancia_absoluta, importancia_percentual)`` sorted
    descending; percent rounded to 2 (half to even).  One row per feature."""
    imp = model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    df = spark.createDataFrame(rows, "feature string, importancia_absoluta double")
    return df.withColumn("importancia_percentual", X.round_half_even(F.col("importancia_absoluta") * 100, 2)).orderBy(
        F.col("importancia_absoluta").desc(), F.col("feature")
    )


# --------------------------------------------------------------------------- S6/S7


def save_model(model: PipelineModel, path: str) -> None:
    """S7 save a fitted pipeline (a directory on the cluster file system)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_feature_contract(spark: SparkSession, features: Sequence[str], path: str) -> None:
    """S6 the ordered model feature list, stored beside the model as JSON lines."""
    rows = [(i, f) for i, f in enumerate(features)]
    spark.createDataFrame(rows, "pos int, feature string").coalesce(1).write.mode("overwrite").json(path)


def load_feature_contract(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema("pos int, feature string").json(path).collect()
    return [r["feature"] for r in sorted(rows, key=lambda r: r["pos"])]
