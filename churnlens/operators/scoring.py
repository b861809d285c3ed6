"""Batch scoring, risk report and segmentation.

``batch_score`` appends the churn probability to every input row.  It takes
either a fitted Spark ML ``PipelineModel`` (the production path; its
probability vector is read with ``vector_to_array``) or a ``LinearScorer``:
fixed coefficients evaluated as a column expression.  The linear form is what
a logistic model reduces to, and it gives a score that SQL can recompute,
which is how the evaluation and report operators are checked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens import functions as X
from churnlens.operators.prepare import validate_features

RISK = "risco_churn_percentual"
SEGMENT = "segmento_risco"
SEGMENT_RANK = "segmento_ordem"


@dataclass(frozen=True)
class LinearScorer:
    """``p = 1 / (1 + exp(-(intercept + sum w_i x_i)))``, rounded to ``digits``."""

    intercept: float
    weights: Mapping[str, float]
    digits: int | None = 6

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def logit(self) -> Column:
        z = F.lit(float(self.intercept))
        for name, w in self.weights.items():
            z = z + F.lit(float(w)) * F.col(name).cast("double")
        return z

    def probability(self) -> Column:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-self.logit()))
        return F.round(p, self.digits) if self.digits is not None else p


def batch_score(df: DataFrame, model, features: Sequence[str] | None = None, out: str = RISK) -> DataFrame:
    """R1 probability of class 1 appended to all input columns.

    The model's feature list is validated first: missing columns raise with
    their names (F12).
    """
    if isinstance(model, LinearScorer):
        feats = list(features) if features is not None else model.features
        validate_features(df, feats)
        return df.withColumn(out, model.probability())
    from pyspark.ml.functions import vector_to_array

    feats = list(features or [])
    validate_features(df, feats)
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array(F.col("probability"))[1].alias(out))


def risk_report(scored: DataFrame, risk: str = RISK) -> DataFrame:
    """R2 risk rounded to 2 digits, average durations to 1 (the complaint one
    only when present), sorted by risk, highest first (T2; key breaks ties)."""
    cols = []
    for c in scored.columns:
        if c == risk:
            cols.append(X.round_half_even(c, 2).alias(c))
        elif c in ("media_dias_exec", "media_dias_exec_reclamacao"):
            cols.append(X.round_half_even(c, 1).alias(c))
        else:
            cols.append(F.col(c))
    order = [F.col(risk).desc_nulls_last()] + ([F.col("cod_cliente").asc()] if "cod_cliente" in scored.columns else [])
    return scored.select(*cols).orderBy(*order)


def risk_segments(report: DataFrame, risk: str = RISK) -> DataFrame:
    """R3/X23 segment label and its order, cut on the rounded risk."""
    return report.withColumn(SEGMENT, X.risk_segment(risk)).withColumn(SEGMENT_RANK, X.risk_segment_rank(risk))


def segment_counts(segmented: DataFrame) -> DataFrame:
    """A29 customers per segment (segments present only)."""
    return segmented.where(F.col(SEGMENT).isNotNull()).groupBy(SEGMENT, SEGMENT_RANK).agg(
        F.count(F.lit(1)).alias("qt_clientes")
    )


def segment_means(segmented: DataFrame, exclude: Sequence[str] = (RISK, "churn")) -> DataFrame:
    """A30 mean of every numeric column per segment, long form
    ``(segmento_risco, segmento_ordem, feature, media)``; segments present only.

    Like the reference, only the risk, the target and the segment itself are
    left out.
    """
    numeric = [
        f.name
        for f in segmented.schema.fields
        if f.name not in (*exclude, SEGMENT, SEGMENT_RANK)
        and f.dataType.typeName() in ("integer", "long", "double", "float", "decimal", "short")
    ]
    wide = segmented.where(F.col(SEGMENT).isNotNull()).groupBy(SEGMENT, SEGMENT_RANK).agg(
        *[F.avg(F.col(c).cast("double")).alias(c) for c in numeric]
    )
    return wide.unpivot([SEGMENT, SEGMENT_RANK], numeric, "feature", "media")


# Deterministic stand-in model used by the registered evaluation and report
# queries: a logistic score over base features with fixed coefficients.
DEMO_SCORER = LinearScorer(
    intercept=1.2,
    weights={
        "meses_vida_cliente": -0.045,
        "media_dias_exec": 0.04,
        "perc_qt_tarefas_sd": 0.01,
        "perc_qt_prioridade_normal": -0.012,
        "qt_tarefas_total": 0.05,
    },
)

# A second, reduced stand-in (fewer features) for the model comparison.
DEMO_SCORER_REDUCED = LinearScorer(
    intercept=1.0,
    weights={"meses_vida_cliente": -0.04, "media_dias_exec": 0.03},
)
