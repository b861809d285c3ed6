"""
A19-A30, 2.6, 2.9 M1-M4/M13, 2.10, 2.11) with their DuckDB oracles.

Inputs are derived from the whole driver tables: the customer feature table
(R4), its production form (R5), the exact stratified test split of R4, and a
deterministic logistic stand-in model (``scoring.DEMO_SCORER``) so that
scores, curves and reports can be recomputed in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from churnlens import functions as X
from churnlens.operators import evaluate as E
from churnlens.operators import features, prepare, profile, scoring
from churnlens.plans import customer, oracle
from churnlens.plans.catalog import PATTERNS, R4_SQL_INNER, R4_WITH
from churnlens.plans.registry import R, register, roles, rounded
from churnlens.rules import RISK_EDGES, RISK_LABELS
from churnlens.session import materialize

W = oracle.with_roles
FEATS = [c for c in features.BASE_OUTPUT if c not in ("cod_cliente", "churn")]
STAT_FEATS = [c for c in FEATS if any(p in c for p in ("media", "qt", "valor"))]
SEED = 42
TEST_SHARE = 0.10


def lit_double(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


# --------------------------------------------------------------------------- shared inputs


def r4(spark, sf_dir):
    return customer.customer_features(roles(spark, sf_dir), R, ordered=False)


def r5(spark, sf_dir):
    return customer.customer_features(roles(spark, sf_dir), R, active_only=True, ordered=False)


def r4_checkpointed(spark, sf_dir):
    """R4 written once to the shared checkpoint folder, for operators that
    read the feature table more than once (split, outliers, histograms, KDE,
    correlation, selection)."""
    return materialize(r4(spark, sf_dir))


R4_CTE = f"r4 AS (SELECT * FROM ({R4_SQL_INNER}) q WHERE media_dias_exec > 0)"
R5_CTE = f"r5 AS (SELECT * FROM ({R4_SQL_INNER}) q WHERE media_dias_exec > 0 AND churn = 0)"


def long_cte(name: str, src: str, feats: list[str], ids: str = "churn") -> str:
    values = ", ".join(f"('{c}', {i})" for i, c in enumerate(feats))
    case = " ".join(f"WHEN '{c}' THEN CAST({c} AS DOUBLE)" for c in feats)
    id_sel = f"{ids}, " if ids else ""
    return (
        f"{name} AS (SELECT {id_sel}f.feature, f.pos, CASE f.feature {case} END AS value "
        f"FROM {src} CROSS JOIN (VALUES {values}) f(feature, pos))"
    )


def rne(expr: str, digits: int = 2) -> str:
    """numpy round in SQL (same doubles as ``rint(x*10^d)/10^d``)."""
    scale = float(10**digits)
    return f"(round_even(({expr}) * {scale!r}, 0) / {scale!r})"


def split_ctes(src: str) -> tuple[str, ...]:
    n_test = f"CEIL({lit_double(TEST_SHARE)} * CAST(SUM(n_c) AS DOUBLE))"
    return (
        f"sp_cnt AS (SELECT churn, COUNT(*) AS n_c FROM {src} GROUP BY churn)",
        f"sp_tot AS (SELECT CAST(SUM(n_c) AS DOUBLE) AS n, {n_test} AS n_test FROM sp_cnt)",
        "sp_b AS (SELECT churn, n_c, FLOOR(n_c * n_test / n) AS base, "
        "n_c * n_test / n - FLOOR(n_c * n_test / n) AS frac, n_test FROM sp_cnt CROSS JOIN sp_tot)",
        "sp_k AS (SELECT churn, base + CASE WHEN ROW_NUMBER() OVER (ORDER BY frac DESC, churn) "
        "<= n_test - SUM(base) OVER () THEN 1 ELSE 0 END AS k_c FROM sp_b)",
        f"split AS (SELECT s.* EXCLUDE (rn, k_c), CASE WHEN rn <= k_c THEN 1 ELSE 0 END AS is_test FROM ("
        f"SELECT x.*, k.k_c, ROW_NUMBER() OVER (PARTITION BY x.churn ORDER BY md5(CAST(x.cod_cliente AS VARCHAR) || '|{SEED}'), "
        f"x.cod_cliente) AS rn FROM {src} x JOIN sp_k k ON x.churn = k.churn) s)",
    )


def split_spark(spark, sf_dir):
    return prepare.stratified_split(r4_checkpointed(spark, sf_dir), TEST_SHARE, SEED)


def scorer_sql(s: scoring.LinearScorer) -> str:
    z = f"{float(s.intercept)!r}"
    for name, w in s.weights.items():
        z = f"({z} + {float(w)!r} * CAST({name} AS DOUBLE))"
    return f"(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-({z}))))"


def demo_scorer(s: scoring.LinearScorer = scoring.DEMO_SCORER) -> scoring.LinearScorer:
    return scoring.LinearScorer(s.intercept, s.weights, digits=None)


def held_out_spark(spark, sf_dir):
    return split_spark(spark, sf_dir).where(F.col("is_test") == 1)


def eval_frame_spark(spark, sf_dir, s=scoring.DEMO_SCORER, test=None):
    """Scored test rows ``(cod_cliente, y, p)``, checkpointed once: the curve
    and metric operators run several small jobs over them.  ``test`` holds the
    test rows where the caller has them (several scorers on one split)."""
    scored = scoring.batch_score(held_out_spark(spark, sf_dir) if test is None else test, demo_scorer(s))
    return materialize(E.scored_frame(scored, "churn", scoring.RISK, key=["cod_cliente"]))


def eval_ctes(s=scoring.DEMO_SCORER, name: str = "ev") -> tuple[str, ...]:
    return (
        R4_CTE,
        *split_ctes("r4"),
        f"{name} AS (SELECT cod_cliente, CAST(churn AS INTEGER) AS y, {scorer_sql(s)} AS p FROM split WHERE is_test = 1)",
    )


def curve_ctes(ev: str = "ev", pfx: str = "") -> tuple[str, ...]:
    return (
        f"{pfx}sc AS (SELECT p, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg FROM {ev} GROUP BY p)",
        f"{pfx}tot AS (SELECT CAST(SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS P, CAST(SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS N FROM {ev})",
        f"{pfx}cum AS (SELECT p, pos, neg, SUM(pos) OVER (ORDER BY p DESC) AS cum_pos, SUM(neg) OVER (ORDER BY p DESC) AS cum_neg FROM {pfx}sc)",
        f"{pfx}pr AS (SELECT threshold, precision, recall, CASE WHEN precision + recall = 0 THEN NULL "
        f"ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM ("
        f"SELECT p AS threshold, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision, "
        f"CAST(cum_pos AS DOUBLE) / (SELECT P FROM {pfx}tot) AS recall FROM {pfx}cum "
        f"UNION ALL SELECT 1.0, 1.0, 0.0) z)",
        f"{pfx}best AS (SELECT * FROM {pfx}pr WHERE f1 IS NOT NULL ORDER BY f1 DESC, threshold ASC LIMIT 1)",
        f"{pfx}auc AS (SELECT SUM(neg * (2 * cum_pos - pos)) / (2.0 * (SELECT P FROM {pfx}tot) * (SELECT N FROM {pfx}tot)) AS roc_auc FROM {pfx}cum)",
    )


def metrics_select(ev: str = "ev", pfx: str = "") -> str:
    return f"""
SELECT COALESCE(tp / NULLIF(tp + fp, 0), 0) AS precisao, COALESCE(tp / NULLIF(tp + fn, 0), 0) AS recall,
       COALESCE((tp + tn) / NULLIF(n, 0), 0) AS acuracia, COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1,
       (SELECT roc_auc FROM {pfx}auc) AS roc_auc
FROM (SELECT CAST(SUM(CASE WHEN y = 1 AND yp = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
             CAST(SUM(CASE WHEN y = 0 AND yp = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
             CAST(SUM(CASE WHEN y = 1 AND yp = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
             CAST(SUM(CASE WHEN y = 0 AND yp = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
             CAST(COUNT(*) AS DOUBLE) AS n
      FROM (SELECT y, CASE WHEN p >= (SELECT threshold FROM {pfx}best) THEN 1 ELSE 0 END AS yp FROM {ev}) a) m"""


# =========================================================================== profiling


@register(
    "class_stats",
    W(
        *R4_WITH,
        R4_CTE,
        long_cte("lg", "r4", STAT_FEATS),
        select=f"SELECT feature, pos, churn, {rne('quantile_cont(value, 0.5)')} AS mediana, {rne('AVG(value)')} AS media, "
        f"{rne('STDDEV_SAMP(value)')} AS desvio_padrao FROM lg GROUP BY feature, pos, churn",
    ),
)
def q_class_stats(spark, sf_dir):
    return profile.class_stats(r4(spark, sf_dir), STAT_FEATS)


@register(
    "class_balance",
    W(
        *R4_WITH,
        R4_CTE,
        select=f"SELECT churn, qt_clientes, {rne('CAST(qt_clientes AS DOUBLE) / SUM(qt_clientes) OVER () * 100.0')} AS perc_clientes "
        "FROM (SELECT churn, COUNT(*) AS qt_clientes FROM r4 GROUP BY churn) c",
    ),
)
def q_class_balance(spark, sf_dir):
    return profile.class_balance(r4(spark, sf_dir))


ZERO_SQL = W(
    *R4_WITH,
    R4_CTE,
    long_cte("lg", "r4", FEATS, ids=""),
    select=f"SELECT feature, pos, proporcao_zeros, CASE WHEN proporcao_zeros > 0.8 THEN 1 ELSE 0 END AS descartar FROM ("
    f"SELECT feature, pos, {rne('AVG(CASE WHEN value = 0 THEN 1.0 ELSE 0.0 END)')} AS proporcao_zeros FROM lg GROUP BY feature, pos) z",
)


@register("zero_inflation", ZERO_SQL)
def q_zero_inflation(spark, sf_dir):
    return profile.zero_inflation(r4(spark, sf_dir), FEATS)


@register(
    "sort_importance",
    W(*R4_WITH, R4_CTE, long_cte("lg", "r4", FEATS, ids=""),
      select=f"SELECT feature, {rne('AVG(CASE WHEN value = 0 THEN 1.0 ELSE 0.0 END)')} AS proporcao_zeros FROM lg GROUP BY feature ORDER BY 2 DESC"),
)
def q_sort_importance(spark, sf_dir):
    z = profile.zero_inflation(r4(spark, sf_dir), FEATS)
    return z.select("feature", "proporcao_zeros").orderBy(F.col("proporcao_zeros").desc(), F.col("feature"))


def corr_sql_ctes() -> tuple[str, ...]:
    k = len(FEATS)
    aggs = [f"STDDEV_SAMP(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(FEATS)]
    aggs += [
        f"COVAR_SAMP(CAST({FEATS[i]} AS DOUBLE), CAST({FEATS[j]} AS DOUBLE)) AS c{i}_{j}"
        for i in range(k)
        for j in range(i + 1, k)
    ]
    rows = []
    for i in range(k):
        for j in range(k):
            if i == j:
                v = f"CASE WHEN s{i} > 0 THEN 1.0 END"
            else:
                a, b = min(i, j), max(i, j)
                v = f"CASE WHEN s{a} > 0 AND s{b} > 0 THEN c{a}_{b} / (s{a} * s{b}) END"
            rows.append(f"SELECT '{FEATS[i]}' AS x, '{FEATS[j]}' AS y, {i} AS pos_x, {j} AS pos_y, CAST({v} AS DOUBLE) AS value FROM cagg")
    return (R4_CTE, f"cagg AS (SELECT {', '.join(aggs)} FROM r4)", "cm AS (" + " UNION ALL ".join(rows) + ")")


CORR = corr_sql_ctes()


def _corr(spark, sf_dir):
    return profile.corr_matrix(r4_checkpointed(spark, sf_dir), FEATS)


@register("corr_matrix", W(*R4_WITH, *CORR, select="SELECT * FROM cm"))
def q_corr_matrix(spark, sf_dir):
    return rounded(_corr(spark, sf_dir))


DROP_SQL = "SELECT y AS feature, pos_y AS pos, MAX(ABS(value)) AS max_abs_corr FROM cm WHERE pos_x < pos_y AND ABS(value) >= 0.75 GROUP BY y, pos_y"


@register("corr_drop_list", W(*R4_WITH, *CORR, select=DROP_SQL))
def q_corr_drop_list(spark, sf_dir):
    return rounded(profile.corr_drop_list(_corr(spark, sf_dir)))


EDGES_SQL = (
    "SELECT DISTINCT LEAST(x, y) AS source, GREATEST(x, y) AS target, value FROM cm "
    "WHERE (value <= -0.75 OR value >= 0.75) AND ROUND(value, 12) <> 1.0 AND x <> y"
)


@register("corr_edges", W(*R4_WITH, *CORR, select=f"SELECT source, target, ROUND(value, 6) AS value FROM ({EDGES_SQL}) e"))
def q_corr_edges(spark, sf_dir):
    return rounded(profile.corr_edges(_corr(spark, sf_dir)))


@register(
    "corr_node_degree",
    W(*R4_WITH, *CORR, select=f"SELECT node, COUNT(*) AS grau FROM (SELECT source AS node FROM ({EDGES_SQL}) a "
      f"UNION ALL SELECT target FROM ({EDGES_SQL}) b) n GROUP BY node"),
)
def q_corr_node_degree(spark, sf_dir):
    return profile.node_degree(profile.corr_edges(_corr(spark, sf_dir)))


@register(
    "distinct_count_gate",
    W(*R4_WITH, R4_CTE, long_cte("lg", "r4", FEATS, ids=""),
      select="SELECT feature, pos, COUNT(DISTINCT value) AS n_distintos, CASE WHEN COUNT(DISTINCT value) > 2 THEN 1 ELSE 0 END AS analisar FROM lg GROUP BY feature, pos"),
)
def q_distinct_count_gate(spark, sf_dir):
    return profile.distinct_counts(r4(spark, sf_dir), FEATS)


@register(
    "iqr_outliers",
    W(
        *R4_WITH,
        R4_CTE,
        long_cte("lg", "r4", FEATS, ids=""),
        "lim AS (SELECT feature, pos, n, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS limite_inferior, q3 + 1.5 * (q3 - q1) AS limite_superior "
        "FROM (SELECT feature, pos, COUNT(*) AS n, COUNT(DISTINCT value) AS nd, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 "
        "FROM lg GROUP BY feature, pos) q WHERE nd > 2)",
        select="SELECT l.feature, l.pos, l.q1, l.q3, l.limite_inferior, l.limite_superior, c.qt_outliers, "
        "c.qt_outliers / CAST(l.n AS DOUBLE) * 100.0 AS perc_outliers, "
        "CASE WHEN c.qt_outliers / CAST(l.n AS DOUBLE) * 100.0 > 5.0 THEN 1 ELSE 0 END AS critico "
        "FROM lim l JOIN (SELECT g.feature, COUNT(*) FILTER (WHERE g.value < m.limite_inferior OR g.value > m.limite_superior) AS qt_outliers "
        "FROM lg g JOIN lim m ON g.feature = m.feature GROUP BY g.feature) c ON l.feature = c.feature",
    ),
)
def q_iqr_outliers(spark, sf_dir):
    return rounded(profile.iqr_outliers(r4_checkpointed(spark, sf_dir), FEATS))


@register(
    "histogram_density",
    W(
        *R4_WITH,
        R4_CTE,
        long_cte("lg0", "r4", FEATS),
        "lg AS (SELECT * FROM lg0 WHERE value IS NOT NULL)",
        "rg AS (SELECT feature, churn, n, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi "
        "FROM (SELECT feature, churn, MIN(value) AS lo0, MAX(value) AS hi0, COUNT(*) AS n FROM lg GROUP BY feature, churn) r)",
        "hb AS (SELECT g.feature, g.pos, g.churn, CAST(LEAST(FLOOR((g.value - r.lo) * (CAST(500 AS DOUBLE) / (r.hi - r.lo))), 499) AS INTEGER) AS bin, "
        "r.lo, r.hi, r.n FROM lg g JOIN rg r ON g.feature = r.feature AND g.churn = r.churn)",
        select="SELECT feature, pos, churn, bin, lo + bin * ((hi - lo) / CAST(500 AS DOUBLE)) AS inicio, COUNT(*) AS qt, "
        "COUNT(*) / (n * ((hi - lo) / CAST(500 AS DOUBLE))) AS densidade FROM hb GROUP BY feature, pos, churn, bin, lo, hi, n",
    ),
)
def q_histogram_density(spark, sf_dir):
    return rounded(profile.histogram_density(r4_checkpointed(spark, sf_dir), FEATS))


@register(
    "kde_peak",
    W(
        *R4_WITH,
        R4_CTE,
        "kv AS (SELECT churn, CAST(meses_vida_cliente AS DOUBLE) AS v FROM r4 WHERE meses_vida_cliente IS NOT NULL)",
        "ks AS (SELECT churn, COUNT(*) AS n, STDDEV_SAMP(v) * POW(CAST(COUNT(*) AS DOUBLE), -0.2) AS bw FROM kv GROUP BY churn)",
        "kc AS (SELECT churn, v, COUNT(*) AS c FROM kv GROUP BY churn, v)",
        "kg AS (SELECT j, 0.0 + CAST(j AS DOUBLE) * " + repr(120.0 / 999) + " AS x FROM range(0, 1000) t(j))",
        f"kd AS (SELECT c.churn, g.j, g.x, s.n, s.bw, SUM(c.c * EXP(-0.5 * ((g.x - c.v) / s.bw) * ((g.x - c.v) / s.bw))) "
        f"/ (s.n * s.bw * {lit_double(math.sqrt(2 * math.pi))}) AS densidade "
        "FROM kc c JOIN ks s ON c.churn = s.churn CROSS JOIN kg g GROUP BY c.churn, g.j, g.x, s.n, s.bw)",
        select="SELECT churn, n, bw AS bandwidth, x AS pico, densidade AS densidade_pico FROM ("
        "SELECT *, ROW_NUMBER() OVER (PARTITION BY churn ORDER BY densidade DESC, j ASC) AS rn FROM kd) z WHERE rn = 1",
    ),
)
def q_kde_peak(spark, sf_dir):
    return rounded(profile.kde_peak(r4_checkpointed(spark, sf_dir)))


@register(
    "feature_selection",
    W(
        *R4_WITH,
        *CORR,
        long_cte("lg", "r4", FEATS, ids=""),
        f"zz AS (SELECT feature, pos, {rne('AVG(CASE WHEN value = 0 THEN 1.0 ELSE 0.0 END)')} AS proporcao_zeros FROM lg GROUP BY feature, pos)",
        f"dd AS ({DROP_SQL})",
        select="SELECT z.feature, z.pos, z.proporcao_zeros, d.max_abs_corr, "
        "CASE WHEN z.proporcao_zeros > 0.8 AND d.max_abs_corr IS NOT NULL THEN 'zeros+correlacao' WHEN z.proporcao_zeros > 0.8 THEN 'zeros' "
        "WHEN d.max_abs_corr IS NOT NULL THEN 'correlacao' END AS motivo, "
        "CASE WHEN z.proporcao_zeros > 0.8 OR d.max_abs_corr IS NOT NULL THEN 0 ELSE 1 END AS mantida "
        "FROM zz z LEFT JOIN dd d ON z.feature = d.feature",
    ),
)
def q_feature_selection(spark, sf_dir):
    return rounded(profile.feature_selection(r4_checkpointed(spark, sf_dir), FEATS))


# =========================================================================== preparation


@register("stratified_split", W(*R4_WITH, R4_CTE, *split_ctes("r4"), select="SELECT cod_cliente, churn, is_test FROM split"))
def q_stratified_split(spark, sf_dir):
    return split_spark(spark, sf_dir).select("cod_cliente", "churn", "is_test")


def _minmax_sql() -> str:
    fit = ", ".join(f"MIN(CAST({c} AS DOUBLE)) AS mn_{c}, MAX(CAST({c} AS DOUBLE)) AS mx_{c}" for c in FEATS)
    cols = ", ".join(
        f"(CAST(t.{c} AS DOUBLE) - f.mn_{c}) / CASE WHEN f.mx_{c} - f.mn_{c} = 0 THEN 1.0 ELSE f.mx_{c} - f.mn_{c} END AS {c}"
        for c in FEATS
    )
    return W(
        *R4_WITH,
        R4_CTE,
        *split_ctes("r4"),
        f"fit AS (SELECT {fit} FROM split WHERE is_test = 0)",
        select=f"SELECT t.cod_cliente, {cols} FROM split t CROSS JOIN fit f WHERE t.is_test = 1",
    )


@register("minmax_scale", _minmax_sql())
def q_minmax_scale(spark, sf_dir):
    s = split_spark(spark, sf_dir)
    fit = prepare.minmax_fit(s.where(F.col("is_test") == 0), FEATS)
    test = s.where(F.col("is_test") == 1).select("cod_cliente", *FEATS)
    return rounded(prepare.minmax_transform(test, fit))


def _robust_sql() -> str:
    fit = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS md_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25) AS iq_{c}"
        for c in FEATS
    )
    cols = ", ".join(
        f"(CAST(t.{c} AS DOUBLE) - f.md_{c}) / CASE WHEN f.iq_{c} = 0 THEN 1.0 ELSE f.iq_{c} END AS {c}" for c in FEATS
    )
    return W(
        *R4_WITH,
        R4_CTE,
        *split_ctes("r4"),
        f"fit AS (SELECT {fit} FROM split WHERE is_test = 0)",
        select=f"SELECT t.cod_cliente, {cols} FROM split t CROSS JOIN fit f WHERE t.is_test = 1",
    )


@register("robust_scale", _robust_sql())
def q_robust_scale(spark, sf_dir):
    s = split_spark(spark, sf_dir)
    fit = prepare.robust_fit(s.where(F.col("is_test") == 0), FEATS)
    test = s.where(F.col("is_test") == 1).select("cod_cliente", *FEATS)
    return rounded(prepare.robust_transform(test, fit))


@register(
    "class_weight",
    W(
        *R4_WITH,
        R4_CTE,
        select="SELECT cod_cliente, churn, CASE WHEN churn = 1 THEN (SELECT CAST(SUM(churn) AS DOUBLE) / SUM(1 - churn) FROM r4) ELSE 1.0 END AS peso FROM r4",
    ),
)
def q_class_weight(spark, sf_dir):
    from churnlens.operators import models

    df = r4(spark, sf_dir)
    return rounded(models.with_class_weight(df, models.class_weight_ratio(df)).select("cod_cliente", "churn", "peso"))


# =========================================================================== scoring and report

SCORE_SQL = scorer_sql(scoring.DEMO_SCORER)
REPORT_COLS = [c for c in features.BASE_OUTPUT]


def report_select(src: str) -> str:
    cols = []
    for c in REPORT_COLS:
        if c in ("media_dias_exec", "media_dias_exec_reclamacao"):
            cols.append(f"{rne(c, 1)} AS {c}")
        else:
            cols.append(c)
    cols.append(f"{rne('risco_churn_percentual', 2)} AS risco_churn_percentual")
    return f"SELECT {', '.join(cols)} FROM {src}"


SCORED_CTE = f"scored AS (SELECT *, {SCORE_SQL} AS risco_churn_percentual FROM r5)"
REPORT_CTE = f"report AS ({report_select('scored')})"


def seg_sql(col: str) -> str:
    lo, a, b, hi = RISK_EDGES
    return (
        f"CASE WHEN {col} >= {lo} AND {col} <= {a} THEN '{RISK_LABELS[0]}' WHEN {col} > {a} AND {col} <= {b} THEN '{RISK_LABELS[1]}' "
        f"WHEN {col} > {b} AND {col} <= {hi} THEN '{RISK_LABELS[2]}' END"
    )


def seg_rank_sql(col: str) -> str:
    lo, a, b, hi = RISK_EDGES
    return (
        f"CASE WHEN {col} >= {lo} AND {col} <= {a} THEN 0 WHEN {col} > {a} AND {col} <= {b} THEN 1 "
        f"WHEN {col} > {b} AND {col} <= {hi} THEN 2 END"
    )


SEG_CTE = f"seg AS (SELECT *, {seg_sql('risco_churn_percentual')} AS segmento_risco, {seg_rank_sql('risco_churn_percentual')} AS segmento_ordem FROM report)"


def scored_spark(spark, sf_dir):
    return scoring.batch_score(r5(spark, sf_dir), demo_scorer())


def report_spark(spark, sf_dir):
    return scoring.risk_report(scored_spark(spark, sf_dir))


@register("batch_score", W(*R4_WITH, R5_CTE, SCORED_CTE, select="SELECT * FROM scored"))
def q_batch_score(spark, sf_dir):
    return rounded(scored_spark(spark, sf_dir))


@register("risk_report", W(*R4_WITH, R5_CTE, SCORED_CTE, REPORT_CTE, select="SELECT * FROM report"))
def q_risk_report(spark, sf_dir):
    return rounded(report_spark(spark, sf_dir))


@register(
    "sort_risk_desc",
    W(*R4_WITH, R5_CTE, SCORED_CTE, REPORT_CTE, select="SELECT cod_cliente, risco_churn_percentual FROM report ORDER BY 2 DESC, 1"),
)
def q_sort_risk_desc(spark, sf_dir):
    return rounded(report_spark(spark, sf_dir).select("cod_cliente", scoring.RISK))


@register(
    "fn_round",
    W(*R4_WITH, R5_CTE, SCORED_CTE, select=f"SELECT cod_cliente, {rne('risco_churn_percentual', 2)} AS risco FROM scored"),
)
def q_fn_round(spark, sf_dir):
    return scored_spark(spark, sf_dir).select("cod_cliente", X.round_half_even(scoring.RISK, 2).alias("risco"))


@register(
    "fn_cut",
    W(*R4_WITH, R5_CTE, SCORED_CTE, REPORT_CTE, select=f"SELECT cod_cliente, {seg_sql('risco_churn_percentual')} AS segmento_risco FROM report"),
)
def q_fn_cut(spark, sf_dir):
    return report_spark(spark, sf_dir).select("cod_cliente", X.risk_segment(scoring.RISK).alias("segmento_risco"))


@register("risk_segments", W(*R4_WITH, R5_CTE, SCORED_CTE, REPORT_CTE, SEG_CTE, select="SELECT * FROM seg"))
def q_risk_segments(spark, sf_dir):
    return rounded(scoring.risk_segments(report_spark(spark, sf_dir)))


@register(
    "segment_counts",
    W(*R4_WITH, R5_CTE, SCORED_CTE, REPORT_CTE, SEG_CTE,
      select="SELECT segmento_risco, segmento_ordem, COUNT(*) AS qt_clientes FROM seg WHERE segmento_risco IS NOT NULL GROUP BY 1, 2"),
)
def q_segment_counts(spark, sf_dir):
    return scoring.segment_counts(scoring.risk_segments(report_spark(spark, sf_dir)))


MEAN_COLS = [c for c in REPORT_COLS if c != "churn"]


@register(
    "segment_means",
    W(
        *R4_WITH, R5_CTE, SCORED_CTE, REPORT_CTE, SEG_CTE,
        "sm AS (SELECT segmento_risco, segmento_ordem, " + ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS {c}" for c in MEAN_COLS)
        + " FROM seg WHERE segmento_risco IS NOT NULL GROUP BY 1, 2)",
        select=" UNION ALL ".join(f"SELECT segmento_risco, segmento_ordem, '{c}' AS feature, {c} AS media FROM sm" for c in MEAN_COLS),
    ),
)
def q_segment_means(spark, sf_dir):
    return rounded(scoring.segment_means(scoring.risk_segments(report_spark(spark, sf_dir))))


# =========================================================================== evaluation


EV = eval_ctes()
CURVE = curve_ctes()


@register(
    "threshold_predict",
    W(*R4_WITH, *EV, select="SELECT cod_cliente, y, p, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS y_pred FROM ev"),
)
def q_threshold_predict(spark, sf_dir):
    return rounded(E.threshold_predict(eval_frame_spark(spark, sf_dir), 0.5))


@register(
    "confusion_matrix",
    W(*R4_WITH, *EV, *CURVE,
      select="SELECT r.real, r.predito, COUNT(e.y) AS qt FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) r(real, predito) "
      "LEFT JOIN (SELECT y, CASE WHEN p >= (SELECT threshold FROM best) THEN 1 ELSE 0 END AS yp FROM ev) e "
      "ON e.y = r.real AND e.yp = r.predito GROUP BY r.real, r.predito"),
)
def q_confusion_matrix(spark, sf_dir):
    ev = eval_frame_spark(spark, sf_dir)
    t = E.best_f1_threshold(ev).first()["threshold"]
    return E.confusion_matrix(E.threshold_predict(ev, t))


@register("roc_auc", W(*R4_WITH, *EV, *CURVE, select="SELECT roc_auc FROM auc"))
def q_roc_auc(spark, sf_dir):
    return rounded(E.roc_auc(eval_frame_spark(spark, sf_dir)))


@register(
    "roc_curve",
    W(*R4_WITH, *EV, *CURVE,
      select="SELECT p AS threshold, cum_neg / (SELECT N FROM tot) AS fpr, cum_pos / (SELECT P FROM tot) AS tpr FROM cum "
      "UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0"),
)
def q_roc_curve(spark, sf_dir):
    return rounded(E.roc_points(eval_frame_spark(spark, sf_dir)))


@register("pr_curve", W(*R4_WITH, *EV, *CURVE, select="SELECT * FROM pr"))
def q_pr_curve(spark, sf_dir):
    return rounded(E.pr_curve(eval_frame_spark(spark, sf_dir)))


@register("best_f1_threshold", W(*R4_WITH, *EV, *CURVE, select="SELECT * FROM best"))
def q_best_f1_threshold(spark, sf_dir):
    return rounded(E.best_f1_threshold(eval_frame_spark(spark, sf_dir)))


@register("argmax_row", W(*R4_WITH, *EV, *CURVE, select="SELECT threshold, f1 FROM best"))
def q_argmax_row(spark, sf_dir):
    return rounded(E.best_f1_threshold(eval_frame_spark(spark, sf_dir)).select("threshold", "f1"))


@register("class_metrics", W(*R4_WITH, *EV, *CURVE, select=metrics_select()))
def q_class_metrics(spark, sf_dir):
    return rounded(E.model_metrics(eval_frame_spark(spark, sf_dir), None))


def _calibration_sql() -> str:
    b = " + ".join(f"CASE WHEN p > {lit_double(e)} THEN 1 ELSE 0 END" for e in E._edges(10))
    return W(*R4_WITH, *EV, select=f"SELECT {b} AS bin, AVG(p) AS prob_pred, AVG(CAST(y AS DOUBLE)) AS prob_true, COUNT(*) AS n FROM ev GROUP BY 1")


@register("calibration", _calibration_sql())
def q_calibration(spark, sf_dir):
    return rounded(E.calibration(eval_frame_spark(spark, sf_dir)))


def _comparison_sql() -> str:
    ev2 = eval_ctes(scoring.DEMO_SCORER_REDUCED, name="ev2")[-1]
    c2 = curve_ctes("ev2", "b_")
    labels = dict(E.METRIC_NAMES)
    parts = []
    for model, pfx, ev in (("completo", "", "ev"), ("reduzido", "b_", "ev2")):
        for col, lbl in labels.items():
            parts.append(f"SELECT '{model}' AS modelo, '{lbl}' AS metrica, {col} AS valor FROM ({metrics_select(ev, pfx)}) m_{pfx or 'a_'}{col}")
    return W(*R4_WITH, *EV, ev2, *CURVE, *c2, select=" UNION ALL ".join(parts))


@register("metric_comparison", _comparison_sql())
def q_metric_comparison(spark, sf_dir):
    test = materialize(held_out_spark(spark, sf_dir))  # both scorers rate one split
    full = eval_frame_spark(spark, sf_dir, test=test)
    reduced = eval_frame_spark(spark, sf_dir, scoring.DEMO_SCORER_REDUCED, test)
    return rounded(E.metric_comparison({"completo": full, "reduzido": reduced}))
