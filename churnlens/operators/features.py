"""Feature aggregates and final projections (A7-A13, A17, A18; J8; F7-F9).

One ``groupBy().agg()`` computes every task feature in a single pass: the
counts and averages are partial-aggregated map-side, the three distinct
counts use Spark's distinct-aggregate rewrite (Expand), which spreads one
customer's rows over many tasks by the distinct value, so a customer holding a
third of all tasks does not land in one task.  ``size(collect_set())`` would
hold the whole set of a hot customer in one task, so it is not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens import functions as X
from churnlens.rules import PRIORITY_BUCKETS, Rules

AVG_COLUMNS = (
    ("dias_exec_tarefa", "media_dias_exec"),
    ("dias_exec_tarefa_sd", "media_dias_exec_tarefa_sd"),
    ("dias_exec_tarefa_hd", "media_dias_exec_tarefa_hd"),
    ("dias_exec_tarefa_reclamacao", "media_dias_exec_reclamacao"),
    ("dias_exec_tarefa_reducao", "media_dias_exec_reducao"),
    ("dias_exec_tarefa_bug", "media_dias_exec_bug"),
)

DISTINCT_COLUMNS = (
    ("categoria", "qt_categorias_distintas"),
    ("subcategoria", "qt_subcategorias_distintas"),
    ("grupo_trabalho", "qt_grupos_envolvidos"),
)

GROUP_SETS = ("sd", "hd", "reclamacao", "reducao", "bug")


def count_columns(rules: Rules) -> list[tuple[Column, str]]:
    """A10 conditional counts (group sets, category sets, text match)."""
    return [
        (X.rule(rules.sd_group), "qt_tarefas_sd"),
        (X.rule(rules.hd_group), "qt_tarefas_hd"),
        (X.rule(rules.complaint_category), "qt_tarefas_reclamacao"),
        (X.rule(rules.reduction_category), "qt_tarefas_reducao"),
        (F.col("is_bug"), "qt_tarefas_bug"),
    ]


def priority_columns() -> list[tuple[Column, str]]:
    """A11 counts per priority bucket; values outside every bucket (or NULL) count nowhere."""
    return [(X.rule(pred), f"qt_prioridade_{name}") for name, pred in PRIORITY_BUCKETS]


def task_aggregates(rules: Rules, with_ratio: bool = True, with_last_task: bool = False) -> list[Column]:
    """A7-A12 (+A17) as a list of aggregate expressions."""
    aggs = [F.count(F.lit(1)).alias("qt_tarefas_total")]  # A7
    if with_last_task:
        aggs.append(F.max("data_cad").alias("data_ultima_tarefa_real"))  # A17
    aggs += [F.avg(F.col(src).cast("double")).alias(dst) for src, dst in AVG_COLUMNS]  # A8
    aggs += [F.count_distinct(F.col(src)).alias(dst) for src, dst in DISTINCT_COLUMNS]  # A9
    aggs += [F.count_if(cond).alias(name) for cond, name in count_columns(rules)]  # A10
    aggs += [F.count_if(cond).alias(name) for cond, name in priority_columns()]  # A11
    if with_ratio:  # A12, computed by the reference but never output
        aggs.append(
            X.ratio(F.count_if(X.rule("prioridade = 4")), F.count(F.lit(1))).alias("perc_prioridade_maxima")
        )
    return aggs


def customer_task_features(tasks: DataFrame, rules: Rules, with_ratio: bool = False) -> DataFrame:
    """tb_features of the base query: one row per customer with tasks."""
    return tasks.groupBy("cod_cliente").agg(*task_aggregates(rules, with_ratio=with_ratio))


# --------------------------------------------------------------------------- base query output

BASE_OUTPUT = (
    "cod_cliente",
    "valor_medio_contrato",
    "meses_vida_cliente",
    "qt_tarefas_total",
    "media_dias_exec",
    "qt_tarefas_sd",
    "media_dias_exec_tarefa_sd",
    "perc_qt_tarefas_sd",
    "qt_tarefas_hd",
    "media_dias_exec_tarefa_hd",
    "perc_qt_tarefas_hd",
    "qt_tarefas_reclamacao",
    "media_dias_exec_reclamacao",
    "perc_qt_tarefas_reclamacao",
    "qt_tarefas_reducao",
    "media_dias_exec_reducao",
    "perc_qt_tarefas_reducao",
    "qt_tarefas_bug",
    "media_dias_exec_bug",
    "perc_qt_tarefas_bug",
    "qt_categorias_distintas",
    "qt_subcategorias_distintas",
    "qt_grupos_envolvidos",
    "perc_qt_prioridade_normal",
    "perc_qt_prioridade_parcial",
    "perc_qt_prioridade_urgente",
    "perc_qt_prioridade_maxima",
    "perc_qt_prioridade_reforco",
    "churn",
)

_AVG_NAME = {
    "sd": "media_dias_exec_tarefa_sd",
    "hd": "media_dias_exec_tarefa_hd",
    "reclamacao": "media_dias_exec_reclamacao",
    "reducao": "media_dias_exec_reducao",
    "bug": "media_dias_exec_bug",
}


def zero(c: str) -> Column:
    """F9 ``COALESCE(metric, 0)`` for customers without tasks.

    Built from SQL text: one expression per column instead of one JVM call
    per sub-expression (the projections have dozens of columns)."""
    return F.expr(f"coalesce({c}, 0) AS {c}")


def zero_double(c: str) -> Column:
    """F9 for averages: ``COALESCE(avg, 0)`` as double."""
    return F.expr(f"coalesce({c}, 0.0D) AS {c}")


def share_sql(n: str, total: str = "qt_tarefas_total") -> str:
    """A13 ``COALESCE((n * 1.0 / total) * 100, 0)`` in doubles (same operations
    as ``functions.percent``)."""
    return f"coalesce(try_divide(CAST({n} AS DOUBLE), CAST({total} AS DOUBLE)) * 100.0D, 0.0D)"


def share(n: str, total: str = "qt_tarefas_total") -> Column:
    """A13 ``COALESCE((n * 1.0 / total) * 100, 0)``."""
    return F.expr(share_sql(n, total))


def customer_lifetime_months(rules: Rules) -> Column:
    """Months from the first signature to the cancel date (churned) or ``as_of``."""
    return F.when(
        F.col("churn") == 1, X.months_diff("primeira_assinatura", "data_cancelamento")
    ).otherwise(X.months_diff("primeira_assinatura", X.as_of_date(rules.as_of)))


def base_projection(joined: DataFrame, rules: Rules) -> DataFrame:
    """F9/A13 final projection of the base query (29 columns, in order)."""
    cols = [
        "cod_cliente",
        "valor_contrato AS valor_medio_contrato",
        None,  # months: built from the column helpers below
        "coalesce(qt_tarefas_total, 0) AS qt_tarefas_total",
        "coalesce(media_dias_exec, 0.0D) AS media_dias_exec",
    ]
    for g in GROUP_SETS:
        n = f"qt_tarefas_{g}"
        cols += [
            f"coalesce({n}, 0) AS {n}",
            f"coalesce({_AVG_NAME[g]}, 0.0D) AS {_AVG_NAME[g]}",
            f"{share_sql(n)} AS perc_qt_tarefas_{g}",
        ]
    cols += [f"coalesce({dst}, 0) AS {dst}" for _, dst in DISTINCT_COLUMNS]
    cols += [f"{share_sql('qt_prioridade_' + name)} AS perc_qt_prioridade_{name}" for name, _ in PRIORITY_BUCKETS]
    cols.append("churn")
    exprs = [F.expr(c) if c is not None else customer_lifetime_months(rules).alias("meses_vida_cliente") for c in cols]
    return joined.select(*exprs)


def join_customer_features(customers: DataFrame, features: DataFrame) -> DataFrame:
    """J8 customers LEFT JOIN features: customers without tasks are kept (NULL metrics)."""
    return customers.join(features, "cod_cliente", "left")


def having_positive_duration(df: DataFrame, active_only: bool = False) -> DataFrame:
    """F7 ``HAVING media_dias_exec > 0 [AND churn = 0]`` on the projected columns."""
    cond = F.col("media_dias_exec") > 0
    if active_only:
        cond = cond & (F.col("churn") == 0)
    return df.where(cond)


# --------------------------------------------------------------------------- product-group output

PRODUCT_OUTPUT = (
    "cod_cliente",
    "data_assinatura",
    "data_cancelamento",
    "meses_vida_contrato",
    "grupo_produto",
    "valor_medio_contrato",
    "media_usuarios",
    "qt_tarefas_total",
    "media_dias_exec",
    "qt_tarefas_sd",
    "media_dias_exec_tarefa_sd",
    "qt_tarefas_hd",
    "media_dias_exec_tarefa_hd",
    "qt_tarefas_reclamacao",
    "media_dias_exec_reclamacao",
    "qt_tarefas_reducao",
    "media_dias_exec_reducao",
    "qt_tarefas_bug",
    "media_dias_exec_bug",
    "dias_ultima_tarefa",
    "qt_categorias_distintas",
    "qt_subcategorias_distintas",
    "qt_grupos_envolvidos",
    "qt_prioridade_normal",
    "qt_prioridade_parcial",
    "qt_prioridade_urgente",
    "qt_prioridade_maxima",
    "qt_prioridade_reforco",
    "churn",
)


def product_task_features(tasks: DataFrame, rules: Rules, with_last_value: bool = False) -> DataFrame:
    """A18 per (customer, product code): A7-A12 and A17.

    With ``with_last_value`` the production form's any-value
    ``dias_exec_tarefa`` is fixed to the latest task's value, ordered by
    (start date, task key, value) so that the pick is total (H1).
    """
    aggs = task_aggregates(rules, with_ratio=True, with_last_task=True)
    if with_last_value:
        aggs.append(
            F.max_by(
                F.col("dias_exec_tarefa"),
                F.struct(F.col("data_cad"), F.col("nros"), F.col("dias_exec_tarefa")),
            ).alias("dias_exec_tarefa")
        )
    return tasks.groupBy("cliente", "cod_ps").agg(*aggs)


def product_projection(joined: DataFrame, rules: Rules, with_last_value: bool = False) -> DataFrame:
    """Final projection of the product-group query (29 columns; 30 in production)."""
    recency = X.recency_days(
        "churn", "data_cancelamento", "data_ultima_tarefa_real", "data_assinatura", rules.as_of
    )
    cols: list[Column] = [
        F.col("cod_cliente"),
        F.col("data_assinatura"),
        F.col("data_cancelamento"),
        F.col("meses_vida_contrato"),
        F.col("grupo_produto"),
        F.col("valor_medio_contrato"),
        F.col("media_usuarios"),
    ]
    if with_last_value:
        cols.append(F.col("dias_exec_tarefa"))
    cols += [zero("qt_tarefas_total"), zero_double("media_dias_exec")]
    for g in GROUP_SETS:
        cols += [zero(f"qt_tarefas_{g}"), zero_double(_AVG_NAME[g])]
    cols.append(recency.alias("dias_ultima_tarefa"))
    cols += [zero(dst) for _, dst in DISTINCT_COLUMNS]
    cols += [zero(f"qt_prioridade_{name}") for name, _ in PRIORITY_BUCKETS]
    cols.append(F.col("churn"))
    return joined.select(*cols)
