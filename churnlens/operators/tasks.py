"""Task enrichment (J2-J7, J13; X13-X18; filters F2-F6).

Tasks are the big table.  The builders keep them narrow and avoid
re-shuffling them for lookups:

* the category lookup is used only through two text tests (excluded text,
  "bug" text), so it is reduced to a small *flag table* holding only the
  categories that match either text (one row per code) before the join; AQE
  can then broadcast it instead of shuffling the tasks by category;
* the history lookup is needed only for tasks without an end date: the others
  carry a key that no history row has, in the same pass over the tasks;
* all filters sit before the joins and reach the scan when the role is a table.

The plain lookup joins (descriptions, status, user, product) exist as
operators too (``join_*``), for the single-operator queries and for callers
that want the wide rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import functions as X
from churnlens.rules import Rules
from churnlens.sources.roles import Roles

# --------------------------------------------------------------------------- filters


def main_tasks(task: DataFrame) -> DataFrame:
    """F5 main tasks only (``nros_sub = 0``)."""
    return task.where(F.col("nros_sub") == 0)


def drop_task_status(task: DataFrame, rules: Rules) -> DataFrame:
    """F2 ``stos NOT IN (...)``; a NULL status is dropped too (SQL three-valued logic)."""
    return task.where(~F.col("stos").isin(list(rules.excluded_task_status)))


def drop_categories(task: DataFrame, rules: Rules) -> DataFrame:
    """F2 ``categoria NOT IN (unimportant ...)``; NULL category dropped."""
    return task.where(~X.rule(rules.unimportant_category))


def keep_products(task: DataFrame, rules: Rules) -> DataFrame:
    """F5 ``cod_ps IN (main product codes)``."""
    return task.where(F.col("cod_ps").isin(list(rules.main_product_codes)))


# --------------------------------------------------------------------------- lookups


def latest_history(task_history: DataFrame) -> DataFrame:
    """A6 latest history date per task."""
    return task_history.groupBy("nros").agg(F.max("datafos").alias("data_exe_hist"))


def join_task_history(task: DataFrame, task_history: DataFrame) -> DataFrame:
    """J7 tasks LEFT JOIN (latest history date per task)."""
    return task.join(latest_history(task_history), "nros", "left")


def join_history_where_needed(task: DataFrame, task_history: DataFrame) -> DataFrame:
    """J7, restricted to the tasks that use it: rows with an end date get a NULL
    history date.

    One pass over the tasks: the key holds whether the end date is missing, which
    is true on the history side, so a task with an end date meets nothing, and its
    number beside it keeps such tasks from meeting in one partition.
    """
    latest = latest_history(task_history.where(F.col("nros").isNotNull()))
    latest = latest.select(F.struct(F.lit(True).alias("missing"), F.col("nros").alias("nros")).alias("_h"), "data_exe_hist")
    keyed = task.withColumn("_h", F.struct(F.col("data_exe").isNull().alias("missing"), F.col("nros").alias("nros")))
    return keyed.join(latest, "_h", "left").drop("_h")


def join_user_group(task: DataFrame, user: DataFrame) -> DataFrame:
    """J4 tasks LEFT JOIN user -> work group."""
    u = user.select(F.col("cod_usu").alias("para1"), F.col("grupo_trabalho"))
    return task.join(u, "para1", "left")


def join_category_twice(task: DataFrame, category: DataFrame) -> DataFrame:
    """J5 the category lookup in two roles: category and subcategory text."""
    c1 = category.select(F.col("st").alias("categoria"), F.col("dst").alias("descr_categoria"))
    c2 = category.select(F.col("st").alias("subcategoria"), F.col("dst").alias("descr_subcategoria"))
    return task.join(c1, "categoria", "left").join(c2, "subcategoria", "left")


def join_task_status(task: DataFrame, status: DataFrame) -> DataFrame:
    """J3 tasks LEFT JOIN status codes.  Spark broadcasts the code table where its
    size allows; a table that a user maps to the role may have any size."""
    s = status.select(F.col("cod").alias("stos"), F.col("sto"), F.col("descr").alias("descr_status"))
    return task.join(s, "stos", "left")


def join_product_lookup(task: DataFrame, product: DataFrame) -> DataFrame:
    """J6 tasks LEFT JOIN product codes.  No output column comes from it; the
    product side is made unique first, so the join never changes the rows."""
    p = product.select("cod_ps").distinct().withColumn("product_known", F.lit(1))
    return task.join(p, "cod_ps", "left")


def category_flags(category: DataFrame, rules: Rules, prefix: str) -> DataFrame:
    """Category codes whose text matches the excluded word or the bug word.

    One row per code (``max`` over duplicates), only matching codes: a small
    table, whatever the size of the category lookup.
    """
    excluded = X.contains_ci("dst", rules.excluded_text)
    bug = X.contains_ci("dst", rules.bug_text)
    return (
        category.where(excluded | bug)
        .groupBy(F.col("st").alias(prefix))
        .agg(
            F.max(excluded).alias(f"{prefix}_excluded"),
            F.max(bug).alias(f"{prefix}_bug"),
        )
    )


def with_category_flags(task: DataFrame, category: DataFrame, rules: Rules) -> DataFrame:
    """Tasks with ``is_excluded_text`` and ``is_bug`` from both category roles.

    Same truth values as ``LOWER(COALESCE(dst, '')) LIKE '%w%'`` on either
    description: an unmatched code gives false.
    """
    f1 = category_flags(category, rules, "categoria")
    f2 = category_flags(category, rules, "subcategoria")
    j = task.join(f1, "categoria", "left").join(f2, "subcategoria", "left")
    no = F.lit(False)
    return j.select(
        *[F.col(c) for c in task.columns],
        (F.coalesce("categoria_excluded", no) | F.coalesce("subcategoria_excluded", no)).alias(
            "is_excluded_text"
        ),
        (F.coalesce("categoria_bug", no) | F.coalesce("subcategoria_bug", no)).alias("is_bug"),
    )


# --------------------------------------------------------------------------- enriched task rows


def duration_columns(rules: Rules, finished: "F.Column | None" = None, guarded: bool = False) -> list:
    """X13-X15 durations of one task.

    Base query (``guarded=False``): overall days with the history fallback;
    the five conditional durations need an end date.  Product-group query
    (``guarded=True``): overall days only when end >= start (calendar days);
    the conditional durations need a finished status instead.
    """
    if guarded:
        total = X.guarded_datediff("data_exe", "data_cad")
        cond_ok = finished
        diff = X.datediff_days("data_exe", "data_cad")
    else:
        total = X.fallback_duration("data_cad", "data_exe", "data_exe_hist")
        cond_ok = F.col("data_exe").isNotNull()
        diff = X.days_diff_24h("data_cad", "data_exe")
    return [
        total.alias("dias_exec_tarefa"),
        X.conditional(X.rule(rules.sd_group) & cond_ok, diff).alias("dias_exec_tarefa_sd"),
        X.conditional(X.rule(rules.hd_group) & cond_ok, diff).alias("dias_exec_tarefa_hd"),
        X.conditional(X.rule(rules.complaint_category) & cond_ok, diff).alias("dias_exec_tarefa_reclamacao"),
        X.conditional(X.rule(rules.reduction_category) & cond_ok, diff).alias("dias_exec_tarefa_reducao"),
        X.conditional(F.col("is_bug") & cond_ok, diff).alias("dias_exec_tarefa_bug"),
    ]


TASK_FEATURE_INPUTS = (
    "categoria",
    "subcategoria",
    "prioridade",
    "grupo_trabalho",
    "is_bug",
)


def customer_tasks(
    roles: Roles,
    rules: Rules,
    history_for_missing_only: bool = True,
    customers: DataFrame | None = None,
    customer_id: int | None = None,
) -> DataFrame:
    """The base query's task CTE, one row per kept main task.

    Columns: cod_cliente, dias_exec_tarefa and the five conditional durations,
    categoria, subcategoria, prioridade, grupo_trabalho, is_bug.  Tasks are not
    restricted to known customers here: the features are per customer and the
    later LEFT JOIN from the customer table drops the others (J2 folded into J8).
    With ``customers`` (``cod_cliente``) or ``customer_id`` the tasks of others
    go before any lookup.
    """
    t = drop_task_status(main_tasks(roles.task), rules).select(
        "cliente", "nros", "data_cad", "data_exe", "categoria", "subcategoria", "prioridade", "para1"
    )
    if customer_id is not None:
        t = t.where(F.col("cliente") == F.lit(customer_id))
    if customers is not None:
        t = t.join(customers.select(F.col("cod_cliente").alias("cliente")), "cliente", "left_semi")
    t = with_category_flags(t, roles.category, rules).where(~F.col("is_excluded_text"))
    if history_for_missing_only:
        t = join_history_where_needed(t, roles.task_history)
    else:
        t = join_task_history(t, roles.task_history)
    t = join_user_group(t, roles.user)
    return t.select(
        F.col("cliente").alias("cod_cliente"),
        *duration_columns(rules),
        *TASK_FEATURE_INPUTS,
    )


def product_tasks(roles: Roles, rules: Rules, customer_id: int | None = None) -> DataFrame:
    """The product-group query's task CTE (filters F2-F6, status join J3).

    Columns: cliente, cod_ps, data_cad, nros, dias_exec_tarefa and the
    conditional durations, categoria, subcategoria, prioridade,
    grupo_trabalho, is_bug.  Rows without a duration are dropped (F6), as the
    feature aggregate does.  With ``customer_id`` (S8) the tasks of others go
    before any lookup.
    """
    t = keep_products(drop_task_status(main_tasks(roles.task), rules), rules)
    t = drop_categories(t, rules).select(
        "cliente", "nros", "cod_ps", "data_cad", "data_exe", "categoria", "subcategoria", "prioridade", "para1", "stos"
    )
    if customer_id is not None:
        t = t.where(F.col("cliente") == F.lit(customer_id))
    t = with_category_flags(t, roles.category, rules).where(~F.col("is_excluded_text"))
    # NOT LIKE on the status text without COALESCE: unmatched or NULL text is dropped
    t = join_task_status(t, roles.status).where(~X.like_ci("descr_status", f"%{rules.return_text}%"))
    t = join_user_group(t, roles.user)
    finished = F.col("sto").isin(list(rules.finished_status))
    out = t.select(
        "cliente",
        "cod_ps",
        "data_cad",
        "nros",
        *duration_columns(rules, finished=finished, guarded=True),
        *TASK_FEATURE_INPUTS,
    )
    return out.where(F.col("cod_ps").isNotNull() & F.col("dias_exec_tarefa").isNotNull())
