"""Customer and contract aggregates (A1-A5, A14-A16; joins J1, J9-J12).

Two grains are built here:

* ``customer_base`` - one row per customer (the base query's customer CTE):
  first signature, cancel date, contract value and the churn target;
* ``contract_products`` and ``customer_products`` - one row per contract and
  one per (customer, product group), for the product-group query.

Scale notes
-----------
Item rows are always aggregated per contract *before* they meet the contract
rows (J1 and the pre-aggregated form of J9), so a contract with a huge number
of items never fans out and the heavy aggregation runs map-side (partial
aggregates are combined before the shuffle).  All later joins are between
tables with one row per key.

Non-deterministic MySQL grouping (H1)
-------------------------------------
The product-group query selects columns that are not grouped; MySQL returns
the value of any row.  We fix one rule per place, each a result MySQL itself
may return:

* a contract's product group is the group of its highest-value item line,
  ties broken by the larger item code (``max_by`` over ``(value, item)``);
* a (customer, product group) row takes status and dates from its latest
  contract, ordered by ``(signature date, contract id)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens import functions as X
from churnlens.rules import Rules
from churnlens.sources.roles import Roles


# --------------------------------------------------------------------------- base query


def item_value_per_contract(item: DataFrame) -> DataFrame:
    """A1 ``SUM(quantidade * valor)`` per contract (exact decimal arithmetic)."""
    return item.groupBy("id_contrato").agg(
        F.sum(F.col("quantidade") * F.col("valor")).alias("valor_total")
    )


def contracts_in_scope(contract: DataFrame, rules: Rules, customer_id: int | None = None) -> DataFrame:
    """F1 contracts that are active or cancelled and have a signature date.

    ``customer_id`` is the query parameter of the reference (S8), off by default.
    """
    out = contract.where(
        F.col("status").isin(rules.status_active, rules.status_cancelled) & F.col("assinatura").isNotNull()
    )
    if customer_id is not None:
        out = out.where(F.col("codigo") == F.lit(customer_id))
    return out


def contracts_with_value(contract: DataFrame, item: DataFrame) -> DataFrame:
    """J1 contracts LEFT JOIN (items summed per contract): no fan-out."""
    values = item_value_per_contract(item)
    return contract.join(values, contract["idcontrato"] == values["id_contrato"], "left").drop("id_contrato")


def cancel_date(rules: Rules) -> Column:
    """A3 cancel date of one contract row (NULL unless cancelled).

    The due date replaces a missing cancel date or one before the signature.
    A NULL comparison falls to the IS NULL branch, as in SQL.
    """
    bad = (F.col("cancelamento") < F.col("assinatura")) | F.col("cancelamento").isNull()
    return F.when(
        F.col("status") == rules.status_cancelled,
        F.when(bad, F.col("vencimento")).otherwise(F.col("cancelamento")),
    )


def cancel_date_coalesce(rules: Rules, cancel: str = "cancelamento", due: str = "vencimento") -> Column:
    """A3b ``CASE WHEN status = 4 THEN DATE(COALESCE(cancel, due)) END``."""
    return F.when(
        F.col("status") == rules.status_cancelled, X.day(F.coalesce(F.col(cancel), F.col(due)))
    )


def churn_flag(rules: Rules) -> Column:
    """A5 aggregate: 1 when the customer has no active contract, else 0."""
    return F.when(F.count_if(F.col("status") == rules.status_active) == 0, F.lit(1)).otherwise(F.lit(0))


def customer_base(roles: Roles, rules: Rules, customer_id: int | None = None) -> DataFrame:
    """The customer CTE: one row per customer.

    Columns: cod_cliente, primeira_assinatura (A2), data_cancelamento (A3),
    valor_contrato decimal(10,2) (A4, NULL without items), churn (A5).
    """
    scoped = contracts_in_scope(roles.contract, rules, customer_id)
    valued = contracts_with_value(scoped, roles.item)
    return valued.groupBy(F.col("codigo").alias("cod_cliente")).agg(
        F.min(X.day("assinatura")).alias("primeira_assinatura"),
        F.max(cancel_date(rules)).alias("data_cancelamento"),
        X.to_decimal(F.sum("valor_total"), 10, 2).alias("valor_contrato"),
        churn_flag(rules).alias("churn"),
    )


def value_rejects(roles: Roles, rules: Rules) -> DataFrame:
    """One row: customers, and those whose contract sum does not fit A4's
    ``DECIMAL(10, 2)`` (``customer_base`` has NULL for them)."""
    valued = contracts_with_value(contracts_in_scope(roles.contract, rules), roles.item)
    total = valued.groupBy("codigo").agg(F.sum("valor_total").alias("total"))
    lost = F.col("total").isNotNull() & X.to_decimal("total", 10, 2).isNull()
    return total.agg(F.count(F.lit(1)).alias("qt_clientes"), F.count_if(lost).alias("qt_rejeitados"))


# --------------------------------------------------------------------------- product-group query


def item_groups(item: DataFrame, item_dict: DataFrame) -> DataFrame:
    """J10 items LEFT JOIN item dictionary: each item line with its raw product group."""
    d = item_dict.select(F.col("codigo").alias("item"), F.col("grupo_produto").alias("grupo_raw"))
    return item.join(d, "item", "left")


def contract_item_summary(item: DataFrame, item_dict: DataFrame, rules: Rules) -> DataFrame:
    """Item lines aggregated per contract before meeting the contract rows.

    valor_contrato (A1), total_usuarios (A15) and the raw product group of the
    highest-value line (H1).
    """
    lines = item_groups(item, item_dict)
    line_value = F.col("quantidade") * F.col("valor")
    return lines.groupBy("id_contrato").agg(
        F.sum(line_value).alias("valor_contrato"),
        F.sum(F.when(X.rule(rules.user_licence_item), F.col("quantidade")).otherwise(F.lit(0))).alias(
            "total_usuarios"
        ),
        F.max_by(F.col("grupo_raw"), F.struct(line_value.alias("v"), F.col("item").alias("i"))).alias(
            "grupo_raw"
        ),
    )


def consolidated_contracts(contract: DataFrame) -> DataFrame:
    """J11 right side: one row per contract id with its cancel date.

    Deduplicated so that a repeated key cannot inflate the sums; when a key
    repeats, the latest non-null cancel date is kept.
    """
    return contract.groupBy(F.col("idcontrato").alias("con_id")).agg(
        F.max("cancelamento").alias("con_cancelamento")
    )


def contract_products(roles: Roles, rules: Rules, having: bool = True, customer_id: int | None = None) -> DataFrame:
    """A14 one row per contract of the product-group query, HAVING applied (F8).

    Columns: cod_cliente, nome_cliente, id_contrato, status, data_assinatura,
    data_cancelamento, grupo_produto, flag_cpj, valor_contrato, total_usuarios.
    """
    cad = roles.contract.where(
        ~F.col("codigo").isin(list(rules.excluded_customers))
        & F.col("status").isin(rules.status_active, rules.status_cancelled)
    )
    if customer_id is not None:
        cad = cad.where(F.col("codigo") == F.lit(customer_id))
    items = contract_item_summary(roles.item, roles.item_dict, rules)
    con = consolidated_contracts(roles.contract)
    com = roles.registry.select(
        F.col("cod_cad"), F.coalesce(F.col("nomecli"), F.col("empresa")).alias("nome_cliente")
    )
    j = (
        cad.join(items, cad["idcontrato"] == items["id_contrato"], "inner")  # J9
        .join(con, cad["idcontrato"] == con["con_id"], "left")  # J11
        .join(com, cad["codigo"] == com["cod_cad"], "inner")  # J12
    )
    grupo = F.coalesce(F.nullif(F.col("grupo_raw"), F.lit("")), F.lit(rules.missing_group_label))
    flag = F.when(X.like_ci("grupo_raw", f"%{rules.product_flag_text}%"), 1).otherwise(0)
    out = j.select(
        F.col("codigo").alias("cod_cliente"),
        F.col("nome_cliente"),
        F.col("idcontrato").alias("id_contrato"),
        F.col("status"),
        X.day("assinatura").alias("data_assinatura"),
        cancel_date_coalesce(rules, "con_cancelamento", "vencimento").alias("data_cancelamento"),
        grupo.alias("grupo_produto"),
        flag.alias("flag_cpj"),
        F.col("valor_contrato"),
        F.col("total_usuarios"),
    )
    if not having:
        return out
    return out.where((F.col("flag_cpj") == 1) & (F.col("valor_contrato") > 0) & (F.col("total_usuarios") > 0))


def customer_products(roles: Roles, rules: Rules, active_only: bool = False, customer_id: int | None = None) -> DataFrame:
    """A16 one row per (customer, product group), HAVING applied (F8).

    Columns: cod_cliente, grupo_produto, cod_gr_produto, id_contrato, status,
    data_assinatura, data_cancelamento, valor_medio_contrato,
    media_usuarios, meses_vida_contrato, churn.
    """
    tpc = contract_products(roles, rules, customer_id=customer_id)
    months = X.months_diff("data_assinatura", F.coalesce(F.col("data_cancelamento"), X.as_of_date(rules.as_of)))
    latest = F.max_by(
        F.struct("id_contrato", "status", "data_assinatura", "data_cancelamento"),
        F.struct("data_assinatura", "id_contrato"),
    )
    g = tpc.groupBy("cod_cliente", "grupo_produto").agg(
        latest.alias("last"),
        F.avg(F.col("valor_contrato")).cast("double").alias("valor_medio_contrato"),
        F.avg(F.col("total_usuarios").cast("double")).alias("media_usuarios"),
        F.avg(months.cast("double")).alias("meses_vida_contrato"),
    )
    out = g.select(
        "cod_cliente",
        "grupo_produto",
        X.product_code("grupo_produto", rules.product_codes).alias("cod_gr_produto"),
        F.col("last.id_contrato").alias("id_contrato"),
        F.col("last.status").alias("status"),
        F.col("last.data_assinatura").alias("data_assinatura"),
        F.col("last.data_cancelamento").alias("data_cancelamento"),
        "valor_medio_contrato",
        "media_usuarios",
        "meses_vida_contrato",
        F.when(F.col("last.status") == rules.status_cancelled, 1).otherwise(0).alias("churn"),
    )
    cond = F.col("meses_vida_contrato") > 0
    if active_only:
        cond = cond & (F.col("churn") == 0)
    return out.where(cond)
