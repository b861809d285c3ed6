"""Registry of named queries: key -> (spark, sf_dir) -> DataFrame, and key -> oracle SQL.

Every query reads the driver's tables at ``sf_dir`` (through the role views)
and runs over the whole tables.  Doubles computed by floating-point
aggregates are rounded to 6 digits in the registered form only, so that the
oracle comparison does not depend on summation order; the library functions
return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.plans import customer, customer_product, oracle
from churnlens.plans.oracle_round import round_doubles
from churnlens.rules import DRIVER_RULES
from churnlens.sources.roles import driver_roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

R = DRIVER_RULES


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns (registered form only): ``rint(x * 10^d) / 10^d``,
    the same IEEE operations as the oracle's ``round_even`` wrapper."""
    scale = float(10**digits)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name).cast("double")
            cols.append((F.rint(c * F.lit(scale)) / F.lit(scale)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(key: str, sql: str | None = None):
    """Register a query; every registered DataFrame has its doubles rounded,
    and the oracle SQL gets the same rounding."""

    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"query {key!r} registered twice")

        def run(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
            return rounded(_fn(spark, sf_dir))

        run.__name__ = getattr(fn, "__name__", key)
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE_SQL[key] = round_doubles(sql)
        return fn

    return deco


def roles(spark: SparkSession, sf_dir: str):
    return driver_roles(spark, sf_dir)


# --------------------------------------------------------------------------- R4-R7


@register("customer_features", oracle.customer_features_sql(R))
def q_customer_features(spark, sf_dir):
    return customer.customer_features(roles(spark, sf_dir), R)


@register("customer_features_active", oracle.customer_features_sql(R, active_only=True))
def q_customer_features_active(spark, sf_dir):
    return customer.customer_features(roles(spark, sf_dir), R, active_only=True)


#: The customer that the single-customer forms are asked for (S8, M12); a parameter of the query.
ONE_CUSTOMER = 3


@register("param_query", f"SELECT * FROM ({oracle.customer_features_sql(R)}) q WHERE cod_cliente = {ONE_CUSTOMER}")
def q_param_query(spark, sf_dir):
    return customer.customer_features(roles(spark, sf_dir), R, customer_id=ONE_CUSTOMER)


@register("customer_product_features", oracle.customer_product_features_sql(R))
def q_customer_product_features(spark, sf_dir):
    return customer_product.customer_product_features(roles(spark, sf_dir), R)


#: A customer with product groups (S8 of the product-group query).
ONE_PRODUCT_CUSTOMER = 9


@register("param_query_product", f"SELECT * FROM ({oracle.customer_product_features_sql(R)}) q WHERE cod_cliente = {ONE_PRODUCT_CUSTOMER}")
def q_param_query_product(spark, sf_dir):
    return customer_product.customer_product_features(roles(spark, sf_dir), R, customer_id=ONE_PRODUCT_CUSTOMER)


@register("customer_product_features_active", oracle.customer_product_features_sql(R, active_only=True))
def q_customer_product_features_active(spark, sf_dir):
    return customer_product.customer_product_features(roles(spark, sf_dir), R, active_only=True)
