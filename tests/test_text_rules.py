"""Accent-insensitive comparison, the parameter of the product-group query, the status join."""

from pyspark.sql import functions as F
from role_cases import SF0001

from churnlens import functions as X
from churnlens.operators import contracts, tasks
from churnlens.plans import customer_product
from churnlens.rules import DRIVER_RULES
from churnlens.sources.roles import driver_roles


def test_like_takes_neither_case_nor_accents(spark):
    df = spark.createDataFrame([("NÃO CONSTA",), ("nao consta",), ("Não",), ("não há",), ("sim",), ("",), (None,)], "t string")
    got = lambda p: [r[0] for r in df.select(X.like_ci("t", p)).collect()]
    assert got("%nao%") == [True, True, True, True, False, False, None]
    assert got("%NÃO") == [False, False, True, False, False, False, None]
    assert got("nao%") == [True, True, True, True, False, False, None]
    assert got("Nao") == [False, False, True, False, False, False, None]
    assert got("n_o%") == [True, True, True, True, False, False, None]


def test_product_text_finds_its_code(spark):
    df = spark.createDataFrame([("Cobrança",), ("COBRANCA plus",), ("outro",)], "g string")
    assert [r[0] for r in df.select(X.product_code("g", [("cobranca", 7)])).collect()] == [7, 7, None]


def test_return_and_product_texts_with_accents(spark):
    df = spark.createDataFrame([(1, "espera RETÓRNO"), (2, "feito")], "k int, descr_status string")
    assert [r.k for r in df.where(~X.like_ci("descr_status", "%retorno%")).collect()] == [2]


def test_product_query_for_one_customer(spark):
    roles = driver_roles(spark, SF0001)
    whole = customer_product.customer_product_features(roles, DRIVER_RULES)
    some = sorted({r["cod_cliente"] for r in whole.select("cod_cliente").collect()})[:3]
    for c in some:
        one = customer_product.customer_product_features(roles, DRIVER_RULES, customer_id=c)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, whole.where(F.col("cod_cliente") == c).collect()))
    for part in (contracts.contract_products(roles, DRIVER_RULES, customer_id=some[0]), tasks.product_tasks(roles, DRIVER_RULES, some[0])):
        pushed = [line for line in part._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line]
        assert any(f"EqualTo(o_custkey,{some[0]})" in line for line in pushed), pushed


def test_status_join_follows_the_size(spark):
    task = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "nros long, stos string")
    status = spark.createDataFrame([("A", "X", "done")], "cod string, sto string, descr string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = tasks.join_task_status(task, status)
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.nros, r.sto) for r in joined.collect()) == [(1, "X"), (2, None), (3, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
