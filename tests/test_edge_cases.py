"""Layer 2: hand-made edge cases (FIXTURES.md section 3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from role_cases import d
from churnlens import functions as X
from churnlens.operators import contracts, evaluate as E, features, profile, scoring, tasks
from churnlens.plans import customer, customer_product
from churnlens.rules import reference_rules

R = reference_rules("2024-06-30")


def contract(codigo, cid, status, sig, cancel=None, due=None):
    return (codigo, cid, status, d(sig), d(cancel), d(due))


def task(cli, nros, cad, exe=None, cat=1, sub=1, prio=0, para1=1, stos="FIN", cod_ps=67, sub_no=0):
    return (cli, nros, sub_no, d(cad), d(exe), cat, sub, prio, para1, stos, cod_ps)


# --------------------------------------------------------------------------- contracts


def test_cancel_date_rules(spark):
    rows = [
        contract(1, 10, 4, "2020-01-10", None, "2021-01-10"),
        contract(1, 11, 4, "2020-05-01", "2020-04-01", "2021-05-01"),
        contract(1, 12, 4, "2020-02-01", "2020-02-01", "2021-02-01"),
        contract(1, 13, 3, "2020-02-01", "2020-02-01", "2021-02-01"),
    ]
    from role_cases import ROLE_SCHEMAS

    df = spark.createDataFrame(rows, ROLE_SCHEMAS["contract"])
    got = {r["idcontrato"]: r["c"] for r in df.select("idcontrato", contracts.cancel_date(R).alias("c")).collect()}
    assert got == {10: d("2021-01-10"), 11: d("2021-05-01"), 12: d("2020-02-01"), 13: None}


def test_churn_value_and_missing_items(make_roles):
    roles = make_roles(
        contract=[
            contract(2, 20, 3, "2020-01-01", None, "2021-01-01"),
            contract(2, 21, 4, "2019-01-01", None, "2020-01-01"),
            contract(3, 30, 3, "2020-01-01", None, "2021-01-01"),
            contract(4, 40, 9, "2020-01-01", None, "2021-01-01"),  # out of scope
        ],
        item=[(20, 1, 2, 10.5), (21, 2, 1, 5.0)],
    )
    base = {r["cod_cliente"]: r for r in contracts.customer_base(roles, R).collect()}
    assert set(base) == {2, 3}
    assert base[2]["churn"] == 0 and float(base[2]["valor_contrato"]) == 26.0
    assert base[2]["primeira_assinatura"] == d("2019-01-01")
    assert base[3]["valor_contrato"] is None


def _one_customer_roles(make_roles, tasks_rows, history=(), category=(), user=(), status=()):
    return make_roles(
        contract=[contract(5, 50, 3, "2020-01-01", None, "2021-01-01"), contract(6, 60, 3, "2020-01-01", None, "2021-01-01")],
        item=[(50, 1, 1, 1.0)],
        task=tasks_rows,
        task_history=list(history),
        category=list(category),
        user=list(user),
        status=list(status),
    )


def test_customer_without_tasks_zero_then_dropped(make_roles):
    roles = _one_customer_roles(make_roles, [task(5, 500, "2023-01-01", "2023-01-11")])
    allrows = {r["cod_cliente"]: r for r in customer.customer_features_all(roles, R).collect()}
    assert allrows[6]["qt_tarefas_total"] == 0 and allrows[6]["media_dias_exec"] == 0.0
    assert allrows[6]["perc_qt_tarefas_sd"] == 0.0
    kept = [r["cod_cliente"] for r in customer.customer_features(roles, R).collect()]
    assert kept == [5]


def test_null_end_uses_history_only_for_overall_duration(make_roles):
    roles = _one_customer_roles(
        make_roles,
        [task(5, 501, "2023-01-01", None, para1=7), task(5, 502, "2023-01-01", None, para1=7)],
        history=[(501, d("2023-01-05")), (501, d("2023-01-09"))],
        user=[(7, 3)],
    )
    t = {r["dias_exec_tarefa"] for r in tasks.customer_tasks(roles, R).collect()}
    assert t == {8, None}
    sd = [r["dias_exec_tarefa_sd"] for r in tasks.customer_tasks(roles, R).collect()]
    assert sd == [None, None]


def test_zero_date_text_is_null(spark):
    df = spark.createDataFrame([("0000-00-00",), ("0000-00-00 00:00:00",), ("",), ("2024-02-29",), ("2024-02-29 10:00:00",)], "s string")
    got = [r[0] for r in df.select(X.clean_zero_date("s")).collect()]
    assert got == [None, None, None, d("2024-02-29"), d("2024-02-29")]


def test_status_null_dropped_category_null_kept(make_roles):
    roles = _one_customer_roles(
        make_roles,
        [
            task(5, 510, "2023-01-01", "2023-01-03", stos=None),
            task(5, 511, "2023-01-01", "2023-01-03", cat=None, sub=None),
            task(5, 512, "2023-01-01", "2023-01-03", cat=9, sub=9),
            task(5, 513, "2023-01-01", "2023-01-03", stos="CAN"),
        ],
        category=[(9, "Cancelamento MRR")],
    )
    rows = tasks.customer_tasks(roles, R).collect()
    assert len(rows) == 1 and rows[0]["categoria"] is None


def test_product_query_rules(make_roles):
    """Unmatched status dropped; end before start gives NULL; finished status needed."""
    roles = make_roles(
        contract=[contract(8, 80, 4, "2020-01-01", "2022-06-01", "2021-01-01")],
        item=[(80, 2, 3, 100.0)],
        item_dict=[(2, "CPJ-3C (SMART)")],
        registry=[(8, None, "ACME")],
        task=[
            task(8, 800, "2021-01-01", "2021-01-11", stos="DON"),
            task(8, 801, "2021-02-01", "2021-01-20", stos="DON"),  # end before start
            task(8, 802, "2021-03-01", "2021-03-05", stos="ZZZ"),  # unmatched status
            task(8, 803, "2021-03-01", "2021-03-05", stos="WAI"),  # waiting on the customer
        ],
        status=[("DON", "X", "DONE"), ("WAI", "P", "WAIT RETORNO")],
    )
    t = tasks.product_tasks(roles, R).collect()
    assert [r["nros"] for r in t] == [800]
    out = customer_product.customer_product_features(roles, R).collect()
    assert len(out) == 1
    row = out[0]
    assert row["grupo_produto"] == "CPJ-3C (SMART)" and row["churn"] == 1
    assert row["qt_tarefas_total"] == 1 and row["media_dias_exec"] == 10.0
    assert row["dias_ultima_tarefa"] == (dt.date(2022, 6, 1) - dt.date(2021, 1, 1)).days


def test_end_before_start_negative_in_base_query(make_roles):
    roles = _one_customer_roles(make_roles, [task(5, 520, "2023-01-10", "2023-01-01")])
    assert [r["dias_exec_tarefa"] for r in tasks.customer_tasks(roles, R).collect()] == [-9]


def test_priority_buckets_and_text_match(make_roles):
    roles = _one_customer_roles(
        make_roles,
        [
            task(5, 530, "2023-01-01", "2023-01-02", prio=None, cat=21, sub=22),
            task(5, 531, "2023-01-01", "2023-01-02", prio=5, cat=23, sub=24),
            task(5, 532, "2023-01-01", "2023-01-02", prio=9, cat=1, sub=1),
        ],
        category=[(21, "BUG in module"), (24, "Sistema - Bug"), (22, "other"), (23, "x")],
    )
    f = features.customer_task_features(tasks.customer_tasks(roles, R), R).collect()[0]
    assert f["qt_prioridade_reforco"] == 1
    assert f["qt_prioridade_normal"] == 0 and f["qt_prioridade_maxima"] == 0
    assert f["qt_tarefas_bug"] == 2
    assert f["qt_tarefas_total"] == 3


def test_month_and_day_differences(spark):
    df = spark.createDataFrame(
        [
            (d("2024-01-31"), d("2024-02-29")),
            (d("2024-03-31"), d("2024-02-29")),
            (d("2024-01-15"), d("2024-02-15")),
        ],
        "a date, b date",
    )
    assert [r[0] for r in df.select(X.months_diff("a", "b")).collect()] == [0, -1, 1]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    r = ts.select(X.days_diff_24h("a", "b").alias("h"), X.datediff_days("b", "a").alias("c")).first()
    assert (r["h"], r["c"]) == (0, 1)


def test_greatest_of_null_is_null(spark):
    df = spark.createDataFrame([(None,), (-3,), (4,)], "x int")
    assert [r[0] for r in df.select(X.greatest_strict(F.lit(0), "x")).collect()] == [None, 0, 4]


def test_consolidated_duplicates_not_double_counted(spark):
    from role_cases import ROLE_SCHEMAS

    dup = spark.createDataFrame(
        [contract(9, 90, 4, "2020-01-01", "2020-06-01", "2021-01-01"), contract(9, 90, 4, "2020-01-01", None, "2021-01-01")],
        ROLE_SCHEMAS["contract"],
    )
    con = contracts.consolidated_contracts(dup).collect()
    assert len(con) == 1 and con[0]["con_cancelamento"] == d("2020-06-01")


def test_latest_contract_tie_broken_by_id(make_roles):
    roles = make_roles(
        contract=[
            contract(7, 70, 4, "2020-01-01", "2021-06-01", "2021-01-01"),
            contract(7, 71, 3, "2020-01-01", None, "2021-01-01"),
        ],
        item=[(70, 2, 1, 10.0), (71, 2, 1, 10.0)],
        item_dict=[(2, "CPJ-3C")],
        registry=[(7, "Cliente", "E")],
    )
    rows = contracts.customer_products(roles, R).collect()
    assert len(rows) == 1 and rows[0]["id_contrato"] == 71 and rows[0]["churn"] == 0


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, c double")
    m = {(r["x"], r["y"]): r["value"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "c")] is None and m[("c", "c")] is None
    assert m[("a", "a")] == pytest.approx(1.0) and m[("a", "b")] > 0.99


def test_two_value_column_skipped_by_outlier_check(spark):
    df = spark.createDataFrame([(float(i % 2), float(i)) for i in range(20)] + [(1.0, 1000.0)], "flag double, v double")
    out = {r["feature"]: r for r in profile.iqr_outliers(df, ["flag", "v"]).collect()}
    assert "flag" not in out and out["v"]["qt_outliers"] == 1


def test_decimal_comma_parsing(spark, tmp_path):
    from churnlens.sources import csv as C

    df = spark.createDataFrame([("1,5",), ("",), ("abc",)], "perc_x string")
    got = [r[0] for r in df.select(X.decimal_comma_to_double("perc_x")).collect()]
    assert got == [1.5, None, None]
    path = str(tmp_path / "export")
    spark.createDataFrame([(1, "1,5"), (2, "abc"), (3, "")], "cod_cliente int, perc_x string").write.option("sep", ";").option(
        "header", True
    ).csv(path)
    assert C.decimal_comma_rejects(spark, path).first()["perc_x"] == 1


def test_risk_segments(spark):
    vals = [0.0, 0.30, 0.31, 0.70, 0.71, 1.0, 1.2]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r[0] for r in df.select(X.risk_segment("p")).collect()]
    assert got == ["Saudável", "Saudável", "Atenção", "Atenção", "Crítico", "Crítico", None]


def test_round_half_even_like_pandas(spark):
    df = spark.createDataFrame([(0.125,), (0.545,), (0.575,)], "x double")
    assert [r[0] for r in df.select(X.round_half_even("x", 2)).collect()] == [0.12, 0.55, 0.57]


def test_auc_counts_ties_as_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, p double")
    auc = E.roc_auc(df).first()[0]
    # 1 pair won outright by each extreme point, ties count half
    pos, neg = [0.5, 0.5, 0.9], [0.5, 0.5, 0.1]
    expected = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / 9
    assert auc == pytest.approx(expected)


def test_no_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2), (1, 0.3), (0, 0.1)], "y int, p double")
    m = E.class_metrics(E.threshold_predict(df, 0.9)).first()
    assert m["precisao"] == 0.0 and m["f1"] == 0.0 and m["recall"] == 0.0 and m["acuracia"] == 0.5


def test_calibration_bins(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (1, 1.0), (0, 0.30000000000000004), (1, 0.3)], "y int, p double")
    bins = sorted((r["bin"], r["n"]) for r in E.calibration(df).collect())
    assert bins == [(0, 2), (2, 2), (9, 1)]


def test_missing_model_column_raises(spark):
    df = spark.createDataFrame([(1, 2.0)], "cod_cliente int, a double")
    with pytest.raises(KeyError, match="'b'"):
        scoring.batch_score(df, scoring.LinearScorer(0.0, {"a": 1.0, "b": 2.0}))


def test_best_f1_ignores_zero_over_zero(spark):
    df = spark.createDataFrame([(0, 0.9), (1, 0.5), (1, 0.4), (0, 0.1)], "y int, p double")
    b = E.best_f1_threshold(df).first()
    assert b["threshold"] == 0.4 and b["f1"] == pytest.approx(2 * (2 / 3) * 1 / (2 / 3 + 1))
    assert not math.isnan(b["f1"])


def test_single_customer_parameter(make_roles):
    """The optional customer parameter restricts the customer table; tasks of
    other customers never reach the output."""
    roles = _one_customer_roles(
        make_roles, [task(5, 540, "2023-01-01", "2023-01-04"), task(6, 541, "2023-01-01", "2023-01-09")]
    )
    both = {r["cod_cliente"] for r in customer.customer_features(roles, R).collect()}
    one = customer.customer_features(roles, R, customer_id=6).collect()
    assert both == {5, 6} and [r["cod_cliente"] for r in one] == [6] and one[0]["media_dias_exec"] == 8.0


def test_overflowing_contract_sums_are_counted(make_roles):
    """A4: a sum beyond DECIMAL(10, 2) is NULL, and counted; a customer without items is no reject."""
    day = d("2020-01-01")
    roles = make_roles(
        contract=[(c, 10 * c, R.status_active, day, None, None) for c in (1, 2, 3)],
        item=[(10, 1, 1, "99999999.99"), (20, 1, 2, "50000000.00")],
    )
    value = {r["cod_cliente"]: r["valor_contrato"] for r in contracts.customer_base(roles, R).collect()}
    assert str(value[1]) == "99999999.99" and value[2] is None and value[3] is None
    assert tuple(contracts.value_rejects(roles, R).first()) == (3, 1)
