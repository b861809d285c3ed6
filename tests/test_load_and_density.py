"""Role schemas with counted rejects, and the kernel density of continuous columns."""

import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation

from churnlens.operators import profile
from churnlens.sources.roles import ROLE_SCHEMAS, table_roles, typed_role


def test_rejects_are_counted_while_reading(spark, tmp_path):
    lines = ["codigo;idcontrato;status;assinatura;cancelamento;vencimento;more", "1;10;3;2020-01-02;0000-00-00;2021-01-02;x", "2;11;four;2020-02-30;;0000-00-00 00:00:00;y", "x;12;4;2020-03-01;2020-04-01;never;z"]
    (tmp_path / "c.csv").write_text("\n".join(lines))
    seen = Observation("contracts")
    roles = table_roles(spark, dict.fromkeys(ROLE_SCHEMAS, str(tmp_path / "c.csv")), "csv", {"contract": seen}, sep=";", header="true")
    frame = roles.contract  # reading the header of the file is a job of its own
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    rows = sorted(frame.collect(), key=lambda r: r["idcontrato"])
    day = dt.date
    assert [tuple(r) for r in rows] == [(1, 10, 3, day(2020, 1, 2), None, day(2021, 1, 2)), (2, 11, None, None, None, None), (None, 12, 4, day(2020, 3, 1), day(2020, 4, 1), None)]
    got = seen.get  # of the same job
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs + 1
    assert {k: v for k, v in got.items() if v} == {"rows": 3, "codigo_rejected": 1, "status_rejected": 1, "assinatura_rejected": 1, "vencimento_rejected": 1, "cancelamento_zero": 1, "vencimento_zero": 1}


def test_overflowing_decimals(spark):
    seen = Observation("items")
    df = spark.createDataFrame([("1", "2", "3", "12.5"), ("1", "2", "123456789012", "1e12"), (None, None, None, None)], "id_contrato string, item string, quantidade string, valor string")
    got = typed_role(df, "item", seen).collect()
    assert [tuple(r) for r in got] == [(1, 2, Decimal(3), Decimal("12.5000")), (1, 2, None, None), (None,) * 4]
    assert seen.get["quantidade_rejected"] == 1 and seen.get["valor_rejected"] == 1 and seen.get["rows"] == 3


def test_typed_tables_stay_as_they_are(spark):
    frame = spark.createDataFrame([(1, 10, 3, dt.date(2020, 1, 1), None, None)], ROLE_SCHEMAS["contract"])
    assert typed_role(frame, "contract").collect() == frame.collect()


def exact_peak(v, lo=0.0, hi=120.0, points=1000):
    h = v.std(ddof=1) * len(v) ** -0.2
    x = lo + np.arange(points) * ((hi - lo) / (points - 1))
    d = np.array([np.exp(-0.5 * ((a - v) / h) ** 2).sum() for a in x]) / (len(v) * h * math.sqrt(2 * math.pi))
    return h, x[d.argmax()], d.max()


@pytest.mark.parametrize("shape", ["smooth", "narrow", "far", "ties"])
def test_density_of_continuous_values(spark, shape):
    rng = np.random.default_rng(21)
    v = {"smooth": rng.gamma(3, 9, 6000), "narrow": 40 + rng.normal(0, 0.01, 3000), "far": np.concatenate([rng.normal(60, 4, 2000), rng.normal(1e5, 10, 50)]), "ties": rng.integers(0, 90, 3000).astype(float)}[shape]
    df = spark.createDataFrame(pd.DataFrame({"churn": 1, "meses_vida_cliente": v}))
    [r] = profile.kde_peak(df).collect()
    h, x, d = exact_peak(v)
    assert r["bandwidth"] == pytest.approx(h) and r["pico"] == pytest.approx(x)
    assert r["densidade_pico"] == pytest.approx(d, rel=1e-6, abs=1e-12)
