"""Feature preparation (M1-M4; F10-F13).

The stratified split (M1) is exact and needs no window over a whole class:
rows are ordered inside their class by ``md5(key|seed)``; the first ``k_c``
rows of class ``c`` form the test set.  To find them without sorting a class
in one task, rows are put in 65,536 hash buckets, bucket counts give the
bucket where each class crosses ``k_c`` (a table of at most 2 x 65,536 rows),
and a row number is computed only inside that one bucket per class.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.quantiles import exact_quantiles, value_counts

KEY = "cod_cliente"
LABEL = "churn"
#: What stands for a missing value in the trees of Spark ML: less than any value (halfway to one is still finite).
LEAST = -1e300


# --------------------------------------------------------------------------- F10-F13


def columns_matching(df: DataFrame, patterns: Iterable[str]) -> list[str]:
    """F10 column names matching any pattern, in table order (``df.filter(regex=p)``
    per pattern, concatenated; a column matching two patterns is listed once)."""
    out: list[str] = []
    for p in patterns:
        for c in df.columns:
            if re.search(p, c) and c not in out:
                out.append(c)
    return out


def select_by_pattern(df: DataFrame, patterns: Iterable[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *columns_matching(df, patterns))


def feature_columns(df: DataFrame, exclude: Sequence[str] = (KEY, LABEL)) -> list[str]:
    """F11 the feature matrix columns: everything but key and target."""
    return [c for c in df.columns if c not in exclude]


def validate_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """F12 fail with the names of missing model columns, then project in model order."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise KeyError(f"columns required by the model are missing: {missing}")
    return df.select(*features)


def filled_sql(column: str, fill: float) -> str:
    """SQL of a numeric column as double, with ``fill`` for null and NaN."""
    name = column.replace("`", "``")
    return f"coalesce(nanvl(CAST(`{name}` AS DOUBLE), {fill!r}D), {fill!r}D)"


def label_split(df: DataFrame, label_value: int, label: str = LABEL) -> DataFrame:
    """F13 rows of one class."""
    return df.where(F.col(label) == label_value)


# --------------------------------------------------------------------------- M1 stratified split

BUCKET_HEX = 4  # 16**4 = 65,536 buckets


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def hash_bucket(hashed: str) -> Column:
    return F.conv(F.substring(hashed, 1, BUCKET_HEX), 16, 10).cast("int")


def class_test_counts(df: DataFrame, test_share: float, label: str = LABEL) -> DataFrame:
    """Test rows per class: ``ceil(share * n)`` in total, shared out like
    scikit-learn's stratified split (floor of the class share, remaining rows
    to the largest fractional parts, ties to the smaller class label).

    Input and output are tiny (one row per class).
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w_all = Window.partitionBy(F.lit(1))
    total = F.sum("n_c").over(w_all)
    n_test = F.ceil(F.lit(test_share) * total)
    exact = F.col("n_c") * n_test / total
    c = counts.select(label, "n_c", F.floor(exact).alias("base"), (exact - F.floor(exact)).alias("frac"), n_test.alias("n_test"))
    rem = F.col("n_test") - F.sum("base").over(w_all)
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("frac").desc(), F.col(label).asc()))
    return c.select(label, "n_c", (F.col("base") + F.when(rank <= rem, 1).otherwise(0)).cast("long").alias("k_c"))


def stratified_split(
    df: DataFrame,
    test_share: float = 0.10,
    seed: int = 42,
    key: str = KEY,
    label: str = LABEL,
) -> DataFrame:
    """M1 exact stratified split: ``df`` plus ``is_test`` (1 = test, 0 = train).

    Deterministic for a given seed; class shares are kept as in scikit-learn.
    """
    rows = df.withColumn("_h", hash_order(key, seed)).withColumn("_b", hash_bucket("_h"))
    k = class_test_counts(df, test_share, label)
    buckets = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # bucket table: at most (#classes x 65,536) rows, so it is broadcast safely
    bt = (
        buckets.join(F.broadcast(k), label)
        .withColumn("_cum", F.sum("_nb").over(w))
        .withColumn("_before", F.col("_cum") - F.col("_nb"))
        .select(
            label,
            "_b",
            F.when(F.col("_cum") <= F.col("k_c"), F.lit("test"))
            .when(F.col("_before") >= F.col("k_c"), F.lit("train"))
            .otherwise(F.lit("cut"))
            .alias("_side"),
            (F.col("k_c") - F.col("_before")).alias("_need"),
        )
    )
    tagged = rows.join(F.broadcast(bt), [label, "_b"])
    whole = tagged.where(F.col("_side") != "cut").withColumn(
        "is_test", F.when(F.col("_side") == "test", 1).otherwise(0)
    )
    cut = tagged.where(F.col("_side") == "cut")
    rn = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key))
    cut = cut.withColumn("is_test", F.when(rn <= F.col("_need"), 1).otherwise(0))
    out_cols = [*df.columns, "is_test"]
    return whole.select(*out_cols).unionByName(cut.select(*out_cols))


# --------------------------------------------------------------------------- M2/M3 scaling


def minmax_fit(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """M2 fit: per-column (min, max) from one aggregate.

    The result has two numbers per feature, so bringing it to the driver is
    bounded by the feature count, not by the data.
    """
    aggs = []
    for c in columns:
        aggs += [F.min(F.col(c).cast("double")).alias(f"min_{c}"), F.max(F.col(c).cast("double")).alias(f"max_{c}")]
    row = train.agg(*aggs).first()
    return {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in columns}


def minmax_transform(df: DataFrame, fit: dict[str, tuple[float, float]]) -> DataFrame:
    """M2 transform: ``(x - min) / (max - min)``; a constant training column uses
    range 1 (scikit-learn's rule), so it maps to ``x - min``."""
    cols = []
    for c in df.columns:
        if c in fit:
            lo, hi = fit[c]
            rng = 1.0 if (hi is None or lo is None or hi - lo == 0) else hi - lo
            cols.append(((F.col(c).cast("double") - F.lit(lo)) / F.lit(rng)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def robust_fit(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """M3 fit: per-column (median, IQR) with exact interpolated quantiles.

    One row a column reaches the driver; the quantiles come from distributed
    rank selection (``quantiles``)."""
    columns = list(columns)
    long = train.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "feature", "value")
    fit = exact_quantiles(value_counts(long, ["feature"]), ["feature"], [0.25, 0.5, 0.75])
    found = {r["feature"]: r["q"] for r in fit.collect()}
    return {c: (found[c][1], found[c][2] - found[c][0]) if c in found else (None, None) for c in columns}


def robust_transform(df: DataFrame, fit: dict[str, tuple[float, float]]) -> DataFrame:
    """M3 transform: ``(x - median) / IQR``; a zero IQR uses 1 (scikit-learn's rule)."""
    cols = []
    for c in df.columns:
        if c in fit:
            med, iqr = fit[c]
            scale = 1.0 if (iqr is None or iqr == 0 or math.isnan(iqr)) else iqr
            cols.append(((F.col(c).cast("double") - F.lit(med)) / F.lit(scale)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
