"""S3 the feature export as ``;``-separated text with decimal commas.

Reading keeps every column as text first (no schema inference pass over the
data), then converts columns whose names match the patterns with
``replace(',', '.')`` + ``try_cast`` (X22); other columns get the given types.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import functions as X

DECIMAL_PATTERNS = ("perc", "score", "valor", "media")


def write_decimal_comma_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` with ``;`` separators; decimal numbers use a comma."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(F.replace(F.col(f.name).cast("string"), F.lit("."), F.lit(",")).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    df.select(*cols).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def read_decimal_comma_csv(
    spark: SparkSession,
    path: str,
    patterns: Iterable[str] = DECIMAL_PATTERNS,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read the export back: pattern columns -> double, others -> ``types`` (else text)."""
    raw = spark.read.option("sep", ";").option("header", True).option("inferSchema", False).csv(path)
    pats = list(patterns)
    types = dict(types or {})
    cols = []
    for c in raw.columns:
        if any(re.search(p, c) for p in pats):
            cols.append(X.decimal_comma_to_double(c).alias(c))
        elif c in types:
            cols.append(F.col(c).try_cast(types[c]).alias(c))
        else:
            cols.append(F.col(c))
    return raw.select(*cols)


def decimal_comma_rejects(spark: SparkSession, path: str, patterns: Iterable[str] = DECIMAL_PATTERNS) -> DataFrame:
    """Per pattern column: non-empty text values that do not convert (one row).

    Conversion failures become NULL and are counted here instead of failing
    the read or dropping rows."""
    raw = spark.read.option("sep", ";").option("header", True).csv(path)
    pats = list(patterns)
    cols = [c for c in raw.columns if any(re.search(p, c) for p in pats)]
    return raw.agg(
        *[
            F.count_if(
                F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & X.decimal_comma_to_double(c).isNull()
            ).alias(c)
            for c in cols
        ]
    )
