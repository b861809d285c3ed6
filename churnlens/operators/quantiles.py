"""Exact quantiles by distributed rank selection.

``percentile`` gathers all distinct values of a group in one task.  Here no task
holds more of a group than a bounded piece:

1. the values of every group are counted (one shuffle by group and value, with
   partial counts in front, so a frequent value costs nothing);
2. the range of a group is cut into ``BUCKETS`` equal parts and the parts are
   counted; running totals over the parts (at most ``BUCKETS`` rows a group)
   tell which part holds a rank;
3. that part alone is cut again, between its least and its largest value, until
   it holds at most ``BUCKETS`` distinct values, which one window then orders.
   The ends of a part always fall into different parts of the next cut, so
   every cut shrinks it.

The values at the ranks on either side of a quantile are interpolated as pandas
and SQL's ``quantile_cont`` do.  NULL and NaN are left out.  Infinite values
have ranks like any other; a quantile between an infinite and a finite value is
what floating point gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import written

#: Parts of one cut, and the distinct values that a window may order for a rank.
BUCKETS = 4096


def value_counts(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """``(keys..., value, c)``, written once: every profile of the values reads it."""
    return written(long.groupBy(*keys, F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("c")), "value-counts")


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _bucket(buckets: int) -> Column:
    """The part of [lo, hi] that holds the value; halves keep the range finite, and the infinite ends go to the outer parts."""
    lo, hi, v = F.col("lo") / 2, F.col("hi") / 2, F.col("value") / 2
    inside = F.least(F.lit(buckets - 2), F.greatest(F.lit(1), 1 + F.floor((v - lo) / (hi - lo) * F.lit(float(buckets - 2)))))
    return F.when(F.col("value") <= F.col("lo"), 0).when(F.col("value") >= F.col("hi"), buckets - 1).when(F.isnan((v - lo) / (hi - lo)), 1).otherwise(inside).cast("int")


def exact_quantiles(counts: DataFrame, keys: Sequence[str], probs: Sequence[float], buckets: int = BUCKETS) -> DataFrame:
    """``(keys..., n, q array<double>)``: the quantiles ``probs`` of every group of ``counts`` (see ``value_counts``).

    ``keys`` names at least one column; a group without values has no row.
    Tables of one row a group and rank are written between the cuts; only
    whether a cut is left reaches the driver.
    """
    keys = list(keys)
    real = counts.where(F.col("value").isNotNull() & ~F.isnan("value"))
    spans = real.groupBy(*keys).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    at = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    wanted = spans.select("*", F.explode(at).alias("w")).withColumn("place", F.col("w.p") * (F.col("n") - 1))
    wanted = wanted.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))))
    wanted = written(wanted.select(*keys, "n", "lo", "hi", "d", F.col("w.i").alias("i"), "place", "rank"), "quantile-ranks")
    left = wanted.select(*keys, "lo", "hi", "d", F.lit(0).cast("long").alias("before"), "rank").distinct()

    found = None
    while True:
        # a part with few values is ordered as it is
        small = left.where(F.col("d") <= buckets)
        rows = _inside(real, small, keys)
        order = Window.partitionBy(*keys, "rank").orderBy("value")
        upto = rows.withColumn("upto", F.col("before") + F.sum("c").over(order))
        hit = upto.where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("c") <= F.col("rank"))).select(*keys, "rank", "value")
        found = written(hit, "quantile-found") if found is None else found.unionByName(written(hit, "quantile-found"))
        large = left.where(F.col("d") > buckets)
        if large.isEmpty():
            break
        cut = _inside(real, large.select(*keys, "lo", "hi", "before").distinct(), keys).withColumn("b", _bucket(buckets))
        parts = cut.groupBy(*keys, "lo", "hi", "before", "b").agg(
            F.sum("c").alias("c"), F.count(F.lit(1)).alias("parts"), F.min("value").alias("least"), F.max("value").alias("most")
        )
        order = Window.partitionBy(*keys, "lo", "hi", "before").orderBy("b")
        parts = parts.withColumn("upto", F.col("before") + F.sum("c").over(order))
        ask = large.select(*[F.col(k).alias(f"k_{k}") for k in keys], F.col("lo").alias("k_lo"), F.col("hi").alias("k_hi"), F.col("before").alias("k_before"), "rank")
        on = _all([F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in [*keys, "lo", "hi", "before"]])
        holds = (F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("c") <= F.col("rank"))
        left = parts.join(F.broadcast(ask), on & holds).select(
            *keys, F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("parts").alias("d"), (F.col("upto") - F.col("c")).alias("before"), "rank"
        )
        left = written(left, "quantile-parts")

    names = [F.col(k).alias(f"k_{k}") for k in keys]
    on = _all([F.col("rank") == F.col("k_rank"), *[F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys]])
    at_rank = wanted.join(F.broadcast(found.select(*names, F.col("rank").alias("k_rank"), "value")), on)
    ends = at_rank.groupBy(*keys, "n", "i", "place").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    share = F.col("place") - F.floor("place")
    q = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * share)
    one = ends.select(*keys, "n", F.struct("i", q.alias("q")).alias("s"))
    return one.groupBy(*keys, "n").agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["q"]).alias("q"))


def _inside(real: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The counted values that lie in a part; there is one part a group and rank, so they are broadcast."""
    named = parts.select(*[F.col(c).alias(f"k_{c}") if c in keys else F.col(c) for c in parts.columns])
    on = _all([F.col("value").between(F.col("lo"), F.col("hi")), *[F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys]])
    return real.join(F.broadcast(named), on).drop(*[f"k_{k}" for k in keys])
