"""Quantiles of many groups at once, exact by counting or approximate by sketch.

Exact: values are counted in buckets of a fixed logarithmic scale, so a group
shuffles a few thousand counts however many values it has.  The counts tell in
which bucket each wanted order statistic lies.  A bucket whose least and
greatest value are the same gives it away; another one is cut into buckets of
equal width over its own span and counted again, round by round, until it holds
few enough values to be looked at.  No value is sorted or shuffled before that.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.session import stored

STEPS_PER_DOUBLING = 64  # of the logarithmic scale
WIDTHS = 1024  # buckets of equal width in a later round
FEW = 20_000  # values of a bucket that are looked at
KLL_K = 400  # rank error about 0.7 %, see ``SKETCH_RANK_ERROR``
SKETCH_RANK_ERROR = 0.01


def _log_bucket(value: Column) -> Column:
    """A bucket that never falls as the value grows."""
    scale = STEPS_PER_DOUBLING / math.log(2.0)
    size = F.least(F.floor(F.log1p(F.abs(value)) * F.lit(scale)), F.lit(1 << 20)).cast("long")
    return F.when(value < 0, -size - 1).otherwise(size)


def _width_bucket(value: Column, low: Column, high: Column) -> Column:
    """One of ``WIDTHS`` buckets between two values of a bucket; they have one sign, so no difference overflows."""
    part = F.floor((value - low) / (high - low) * F.lit(float(WIDTHS)))
    return F.least(part, F.lit(WIDTHS)).cast("long")


def _counted(rows: DataFrame, groups: Sequence[str], bucket: Column) -> DataFrame:
    """Number, least and greatest value of each bucket; one row per bucket leaves each map task."""
    return rows.groupBy(*groups, bucket.alias("_b")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )


def _located(counts: DataFrame, groups: Sequence[str], first: Column, ranks: Column) -> DataFrame:
    """The buckets that hold one of the ranks, with the rank their least value has.

    ``first`` is the rank of the group's least value; a group has at most a few
    thousand buckets.
    """
    until = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_first", first + F.sum("_c").over(until) - F.col("_c"))
    last = F.col("_first") + F.col("_c") - 1
    return ranked.withColumn("_wanted", F.filter(ranks, lambda r: (F.col("_first") <= r) & (r <= last))).where(
        F.size("_wanted") > 0
    )


def _ranks_of(probabilities: Sequence[float], n: int) -> list[int]:
    """The ranks next to every quantile among 0 to n - 1."""
    low = [math.floor((n - 1) * p) for p in probabilities]
    return sorted({r for k in low for r in (k, min(k + 1, n - 1))})


def _interpolated(p: float, n: int, at: dict[int, float]) -> float:
    position = (n - 1) * p
    low = math.floor(position)
    a, b, t = at[low], at[min(low + 1, n - 1)], position - low
    return a + (b - a) * t if t < 0.5 else b - (b - a) * (1.0 - t)


def exact_quantiles(
    long: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float], few: int = FEW
) -> DataFrame:
    """Exact quantiles per group with linear interpolation: (*groups, QUANTILES array, N).

    Rank (n - 1) * p falls between two order statistics.  NULL values do not
    count, and a group without any has no row.  ``long`` is read once for the
    logarithmic counts and once for the values of buckets with at most ``few``;
    a bucket of more is counted once more for each round, and each round cuts
    its span by a factor of 1024.  What comes to the driver is the result's
    size: a few order statistics for each group.
    """
    groups = list(groups)
    spark, fields = long.sparkSession, [long.schema[g] for g in groups]
    rows = long.select(*groups, F.col(value).cast("double").alias("_v")).where("_v is not null")
    counts = stored(_counted(rows, groups, _log_bucket(F.col("_v"))), "quantile_counts")
    sizes = {tuple(r[g] for g in groups): r["_n"] for r in counts.groupBy(*groups).agg(F.sum("_c").alias("_n")).collect()}
    at: dict[tuple, dict[int, float]] = {key: {} for key in sizes}
    if not sizes:
        schema = T.StructType([*fields, T.StructField("QUANTILES", T.ArrayType(T.DoubleType())), T.StructField("N", T.LongType())])
        return spark.createDataFrame([], schema)
    wanted = [(*key, 0, -1, 0.0, 0.0, _ranks_of(probabilities, n)) for key, n in sizes.items()]
    span = T.StructType(
        [
            *fields,
            T.StructField("_start", T.LongType()),
            T.StructField("_size", T.LongType()),
            T.StructField("_from", T.DoubleType()),
            T.StructField("_to", T.DoubleType()),
            T.StructField("_ranks", T.ArrayType(T.LongType())),
        ]
    )
    inside = [*groups, "_start", "_from", "_to"]
    ranks = spark.createDataFrame(wanted, span).select(*groups, "_ranks")
    found = _located(counts.join(F.broadcast(ranks), groups), groups, F.lit(0), F.col("_ranks")).collect()
    while True:
        open_spans = []
        for r in found:
            key, first, last = tuple(r[g] for g in groups), r["_first"], r["_first"] + r["_c"] - 1
            left = []
            for rank in r["_wanted"]:
                if r["_low"] == r["_high"] or rank in (first, last):
                    at[key][rank] = r["_low"] if rank == first or r["_low"] == r["_high"] else r["_high"]
                else:
                    left.append(rank)
            if left:
                open_spans.append((*key, first, r["_c"], r["_low"], r["_high"], left))
        if not open_spans:
            break
        # a few spans for each group, each value in one of them at most
        spans = F.broadcast(spark.createDataFrame(open_spans, span))
        within = rows.join(spans, groups).where("_v >= _from and _v <= _to")
        # of a small span every value is a bucket, numbered by its place among them
        small = within.where(F.col("_size") <= few)
        values = small.groupBy(*inside, "_ranks", F.col("_v").alias("_b")).agg(F.count("*").alias("_c"))
        values = values.withColumn("_low", F.col("_b")).withColumn("_high", F.col("_b"))
        parts = [_located(values, inside, F.col("_start"), F.col("_ranks"))]
        if any(s[len(groups) + 1] > few for s in open_spans):
            large = within.where(F.col("_size") > few)
            bucket = _width_bucket(F.col("_v"), F.col("_from"), F.col("_to"))
            cut = _counted(large, [*inside, "_ranks"], bucket)
            parts.append(_located(cut, inside, F.col("_start"), F.col("_ranks")))
        taken = [*groups, "_first", "_c", "_low", "_high", "_wanted"]
        found = [r for part in parts for r in part.select(*taken).collect()]
    done = [(*key, [_interpolated(p, n, at[key]) for p in probabilities], n) for key, n in sizes.items()]
    schema = T.StructType([*fields, T.StructField("QUANTILES", T.ArrayType(T.DoubleType())), T.StructField("N", T.LongType())])
    return spark.createDataFrame(done, schema)


def sketched_quantiles(
    long: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float], k: int = KLL_K
) -> DataFrame:
    """Approximate quantiles per group from one pass: (*groups, QUANTILES array, N).

    Every map task keeps a KLL sketch for each group, of a few kilobytes, and
    the sketches merge.  The rank of each answer is off by less than
    ``SKETCH_RANK_ERROR`` of the values; the least and the greatest are exact.
    Answers are values of the group, not interpolated ones.  NULL values do not
    count, and a group without any has no row.
    """
    rows = long.select(*groups, F.col(value).cast("double").alias("_v")).where("_v is not null")
    sketched = rows.groupBy(*groups).agg(
        F.kll_sketch_agg_double("_v", F.lit(k)).alias("_s"),
        F.count("*").alias("N"),
        F.min("_v").alias("_low"),
        F.max("_v").alias("_high"),
    )
    inner = [F.kll_sketch_get_quantile_double("_s", F.lit(float(p))) for p in probabilities]
    ends = [
        F.col("_low") if p <= 0 else F.col("_high") if p >= 1 else q for p, q in zip(probabilities, inner)
    ]
    return sketched.select(*groups, F.array(*ends).alias("QUANTILES"), "N")
