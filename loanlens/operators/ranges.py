"""Ordered work in parallel: cut a sorted axis into ranges of similar size.

A running sum over one sorted group would run in one task.  Here the axis is
cut at approximate percentiles of all values, the running sum is taken within
each range, and range totals (few rows) give the offsets.  Any cuts give the
exact result; they only decide how even the work is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_RANGES = 64
SKETCH_GROUPS = 64


def ranges_for(df: DataFrame) -> int:
    """As many ranges as shuffle partitions, and at least a few."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, MIN_RANGES)


def _cuts(df: DataFrame, value: str, ranges: int) -> DataFrame:
    """Approximate percentiles, merged in two steps.

    The sketches of the map tasks first meet in ``SKETCH_GROUPS`` tasks; the one
    task after them sees only the groups' percentiles, however many map tasks
    there were.
    """
    probabilities = [i / ranges for i in range(1, ranges)]
    sketch = lambda v: F.percentile_approx(v, probabilities, 4 * ranges)
    grouped = df.select(
        F.col(value).alias("_v"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g")
    )
    parts = grouped.groupBy("_g").agg(sketch("_v").alias("_c"))
    return parts.select(F.explode("_c").alias("_v")).agg(sketch("_v").alias("_cuts"))


def _range_of(value: str, cuts: Column, most: int) -> Column:
    """Number of sorted cuts, ``most`` at most, below the value; 0 without cuts.

    A binary search: the work for a row grows with the logarithm of the cuts.
    """
    steps = [1 << k for k in reversed(range(most.bit_length()))] or [1]

    def further(found: Column, step: Column) -> Column:
        return F.when(F.get(cuts, found + step - 1) < F.col(value), found + step).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def with_range(
    df: DataFrame, value: str, rows: DataFrame, ranges: int | None = None, name: str = "_range"
) -> DataFrame:
    """Adds the range of a value; the cuts are a one-row subquery over ``rows``.

    ``rows`` are ``df`` itself or the rows it was counted from; no range can
    hold more distinct values than rows.
    """
    ranges = ranges_for(df) if ranges is None else ranges
    if ranges <= 1:
        return df.withColumn(name, F.lit(0))
    found = _cuts(rows, value, ranges).scalar()
    placed = _range_of(value, F.col("_found"), ranges - 1)
    return df.select("*", found.alias("_found")).withColumn(name, placed).drop("_found")


def fixed_cuts(df: DataFrame, value: str, ranges: int | None = None) -> list[float]:
    """The cuts as numbers, for plans that use them in more than one place."""
    ranges = ranges_for(df) if ranges is None else ranges
    if ranges <= 1:
        return []
    return sorted(set(_cuts(df, value, ranges).first()[0] or []))


def _as_array(cuts: Sequence[float]) -> Column:
    """The numbers as one literal, which keeps the plan small."""
    if not cuts:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")


def in_fixed_range(value: str, cuts: Sequence[float]) -> Column:
    """The range of a value for cuts known as numbers."""
    return _range_of(value, _as_array(cuts), len(cuts))
