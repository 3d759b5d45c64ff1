"""KS table of scores: bads and goods per score bucket, running shares, greatest gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions import percent_text, round_half_even
from loanlens.sources.schemas import OUTCOME_LABEL

# Inner cuts of the score buckets, upper edges belong to the bucket below.
KS_CUTS = (0.0162, 0.026, 0.0392, 0.0532)
KS_SCORES = ("CALIB_PD", "SMS_PD", "TRX_PD", "BR_PD")


def _bucket(value: Column, edges: Sequence[Column]) -> Column:
    """1 for values up to the first edge, len(edges) + 1 above the last; NULL for NULL."""
    bucket = F.when(value.isNull(), F.lit(None).cast("int"))
    for i, edge in enumerate(edges, start=1):
        bucket = bucket.when(value <= edge, F.lit(i))
    return bucket.otherwise(F.lit(len(edges) + 1))


def _equal_width_edges(score: str, buckets: int) -> Column:
    """Inner edges between the least and greatest value, as an aggregate.

    A single value is widened by 0.1 percent.
    """
    low, high = F.min(score).cast("double"), F.max(score).cast("double")
    pad = F.when(low == high, F.when(low == 0, F.lit(0.001)).otherwise(F.abs(low) * 0.001)).otherwise(
        F.lit(0.0)
    )
    start, stop = low - pad, high + pad
    step = (stop - start) / F.lit(float(buckets))
    return F.array(*[F.lit(float(i)) * step + start for i in range(1, buckets)])


def ks_table(
    df: DataFrame,
    scores: Sequence[str] = KS_SCORES,
    label: str = OUTCOME_LABEL,
    buckets: str = "fixed",
    cuts: Sequence[float] = KS_CUTS,
    n_buckets: int = 10,
) -> DataFrame:
    """One row per score, model and bucket, empty buckets included.

    ``buckets="fixed"`` uses the cuts, lists scores upwards and takes goods
    minus bads.  ``"equal_width"`` divides the range of each score over all
    rows, lists downwards and takes bads minus goods.  Rows without a score
    fall in no bucket but count in the totals.  One pass aggregates every
    bucket of every score; the shuffle carries one row per model and score.
    """
    if buckets not in ("fixed", "equal_width"):
        raise ValueError(f"unknown buckets {buckets!r}")
    fixed = buckets == "fixed"
    count = len(cuts) + 1 if fixed else n_buckets
    base = df.select("MODEL_TYPE", F.col(label).alias("_y"), *scores)
    if fixed:
        bucket_of = {s: _bucket(F.col(s), [F.lit(float(c)) for c in cuts]) for s in scores}
    else:
        edges = df.agg(
            F.struct(*[_equal_width_edges(s, n_buckets).alias(s) for s in scores])
        ).scalar()
        base = base.select("*", edges.alias("_edges"))
        bucket_of = {
            s: _bucket(F.col(s), [F.col(f"_edges.{s}")[i] for i in range(n_buckets - 1)])
            for s in scores
        }
    entries = F.array(
        *[
            F.struct(
                F.lit(s).alias("SCORE"),
                F.col(s).cast("double").alias("P"),
                bucket_of[s].alias("B"),
            )
            for s in scores
        ]
    )
    long = base.select("MODEL_TYPE", "_y", F.inline(entries))
    bad, good = F.col("_y"), 1 - F.col("_y")

    def part(i: int) -> Column:
        here = F.col("B") == i
        return F.struct(
            F.lit(i).alias("BUCKET"),
            F.min(F.when(here, F.col("P"))).alias("MIN_PROB"),
            F.max(F.when(here, F.col("P"))).alias("MAX_PROB"),
            F.coalesce(F.sum(F.when(here, bad)), F.lit(0)).alias("BADS"),
            F.coalesce(F.sum(F.when(here, good)), F.lit(0)).alias("GOODS"),
        )

    counted = long.groupBy("SCORE", "MODEL_TYPE").agg(
        F.array(*[part(i) for i in range(1, count + 1)]).alias("_parts"),
        F.sum(bad).alias("_all_bads"),
        F.sum(good).alias("_all_goods"),
    )
    rows = counted.select(
        "SCORE", "MODEL_TYPE", "_all_bads", "_all_goods", F.inline("_parts")
    )
    shares = rows.withColumns(
        {
            "DISTRIBUTION_BADS": F.try_divide(F.col("BADS").cast("double"), F.col("_all_bads")),
            "DISTRIBUTION_GOODS": F.try_divide(F.col("GOODS").cast("double"), F.col("_all_goods")),
        }
    )
    by_score = (
        F.col("MIN_PROB").asc_nulls_last() if fixed else F.col("MIN_PROB").desc_nulls_last()
    )
    listed = Window.partitionBy("SCORE", "MODEL_TYPE").orderBy(by_score, "BUCKET")
    so_far = listed.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = shares.withColumns(
        {
            "DECILE": F.row_number().over(listed),
            "CUM_BADS": F.sum("BADS").over(so_far),
            "CUM_GOODS": F.sum("GOODS").over(so_far),
            "CUM_BADS_SHARE": F.sum("DISTRIBUTION_BADS").over(so_far),
            "CUM_GOODS_SHARE": F.sum("DISTRIBUTION_GOODS").over(so_far),
        }
    )
    gap = F.col("CUM_GOODS_SHARE") - F.col("CUM_BADS_SHARE")
    return running.select(
        F.concat_ws("_", "SCORE", "MODEL_TYPE").alias("PRED_COL"),
        "SCORE", "MODEL_TYPE", "DECILE", "BUCKET", "MIN_PROB", "MAX_PROB", "BADS", "GOODS",
        "DISTRIBUTION_BADS", "DISTRIBUTION_GOODS", "CUM_BADS", "CUM_GOODS",
        "CUM_BADS_SHARE", "CUM_GOODS_SHARE",
        (round_half_even(gap if fixed else -gap, 3) * 100.0).alias("CUM_DIFFERENCE"),
    )


def as_display(table: DataFrame) -> DataFrame:
    """The shares as text with a percent sign."""
    shares = ("DISTRIBUTION_BADS", "DISTRIBUTION_GOODS", "CUM_BADS_SHARE", "CUM_GOODS_SHARE")
    return table.withColumns({c: percent_text(c) for c in shares})


def ks_statistic(table: DataFrame) -> DataFrame:
    """Greatest signed difference per score and model, and the first decile that has it."""
    return table.groupBy("PRED_COL", "SCORE", "MODEL_TYPE").agg(
        F.max("CUM_DIFFERENCE").alias("KS"),
        F.max_by("DECILE", F.struct("CUM_DIFFERENCE", -F.col("DECILE"))).alias("DECILE"),
    )
