"""Kullback-Leibler divergence of two distributions over the same buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aligned_shares(p: DataFrame, q: DataFrame, bucket: str) -> DataFrame:
    """BUCKET, P, Q: shares of the rows of each side; a bucket one side lacks has share 0.

    Both sides are counted per bucket before they meet.
    """

    def shares(df: DataFrame, name: str) -> DataFrame:
        given = df.where(F.col(bucket).isNotNull())
        counts = given.groupBy(F.col(bucket).alias("BUCKET")).agg(F.count("*").alias("_c"))
        total = counts.agg(F.sum("_c")).scalar()
        return counts.select("BUCKET", (F.col("_c").cast("double") / total).alias(name))

    return shares(p, "P").join(shares(q, "Q"), ["BUCKET"], "full").fillna(0.0, ["P", "Q"])


def kl_divergence(
    aligned: DataFrame, p: str = "P", q: str = "Q", groups: Sequence[str] = ()
) -> DataFrame:
    """Sum of p * log2(p / q) as KL; 0 * log 0 is 0, and p > 0 with q = 0 gives NULL."""
    p_share, q_share = F.col(p), F.col(q)
    term = F.when(p_share > 0, p_share * F.log2(F.try_divide(p_share, q_share))).otherwise(F.lit(0.0))
    undefined = F.count_if((p_share > 0) & (q_share == 0)) > 0
    return aligned.groupBy(*groups).agg(
        F.when(~undefined, F.sum(term)).alias("KL")
    )
