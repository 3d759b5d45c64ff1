"""Gini of scores against a 0/1 outcome, overall, by month, and beside another score."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions import month_label
from loanlens.operators.ranges import with_range
from loanlens.session import stored
from loanlens.sources import schemas as S

# Score column and the flag that has to be true for it.
GINI_SCORES: list[tuple[str, str | None]] = [
    ("CALIB_PD", None),
    ("SMS_PD", S.SMS_FLAG),
    ("TRX_PD", S.LEDGER_FLAG),
    ("BR_PD", S.BUREAU_FLAG),
    (S.EXTERNAL_SCORE, None),
]
# Scores whose flag also counts beside the external score.
FLAGGED_BESIDE_EXTERNAL = ("BR_PD",)
DISBURSED_SINCE = "2022-08-01"


def gini(
    df: DataFrame,
    groups: Sequence[str],
    score: str,
    label: str,
    ranges: int | None = None,
) -> DataFrame:
    """BADS, GOODS and GINI = 2 AUC - 1 per group; ties count half.

    Rows are first counted per group and score, so equal scores shrink in the
    map tasks.  Goods below a score are counted within its range and the totals
    of lower ranges added.  NULL when a group holds one class only.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).withColumn(
        "_score", F.col(score)
    )
    return _of_counts(_counted(rows, [*groups, "_score"], label), list(groups), ranges)


def _counted(rows: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    outcome = F.col(label).cast("long")
    return rows.groupBy(*keys).agg(F.sum(outcome).alias("_b"), F.sum(1 - outcome).alias("_g"))


def _of_counts(counts: DataFrame, groups: list[str], ranges: int | None) -> DataFrame:
    """``gini`` from the bads (_b) and goods (_g) per group and _score."""
    return _of_ranges(with_range(counts, "_score", counts, ranges), groups)


def _of_ranges(ranged: DataFrame, groups: list[str], dealt_by: Sequence[str] = ()) -> DataFrame:
    """``_of_counts`` of rows with their _range.

    Rows that are dealt by ``dealt_by`` and the range already, columns that say
    no more than the groups do, stay where they are.
    """
    inside = [*dealt_by, *groups, "_range"]
    below = (
        Window.partitionBy(*inside)
        .orderBy("_score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    goods_below = F.coalesce(F.sum("_g").over(below), F.lit(0))
    per_range = (
        ranged.withColumn("_below", goods_below)
        .groupBy(*inside)
        .agg(
            F.sum(F.col("_b") * (F.col("_below") + F.col("_g") / 2.0)).alias("_area"),
            F.sum("_b").alias("_b"),
            F.sum("_g").alias("_g"),
        )
    )
    lower_ranges = (
        Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    goods_in_lower = F.coalesce(F.sum("_g").over(lower_ranges), F.lit(0))
    total = (
        per_range.withColumn("_lower", goods_in_lower)
        .groupBy(*groups)
        .agg(
            F.sum(F.col("_area") + F.col("_b").cast("double") * F.col("_lower")).alias("_area"),
            F.sum("_b").alias("BADS"),
            F.sum("_g").alias("GOODS"),
        )
    )
    pairs = F.col("BADS").cast("double") * F.col("GOODS")
    auc = F.try_divide(F.col("_area"), pairs)
    return total.select(*groups, "BADS", "GOODS", (2.0 * auc - 1.0).alias("GINI"))


def _eligible(score: str, flag: str | None) -> Column:
    given = F.col(score).isNotNull()
    return given if flag is None else given & F.coalesce(F.col(flag), F.lit(False))


def _metrics(
    since: dt.date | str, scores: Sequence[tuple[str, str | None]], day: str
) -> list[tuple[str, str, bool, Column]]:
    """(output column, score measured, by month, rows that count)."""
    recent = F.coalesce(F.col(day) >= F.lit(dt.date.fromisoformat(str(since))), F.lit(False))
    dated = F.col(day).isNotNull()
    wanted = []
    for score, flag in scores:
        rows = _eligible(score, flag)
        wanted.append((f"{score}_GINI_OVERALL", score, False, rows & recent))
        wanted.append((f"{score}_GINI", score, True, rows & dated))
        if score != S.EXTERNAL_SCORE:
            own = _eligible(score, flag if score in FLAGGED_BESIDE_EXTERNAL else None)
            beside = own & dated & F.col(S.EXTERNAL_SCORE).isNotNull()
            wanted.append((f"{score}_AND_FB_SCORE_GINI", S.EXTERNAL_SCORE, True, beside))
    return wanted


def gini_metrics(
    df: DataFrame,
    since: dt.date | str = DISBURSED_SINCE,
    scores: Sequence[tuple[str, str | None]] = tuple(GINI_SCORES),
    label: str = S.OUTCOME_LABEL,
    day: str = "DISBURSED_DATE",
    ranges: int | None = None,
) -> DataFrame:
    """METRIC, MODEL_TYPE, MONTH_YEAR (NULL for overall), BADS, GOODS, GINI.

    Rows disbursed from ``since`` on count for the overall figures, all rows
    for the monthly ones.  Each row is taken once per score, with a mask of the
    metrics it counts for; rows are counted per score, value, model, month and
    mask.  These counts are stored, since they are read for the cuts and for the
    figures, and dealt once, by score and range: the metrics are made from them
    where they lie.
    """
    specs = _metrics(since, scores, day)
    measured = list(dict.fromkeys(score for _, score, _, _ in specs))

    def entry(number: int, score: str) -> Column:
        mask = F.lit(0)
        for i, (_, of, _, rows) in enumerate(specs):
            if of == score:
                mask = mask.bitwiseOR(F.when(rows, F.lit(1 << i)).otherwise(F.lit(0)))
        return F.struct(
            F.lit(number).alias("_of"), mask.alias("_mask"), F.col(score).cast("double").alias("_score")
        )

    long = (
        df.withColumn("_month", F.trunc(day, "month"))
        .select(
            "MODEL_TYPE",
            "_month",
            F.col(label).alias("_label"),
            F.inline(F.array(*[entry(n, s) for n, s in enumerate(measured)])),
        )
        .where("_mask <> 0 and _label is not null")
    )
    counted = stored(_counted(long, ["_of", "_mask", "MODEL_TYPE", "_month", "_score"], "_label"), "gini_counts")
    metrics = F.array(
        *[
            F.struct(
                F.lit(i).alias("_metric"), F.lit(measured.index(score)).alias("_of"),
                F.lit(1 << i).alias("_bit"), F.lit(monthly).alias("_monthly"),
            )
            for i, (_, score, monthly, _) in enumerate(specs)
        ]
    )
    # one row per metric bounds the broadcast
    table = F.broadcast(df.sparkSession.range(1).select(F.inline(metrics)))
    groups = ["_metric", "MODEL_TYPE", "_month"]
    dealt = with_range(counted, "_score", counted, ranges).repartition("_of", "_range")
    counts = (
        dealt.join(table, ["_of"])
        .where(F.col("_mask").bitwiseAND(F.col("_bit")) != 0)
        .withColumn("_month", F.when(F.col("_monthly"), F.col("_month")))
        .groupBy("_of", "_range", *groups, "_score")
        .agg(F.sum("_b").alias("_b"), F.sum("_g").alias("_g"))
    )
    names = F.array(*[F.lit(metric) for metric, _, _, _ in specs])
    figures = _of_ranges(counts, groups, ["_of"]).withColumn("METRIC", F.get(names, F.col("_metric")))
    return figures.select(
        "METRIC", "MODEL_TYPE", month_label("_month").alias("MONTH_YEAR"), "BADS", "GOODS", "GINI"
    )


def with_gini_columns(
    df: DataFrame,
    since: dt.date | str = DISBURSED_SINCE,
    scores: Sequence[tuple[str, str | None]] = tuple(GINI_SCORES),
    label: str = S.OUTCOME_LABEL,
    day: str = "DISBURSED_DATE",
    ranges: int | None = None,
) -> DataFrame:
    """MONTH_YEAR and one Gini column per metric, on the rows that counted for it.

    The figures (a few rows per model and month) are stored and read back, so
    the optimizer sees their size when it plans the joins with all rows.
    """
    specs = _metrics(since, scores, day)
    figures = stored(gini_metrics(df, since, scores, label, day, ranges), "gini_figures")

    def wide(monthly: bool, keys: list[str]) -> DataFrame:
        return figures.groupBy(*keys).agg(
            *[
                F.max(F.when(F.col("METRIC") == metric, F.col("GINI"))).alias(f"_{metric}")
                for metric, _, by_month, _ in specs
                if by_month == monthly
            ]
        )

    dated = df.withColumn("MONTH_YEAR", month_label(day))
    joined = dated.join(wide(False, ["MODEL_TYPE"]), ["MODEL_TYPE"], "left").join(
        wide(True, ["MODEL_TYPE", "MONTH_YEAR"]), ["MODEL_TYPE", "MONTH_YEAR"], "left"
    )
    return joined.select(
        *df.columns,
        "MONTH_YEAR",
        *[F.when(rows, F.col(f"_{metric}")).alias(metric) for metric, _, _, rows in specs],
    )
