"""Blending the module scores of a decision into one calibrated score and band."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import logit, number, sigmoid
from loanlens.operators.scoring import Calibration
from loanlens.operators.skew import left_joins
from loanlens.sources import schemas as S

# Weights (percent) of the log-odds per combination type.
BLEND_WEIGHTS: dict[str, dict[str, float]] = {
    "SMS_TRX_SUFFICIENT": {"LOGODDS_TRX": 50, "LOGODDS_SMS": 50},
    "SMS_BR_SUFFICIENT": {"LOGODDS_BR": 40, "LOGODDS_SMS": 60},
    "SMS_BR_TRX_SUFFICIENT": {"LOGODDS_TRX": 33, "LOGODDS_SMS": 34, "LOGODDS_BR": 33},
}

# Upper edges (inclusive) of the risk bands; above the last is E.
BAND_CUTS: list[tuple[str, float]] = [
    ("A", 0.0162),
    ("B", 0.0267),
    ("C", 0.0392),
    ("D", 0.053163138),
]
LAST_BAND = "E"
NO_BAND = "Missing"


def _yes(condition: Column) -> Column:
    return F.when(condition, F.lit("YES")).otherwise(F.lit("NO"))


def sufficiency_numbers(df: DataFrame) -> DataFrame:
    """The inputs of the sufficiency flags as numbers."""
    return df.withColumns(
        {c: number(c) for c in ("NUM_READABLE_SMS_180D", "BUREAUSCORE", "TOTAL_TRXNS", "DAYS_SINCE_LAST_TXN")}
    )


def sufficiency_flags(df: DataFrame) -> DataFrame:
    """Whether bureau, message and transaction data suffice; unknown counts as NO."""
    return sufficiency_numbers(df).withColumns(
        {
            "IS_SMS_FEATURE": F.coalesce(F.col("NUM_READABLE_SMS_180D") > 0, F.lit(False)),
            "IS_BR_SUFF": _yes(F.col("BUREAUSCORE") >= 300),
            "IS_SMS_SUFF": _yes(F.col("NUM_READABLE_SMS_180D") > 0),
            "IS_TRX_SUFF": _yes((F.col("DAYS_SINCE_LAST_TXN") <= 90) & (F.col("TOTAL_TRXNS") >= 10)),
        }
    )


def combination_type() -> Column:
    """Which modules a decision can be scored with."""
    bureau = F.col("IS_BR_SUFF") == "YES"
    transactions = F.col("IS_TRX_SUFF") == "YES"
    return (
        F.when(F.col("IS_SMS_SUFF") != "YES", F.lit("SMS_INSUFFICIENT"))
        .when(bureau & transactions, F.lit("SMS_BR_TRX_SUFFICIENT"))
        .when(transactions, F.lit("SMS_TRX_SUFFICIENT"))
        .when(bureau, F.lit("SMS_BR_SUFFICIENT"))
        .otherwise(F.lit("SMS_SUFFICIENT"))
    )


def readable_messages_only(sms_results: DataFrame) -> DataFrame:
    """Message results that rest on at least one readable message."""
    return sms_results.withColumn(
        "IS_SMS_FEATURE", F.coalesce(number("NUM_READABLE_SMS_180D") > 0, F.lit(False))
    ).where("IS_SMS_FEATURE")


def _module_scores(results: DataFrame, pd_name: str, logodds_name: str) -> DataFrame:
    return results.select(
        "BRE_RUN_ID",
        F.col("PRED_TRAIN_XGB").alias(pd_name),
        F.col("LOGODDS_SCORE").alias(logodds_name),
    ).distinct()


def join_module_scores(
    decisions: DataFrame,
    bureau: DataFrame,
    transaction: DataFrame,
    sms: DataFrame,
) -> DataFrame:
    """Decisions with the scores of three modules; decisions without one keep NULL.

    Full-row duplicates go before the joins, on both sides, which gives the
    same rows as removing them after each join and shuffles less.  Decisions
    move once, by the key of the joins.
    """
    return left_joins(
        decisions,
        [
            _module_scores(bureau, "BR_PD", "LOGODDS_BR"),
            _module_scores(transaction, "TRX_PD", "LOGODDS_TRX"),
            _module_scores(readable_messages_only(sms), "SMS_PD", "LOGODDS_SMS"),
        ],
        ["BRE_RUN_ID"],
        counted=decisions,
        distinct=True,
    )


def blended_pd(weights: Mapping[str, Mapping[str, float]] = BLEND_WEIGHTS) -> Column:
    """Sigmoid of the weighted log-odds; NULL for types without weights."""
    kind = F.lower(F.trim("COMBINATION_TYPE"))
    blended = F.lit(None).cast("double")
    for name, parts in weights.items():
        terms = [F.lit(percent / 100.0) * F.col(column) for column, percent in parts.items()]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        blended = F.when(kind == name.strip().lower(), sigmoid(total)).otherwise(blended)
    return blended


def risk_band(
    score: Column | str = "CALIB_PD",
    cuts: Sequence[tuple[str, float]] = BAND_CUTS,
    last: str = LAST_BAND,
    missing: str = NO_BAND,
) -> Column:
    """Band of a score; upper edges belong to the band below.

    Looked up in an array: Spark compiles no lambda into a stage, so the joins
    before it and the rules after it become two methods, and each is within the
    8,000 bytes up to which the JVM compiles one.
    """
    score = F.col(score) if isinstance(score, str) else score
    bands = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(upper).alias("upper")) for name, upper in cuts])
    fitting = F.filter(bands, lambda band: score <= band["upper"])
    band = F.coalesce(F.get(fitting, F.lit(0))["name"], F.lit(last))
    return F.when(score.isNull(), F.lit(missing)).otherwise(band)


def blend(
    joined: DataFrame,
    calibration: Calibration,
    weights: Mapping[str, Mapping[str, float]] = BLEND_WEIGHTS,
) -> DataFrame:
    """COMBINED_PD, COMBINED_LOGODDS, CALIB_PD and RISK_BANDS."""
    return (
        joined.withColumn("COMBINED_PD", blended_pd(weights))
        .withColumn("COMBINED_LOGODDS", logit("COMBINED_PD"))
        .withColumn("CALIB_PD", calibration.apply("COMBINED_LOGODDS"))
        .withColumn("RISK_BANDS", risk_band())
    )


def join_lr_modules(
    activity: DataFrame,
    transaction: DataFrame,
    bureau: DataFrame,
) -> DataFrame:
    """Activity results with transaction and bureau results, raw scores as log-odds."""
    left = activity.select(
        "USER_ID", "BRE_RUN_ID", "DISBURSED_DATE",
        F.col("PRED_TRAIN").alias("ACT_PRED"),
        logit("PRED_TRAIN").alias("ACT_LOGODDS"),
        S.ACTIVITY_FLAG,
    )
    lookups = [
        results.select(
            "BRE_RUN_ID",
            F.col("PRED_TRAIN").alias(f"{short}_PRED"),
            logit("PRED_TRAIN").alias(logodds),
            flag,
        )
        for results, short, logodds, flag in (
            (transaction, "TXN", "TRX_LOGODDS", S.LEDGER_FLAG),
            (bureau, "BR", "BR_LOGODDS", S.BUREAU_FLAG),
        )
    ]
    return left_joins(left, lookups, ["BRE_RUN_ID"], counted=activity)


def lr_blend(
    joined: DataFrame,
    activity_weight: float,
    transaction_weight: float,
    bureau_weight: float,
    calibration: Calibration,
) -> DataFrame:
    """COMB_SCORE, PD_SCORE and CALIB_PD for complete rows, NULL for the others.

    A row is complete when its three flags are true and no column is NULL.
    Weights are percent.  One pass; no join back to the unfiltered rows.
    """
    complete = F.col(S.ACTIVITY_FLAG) & F.col(S.LEDGER_FLAG) & F.col(S.BUREAU_FLAG)
    for name in joined.columns:
        complete = complete & F.col(name).isNotNull()
    score = (
        F.lit(transaction_weight / 100.0) * F.col("TRX_LOGODDS")
        + F.lit(bureau_weight / 100.0) * F.col("BR_LOGODDS")
        + F.lit(activity_weight / 100.0) * F.col("ACT_LOGODDS")
    )
    return (
        joined.withColumn("COMB_SCORE", F.when(complete, score))
        .withColumn("PD_SCORE", sigmoid("COMB_SCORE"))
        .withColumn("CALIB_PD", calibration.apply("COMB_SCORE"))
    )
