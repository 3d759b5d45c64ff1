"""Scans of the decision fact and of the tables derived from it.

Each scan is a filter and a column list, so the filter is pushed into the
parquet scan and only the listed columns are read.  For scoring, pass the
model's own feature list as ``features``: beyond 100 columns whole-stage code
generation is switched off, and no model needs all columns of its module.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions import in_day_window, null_if_nan, trimmed
from loanlens.operators.skew import left_join
from loanlens.sources import schemas as S


@dataclass(frozen=True)
class ModuleScan:
    """What one module reads from the fact."""

    features: tuple[str, ...]
    flag: str
    flag_required: bool = False
    id_columns: tuple[str, ...] = ()
    rounded: tuple[str, ...] = ()
    max_idle_days: int | None = None


# Flags, rounded columns and the recency limit of each module.
MODULE_SCANS = {
    "transaction_module": ModuleScan(
        features=tuple(S.TRANSACTION_FEATURES),
        flag=S.LEDGER_FLAG,
        rounded=(
            "RATIO_CNT_L1_L3_MNTH_DAILY",
            "RATIO_AMNT_L1_L3_MNTH_DAILY",
            "FULL_SETTLED_TRXNS_OVERALL_AVG_DAILY",
            "UNSETTLED_TRXNS_OVERALL_AVG_DAILY",
            "PARTIAL_SETTLED_TRXNS_OVERALL_AVG_MONTHLY",
        ),
        max_idle_days=90,
    ),
    "activity_module": ModuleScan(tuple(S.ACTIVITY_FEATURES), S.ACTIVITY_FLAG),
    "bureau_module": ModuleScan(tuple(S.BUREAU_FEATURES), S.BUREAU_FLAG, flag_required=True),
    "sms_module": ModuleScan(
        features=(*S.SMS_FEATURES, *S.SMS_COUNTS),
        flag=S.SMS_FLAG,
        flag_required=True,
        id_columns=("DEVICE_ID",),
    ),
}


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL for NaN in every float column, in one projection."""
    return df.select(
        *[
            null_if_nan(f.name).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema
        ]
    )


def used_recently(max_days: int) -> Column:
    """Last transaction known and at most ``max_days`` ago."""
    days = F.col("DAYS_SINCE_LAST_TXN")
    return days.isNotNull() & (days <= max_days)


def module_scan(
    fact: DataFrame,
    module: str,
    start: dt.date | str,
    end: dt.date | str,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Feature rows of one module in an inclusive day window."""
    scan = MODULE_SCANS[module]
    keep = in_day_window("BRE_RUN_DATE", start, end)
    if scan.flag_required:
        keep = keep & F.col(scan.flag)
    if scan.max_idle_days is not None:
        keep = keep & used_recently(scan.max_idle_days)

    def feature(name: str) -> Column:
        return F.round(name, 2).alias(name) if name in scan.rounded else F.col(name)

    chosen = scan.features if features is None else features
    return nan_to_null(
        fact.where(keep).select(
            F.col("CUSTOMER_ID").alias("USER_ID"),
            "BRE_RUN_ID",
            *scan.id_columns,
            F.col("BRE_RUN_DATE").alias("DISBURSED_DATE"),
            *[feature(name) for name in chosen],
            scan.flag,
        )
    )


def decision_scan(fact: DataFrame, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """The columns the blend and the rule engine need, in an inclusive day window."""
    return nan_to_null(
        fact.where(in_day_window("BRE_RUN_DATE", start, end)).select(*S.DECISION_COLUMNS)
    )


def sms_sufficiency_scan(
    fact: DataFrame,
    sufficiency: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
) -> DataFrame:
    """Bounce and overdue counts with the readable-message count of another table.

    The tables meet on the trimmed customer and run.
    """
    facts = fact.where(in_day_window("BRE_RUN_DATE", start, end) & F.col(S.SMS_FLAG)).select(
        trimmed("CUSTOMER_ID").alias("_customer"),
        trimmed("BRE_RUN_ID").alias("_run"),
        F.col("CUSTOMER_ID").alias("USER_ID"),
        "DEVICE_ID",
        F.col("BRE_RUN_DATE").alias("DISBURSED_DATE"),
        *S.SMS_EVENT_COUNTS,
        S.SMS_FLAG,
    )
    counts = sufficiency.select(
        trimmed("USER_ID").alias("_customer"),
        trimmed("BRE_RUN_ID").alias("_run"),
        "NUM_READABLE_SMS_180D",
    )
    return left_join(facts, counts, ["_customer", "_run"]).drop("_customer", "_run")


def matured(
    master: DataFrame, as_of: dt.date | str, months: int = 3, day: str = "DISBURSED_DATE"
) -> DataFrame:
    """Loans paid out more than ``months`` before ``as_of``; undated rows drop out."""
    limit = F.add_months(F.lit(dt.date.fromisoformat(str(as_of))), -months)
    return master.where(F.col(day) < limit)


def of_model(df: DataFrame, model_type: str) -> DataFrame:
    return df.where(F.col("MODEL_TYPE") == model_type)


def incremental_window(
    run_log: DataFrame,
    today: dt.date | str,
    default_start: dt.date | str,
    requested_start: dt.date | str | None = None,
    day: str = "RUN_DATE",
    succeeded: str = "SUCCEEDED",
) -> tuple[dt.date, dt.date]:
    """First and last day to read.

    The start is the requested day, else the day of the last successful run,
    else the default.  One aggregate row comes back from the run log.
    """
    today = dt.date.fromisoformat(str(today))
    if requested_start is not None:
        return dt.date.fromisoformat(str(requested_start)), today
    last = run_log.where(F.col(succeeded)).agg(F.max(F.to_date(day))).first()[0]
    return last or dt.date.fromisoformat(str(default_start)), today


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    """Whole scan of an intermediate table of the catalog."""
    return spark.read.table(name)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or ValueError when it has no row (reads one row only)."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df
