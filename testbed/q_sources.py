"""Scans, filters, cleaning, scalar functions and sinks."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from loanlens.functions import day_diff, iso_day, logit, month_label, sigmoid
from loanlens.operators import cleaning as C
from loanlens.operators.blend import readable_messages_only
from loanlens.operators.scoring import credit_band_shares
from loanlens.session import shared_folder
from loanlens.sources import assets, scans, sinks
from loanlens.sources import schemas as S
from testbed import proxies as P
from testbed.registry import query, r6, rounded, s6, text_day, with_ctes

START, END = "1996-01-01", "2000-12-31"
ASSETS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "assets")
WINDOW = f"BRE_RUN_DATE >= date '{START}' AND BRE_RUN_DATE <= date '{END}'"


def asset(spark, name, schema):
    return assets.read_csv(spark, os.path.join(ASSETS, name), schema)


def activity_roles(spark):
    return assets.feature_roles(asset(spark, "activity_dictionary.csv", assets.FEATURE_DICTIONARY))


def _scan_sql(part, module, extra=""):
    scan = scans.MODULE_SCANS[module]

    def column(c):
        if c in scan.rounded:
            return f"(round({c}, 2) + 0.0) AS {c}"
        if c == "PRICE":
            return "CASE WHEN isnan(PRICE) THEN NULL ELSE PRICE END AS PRICE"
        return c

    names = ", ".join([*scan.id_columns, *[column(c) for c in scan.features], scan.flag])
    return with_ctes(
        "SELECT CUSTOMER_ID AS USER_ID, BRE_RUN_ID, cast(BRE_RUN_DATE AS string) AS DISBURSED_DATE,"
        f" {names} FROM fact_{part} WHERE {WINDOW} {extra}",
        f"fact_{part}",
    )


def _scan(part, module):
    def run(spark, sf):
        rows = scans.module_scan(P.fact(spark, sf, part), module, START, END)
        return rows.withColumn("DISBURSED_DATE", text_day("DISBURSED_DATE"))

    return run


query(
    "transaction_scan",
    _scan_sql("transaction", "transaction_module", "AND DAYS_SINCE_LAST_TXN <= 90"),
)(_scan("transaction", "transaction_module"))
query("activity_scan", _scan_sql("activity", "activity_module"))(_scan("activity", "activity_module"))
query("bureau_scan", _scan_sql("bureau", "bureau_module", f"AND {S.BUREAU_FLAG}"))(
    _scan("bureau", "bureau_module")
)
query("sms_scan", _scan_sql("sms", "sms_module", f"AND {S.SMS_FLAG}"))(_scan("sms", "sms_module"))


@query(
    "trimmed_key_join",
    with_ctes(
        "SELECT a.CUSTOMER_ID AS USER_ID, a.DEVICE_ID, cast(a.BRE_RUN_DATE AS string) AS DISBURSED_DATE, "
        + ", ".join(f"a.{c}" for c in S.SMS_EVENT_COUNTS)
        + f", a.{S.SMS_FLAG}, b.NUM_READABLE_SMS_180D FROM fact_sms_events a LEFT JOIN sufficiency b"
        " ON trim(a.CUSTOMER_ID) = trim(b.USER_ID) AND trim(a.BRE_RUN_ID) = trim(b.BRE_RUN_ID)"
        f" WHERE a.{S.SMS_FLAG} AND {WINDOW}",
        "fact_sms_events", "sufficiency",
    ),
)
def trimmed_key_join(spark, sf):
    rows = scans.sms_sufficiency_scan(
        P.fact(spark, sf, "sms_events"), P.sufficiency(spark, sf), START, END
    )
    return rows.withColumn("DISBURSED_DATE", text_day("DISBURSED_DATE"))


_DECISION_SQL = ", ".join(
    "cast(BRE_RUN_DATE AS string) AS BRE_RUN_DATE"
    if c == "BRE_RUN_DATE"
    else f"{s6(c)} AS {c}" if c == S.EXTERNAL_SCORE else c
    for c in S.DECISION_COLUMNS
)


@query(
    "decision_scan_window",
    with_ctes(f"SELECT {_DECISION_SQL} FROM fact_decision WHERE {WINDOW}", "fact_decision"),
)
def decision_scan_window(spark, sf):
    return rounded(scans.decision_scan(P.fact(spark, sf), START, END))


RUN_LOG_LIMIT = "2000-06-01"


@query(
    "incremental_scan",
    with_ctes(
        "SELECT BRE_RUN_ID, cast(BRE_RUN_DATE AS string) AS BRE_RUN_DATE FROM fact_decision"
        " WHERE BRE_RUN_DATE >= (SELECT max(cast(o_orderdate AS date)) FROM orders"
        f" WHERE o_orderstatus = 'F' AND o_orderdate < date '{RUN_LOG_LIMIT}')"
        " AND BRE_RUN_DATE <= date '2001-12-31'",
        "fact_decision",
    ),
)
def incremental_scan(spark, sf):
    log = P.table(spark, sf, "orders").selectExpr(
        "o_orderdate as RUN_DATE",
        f"o_orderstatus = 'F' and o_orderdate < date '{RUN_LOG_LIMIT}' as SUCCEEDED",
    )
    start, end = scans.incremental_window(log, "2001-12-31", default_start="1990-01-01")
    rows = scans.decision_scan(P.fact(spark, sf), start, end)
    return rows.select("BRE_RUN_ID", text_day("BRE_RUN_DATE"))


@query(
    "recency_filter",
    with_ctes(
        "SELECT BRE_RUN_ID, DAYS_SINCE_LAST_TXN FROM fact_decision"
        " WHERE DAYS_SINCE_LAST_TXN <= 90 AND DAYS_SINCE_LAST_TXN IS NOT NULL",
        "fact_decision",
    ),
)
def recency_filter(spark, sf):
    return P.fact(spark, sf).where(scans.used_recently(90)).select("BRE_RUN_ID", "DAYS_SINCE_LAST_TXN")


@query(
    "availability_filter",
    with_ctes(
        f"SELECT BRE_RUN_ID, {s6('TRX_PD')} AS TRX_PD FROM scored"
        f" WHERE TRX_PD IS NOT NULL AND {S.LEDGER_FLAG} AND MODEL_TYPE = 'XGBOOST'",
        "scored",
    ),
)
def availability_filter(spark, sf):
    rows = C.not_null(scans.of_model(P.scored(spark, sf), "XGBOOST"), ["TRX_PD"], S.LEDGER_FLAG)
    return rows.select("BRE_RUN_ID", r6("TRX_PD").alias("TRX_PD"))


@query(
    "positive_sms_filter",
    with_ctes(
        f"SELECT DISTINCT BRE_RUN_ID, {s6('PRED_TRAIN')} AS PRED_TRAIN, NUM_READABLE_SMS_180D,"
        " true AS IS_SMS_FEATURE FROM raw_sms WHERE NUM_READABLE_SMS_180D > 0",
        "raw_sms",
    ),
)
def positive_sms_filter(spark, sf):
    return rounded(readable_messages_only(P.result_rows(spark, sf, "sms")).distinct())


_CLEAN_NUM = ["LAST_1_MONTH_CUSTOMERS", "LAST_3_MONTH_CUSTOMERS", "DELETED_BOOKS", "TOTAL_APPS", "PRICE"]
_CLEAN_CAT = ["DEVICE_BRAND_GD", "DEVICE_CARRIER_GROUP"]


@query(
    "clean_fill_replace",
    with_ctes(
        "SELECT BRE_RUN_ID, "
        + ", ".join(
            f"CASE WHEN {c} IS NULL OR isnan({c}) THEN -99999e0 ELSE {c} END AS {c}" for c in _CLEAN_NUM
        )
        + ", "
        + ", ".join(
            f"CASE WHEN {c} IS NULL OR {c} = '--' THEN 'MISSING' ELSE {c} END AS {c}" for c in _CLEAN_CAT
        )
        + " FROM fact_activity",
        "fact_activity",
    ),
)
def clean_fill_replace(spark, sf):
    rows = P.fact(spark, sf, "activity").select("BRE_RUN_ID", *_CLEAN_NUM, *_CLEAN_CAT)
    return C.clean(rows, activity_roles(spark), missing_num=-99999, missing_cat="MISSING")


@query(
    "category_replace_only",
    with_ctes(
        "SELECT BRE_RUN_ID, "
        + ", ".join(f"CASE WHEN {c} = '--' THEN 'MISSING' ELSE {c} END AS {c}" for c in _CLEAN_CAT)
        + " FROM fact_activity",
        "fact_activity",
    ),
)
def category_replace_only(spark, sf):
    rows = P.fact(spark, sf, "activity").select("BRE_RUN_ID", *_CLEAN_CAT)
    return C.clean(rows, activity_roles(spark), missing_cat="MISSING", fill_categories=False)


_TEXT_NUMBERS = ["BUREAUSCORE", "REQUEST_180_DAYS_FOR_RULE"]


@query(
    "failed_casts",
    with_ctes(
        "SELECT "
        + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND try_cast({c} AS double) IS NULL) AS {c}"
            for c in _TEXT_NUMBERS
        )
        + " FROM fact_policy",
        "fact_policy",
    ),
)
def failed_casts(spark, sf):
    return C.failed_casts(P.fact(spark, sf, "policy"), _TEXT_NUMBERS)


@query(
    "text_to_number",
    with_ctes(
        "SELECT BRE_RUN_ID, " + ", ".join(f"try_cast({c} AS double) AS {c}" for c in _TEXT_NUMBERS)
        + " FROM fact_policy",
        "fact_policy",
    ),
)
def text_to_number(spark, sf):
    rows = P.fact(spark, sf, "policy").select("BRE_RUN_ID", *_TEXT_NUMBERS)
    return C.to_numbers(rows, _TEXT_NUMBERS)


@query(
    "zero_fill",
    with_ctes(
        "SELECT BRE_RUN_ID, coalesce(D_1_TXNS, 0) AS D_1_TXNS, coalesce(D_30_TXNS, 0) AS D_30_TXNS,"
        " coalesce(TOTAL_KHATAS, 0) AS TOTAL_KHATAS, KB_AGE FROM fact_transaction",
        "fact_transaction",
    ),
)
def zero_fill(spark, sf):
    names = assets.listed(asset(spark, "transaction_zero_fill.csv", assets.ZERO_FILL_LIST), "Features")
    return C.zero_fill(P.fact(spark, sf, "transaction"), names).select("BRE_RUN_ID", *names, "KB_AGE")


@query(
    "feature_subset",
    with_ctes(
        "SELECT BRE_RUN_ID, KB_AGE, D_30_TXNS, TOTAL_TXN_AMNT, AVG_TRXNS_CNT_L3MONTH_DAILY,"
        " RATIO_CNT_L1_L3_MNTH_DAILY FROM fact_transaction",
        "fact_transaction",
    ),
)
def feature_subset(spark, sf):
    names = assets.listed(asset(spark, "transaction_model_features.csv", assets.FEATURE_LIST))
    return P.fact(spark, sf, "transaction").select("BRE_RUN_ID", *names)


@query(
    "complete_rows",
    with_ctes(
        "SELECT BRE_RUN_ID, TOTAL_APPS, DELETED_BOOKS, DEVICE_BRAND_GD FROM fact_activity"
        " WHERE TOTAL_APPS IS NOT NULL AND DELETED_BOOKS IS NOT NULL AND DEVICE_BRAND_GD IS NOT NULL",
        "fact_activity",
    ),
)
def complete_rows(spark, sf):
    rows = P.fact(spark, sf, "activity")
    return C.complete_rows(rows.select("BRE_RUN_ID", "TOTAL_APPS", "DELETED_BOOKS", "DEVICE_BRAND_GD"))


@query(
    "distinct_rows",
    with_ctes(f"SELECT DISTINCT BRE_RUN_ID, {s6('PRED_TRAIN')} AS PRED_TRAIN FROM raw_bureau", "raw_bureau"),
)
def distinct_rows(spark, sf):
    rows = P.result_rows(spark, sf, "bureau").select("BRE_RUN_ID", "PRED_TRAIN")
    return rounded(rows.distinct())


_BANDS = " + ".join(S.CREDIT_BANDS)


@query(
    "share_of_total",
    with_ctes(
        "SELECT BRE_RUN_ID, "
        + s6(f"{S.CREDIT_BANDS[0]} / nullif({_BANDS}, 0)")
        + " AS PROP_CREDIT_TXNS_LESSTHAN_100_LAST30D, "
        + s6(f"{S.CREDIT_BANDS[-1]} / nullif({_BANDS}, 0)")
        + " AS PROP_CREDIT_TXNS_GREATERTHAN_10000_LAST30D FROM fact_sms",
        "fact_sms",
    ),
)
def share_of_total(spark, sf):
    rows = credit_band_shares(P.fact(spark, sf, "sms").select("BRE_RUN_ID", *S.CREDIT_BANDS))
    return rounded(rows.drop(*S.CREDIT_BANDS))


@query(
    "logit_sigmoid",
    with_ctes(
        f"SELECT BRE_RUN_ID, {s6('ln(CALIB_PD/(1-CALIB_PD))')} AS LOGODDS,"
        f" {s6('1/(1+exp(-(ln(CALIB_PD/(1-CALIB_PD)))))')} AS BACK FROM scored",
        "scored",
    ),
)
def logit_sigmoid(spark, sf):
    rows = P.scored(spark, sf).withColumn("LOGODDS", logit("CALIB_PD"))
    return rounded(rows.select("BRE_RUN_ID", "LOGODDS", sigmoid("LOGODDS").alias("BACK")))


@query(
    "date_functions",
    with_ctes(
        "SELECT LOAN_ID, DISBURSED_DATE::string AS ISO_DAY, strftime(DISBURSED_DATE, '%b-%Y') AS MONTH_YEAR,"
        " upper(strftime(DISBURSED_DATE, '%b-%Y')) AS MONTH_UPPER,"
        " date_diff('day', date '1995-01-01', DISBURSED_DATE) AS DAYS,"
        " cast(cast(DISBURSED_DATE - INTERVAL 3 MONTH AS date) AS string) AS THREE_MONTHS_BEFORE"
        " FROM repayments",
        "repayments",
    ),
)
def date_functions(spark, sf):
    day = F.col("DISBURSED_DATE")
    return P.repayments(spark, sf).select(
        "LOAN_ID",
        iso_day(day).alias("ISO_DAY"),
        month_label(day).alias("MONTH_YEAR"),
        F.upper(month_label(day)).alias("MONTH_UPPER"),
        day_diff(F.lit("1995-01-01").cast("date"), day).cast("long").alias("DAYS"),
        F.add_months(day, -3).cast("string").alias("THREE_MONTHS_BEFORE"),
    )


@query(
    "table_overwrite_scan",
    with_ctes(
        "SELECT BRE_RUN_ID AS RUN, cast(BRE_RUN_DATE AS string) AS BRE_RUN_DATE, OVERALL_BOUNCE_M0123 AS BOUNCES,"
        f" {s6(S.EXTERNAL_SCORE)} AS SCORE, {S.SMS_FLAG} AS FLAG FROM fact_decision",
        "fact_decision",
    ),
)
def table_overwrite_scan(spark, sf):
    """Written twice under one name with lower-case columns, then scanned whole."""
    rows = P.fact(spark, sf).select(
        F.col("BRE_RUN_ID").alias("run"),
        F.col("BRE_RUN_DATE").alias("bre_run_date"),
        F.col("OVERALL_BOUNCE_M0123").alias("bounces"),
        F.round(S.EXTERNAL_SCORE, 6).alias("score"),
        F.col(S.SMS_FLAG).alias("flag"),
    )
    root = shared_folder(spark)
    sinks.overwrite_path(rows.where("flag"), root, "final_result", "DECISIONS")
    path = sinks.overwrite_path(rows, root, "final_result", "DECISIONS")
    return sinks.read_path(spark, path).withColumn("BRE_RUN_DATE", text_day("BRE_RUN_DATE"))
