"""Inputs in the shapes the jobs read, derived from the driver tables.

The expressions are valid in Spark and in the SQL of the comparison engine, so
both sides start from the same rows.  Remainders of the keys make missing and
boundary values repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanlens.sources import schemas as S

K, CK = "o_orderkey", "o_custkey"


def _count(modulus: int) -> str:
    return f"case when {K}%19=0 then null when {K}%{modulus}=0 then 1 else 0 end"


def pd_expr(a: int, b: int, low: str = "1e-3", span: str = "9e-2") -> str:
    return f"({low} + {span} * cast((({K}*{a}+{CK}*{b})%10007) as double) / 10007e0)"


DECISION: dict[str, str] = {
    "CUSTOMER_ID": f"' ' || cast({CK} as string) || ' '",
    "BRE_RUN_ID": f"'R' || cast({K} as string)",
    "BRE_RUN_DATE": "cast(o_orderdate as date)",
    "OVERALL_BOUNCE_M0123": f"case when {K}%11=0 then null else {K}%8 end",
    "AUTO_DEBIT_BOUNCE_M0": f"case when {K}%5=0 then 'true' when {K}%5=1 then null else 'false' end",
    "AUTO_DEBIT_BOUNCE_M1": f"case when {K}%3=0 then 'true' else 'false' end",
    "BUREAUSCORE": f"case when {K}%13=0 then null else 250+({K}*37)%600 end",
    "WRITTEN_OFF_SETTLED_24MONTHS_CNT_FOR_RULE": _count(23),
    "WRITTEN_OFF_AMT_TOTAL_FOR_RULE": f"case when {K}%17=0 then null else ({K}%12)*100e0 end",
    "SUITFILED_WILFULDEFAULT_24MONTHS_FOR_RULE": _count(29),
    "NEGATIVEACCOUNSTATUS_24MONTHS_FOR_RULE": _count(41),
    "SUITFILEDWILLFULDEFAULTWRITTENOFFSTATUS_24MONTHS_FOR_RULE": _count(31),
    "DEFAULT_ACCOUNTS_FOR_RULE": f"{K}%4",
    "MAX_DPD_2_YEARS_FOR_RULE": f"case when {K}%19=0 then null else ({K}*7)%60 end",
    "PAYMENTHISTORYPROFILE_12MONTHS_FOR_RULE": _count(37),
    S.EXTERNAL_SCORE: f"case when {K}%53=0 then null else {pd_expr(7919, 104729)} end",
    "NUM_READABLE_SMS_180D": f"{K}%7",
    "TOTAL_TRXNS": f"{K}%40",
    "DAYS_SINCE_LAST_TXN": f"case when {K}%59=0 then null else ({K}*3)%130 end",
    S.SMS_FLAG: f"{K}%7>0",
    S.LEDGER_FLAG: f"({K}*3)%130<=90 and {K}%40>=10",
    S.BUREAU_FLAG: f"{K}%13<>0",
    "NUM_LOAN_OVERDUE_30D": f"{K}%3",
    "NUM_CREDIT_CARD_OVERDUE_30D": f"case when {K}%61=0 then null else {CK}%3 end",
    "NUM_LOAN_DEFAULT_30D": f"case when {K}%43=0 then 1 else 0 end",
    "NUM_CREDIT_CARD_DEFAULT_30D": f"case when {CK}%47=0 then 1 else 0 end",
}

# Inputs of the reject policies.  Bounces arrive in upper case, the bureau score as text.
POLICY_INPUT: dict[str, str] = {
    **{c: e for c, e in DECISION.items() if c.endswith("_FOR_RULE")},
    "BRE_RUN_ID": DECISION["BRE_RUN_ID"],
    S.EXTERNAL_SCORE: f"case when {K}%53=0 then null else {pd_expr(7919, 104729, '1e-3', '4e-2')} end",
    "OVERALL_BOUNCE_M0123": f"case when {K}%47=0 then null else {K}%6 end",
    "WRITTEN_OFF_AMT_TOTAL_FOR_RULE": f"case when {K}%17=0 then null else ({K}%7)*100e0 end",
    "MAX_DPD_2_YEARS_FOR_RULE": f"case when {K}%19=0 then null else ({K}*7)%36 end",
    "AUTO_DEBIT_BOUNCE_M0": f"case when {K}%10=0 then 'TRUE' when {K}%10=1 then null else 'FALSE' end",
    "AUTO_DEBIT_BOUNCE_M1": f"case when {K}%9=0 then 'TRUE' when {K}%9=1 then null else 'FALSE' end",
    "BUREAUSCORE": (
        f"case when {K}%17=0 then '' when {K}%29=0 then 'NULL' when {K}%37=0 then null"
        f" when {K}%5=0 then cast(280+({K}*37)%30 as string)"
        f" else cast(640+({K}*37)%200 as string) end"
    ),
    "SCORE_XSELL": f"case when {K}%21=0 then null else 545+({K}*13)%120 end",
    "MAX_DPD_6_MONTHS_UNSECURED_FOR_RULE": f"case when {K}%39=0 then null else ({K}*5)%16 end",
    "MAX_DPD_6_MONTHS_SECURED_FOR_RULE": f"({K}*3)%17",
    "ACCOUNTS_GT1L_OPEN_IN_60DAYS_FOR_RULE": f"{K}%5",
    "ACCOUNTS_LTE1L_OPEN_IN_60DAYS_FOR_RULE": f"({K}*11)%7",
    "ACTIVE_ACCOUNTS_FOR_RULE": f"({K}*17)%16",
    "REQUEST_180_DAYS_FOR_RULE": f"case when {K}%33=0 then 'NULL' else cast(({K}*19)%17 as string) end",
    "AMOUNT_PAST_DUE_FOR_RULE": f"({K}%12)*500e0",
    "CNT_DELINQUNCY_LOAN_C30": f"({K}*23)%4",
    "TOTAL_CREDIT_FOR_RULE": f"({K}%30)*500",
}

TEXT_FEATURES = (
    "DEVICE_BRAND_GD", "DEVICE_CARRIER_GROUP", "TYPE_OF_COLLATERAL", "RESIDENCE_CODE_NON_NORMALIZED",
)


def _feature(name: str, j: int) -> str:
    if name in DECISION:
        return DECISION[name]
    if name in TEXT_FEATURES:
        prefix = name.split("_")[1]
        return (
            f"case when {K}%25=0 then '--' when ({K}+{j})%7=0 then null"
            f" else '{prefix}_' || cast(({K}+{j})%5 as string) end"
        )
    value = f"cast(({K}*{2 * j + 7}+{CK}*{3 * j + 5})%1009 as double)/8e0"
    odd = f" when {K}%31=0 then cast('NaN' as double)" if name == "PRICE" else ""
    return f"case when ({K}+{j})%23=0 then null{odd} else {value} end"


def features(names) -> dict[str, str]:
    return {name: _feature(name, j) for j, name in enumerate(names)}


DEVICE = {"DEVICE_ID": f"'D' || cast({K}%1000 as string)"}
ACTIVITY_FLAG = {S.ACTIVITY_FLAG: f"{K}%9<>0"}

# The fact, by the part of it a scan reads.
FACT_PARTS: dict[str, dict[str, str]] = {
    "transaction": {**DECISION, **features(S.TRANSACTION_FEATURES)},
    "activity": {**DECISION, **features(S.ACTIVITY_FEATURES), **ACTIVITY_FLAG},
    "bureau": {**DECISION, **features(S.BUREAU_FEATURES)},
    "sms": {**DECISION, **DEVICE, **features([*S.SMS_FEATURES, *S.SMS_COUNTS])},
    "sms_events": {**DECISION, **DEVICE, **features(S.SMS_EVENT_COUNTS)},
    "decision": DECISION,
    "policy": POLICY_INPUT,
}

# Module results: raw probability of each module, with exact duplicates to remove.
RESULTS: dict[str, tuple[dict[str, str], str]] = {
    "bureau": ({"PRED_TRAIN": pd_expr(6007, 30011, span="4e-1"), S.BUREAU_FLAG: "true"}, f"{K}%13<>0"),
    "transaction": (
        {"PRED_TRAIN": pd_expr(3571, 81799, span="4e-1"), S.LEDGER_FLAG: DECISION[S.LEDGER_FLAG]},
        f"({K}*3)%130<=90",
    ),
    "sms": (
        {"PRED_TRAIN": pd_expr(9241, 50021, span="4e-1"), "NUM_READABLE_SMS_180D": f"{K}%7"},
        f"{K}%7>0 or {K}%2=0",
    ),
    "activity": (
        {
            "USER_ID": DECISION["CUSTOMER_ID"],
            "DISBURSED_DATE": DECISION["BRE_RUN_DATE"],
            "PRED_TRAIN": f"case when {K}%27=0 then null else {pd_expr(7013, 20011, span='4e-1')} end",
            **ACTIVITY_FLAG,
        },
        f"{K}%3<>0",
    ),
}

REPAYMENT = {
    "USER_ID": f"cast({CK} as string)",
    "LOAN_ID": "cast(l_orderkey*10+l_linenumber as string)",
    "DISBURSED_DATE": "cast(l_shipdate as date)",
    "VENDOR": "cast(l_suppkey as string)",
    "STATUS": "l_linestatus",
    "EVER_15DPD_IN_90DAYS": "case when l_returnflag='R' then 1 else 0 end",
    "EVER_30DPD_IN_90DAYS": "case when l_returnflag='R' and l_linenumber%2=0 then 1 else 0 end",
}

# Labelled, scored rows for the metrics; the label depends on the blended score.
SCORED = {
    "BRE_RUN_ID": DECISION["BRE_RUN_ID"],
    "MODEL_TYPE": f"case when {K}%2=0 then 'XGBOOST' else 'LR' end",
    "DISBURSED_DATE": f"case when {K}%97=0 then null else cast(o_orderdate as date) end",
    "CALIB_PD": f"case when {K}%9=0 then null else {pd_expr(7919, 104729)} end",
    "SMS_PD": f"case when {K}%8=0 then null else {pd_expr(9241, 50021)} end",
    "TRX_PD": f"case when {K}%6=0 then null else {pd_expr(3571, 81799, span='5e-2')} end",
    "BR_PD": f"case when {K}%10=0 then null else cast((({K}*6007+{CK})%97) as double)/1000e0 end",
    S.EXTERNAL_SCORE: f"case when {K}%53=0 then null else {pd_expr(6007, 30011)} end",
    S.SMS_FLAG: f"case when {K}%71=0 then null else {K}%7>0 end",
    S.LEDGER_FLAG: DECISION[S.LEDGER_FLAG],
    S.BUREAU_FLAG: f"{K}%13<>0",
    "EVER_15DPD_IN_90DAYS": (
        f"case when ({K}*31)%100 < 700e0*{pd_expr(7919, 104729)} then 1 else 0 end"
    ),
}

DRIFT = {
    "DAY": "cast(o_orderdate as date)",
    "TOTAL_PRICE": f"case when {K}%9=0 then null else o_totalprice end",
    "BALANCE": "c_acctbal",
    "SMALL_COUNT": f"cast({K}%8 as double)",
    "PRIORITY": f"case when {K}%25=0 then '--' else o_orderpriority end",
    "SEGMENT": f"case when {K}%14=0 then null else c_mktsegment end",
}
DRIFT_SPLIT = "1998-01-01"

_PD = "cast(1+event_id%9 as string)"
METADATA = (
    "'{\"scoringServiceInput\":{\"features\":{\"sms\":{\"amt\":' || cast(cast(floor(value) as bigint) as string)"
    " || ',\"kind\":\"' || event_type || '\"},\"ledger\":'"
    " || case when event_id%3=0 then '{}' else '{\"n\":' || cast(event_id%50 as string) || '}' end"
    " || ',\"bureau\":' || case when event_id%4=0 then '{}' else '{\"score\":'"
    " || cast(300+event_id%600 as string) || '}' end || '}}'"
    " || case when event_id%11=0 then '' when event_id%10=0 then ',\"scoringServiceOutput\":null'"
    f" else ',\"scoringServiceOutput\":{{\"model_config\":{{\"model_version\":\"v' || cast(event_id%3 as string)"
    f" || '\"}},\"raw_output\":{{\"SMS_PD\":0.0' || {_PD} || ',\"Trx_PD\":0.1' || {_PD}"
    f" || ',\"Br_PD\":0.2' || {_PD} || ',\"Calib_PD\":0.3' || {_PD} || ',\"Risk_bands\":\"A\"}}}}' end"
    " || ',\"riskBucket\":\"B' || cast(event_id%5 as string) || '\"'"
    " || ',\"reRenewalData\":{\"IS_RENEWAL\":' || case when event_id%2=0 then 'true' else 'false' end || '}'"
    " || ',\"reVendorInsightsData\":{\"X_SELL_SCORE\":' || cast(500+event_id%100 as string) || '}}'"
)
OFFER = {
    "ID": "event_id",
    "EXPIRE_AT": "ts",
    "CREATED_AT": "ts",
    "UPDATED_AT": "ts",
    "LOAN_APPLICATION_ID": "'A' || cast(event_id as string)",
    "UID": "cast(user_id as string)",
    "USER_ID": "cast(user_id as string)",
    "TYPE": "event_type",
    "STATUS": "case when event_id%2=0 then 'OPEN' else 'DONE' end",
    "LOAN_TYPE": "'TERM'",
    "LENDER": "'L' || cast(event_id%4 as string)",
    "METADATA": METADATA,
}


# --- Spark side -------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as {c}" for c, e in exprs.items()])


def fact(spark: SparkSession, sf_dir: str, part: str = "decision") -> DataFrame:
    return _columns(table(spark, sf_dir, "orders"), FACT_PARTS[part])


def result_rows(spark: SparkSession, sf_dir: str, module: str) -> DataFrame:
    """Raw module results, some rows twice."""
    exprs, keep = RESULTS[module]
    orders = table(spark, sf_dir, "orders").where(keep)
    rows = orders.unionByName(orders.where(f"{K}%50=0"))
    return _columns(rows, {"BRE_RUN_ID": DECISION["BRE_RUN_ID"], **exprs})


def sufficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(table(spark, sf_dir, "orders").where(f"{K}%4<>0"), SUFFICIENCY)


SUFFICIENCY = {
    "USER_ID": f"cast({CK} as string)",
    "BRE_RUN_ID": f"' R' || cast({K} as string)",
    "NUM_READABLE_SMS_180D": f"{K}%7",
}


def repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(K, CK)
    return _columns(lines.join(orders, lines.l_orderkey == orders[K]), REPAYMENT)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(table(spark, sf_dir, "orders"), SCORED)


def drift(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Baseline and new rows; new rows carry their month."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    rows = _columns(orders.join(customers, orders[CK] == customers.c_custkey), DRIFT)
    new = rows.where(f"DAY >= date '{DRIFT_SPLIT}'")
    return (
        rows.where(f"DAY < date '{DRIFT_SPLIT}'"),
        new.selectExpr("*", "date_format(DAY, 'MMM-yyyy') as MONTH_YEAR"),
    )


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(table(spark, sf_dir, "events"), OFFER)


# --- SQL side ---------------------------------------------------------------


def _select(exprs: dict[str, str], source: str) -> str:
    body = ",\n  ".join(f"{e} AS {c}" for c, e in exprs.items())
    return f"SELECT {body}\nFROM {source}"


def _result_sql(module: str) -> str:
    exprs, keep = RESULTS[module]
    rows = f"(SELECT * FROM orders WHERE {keep} UNION ALL SELECT * FROM orders WHERE ({keep}) AND {K}%50=0)"
    return _select({"BRE_RUN_ID": DECISION["BRE_RUN_ID"], **exprs}, rows)


SQL: dict[str, str] = {
    **{f"fact_{part}": _select(exprs, "orders") for part, exprs in FACT_PARTS.items()},
    **{f"raw_{module}": _result_sql(module) for module in RESULTS},
    "sufficiency": _select(SUFFICIENCY, f"orders WHERE {K}%4<>0"),
    "repayments": _select(REPAYMENT, f"lineitem JOIN orders ON l_orderkey = {K}"),
    "scored": _select(SCORED, "orders"),
    "drift_rows": _select(DRIFT, f"orders JOIN customer ON {CK} = c_custkey"),
    "offers": _select(OFFER, "events"),
}
