"""Scoring, blending, rules, verdicts, policies and the upsert."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from loanlens.operators import blend as B
from loanlens.operators import policies as PO
from loanlens.operators import rules as R
from loanlens.operators.cleaning import clean, matching_columns
from loanlens.operators.scoring import (
    Calibration,
    ModuleModel,
    prepare,
    score_with_function,
    score_with_pipeline,
    with_scores,
)
from loanlens.operators.upsert import upsert
from loanlens.operators.woe import apply_woe
from loanlens.plans import decisions as D
from loanlens.session import shared_folder
from loanlens.sources import assets, scans, sinks
from loanlens.sources import schemas as S
from loanlens.sources.assets import Roles
from testbed import proxies as P
from testbed.q_sources import activity_roles, asset
from testbed.registry import CTES, logit_sql, query, rounded, s6, sigmoid_sql, with_ctes

START, END = "1995-01-01", "2001-12-31"
CALIBRATION = Calibration(-2.0, 0.9)
FINAL_CALIBRATION = Calibration(-0.3, 0.95)


def _calibrated_sql(logodds: str, c: Calibration) -> str:
    return sigmoid_sql(f"{c.intercept:e} + {c.slope:e} * ({logodds})")


for _m in ("bureau", "transaction", "sms", "activity"):
    _extra = ", NUM_READABLE_SMS_180D" if _m == "sms" else ""
    _keep = "WHERE NUM_READABLE_SMS_180D > 0" if _m == "sms" else ""
    CTES[f"result_{_m}"] = (
        f"SELECT DISTINCT BRE_RUN_ID, PRED_TRAIN, {logit_sql('PRED_TRAIN')} AS LOGODDS_SCORE,"
        f" {_calibrated_sql(logit_sql('PRED_TRAIN'), CALIBRATION)} AS PRED_TRAIN_XGB {_extra}"
        f" FROM raw_{_m} {_keep}"
    )


def results(spark, sf, module):
    return with_scores(P.result_rows(spark, sf, module), F.col("PRED_TRAIN"), CALIBRATION)


# --- module scores ----------------------------------------------------------


@query(
    "calibrated_module_pd",
    with_ctes(
        f"SELECT BRE_RUN_ID, {s6('PRED_TRAIN')} AS PRED_TRAIN, {s6('LOGODDS_SCORE')} AS LOGODDS_SCORE,"
        f" {s6('PRED_TRAIN_XGB')} AS PRED_TRAIN_XGB FROM result_transaction",
        "raw_transaction", "result_transaction",
    ),
)
def calibrated_module_pd(spark, sf):
    rows = results(spark, sf, "transaction").drop(S.LEDGER_FLAG)
    return rounded(rows.distinct())


_TX = ["KB_AGE", "D_30_TXNS", "TOTAL_TXN_AMNT", "AVG_TRXNS_CNT_L3MONTH_DAILY", "RATIO_CNT_L1_L3_MNTH_DAILY"]
_WEIGHTS = [0.012, -0.02, 0.004, 0.01, -0.015]


def _outside_model(batch: pd.DataFrame) -> pd.Series:
    x = np.nan_to_num(batch.to_numpy(dtype="float64"), nan=0.0)
    z = np.full(len(x), -2.0)
    for i, w in enumerate(_WEIGHTS):
        z = z + w * x[:, i]
    return pd.Series(1.0 / (1.0 + np.exp(-z)))


def _tx_model(spark, missing_num=None):
    zero = assets.listed(asset(spark, "transaction_zero_fill.csv", assets.ZERO_FILL_LIST), "Features")
    return ModuleModel(
        features=_TX,
        roles=Roles(numerical=tuple(_TX)),
        calibration=CALIBRATION,
        zero_filled=[c for c in zero if c in _TX],
        missing_num=missing_num,
    )


_Z = "-2e0" + "".join(
    f" + {w:e} * coalesce({'round(' + c + ', 2)' if c.startswith('RATIO') else c}, 0)"
    for c, w in zip(_TX, _WEIGHTS)
)


@query(
    "module_scoring_outside_model",
    with_ctes(
        f"SELECT BRE_RUN_ID, {s6(sigmoid_sql(_Z))} AS PRED_TRAIN, {s6(logit_sql(sigmoid_sql(_Z)))} AS LOGODDS_SCORE,"
        f" {s6(_calibrated_sql(logit_sql(sigmoid_sql(_Z)), CALIBRATION))} AS PRED_TRAIN_XGB"
        " FROM fact_transaction WHERE DAYS_SINCE_LAST_TXN <= 90",
        "fact_transaction",
    ),
)
def module_scoring_outside_model(spark, sf):
    scored = D.score_module(
        P.fact(spark, sf, "transaction"), "transaction_module", START, END, _tx_model(spark),
        lambda df, c: score_with_function(df, _TX, _outside_model, c),
    )
    return rounded(scored.select("BRE_RUN_ID", "PRED_TRAIN", "LOGODDS_SCORE", "PRED_TRAIN_XGB"))


@query("module_scoring")
def module_scoring(spark, sf):
    """Boosted trees fitted on the labelled rows, applied to the whole module scan."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    labelled = P.scored(spark, sf).select("BRE_RUN_ID", F.col(S.OUTCOME_LABEL).cast("double").alias("label"))
    fact = P.fact(spark, sf, "transaction")
    model = _tx_model(spark, missing_num=-99999)
    training = prepare(fact.select("BRE_RUN_ID", *_TX).join(labelled, ["BRE_RUN_ID"]), model)
    fitted = Pipeline(
        stages=[
            VectorAssembler(inputCols=_TX, outputCol="features"),
            GBTClassifier(maxIter=3, maxDepth=3, seed=7),
        ]
    ).fit(training)
    scored = D.score_module(
        fact, "transaction_module", START, END, model,
        lambda df, c: score_with_pipeline(df, fitted, c),
    )
    return scored.select("BRE_RUN_ID", "PRED_TRAIN", "LOGODDS_SCORE", "PRED_TRAIN_XGB")


_LAST = "CASE WHEN LAST_1_MONTH_CUSTOMERS IS NULL THEN -99999 ELSE LAST_1_MONTH_CUSTOMERS END"
_APPS = "CASE WHEN TOTAL_APPS IS NULL THEN -99999 ELSE TOTAL_APPS END"
_BRAND = "CASE WHEN DEVICE_BRAND_GD IS NULL OR DEVICE_BRAND_GD = '--' THEN 'MISSING' ELSE DEVICE_BRAND_GD END"
CTES["encoded"] = (
    "SELECT CUSTOMER_ID AS USER_ID, BRE_RUN_ID, cast(BRE_RUN_DATE AS string) AS DISBURSED_DATE,"
    f" CASE WHEN {_LAST} < -1 THEN 0.35e0 WHEN {_LAST} < 20 THEN 0.21e0 WHEN {_LAST} < 75.5 THEN -0.08e0"
    " ELSE -0.4e0 END AS LAST_1_MONTH_CUSTOMERS_woe,"
    f" CASE WHEN {_APPS} = -99999 THEN 0.6e0 WHEN {_APPS} < 30 THEN 0.12e0 ELSE -0.15e0 END AS TOTAL_APPS_woe,"
    f" CASE WHEN {_BRAND} IN ('MISSING', 'BRAND_0') THEN 0.5e0 WHEN {_BRAND} IN ('BRAND_1', 'BRAND_2')"
    f" THEN -0.1e0 WHEN {_BRAND} = 'BRAND_3' THEN -0.3e0 END AS DEVICE_BRAND_GD_woe FROM fact_activity"
)


def _bins(spark):
    return assets.woe_bins(asset(spark, "activity_bins.csv", assets.WOE_BINS))


@query("woe_apply", with_ctes("SELECT * FROM encoded", "fact_activity", "encoded"))
def woe_apply(spark, sf):
    rows = scans.module_scan(P.fact(spark, sf, "activity"), "activity_module", START, END)
    prepared = clean(rows, activity_roles(spark), -99999, "MISSING")
    return rounded(apply_woe(prepared, _bins(spark), S.ID_COLUMNS))


@query(
    "woe_columns",
    with_ctes(
        "SELECT BRE_RUN_ID, LAST_1_MONTH_CUSTOMERS_woe, TOTAL_APPS_woe, DEVICE_BRAND_GD_woe FROM encoded",
        "fact_activity", "encoded",
    ),
)
def woe_columns(spark, sf):
    return matching_columns(woe_apply(spark, sf), "_woe$", ["BRE_RUN_ID"])


_LR = "-2.5e0 + 0.9e0*LAST_1_MONTH_CUSTOMERS_woe + 1.1e0*TOTAL_APPS_woe + 0.7e0*DEVICE_BRAND_GD_woe"


@query(
    "woe_lr_score",
    with_ctes(
        "SELECT USER_ID, BRE_RUN_ID, DISBURSED_DATE, LAST_1_MONTH_CUSTOMERS_woe AS LAST_1_MONTH_CUSTOMERS_WOE,"
        " TOTAL_APPS_woe AS TOTAL_APPS_WOE, DEVICE_BRAND_GD_woe AS DEVICE_BRAND_GD_WOE,"
        f" {s6(sigmoid_sql(_LR))} AS PRED_TRAIN FROM encoded",
        "fact_activity", "encoded",
    ),
)
def woe_lr_score(spark, sf):
    model = assets.model_variables(asset(spark, "activity_model.csv", assets.MODEL_VARIABLES), 0)
    scored = D.activity_woe_score(
        P.fact(spark, sf, "activity"), START, END, activity_roles(spark), _bins(spark), model,
        -99999, "MISSING",
    )
    return rounded(scored)


# --- blend ------------------------------------------------------------------

CTES["flags"] = (
    f"SELECT * REPLACE (cast(BUREAUSCORE AS double) AS BUREAUSCORE, cast(TOTAL_TRXNS AS double) AS TOTAL_TRXNS,"
    " cast(NUM_READABLE_SMS_180D AS double) AS NUM_READABLE_SMS_180D,"
    " cast(DAYS_SINCE_LAST_TXN AS double) AS DAYS_SINCE_LAST_TXN, cast(BRE_RUN_DATE AS string) AS BRE_RUN_DATE),"
    " NUM_READABLE_SMS_180D > 0 AS IS_SMS_FEATURE,"
    " CASE WHEN BUREAUSCORE >= 300 THEN 'YES' ELSE 'NO' END AS IS_BR_SUFF,"
    " CASE WHEN NUM_READABLE_SMS_180D > 0 THEN 'YES' ELSE 'NO' END AS IS_SMS_SUFF,"
    " CASE WHEN DAYS_SINCE_LAST_TXN <= 90 AND DAYS_SINCE_LAST_TXN IS NOT NULL AND TOTAL_TRXNS >= 10"
    " THEN 'YES' ELSE 'NO' END AS IS_TRX_SUFF FROM fact_decision"
)
CTES["typed"] = (
    "SELECT *, CASE WHEN IS_SMS_SUFF = 'NO' THEN 'SMS_INSUFFICIENT'"
    " WHEN IS_BR_SUFF = 'YES' AND IS_TRX_SUFF = 'YES' THEN 'SMS_BR_TRX_SUFFICIENT'"
    " WHEN IS_BR_SUFF = 'NO' AND IS_TRX_SUFF = 'YES' THEN 'SMS_TRX_SUFFICIENT'"
    " WHEN IS_BR_SUFF = 'YES' AND IS_TRX_SUFF = 'NO' THEN 'SMS_BR_SUFFICIENT'"
    " ELSE 'SMS_SUFFICIENT' END AS COMBINATION_TYPE FROM flags"
)
CTES["joined"] = (
    "SELECT t.*, b.PRED_TRAIN_XGB AS BR_PD, b.LOGODDS_SCORE AS LOGODDS_BR, x.PRED_TRAIN_XGB AS TRX_PD,"
    " x.LOGODDS_SCORE AS LOGODDS_TRX, s.PRED_TRAIN_XGB AS SMS_PD, s.LOGODDS_SCORE AS LOGODDS_SMS"
    " FROM typed t LEFT JOIN result_bureau b USING (BRE_RUN_ID)"
    " LEFT JOIN result_transaction x USING (BRE_RUN_ID) LEFT JOIN result_sms s USING (BRE_RUN_ID)"
)
CTES["combined"] = (
    "SELECT *, CASE COMBINATION_TYPE"
    f" WHEN 'SMS_TRX_SUFFICIENT' THEN {sigmoid_sql('0.5e0*LOGODDS_TRX + 0.5e0*LOGODDS_SMS')}"
    f" WHEN 'SMS_BR_SUFFICIENT' THEN {sigmoid_sql('0.4e0*LOGODDS_BR + 0.6e0*LOGODDS_SMS')}"
    f" WHEN 'SMS_BR_TRX_SUFFICIENT' THEN {sigmoid_sql('0.33e0*LOGODDS_TRX + 0.34e0*LOGODDS_SMS + 0.33e0*LOGODDS_BR')}"
    " END AS COMBINED_PD FROM joined"
)
CTES["calibrated"] = (
    f"SELECT *, {logit_sql('COMBINED_PD')} AS COMBINED_LOGODDS,"
    f" {_calibrated_sql(logit_sql('COMBINED_PD'), FINAL_CALIBRATION)} AS CALIB_PD FROM combined"
)
CTES["banded"] = (
    "SELECT *, CASE WHEN CALIB_PD IS NULL THEN 'Missing' WHEN CALIB_PD <= 0.0162 THEN 'A'"
    " WHEN CALIB_PD <= 0.0267 THEN 'B' WHEN CALIB_PD <= 0.0392 THEN 'C'"
    " WHEN CALIB_PD <= 0.053163138 THEN 'D' ELSE 'E' END AS RISK_BANDS FROM calibrated"
)
_TO_JOINED = (
    "fact_decision", "raw_bureau", "raw_transaction", "raw_sms", "result_bureau",
    "result_transaction", "result_sms", "flags", "typed", "joined",
)
_TO_BANDED = (*_TO_JOINED, "combined", "calibrated", "banded")


def _blended(spark, sf):
    return D.blended_decisions(
        P.fact(spark, sf), results(spark, sf, "bureau"), results(spark, sf, "transaction"),
        results(spark, sf, "sms"), START, END, FINAL_CALIBRATION,
    )


@query(
    "sufficiency_flags",
    with_ctes(
        "SELECT BRE_RUN_ID, IS_SMS_FEATURE, IS_BR_SUFF, IS_SMS_SUFF, IS_TRX_SUFF FROM flags",
        "fact_decision", "flags",
    ),
)
def sufficiency_flags(spark, sf):
    return B.sufficiency_flags(P.fact(spark, sf)).select(
        "BRE_RUN_ID", "IS_SMS_FEATURE", "IS_BR_SUFF", "IS_SMS_SUFF", "IS_TRX_SUFF"
    )


@query(
    "combination_type",
    with_ctes(
        "SELECT BRE_RUN_ID, COMBINATION_TYPE FROM typed", "fact_decision", "flags", "typed"
    ),
)
def combination_type(spark, sf):
    flagged = B.sufficiency_flags(P.fact(spark, sf))
    return flagged.select("BRE_RUN_ID", B.combination_type().alias("COMBINATION_TYPE"))


_SCORES = ["BR_PD", "LOGODDS_BR", "TRX_PD", "LOGODDS_TRX", "SMS_PD", "LOGODDS_SMS"]


@query(
    "module_left_joins",
    with_ctes(
        "SELECT BRE_RUN_ID, " + ", ".join(f"{s6(c)} AS {c}" for c in _SCORES) + " FROM joined",
        *_TO_JOINED,
    ),
)
def module_left_joins(spark, sf):
    joined = B.join_module_scores(
        P.fact(spark, sf).select("BRE_RUN_ID"),
        results(spark, sf, "bureau"), results(spark, sf, "transaction"), results(spark, sf, "sms"),
    )
    return rounded(joined.select("BRE_RUN_ID", *_SCORES))


@query(
    "blend_score",
    with_ctes(
        f"SELECT BRE_RUN_ID, COMBINATION_TYPE, {s6('COMBINED_PD')} AS COMBINED_PD FROM combined",
        *_TO_JOINED, "combined",
    ),
)
def blend_score(spark, sf):
    return rounded(_blended(spark, sf).select("BRE_RUN_ID", "COMBINATION_TYPE", "COMBINED_PD"))


@query(
    "calibrated_pd",
    with_ctes(
        f"SELECT BRE_RUN_ID, {s6('COMBINED_LOGODDS')} AS COMBINED_LOGODDS, {s6('CALIB_PD')} AS CALIB_PD"
        " FROM calibrated",
        *_TO_JOINED, "combined", "calibrated",
    ),
)
def calibrated_pd(spark, sf):
    return rounded(_blended(spark, sf).select("BRE_RUN_ID", "COMBINED_LOGODDS", "CALIB_PD"))


@query(
    "risk_bands",
    with_ctes(
        "SELECT RISK_BANDS, count(*) AS N FROM banded GROUP BY RISK_BANDS", *_TO_BANDED
    ),
)
def risk_bands(spark, sf):
    return _blended(spark, sf).groupBy("RISK_BANDS").agg(F.count("*").alias("N"))


# --- rules ------------------------------------------------------------------

_NTC = "CASE WHEN BUREAUSCORE < 300 OR BUREAUSCORE IS NULL THEN 1 ELSE 0 END"


def _zero_rule(c):
    return f"CASE WHEN {c} = 0 THEN 'PASS' WHEN {c} > 0 THEN 'FAIL' ELSE 'NOT_DECIDED' END"


def _limit_rule(c, limit):
    return f"CASE WHEN {c} <= {limit} THEN 'PASS' WHEN {c} > {limit} THEN 'FAIL' ELSE 'NOT_DECIDED' END"


_E = S.EXTERNAL_SCORE
_X, _Y = "NUM_LOAN_OVERDUE_30D", "NUM_CREDIT_CARD_OVERDUE_30D"
_DZ, _DW = "NUM_LOAN_DEFAULT_30D", "NUM_CREDIT_CARD_DEFAULT_30D"
RULE_SQL = {
    "2": "CASE WHEN OVERALL_BOUNCE_M0123 < 5 THEN 'PASS' WHEN OVERALL_BOUNCE_M0123 >= 5 THEN 'FAIL'"
    " ELSE 'NOT_DECIDED' END",
    "4": "CASE WHEN AUTO_DEBIT_BOUNCE_M0 = 'false' OR AUTO_DEBIT_BOUNCE_M1 = 'false' THEN 'PASS'"
    " WHEN AUTO_DEBIT_BOUNCE_M0 = 'true' AND AUTO_DEBIT_BOUNCE_M1 = 'true' THEN 'FAIL' ELSE 'NOT_DECIDED' END",
    "5": _zero_rule("WRITTEN_OFF_SETTLED_24MONTHS_CNT_FOR_RULE"),
    "6": _limit_rule("WRITTEN_OFF_AMT_TOTAL_FOR_RULE", 500),
    "7": _zero_rule("SUITFILED_WILFULDEFAULT_24MONTHS_FOR_RULE"),
    "8": _zero_rule("SUITFILEDWILLFULDEFAULTWRITTENOFFSTATUS_24MONTHS_FOR_RULE"),
    "9": _limit_rule("MAX_DPD_2_YEARS_FOR_RULE", 30),
    "10": _zero_rule("PAYMENTHISTORYPROFILE_12MONTHS_FOR_RULE"),
    "11": _zero_rule("NEGATIVEACCOUNSTATUS_24MONTHS_FOR_RULE"),
    "12": "CASE WHEN BUREAUSCORE >= 700 THEN 'PASS' WHEN BUREAUSCORE >= 300 THEN 'FAIL' ELSE 'NOT_DECIDED' END",
    "13": f"CASE WHEN {_NTC} = 1 AND {_E} <= 0.0284 THEN 'PASS' WHEN {_NTC} = 1 AND {_E} > 0.0284 THEN 'FAIL'"
    " ELSE 'NOT_DECIDED' END",
    "14": _limit_rule(_E, 0.0354),
    "15": f"CASE WHEN coalesce({_X} + {_Y} > 3, false) OR {_DZ} > 0 OR {_DW} > 0 THEN 'FAIL'"
    f" WHEN {_X} + {_Y} <= 3 AND {_DZ} = 0 AND {_DW} = 0 THEN 'PASS' ELSE 'NOT_DECIDED' END",
}
_OUT = {n: r for n, r in zip(RULE_SQL, S.RULE_COLUMNS[1:])}


def _rule_query(number):
    output = _OUT[number]

    def run(spark, sf):
        return R.apply_rules(P.fact(spark, sf), [number]).select("BRE_RUN_ID", output)

    return run


query("rule_0_new_to_credit", with_ctes(f"SELECT BRE_RUN_ID, {_NTC} AS NTC_FLAG FROM fact_decision", "fact_decision"))(
    lambda spark, sf: P.fact(spark, sf).select("BRE_RUN_ID", R.new_to_credit().alias("NTC_FLAG"))
)
for _n in RULE_SQL:
    query(
        f"rule_{_n}",
        with_ctes(f"SELECT BRE_RUN_ID, {RULE_SQL[_n]} AS {_OUT[_n]} FROM fact_decision", "fact_decision"),
    )(_rule_query(_n))

_POLICY_NUMBERS = ("2", "4", "5", "6", "7", "8", "9", "10", "11", "12", "15")


def _verdict_ctes(source, name):
    CTES[f"{name}_ruled"] = (
        f"SELECT *, {_NTC} AS NTC_FLAG, "
        + ", ".join(f"{RULE_SQL[n]} AS {_OUT[n]}" for n in RULE_SQL)
        + f" FROM {source}"
    )
    CTES[f"{name}_alone"] = (
        "SELECT *, CASE WHEN "
        + " OR ".join(f"{_OUT[n]} = 'FAIL'" for n in _POLICY_NUMBERS)
        + f" THEN 'FAIL' ELSE 'PASS' END AS VERDICT_POLICY_ALONE FROM {name}_ruled"
    )
    CTES[f"{name}_verdicts"] = (
        f"SELECT *, CASE WHEN VERDICT_POLICY_ALONE = 'FAIL' OR {_OUT['14']} = 'FAIL' OR {_OUT['13']} = 'FAIL'"
        f" THEN 'FAIL' ELSE 'PASS' END AS VERDICT_POLICY_WITH_FB FROM {name}_alone"
    )
    return (f"{name}_ruled", f"{name}_alone", f"{name}_verdicts")


_PLAIN = _verdict_ctes("fact_decision", "plain")
_FULL = _verdict_ctes("banded", "full")


@query(
    "verdict_policy",
    with_ctes("SELECT BRE_RUN_ID, VERDICT_POLICY_ALONE FROM plain_verdicts", "fact_decision", *_PLAIN),
)
def verdict_policy(spark, sf):
    return R.with_verdicts(R.apply_rules(P.fact(spark, sf))).select("BRE_RUN_ID", "VERDICT_POLICY_ALONE")


@query(
    "verdict_with_external",
    with_ctes("SELECT BRE_RUN_ID, VERDICT_POLICY_WITH_FB FROM plain_verdicts", "fact_decision", *_PLAIN),
)
def verdict_with_external(spark, sf):
    return R.with_verdicts(R.apply_rules(P.fact(spark, sf))).select("BRE_RUN_ID", "VERDICT_POLICY_WITH_FB")


_DOUBLES = {_E, "BR_PD", "LOGODDS_BR", "TRX_PD", "LOGODDS_TRX", "SMS_PD", "LOGODDS_SMS", "COMBINED_PD",
            "COMBINED_LOGODDS", "CALIB_PD"}
_MASTER_SQL = ", ".join(
    "'XGBOOST' AS MODEL_TYPE" if c == "MODEL_TYPE" else f"{s6(c)} AS {c}" if c in _DOUBLES else c
    for c in S.MASTER_COLUMNS
)


@query("decided_rows", with_ctes(f"SELECT {_MASTER_SQL} FROM full_verdicts", *_TO_BANDED, *_FULL))
def decided_rows(spark, sf):
    """Every decision with all columns of the master."""
    return rounded(D.decided(_blended(spark, sf)))


@query(
    "verdicts_by_band",
    with_ctes(
        "SELECT RISK_BANDS, COMBINATION_TYPE, VERDICT_POLICY_ALONE, VERDICT_POLICY_WITH_FB, count(*) AS N,"
        f" {s6('avg(CALIB_PD)')} AS MEAN_CALIB_PD FROM full_verdicts GROUP BY ALL",
        *_TO_BANDED, *_FULL,
    ),
)
def verdicts_by_band(spark, sf):
    rows = D.decided(_blended(spark, sf))
    keys = ["RISK_BANDS", "COMBINATION_TYPE", "VERDICT_POLICY_ALONE", "VERDICT_POLICY_WITH_FB"]
    return rounded(
        rows.groupBy(*keys).agg(F.count("*").alias("N"), F.avg("CALIB_PD").alias("MEAN_CALIB_PD"))
    )


# --- logistic-regression blend ---------------------------------------------

CTES["lr_joined"] = (
    "SELECT a.USER_ID, a.BRE_RUN_ID, cast(a.DISBURSED_DATE AS string) AS DISBURSED_DATE, a.PRED_TRAIN AS ACT_PRED,"
    f" {logit_sql('a.PRED_TRAIN')} AS ACT_LOGODDS, a.{S.ACTIVITY_FLAG}, t.PRED_TRAIN AS TXN_PRED,"
    f" {logit_sql('t.PRED_TRAIN')} AS TRX_LOGODDS, t.{S.LEDGER_FLAG}, b.PRED_TRAIN AS BR_PRED,"
    f" {logit_sql('b.PRED_TRAIN')} AS BR_LOGODDS, b.{S.BUREAU_FLAG}"
    " FROM (SELECT DISTINCT * FROM raw_activity) a LEFT JOIN (SELECT DISTINCT * FROM raw_transaction) t"
    " USING (BRE_RUN_ID) LEFT JOIN (SELECT DISTINCT * FROM raw_bureau) b USING (BRE_RUN_ID)"
)
CTES["lr_scored"] = (
    "SELECT *, CASE WHEN " + f"{S.ACTIVITY_FLAG} AND {S.LEDGER_FLAG} AND {S.BUREAU_FLAG} AND ACT_PRED IS NOT NULL"
    " AND TXN_PRED IS NOT NULL AND BR_PRED IS NOT NULL AND USER_ID IS NOT NULL AND DISBURSED_DATE IS NOT NULL"
    " THEN 0.35e0*TRX_LOGODDS + 0.4e0*BR_LOGODDS + 0.25e0*ACT_LOGODDS END AS COMB_SCORE FROM lr_joined"
)
CTES["lr_blended"] = (
    f"SELECT *, {sigmoid_sql('COMB_SCORE')} AS PD_SCORE, {_calibrated_sql('COMB_SCORE', CALIBRATION)} AS CALIB_PD"
    " FROM lr_scored"
)
_LR_CTES = ("raw_activity", "raw_transaction", "raw_bureau", "lr_joined", "lr_scored", "lr_blended")
_LR_DOUBLES = ["ACT_PRED", "ACT_LOGODDS", "TXN_PRED", "TRX_LOGODDS", "BR_PRED", "BR_LOGODDS",
               "COMB_SCORE", "PD_SCORE", "CALIB_PD"]
_LR_PLAIN = ["USER_ID", "BRE_RUN_ID", "DISBURSED_DATE", S.ACTIVITY_FLAG, S.LEDGER_FLAG, S.BUREAU_FLAG]


def _lr_blended(spark, sf):
    parts = {m: P.result_rows(spark, sf, m).distinct() for m in ("activity", "transaction", "bureau")}
    joined = B.join_lr_modules(parts["activity"], parts["transaction"], parts["bureau"])
    return B.lr_blend(joined, 25, 35, 40, CALIBRATION)


@query(
    "lr_blend",
    with_ctes(
        "SELECT " + ", ".join([*_LR_PLAIN, *[f"{s6(c)} AS {c}" for c in _LR_DOUBLES]]) + " FROM lr_blended",
        *_LR_CTES,
    ),
)
def lr_blend(spark, sf):
    return rounded(_lr_blended(spark, sf))


THRESHOLDS = {"ACT_PRED": [0.1, 0.2], "TXN_PRED": [0.15], "BR_PRED": [0.15, 0.3], "CALIB_PD": [0.03, 0.05, 0.08]}


def _threshold_sql():
    parts = []
    for score, limits in THRESHOLDS.items():
        for i, t in enumerate(limits, 1):
            model = f"CASE WHEN {score} IS NULL THEN 'NOT_DECIDED' WHEN {score} > {t} THEN 'FAIL' ELSE 'PASS' END"
            parts.append(f"{model} AS {score}_VERDICT_MODEL_THRESH_{i}")
            parts.append(
                f"CASE WHEN VERDICT_POLICY_ALONE = 'FAIL' OR {model} = 'FAIL' THEN 'FAIL'"
                f" WHEN {model} = 'NOT_DECIDED' THEN 'NOT_DECIDED' ELSE 'PASS' END"
                f" AS {score}_VERDICT_POLICY_AND_MODEL_THRESH_{i}"
            )
    return ", ".join(parts)


@query(
    "threshold_verdicts",
    with_ctes(
        f"SELECT BRE_RUN_ID, VERDICT_POLICY_ALONE, {_threshold_sql()}"
        " FROM lr_blended JOIN plain_verdicts USING (BRE_RUN_ID)",
        *_LR_CTES, "fact_decision", *_PLAIN,
    ),
)
def threshold_verdicts(spark, sf):
    scores = _lr_blended(spark, sf).select("BRE_RUN_ID", *THRESHOLDS)
    decided = D.lr_decided(P.fact(spark, sf).join(scores, ["BRE_RUN_ID"]), THRESHOLDS)
    return decided.select(
        "BRE_RUN_ID", "VERDICT_POLICY_ALONE", *[c for c in decided.columns if "_THRESH_" in c]
    )


# --- policies ---------------------------------------------------------------


def _num(c):
    return f"try_cast({c} AS double)"


def _ok(condition):
    return f"coalesce({condition}, false)"


_SHARED_SQL = [
    _ok(f"{_num(c)} = 0")
    for c in (
        "NEGATIVEACCOUNSTATUS_24MONTHS_FOR_RULE", "WRITTEN_OFF_SETTLED_24MONTHS_CNT_FOR_RULE",
        "SUITFILED_WILFULDEFAULT_24MONTHS_FOR_RULE",
        "SUITFILEDWILLFULDEFAULTWRITTENOFFSTATUS_24MONTHS_FOR_RULE",
        "PAYMENTHISTORYPROFILE_12MONTHS_FOR_RULE",
    )
] + [_ok("WRITTEN_OFF_AMT_TOTAL_FOR_RULE <= 500"), _ok("OVERALL_BOUNCE_M0123 < 5")]
_ACCOUNT_SQL = [
    _ok("SCORE_XSELL >= 550"), _ok("MAX_DPD_6_MONTHS_UNSECURED_FOR_RULE < 15"),
    _ok("ACCOUNTS_GT1L_OPEN_IN_60DAYS_FOR_RULE <= 3"), _ok("ACCOUNTS_LTE1L_OPEN_IN_60DAYS_FOR_RULE <= 5"),
    _ok("MAX_DPD_6_MONTHS_SECURED_FOR_RULE < 15"), _ok("ACTIVE_ACCOUNTS_FOR_RULE < 15"),
    _ok(f"{_num('REQUEST_180_DAYS_FOR_RULE')} < 15"), _ok("CNT_DELINQUNCY_LOAN_C30 < 3"),
]
_NO_BOUNCE = "NOT (coalesce(AUTO_DEBIT_BOUNCE_M0, '') = 'TRUE' OR coalesce(AUTO_DEBIT_BOUNCE_M1, '') = 'TRUE')"
_M0_CLEAR = _ok("AUTO_DEBIT_BOUNCE_M0 = 'FALSE'")
_BUREAU_650 = _ok(f"BUREAUSCORE = '' OR {_num('BUREAUSCORE')} >= 650")
_BUREAU_700 = _ok(f"BUREAUSCORE = '' OR {_num('BUREAUSCORE')} >= 700")
_EXTERNAL = _ok(
    f"CASE WHEN {_num('BUREAUSCORE')} >= 300 AND {_num('BUREAUSCORE')} < 700 THEN {_E} <= 0.0354 ELSE {_E} <= 0.0284 END"
)
POLICY_SQL = {
    "w": [*_SHARED_SQL, *_ACCOUNT_SQL, _BUREAU_650, _ok("AMOUNT_PAST_DUE_FOR_RULE <= 5000"), _NO_BOUNCE],
    "1_9_b": [*_SHARED_SQL, *_ACCOUNT_SQL, _BUREAU_650, _NO_BOUNCE, _M0_CLEAR],
    "1_8_1": [*_SHARED_SQL, *_ACCOUNT_SQL, _M0_CLEAR],
    "1_8_0": [*_SHARED_SQL, _BUREAU_700, _NO_BOUNCE, _ok("MAX_DPD_2_YEARS_FOR_RULE <= 30"), _EXTERNAL],
}


def _reject_sql(policy):
    return "CASE WHEN " + " AND ".join(f"({c})" for c in POLICY_SQL[policy]) + " THEN 0 ELSE 1 END"


def _policy_query(policy):
    def run(spark, sf):
        return P.fact(spark, sf, "policy").select("BRE_RUN_ID", PO.policy_reject(policy).alias("REJECT"))

    return run


for _p in POLICY_SQL:
    query(
        f"policy_{_p}",
        with_ctes(f"SELECT BRE_RUN_ID, {_reject_sql(_p)} AS REJECT FROM fact_policy", "fact_policy"),
    )(_policy_query(_p))

CTES["policy_flags"] = (
    "SELECT p.BRE_RUN_ID, VERDICT_POLICY_ALONE, "
    + ", ".join(f"{_reject_sql(p)} AS POLICY_{p.upper()}" for p in POLICY_SQL)
    + " FROM fact_policy p JOIN (SELECT BRE_RUN_ID, VERDICT_POLICY_ALONE FROM plain_verdicts) v USING (BRE_RUN_ID)"
)


@query(
    "policy_cascade",
    with_ctes(
        "SELECT *, CASE WHEN POLICY_W = 0 THEN 'w' WHEN VERDICT_POLICY_ALONE = 'PASS' THEN '1_9_a'"
        " WHEN POLICY_1_9_B = 0 THEN '1_9_b' WHEN POLICY_1_8_0 = 0 THEN '1_8_0' WHEN POLICY_1_8_1 = 0 THEN '1_8_1'"
        " END AS ACCEPTED_BY, CASE WHEN POLICY_W = 0 OR VERDICT_POLICY_ALONE = 'PASS' OR POLICY_1_9_B = 0"
        " OR POLICY_1_8_0 = 0 OR POLICY_1_8_1 = 0 THEN 'pass' ELSE 'fail' END AS POLICY_CASCADE FROM policy_flags",
        "fact_decision", *_PLAIN, "fact_policy", "policy_flags",
    ),
)
def policy_cascade(spark, sf):
    verdicts = R.with_verdicts(R.apply_rules(P.fact(spark, sf))).select("BRE_RUN_ID", "VERDICT_POLICY_ALONE")
    rows = PO.with_cascade(PO.with_policies(P.fact(spark, sf, "policy").join(verdicts, ["BRE_RUN_ID"])))
    return rows.select(
        "BRE_RUN_ID", "VERDICT_POLICY_ALONE", *[f"POLICY_{p.upper()}" for p in POLICY_SQL],
        "ACCEPTED_BY", "POLICY_CASCADE",
    )


# --- upsert -----------------------------------------------------------------

_KEPT = ["CUSTOMER_ID", "BRE_RUN_ID", "MODEL_TYPE", "BRE_RUN_DATE", "VERDICT"]
CTES["upsert_target"] = (
    "SELECT ' ' || cast(o_custkey AS string) AS CUSTOMER_ID, 'R' || cast(o_orderkey AS string) AS BRE_RUN_ID,"
    " 'XGBOOST' AS MODEL_TYPE, cast(o_orderdate AS date) AS BRE_RUN_DATE, 'old' AS VERDICT"
    " FROM orders WHERE o_orderstatus <> 'P'"
)
CTES["upsert_source"] = (
    "SELECT cast(o_custkey AS string) || ' ' AS CUSTOMER_ID, ' R' || cast(o_orderkey AS string) AS BRE_RUN_ID,"
    " 'XGBOOST ' AS MODEL_TYPE, cast(o_orderdate AS date) AS BRE_RUN_DATE, 'new' AS VERDICT"
    " FROM orders WHERE o_orderpriority < '4' UNION ALL"
    " SELECT cast(o_custkey AS string), 'R' || cast(o_orderkey AS string), 'XGBOOST',"
    " cast(o_orderdate AS date) - INTERVAL 1 DAY, 'stale' FROM orders WHERE o_orderpriority < '2'"
)


@query(
    "upsert_master",
    with_ctes(
        "SELECT CUSTOMER_ID, BRE_RUN_ID, MODEL_TYPE, cast(cast(BRE_RUN_DATE AS date) AS string) AS BRE_RUN_DATE,"
        " VERDICT FROM upsert_target t WHERE NOT EXISTS (SELECT 1 FROM upsert_source s"
        " WHERE trim(s.CUSTOMER_ID) = trim(t.CUSTOMER_ID) AND trim(s.BRE_RUN_ID) = trim(t.BRE_RUN_ID)"
        " AND trim(s.MODEL_TYPE) = trim(t.MODEL_TYPE))"
        " UNION ALL SELECT CUSTOMER_ID, BRE_RUN_ID, MODEL_TYPE,"
        " cast(cast(BRE_RUN_DATE AS date) AS string) AS BRE_RUN_DATE, VERDICT FROM upsert_source"
        " QUALIFY row_number() OVER (PARTITION BY trim(CUSTOMER_ID), trim(BRE_RUN_ID), trim(MODEL_TYPE)"
        " ORDER BY BRE_RUN_DATE DESC) = 1",
        "upsert_target", "upsert_source",
    ),
)
def upsert_master(spark, sf):
    """Merged against the stored master, written as a new snapshot and read back."""
    orders = P.table(spark, sf, "orders")
    run, customer = "cast(o_orderkey as string)", "cast(o_custkey as string)"
    target = orders.where("o_orderstatus <> 'P'").selectExpr(
        f"' ' || {customer} as CUSTOMER_ID", f"'R' || {run} as BRE_RUN_ID", "'XGBOOST' as MODEL_TYPE",
        "cast(o_orderdate as date) as BRE_RUN_DATE", "'old' as VERDICT",
    )
    fresh = orders.where("o_orderpriority < '4'").selectExpr(
        f"{customer} || ' ' as CUSTOMER_ID", f"' R' || {run} as BRE_RUN_ID", "'XGBOOST ' as MODEL_TYPE",
        "cast(o_orderdate as date) as BRE_RUN_DATE", "'new' as VERDICT",
    )
    stale = orders.where("o_orderpriority < '2'").selectExpr(
        f"{customer} as CUSTOMER_ID", f"'R' || {run} as BRE_RUN_ID", "'XGBOOST' as MODEL_TYPE",
        "date_sub(cast(o_orderdate as date), 1) as BRE_RUN_DATE", "'stale' as VERDICT",
    )
    root = shared_folder(spark)
    stored = spark.read.parquet(sinks.write_snapshot(target, f"{root}/master/run=1"))
    merged = upsert(stored, fresh.unionByName(stale))
    path = sinks.write_snapshot(merged, f"{root}/master/run=2")
    return rounded(spark.read.parquet(path).select(*_KEPT))
