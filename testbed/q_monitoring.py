"""The monitoring job end to end: decisions, outcomes, matured rows, metrics and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.functions import month_label
from loanlens.operators.gini import GINI_SCORES, gini_metrics
from loanlens.operators.ks import KS_SCORES, ks_statistic, ks_table
from loanlens.operators.psi import DriftModule
from loanlens.plans import decisions as D
from loanlens.plans import monitoring as M
from loanlens.session import stored
from loanlens.sources import schemas as S
from loanlens.sources.assets import Roles
from testbed import proxies as P
from testbed.q_decisions import _FULL, _TO_BANDED, _blended
from testbed.q_metrics import SINCE, gini_ctes, numeric_psi_ctes
from testbed.registry import CTES, query, rounded, s6, with_ctes

PAID_FROM, PAID_TO, LABELLED_SINCE, AS_OF = "1996-01-01", "2001-12-31", "1996-06-01", "2001-06-30"

CTES["job_loans"] = (
    "SELECT * FROM repayments QUALIFY row_number() OVER (PARTITION BY USER_ID, LOAN_ID, DISBURSED_DATE"
    " ORDER BY EVER_15DPD_IN_90DAYS DESC, VENDOR, STATUS, EVER_30DPD_IN_90DAYS) = 1"
)
CTES["job_latest"] = (
    "SELECT l.USER_ID, l.LOAN_ID, l.DISBURSED_DATE, l.EVER_15DPD_IN_90DAYS, d.BRE_RUN_ID FROM job_loans l"
    " JOIN full_verdicts d ON l.USER_ID = trim(d.CUSTOMER_ID) AND l.DISBURSED_DATE >= cast(d.BRE_RUN_DATE AS date)"
    " QUALIFY row_number() OVER (PARTITION BY l.USER_ID, l.LOAN_ID, l.DISBURSED_DATE"
    " ORDER BY d.BRE_RUN_DATE DESC, d.BRE_RUN_ID DESC) = 1"
)
CTES["job_rows"] = (
    "SELECT a.*, 'XGBOOST' AS MODEL_TYPE, p.LOAN_ID, p.EVER_15DPD_IN_90DAYS, p.DISBURSED_DATE FROM full_verdicts a"
    " JOIN job_latest p USING (BRE_RUN_ID)"
    f" WHERE p.DISBURSED_DATE >= date '{PAID_FROM}' AND p.DISBURSED_DATE <= date '{PAID_TO}'"
    f" AND cast(a.BRE_RUN_DATE AS date) >= date '{LABELLED_SINCE}'"
    f" AND p.DISBURSED_DATE < date '{AS_OF}' - INTERVAL 3 MONTH"
)
_JOB = (*_TO_BANDED, *_FULL, "repayments", "job_loans", "job_latest", "job_rows")


def _master(spark, sf, columns=S.MASTER_COLUMNS):
    """The decided master, stored as its table, or the columns of it that a job reads beside its key and day."""
    read = [c for c in S.MASTER_COLUMNS if c in {"CUSTOMER_ID", "BRE_RUN_ID", "BRE_RUN_DATE", "MODEL_TYPE", *columns}]
    return stored(D.decided(_blended(spark, sf)).select(*read), "master")


def _matured(spark, sf, master):
    """The matured rows of the master with their outcomes, for one reader: only the columns that are read are joined."""
    return M.matured_outcomes(master, P.repayments(spark, sf), PAID_FROM, PAID_TO, AS_OF, LABELLED_SINCE)


@query(
    "job_gini",
    with_ctes(
        f"SELECT METRIC, MODEL_TYPE, MONTH_YEAR, BADS, GOODS, {s6('GINI')} AS GINI FROM job_gini_values",
        *_JOB, *gini_ctes("job_gini", "job_rows"),
    ),
)
def job_gini(spark, sf):
    columns = [c for pair in GINI_SCORES for c in pair if c]
    return rounded(gini_metrics(_matured(spark, sf, _master(spark, sf, columns)), SINCE))


_CUTS = "CASE WHEN {0} IS NULL THEN NULL WHEN {0} <= 0.0162 THEN 1 WHEN {0} <= 0.026 THEN 2 WHEN {0} <= 0.0392 THEN 3 WHEN {0} <= 0.0532 THEN 4 ELSE 5 END"
CTES["job_ks_long"] = " UNION ALL ".join(
    f"SELECT '{s}' AS SCORE, {s} AS P, EVER_15DPD_IN_90DAYS AS Y, {_CUTS.format(s)} AS B FROM job_rows"
    for s in ("CALIB_PD", "SMS_PD", "TRX_PD", "BR_PD")
)
CTES["job_ks_steps"] = (
    "SELECT SCORE, b.i AS BUCKET, min(P) FILTER (WHERE B = b.i) AS low,"
    " coalesce(sum(Y) FILTER (WHERE B = b.i), 0) / sum(Y)::double AS db,"
    " coalesce(sum(1 - Y) FILTER (WHERE B = b.i), 0) / sum(1 - Y)::double AS dg"
    " FROM job_ks_long CROSS JOIN (SELECT unnest(range(1, 6)) AS i) b GROUP BY SCORE, b.i"
)
CTES["job_ks_gaps"] = (
    "SELECT SCORE, row_number() OVER w AS DECILE, round_even((sum(dg) OVER w - sum(db) OVER w) * 1000, 0) / 1000 * 100"
    " AS gap FROM job_ks_steps WINDOW w AS (PARTITION BY SCORE ORDER BY low NULLS LAST, BUCKET"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)


@query(
    "job_ks",
    with_ctes(
        f"SELECT SCORE || '_XGBOOST' AS PRED_COL, SCORE, 'XGBOOST' AS MODEL_TYPE, {s6('gap')} AS KS,"
        " cast(DECILE AS integer) AS DECILE FROM job_ks_gaps"
        " QUALIFY row_number() OVER (PARTITION BY SCORE ORDER BY gap DESC, DECILE) = 1",
        *_JOB, "job_ks_long", "job_ks_steps", "job_ks_gaps",
    ),
)
def job_ks(spark, sf):
    return rounded(ks_statistic(ks_table(_matured(spark, sf, _master(spark, sf, KS_SCORES)))))


FEATURES = ["KB_AGE", "TOTAL_TXN_AMNT"]
BASELINE_END = "1997-01-01"
CTES["job_drift_rows"] = (
    "SELECT 'new' AS side, f.KB_AGE, f.TOTAL_TXN_AMNT, r.TRX_PD, r.SMS_PD, r.BR_PD, r.CALIB_PD,"
    f" r.{S.LEDGER_FLAG}, r.DISBURSED_DATE AS DAY FROM job_rows r LEFT JOIN fact_transaction f USING (BRE_RUN_ID)"
    " UNION ALL SELECT 'old', f.KB_AGE, f.TOTAL_TXN_AMNT, v.TRX_PD, v.SMS_PD, v.BR_PD, v.CALIB_PD, NULL, NULL"
    " FROM full_verdicts v JOIN fact_transaction f USING (BRE_RUN_ID)"
    f" WHERE cast(v.BRE_RUN_DATE AS date) < date '{BASELINE_END}'"
)
_OLD = "side = 'old'"
_MODULES = [("transaction_module", [*FEATURES, "TRX_PD"], f"side = 'new' AND TRX_PD IS NOT NULL AND {S.LEDGER_FLAG}"),
            ("combination_module_xg", ["TRX_PD", "SMS_PD", "BR_PD", "CALIB_PD"], "side = 'new' AND CALIB_PD IS NOT NULL")]
_DRIFT = numeric_psi_ctes(
    "j", [(m, c, _OLD) for m, cs, _ in _MODULES for c in cs], [(m, c, rows) for m, cs, rows in _MODULES for c in cs],
    "job_drift_rows", "quantiles",
)


@query(
    "job_drift",
    with_ctes(
        f"SELECT upper(MODULE) AS COL_MODULE, L AS PSI_MONTH, VAR AS PSI_VAR, {s6('PSI')} AS PSI FROM psi_num_j",
        *_JOB, "fact_transaction", "job_drift_rows", *_DRIFT,
    ),
)
def job_drift(spark, sf):
    """Fact features and scores of the matured rows against the decisions of the first years."""
    scores = ["TRX_PD", "SMS_PD", "BR_PD", "CALIB_PD"]
    master = _master(spark, sf, [*scores, S.LEDGER_FLAG])
    matured = _matured(spark, sf, master)
    rows = matured.withColumn("MONTH_YEAR", month_label("DISBURSED_DATE"))
    fact = P.fact(spark, sf, "transaction").select("CUSTOMER_ID", "BRE_RUN_ID", *FEATURES)
    first = master.where(F.col("BRE_RUN_DATE") < BASELINE_END)
    baseline = stored(
        first.select("BRE_RUN_ID", *scores).join(
            fact.drop("CUSTOMER_ID"), ["BRE_RUN_ID"]
        ),
        "drift_baseline",
    )
    specs = [
        DriftModule("transaction_module", "TRX_PD", Roles(tuple(FEATURES)), baseline, S.LEDGER_FLAG),
        DriftModule(M.BLEND_MODULE, "CALIB_PD", M.BLEND_ROLES, baseline),
    ]
    return rounded(M.drift_report(rows, fact, specs))


