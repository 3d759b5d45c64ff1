"""As-of join, labelled master and the joins after it."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.operators.outcomes import as_of_latest_run, features_for_master
from loanlens.plans.monitoring import attach_outcomes
from loanlens.session import shared_folder
from loanlens.sources import scans, sinks
from loanlens.sources import schemas as S
from testbed import proxies as P
from testbed.registry import CTES, query, rounded, s6, with_ctes

PAID_FROM, PAID_TO, LABELLED_SINCE = "1996-01-01", "2000-12-31", "1997-01-01"
AS_OF = "2000-06-15"

CTES["master"] = (
    "SELECT d.CUSTOMER_ID, d.BRE_RUN_ID, d.BRE_RUN_DATE, d.BUREAUSCORE, m.MODEL_TYPE FROM fact_decision d,"
    " (VALUES ('XGBOOST'), ('LOGISTIC_REGRESSION')) m(MODEL_TYPE)"
)
CTES["loans"] = (
    "SELECT * FROM repayments QUALIFY row_number() OVER (PARTITION BY USER_ID, LOAN_ID, DISBURSED_DATE"
    " ORDER BY EVER_15DPD_IN_90DAYS DESC, VENDOR, STATUS, EVER_30DPD_IN_90DAYS) = 1"
)
CTES["paired"] = (
    "SELECT l.*, d.BRE_RUN_DATE, d.BRE_RUN_ID, row_number() OVER (PARTITION BY l.USER_ID, l.LOAN_ID, l.DISBURSED_DATE"
    " ORDER BY d.BRE_RUN_DATE DESC NULLS LAST, d.BRE_RUN_ID DESC NULLS LAST) AS n"
    " FROM loans l LEFT JOIN fact_decision d ON l.USER_ID = trim(d.CUSTOMER_ID)"
    " AND l.DISBURSED_DATE >= d.BRE_RUN_DATE"
)
CTES["latest"] = "SELECT * EXCLUDE (n) FROM paired WHERE n = 1"
CTES["labelled"] = (
    "SELECT a.*, p.LOAN_ID, p.VENDOR, p.STATUS, p.EVER_15DPD_IN_90DAYS, p.DISBURSED_DATE FROM master a"
    f" LEFT JOIN (SELECT * FROM latest WHERE DISBURSED_DATE >= date '{PAID_FROM}'"
    f" AND DISBURSED_DATE <= date '{PAID_TO}') p ON trim(a.CUSTOMER_ID) = p.USER_ID"
    f" AND a.BRE_RUN_ID = p.BRE_RUN_ID AND a.BRE_RUN_DATE >= date '{LABELLED_SINCE}'"
)
_AS_OF = ("fact_decision", "repayments", "loans", "paired", "latest")
_LABELLED = ("fact_decision", "master", "repayments", "loans", "paired", "latest", "labelled")


def master(spark, sf):
    models = F.explode(F.array(F.lit("XGBOOST"), F.lit("LOGISTIC_REGRESSION")))
    return P.fact(spark, sf).select(
        "CUSTOMER_ID", "BRE_RUN_ID", "BRE_RUN_DATE", "BUREAUSCORE", models.alias("MODEL_TYPE")
    )


def labelled(spark, sf):
    return attach_outcomes(master(spark, sf), P.repayments(spark, sf), PAID_FROM, PAID_TO, LABELLED_SINCE)


_LOAN = "USER_ID, LOAN_ID, cast(DISBURSED_DATE AS string) AS DISBURSED_DATE"


@query(
    "asof_latest_run",
    with_ctes(
        f"SELECT {_LOAN}, VENDOR, STATUS, EVER_15DPD_IN_90DAYS, EVER_30DPD_IN_90DAYS, cast(BRE_RUN_DATE AS string) AS BRE_RUN_DATE,"
        " BRE_RUN_ID, cast(date_diff('day', BRE_RUN_DATE, DISBURSED_DATE) AS integer) AS DAYS_DIFF FROM latest",
        *_AS_OF,
    ),
)
def asof_latest_run(spark, sf):
    rows = as_of_latest_run(P.repayments(spark, sf), master(spark, sf))
    return rounded(
        rows.select(
            *S.REPAYMENT_KEYS, "VENDOR", "STATUS", S.OUTCOME_LABEL, "EVER_30DPD_IN_90DAYS",
            "BRE_RUN_DATE", "BRE_RUN_ID", "DAYS_DIFF",
        )
    )


_LABELLED_COLUMNS = (
    "CUSTOMER_ID, BRE_RUN_ID, cast(BRE_RUN_DATE AS string) AS BRE_RUN_DATE, BUREAUSCORE, MODEL_TYPE, LOAN_ID,"
    " VENDOR, STATUS, EVER_15DPD_IN_90DAYS, cast(DISBURSED_DATE AS string) AS DISBURSED_DATE"
)


@query("labelled_master", with_ctes(f"SELECT {_LABELLED_COLUMNS} FROM labelled", *_LABELLED))
def labelled_master_query(spark, sf):
    return rounded(labelled(spark, sf))


@query(
    "labelled_master_table",
    with_ctes(
        "SELECT MODEL_TYPE, STATUS, count(*) AS N, count(LOAN_ID) AS LOANS,"
        " cast(coalesce(sum(EVER_15DPD_IN_90DAYS), 0) AS bigint) AS BADS FROM labelled GROUP BY MODEL_TYPE, STATUS",
        *_LABELLED,
    ),
)
def labelled_master_table(spark, sf):
    """Created (or replaced) as a stored table by payout status, then scanned."""
    path = sinks.overwrite_path(
        labelled(spark, sf), shared_folder(spark), "verdict_with_bad_flag", "MASTER", partition_by=["MODEL_TYPE"]
    )
    return sinks.read_path(spark, path).groupBy("MODEL_TYPE", "STATUS").agg(
        F.count("*").alias("N"),
        F.count("LOAN_ID").alias("LOANS"),
        F.coalesce(F.sum(S.OUTCOME_LABEL), F.lit(0)).alias("BADS"),
    )


@query(
    "matured_master",
    with_ctes(
        f"SELECT {_LABELLED_COLUMNS} FROM labelled WHERE DISBURSED_DATE < date '{AS_OF}' - INTERVAL 3 MONTH",
        *_LABELLED,
    ),
)
def matured_master(spark, sf):
    return rounded(scans.matured(labelled(spark, sf), AS_OF))


@query(
    "fact_right_join",
    with_ctes(
        "SELECT f.CUSTOMER_ID, f.BRE_RUN_ID, cast(f.BRE_RUN_DATE AS string) AS BRE_RUN_DATE, f.OVERALL_BOUNCE_M0123,"
        f" {s6('f.' + S.EXTERNAL_SCORE)} AS {S.EXTERNAL_SCORE}, b.MODEL_TYPE, b.LOAN_ID, b.EVER_15DPD_IN_90DAYS"
        " FROM (SELECT * FROM fact_decision WHERE DAYS_SINCE_LAST_TXN <= 90) f RIGHT JOIN labelled b"
        " ON trim(f.CUSTOMER_ID) = trim(b.CUSTOMER_ID) AND trim(f.BRE_RUN_ID) = trim(b.BRE_RUN_ID)",
        *_LABELLED,
    ),
)
def fact_right_join(spark, sf):
    """Master rows whose fact row is not among the recent ones keep NULL features."""
    fact = P.fact(spark, sf).where(scans.used_recently(90)).select(
        "CUSTOMER_ID", "BRE_RUN_ID", "BRE_RUN_DATE", "OVERALL_BOUNCE_M0123", S.EXTERNAL_SCORE
    )
    return rounded(
        features_for_master(labelled(spark, sf), fact, ["MODEL_TYPE", "LOAN_ID", S.OUTCOME_LABEL])
    )
