"""Credit policies that reject a decision when any criterion does.

A criterion states when it accepts.  A missing input rejects; the debit-bounce
criterion is the exception, it accepts unless a bounce is known.  The text
"NULL" counts as missing.  Scores are 1 for reject and 0 for accept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import number, same_text
from loanlens.operators.rules import FAIL
from loanlens.sources.schemas import EXTERNAL_SCORE

# Criterion -> column, comparison, limit.
NUMERIC_CRITERIA: dict[str, tuple[str, str, float]] = {
    "cross_sell_score": ("SCORE_XSELL", ">=", 550),
    "dpd_unsecured": ("MAX_DPD_6_MONTHS_UNSECURED_FOR_RULE", "<", 15),
    "dpd_secured": ("MAX_DPD_6_MONTHS_SECURED_FOR_RULE", "<", 15),
    "new_large_accounts": ("ACCOUNTS_GT1L_OPEN_IN_60DAYS_FOR_RULE", "<=", 3),
    "new_small_accounts": ("ACCOUNTS_LTE1L_OPEN_IN_60DAYS_FOR_RULE", "<=", 5),
    "active_accounts": ("ACTIVE_ACCOUNTS_FOR_RULE", "<", 15),
    "enquiries": ("REQUEST_180_DAYS_FOR_RULE", "<", 15),
    "past_due": ("AMOUNT_PAST_DUE_FOR_RULE", "<=", 5000),
    "negative_status": ("NEGATIVEACCOUNSTATUS_24MONTHS_FOR_RULE", "=", 0),
    "written_off_amount": ("WRITTEN_OFF_AMT_TOTAL_FOR_RULE", "<=", 500),
    "written_off_settled": ("WRITTEN_OFF_SETTLED_24MONTHS_CNT_FOR_RULE", "=", 0),
    "bounces": ("OVERALL_BOUNCE_M0123", "<", 5),
    "delinquent_loans": ("CNT_DELINQUNCY_LOAN_C30", "<", 3),
    "wilful_default": ("SUITFILED_WILFULDEFAULT_24MONTHS_FOR_RULE", "=", 0),
    "wilful_written_off": ("SUITFILEDWILLFULDEFAULTWRITTENOFFSTATUS_24MONTHS_FOR_RULE", "=", 0),
    "payment_history": ("PAYMENTHISTORYPROFILE_12MONTHS_FOR_RULE", "=", 0),
    "dpd_two_years": ("MAX_DPD_2_YEARS_FOR_RULE", "<=", 30),
}

_SHARED = (
    "written_off_amount", "written_off_settled", "bounces", "negative_status",
    "wilful_default", "wilful_written_off", "payment_history",
)
_ACCOUNT_LIMITS = (
    "cross_sell_score", "dpd_unsecured", "dpd_secured", "new_large_accounts",
    "new_small_accounts", "active_accounts", "enquiries", "delinquent_loans",
)

# The criteria of each policy.  Total credit is in none of them.
POLICIES: dict[str, tuple[str, ...]] = {
    "w": (*_SHARED, *_ACCOUNT_LIMITS, "bureau_650", "past_due", "no_debit_bounce"),
    "1_9_b": (*_SHARED, *_ACCOUNT_LIMITS, "bureau_650", "no_debit_bounce", "debit_clear_m0"),
    "1_8_1": (*_SHARED, *_ACCOUNT_LIMITS, "debit_clear_m0"),
    "1_8_0": (*_SHARED, "bureau_700", "no_debit_bounce", "dpd_two_years", "external_score"),
}

# Order in which the cascade asks the policies; 1_9_a is the rule verdict.
CASCADE = ("w", "1_9_a", "1_9_b", "1_8_0", "1_8_1")

_COMPARE = {
    ">=": lambda value, limit: value >= limit,
    "<=": lambda value, limit: value <= limit,
    "<": lambda value, limit: value < limit,
    "=": lambda value, limit: value == limit,
}


def _bureau_blank() -> Column:
    return F.coalesce(F.col("BUREAUSCORE").cast("string") == "", F.lit(False))


def _bureau_at_least(limit: float) -> Column:
    return _bureau_blank() | (number("BUREAUSCORE") >= limit)


def _external_accepts() -> Column:
    """The lower limit holds without a bureau score, below 300 and from 700 on."""
    bureau = number("BUREAUSCORE")
    external = F.col(EXTERNAL_SCORE)
    middle = (bureau >= 300) & (bureau < 700)
    return F.when(middle, external <= 0.0354).otherwise(external <= 0.0284)


def criterion(name: str) -> Column:
    """True where the criterion accepts; never NULL."""
    if name in NUMERIC_CRITERIA:
        column, comparison, limit = NUMERIC_CRITERIA[name]
        accepts = _COMPARE[comparison](number(column), F.lit(float(limit)))
    elif name == "no_debit_bounce":
        bounced = same_text("AUTO_DEBIT_BOUNCE_M0", "true") | same_text(
            "AUTO_DEBIT_BOUNCE_M1", "true"
        )
        accepts = ~F.coalesce(bounced, F.lit(False))
    elif name == "debit_clear_m0":
        accepts = same_text("AUTO_DEBIT_BOUNCE_M0", "false")
    elif name == "bureau_650":
        accepts = _bureau_at_least(650)
    elif name == "bureau_700":
        accepts = _bureau_at_least(700)
    elif name == "external_score":
        accepts = _external_accepts()
    else:
        raise KeyError(name)
    return F.coalesce(accepts, F.lit(False))


def policy_reject(policy: str) -> Column:
    """1 when any criterion of the policy rejects, else 0.

    In policy 1_8_0 a payment history of 0 accepts, as in the other policies;
    its original wording rejected every row.
    """
    accepted = F.lit(True)
    for name in POLICIES[policy]:
        accepted = accepted & criterion(name)
    return F.when(accepted, F.lit(0)).otherwise(F.lit(1))


def with_policies(df: DataFrame) -> DataFrame:
    """One 0/1 column ``POLICY_{name}`` per policy."""
    return df.withColumns({f"POLICY_{p.upper()}": policy_reject(p) for p in POLICIES})


def with_cascade(df: DataFrame, verdict: str = "VERDICT_POLICY_ALONE") -> DataFrame:
    """POLICY_CASCADE pass or fail, and the first policy that accepts (NULL if none)."""
    accepted_by = F.lit(None).cast("string")
    for policy in reversed(CASCADE):
        accepts = F.col(verdict) != FAIL if policy == "1_9_a" else policy_reject(policy) == 0
        accepted_by = F.when(accepts, F.lit(policy)).otherwise(accepted_by)
    return df.withColumn("ACCEPTED_BY", accepted_by).withColumn(
        "POLICY_CASCADE",
        F.when(F.col("ACCEPTED_BY").isNotNull(), F.lit("pass")).otherwise(F.lit("fail")),
    )
