"""Credit rules and verdicts as column expressions.

A rule is PASS, FAIL or NOT_DECIDED.  Comparisons with NULL are neither true
nor false, so a missing input falls through to NOT_DECIDED; in a disjunction
one true part is enough, so a clear breach fails whatever else is missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import number, same_text
from loanlens.sources.schemas import EXTERNAL_SCORE

PASS, FAIL, NOT_DECIDED = "PASS", "FAIL", "NOT_DECIDED"

# Cutoffs of the rules.
MAX_BOUNCES = 5
MAX_WRITTEN_OFF = 500
MAX_DPD = 30
MIN_BUREAU_SCORE = 300
GOOD_BUREAU_SCORE = 700
MAX_EXTERNAL_NEW_TO_CREDIT = 0.0284
MAX_EXTERNAL = 0.0354
MAX_OVERDUE = 3


@dataclass(frozen=True)
class Rule:
    """Output column and the two conditions; ``inputs`` are the columns read."""

    output: str
    inputs: tuple[str, ...]
    passes: Column
    fails: Column

    def decision(self) -> Column:
        return (
            F.when(self.fails, F.lit(FAIL))
            .when(self.passes, F.lit(PASS))
            .otherwise(F.lit(NOT_DECIDED))
        )


def _none_counted(output: str, column: str) -> Rule:
    """Passes when the count is zero, fails when it is positive."""
    value = F.col(column)
    return Rule(output, (column,), value == 0, value > 0)


def _at_most(output: str, column: str, limit: float) -> Rule:
    value = F.col(column)
    return Rule(output, (column,), value <= limit, value > limit)


def new_to_credit() -> Column:
    """1 when there is no bureau score or it is below the lowest real one, else 0."""
    score = number("BUREAUSCORE")
    return F.when(score.isNull() | (score < MIN_BUREAU_SCORE), F.lit(1)).otherwise(F.lit(0))


def build_rules() -> dict[str, Rule]:
    """The active rules by number; 1 and 3 are not in use.

    Fixed values: numbers, output names and input names.
    """
    bounces = F.col("OVERALL_BOUNCE_M0123")
    m0, m1 = "AUTO_DEBIT_BOUNCE_M0", "AUTO_DEBIT_BOUNCE_M1"
    score = number("BUREAUSCORE")
    external = F.col(EXTERNAL_SCORE)
    first_credit = F.col("NTC_FLAG") == 1
    overdue_columns = ("NUM_LOAN_OVERDUE_30D", "NUM_CREDIT_CARD_OVERDUE_30D")
    default_columns = ("NUM_LOAN_DEFAULT_30D", "NUM_CREDIT_CARD_DEFAULT_30D")
    overdue = F.col(overdue_columns[0]) + F.col(overdue_columns[1])
    loan_defaults, card_defaults = F.col(default_columns[0]), F.col(default_columns[1])
    return {
        "2": Rule(
            "RULE2_OVERALL_BOUNCE_M0123_RULE_DECISION",
            ("OVERALL_BOUNCE_M0123",),
            bounces < MAX_BOUNCES,
            bounces >= MAX_BOUNCES,
        ),
        "4": Rule(
            "RULE4_AUTO_DEBIT_BOUNCE_RULE_DECISION",
            (m0, m1),
            same_text(m0, "false") | same_text(m1, "false"),
            same_text(m0, "true") & same_text(m1, "true"),
        ),
        "5": _none_counted(
            "RULE5_WRITTEN_OFF_SETTLED_RULE_DECISION", "WRITTEN_OFF_SETTLED_24MONTHS_CNT_FOR_RULE"
        ),
        "6": _at_most(
            "RULE6_WRITTEN_OFF_AMT_TOTAL_FOR_RULE_DECISION",
            "WRITTEN_OFF_AMT_TOTAL_FOR_RULE",
            MAX_WRITTEN_OFF,
        ),
        "7": _none_counted(
            "RULE7_NO_FOLL_SUIT_FILED_DEFAULT_RULE_DECISION",
            "SUITFILED_WILFULDEFAULT_24MONTHS_FOR_RULE",
        ),
        "8": _none_counted(
            "RULE8_NO_FOLL_SUIT_FILED_WRITTEN_OFF_RULE_DECISION",
            "SUITFILEDWILLFULDEFAULTWRITTENOFFSTATUS_24MONTHS_FOR_RULE",
        ),
        "9": _at_most("RULE9_MAX_DPD_2_YEARS_FOR_RULE", "MAX_DPD_2_YEARS_FOR_RULE", MAX_DPD),
        "10": _none_counted(
            "RULE10_NO_FOLL_PAYMENTHISTORYPROFILE_12MONTHS_FOR_RULE",
            "PAYMENTHISTORYPROFILE_12MONTHS_FOR_RULE",
        ),
        "11": _none_counted(
            "RULE11_NO_FOLL_STATUS_IN_24M_RULE", "NEGATIVEACCOUNSTATUS_24MONTHS_FOR_RULE"
        ),
        "12": Rule(
            "RULE12_EXPERIAN_SCORE",
            ("BUREAUSCORE",),
            score >= GOOD_BUREAU_SCORE,
            (score < GOOD_BUREAU_SCORE) & (score >= MIN_BUREAU_SCORE),
        ),
        "13": Rule(
            "RULE13_NTC_FIS_PD_SCORE_RULE_DECISION",
            ("NTC_FLAG", EXTERNAL_SCORE),
            first_credit & (external <= MAX_EXTERNAL_NEW_TO_CREDIT),
            first_credit & (external > MAX_EXTERNAL_NEW_TO_CREDIT),
        ),
        "14": _at_most("RULE14_FIS_PD_SCORE_RULE_DECISION", EXTERNAL_SCORE, MAX_EXTERNAL),
        "15": Rule(
            "RULE15_NUM_LOAN_DEFAULTS_30D",
            (*overdue_columns, *default_columns),
            (overdue <= MAX_OVERDUE) & (loan_defaults == 0) & (card_defaults == 0),
            (overdue > MAX_OVERDUE) | (loan_defaults > 0) | (card_defaults > 0),
        ),
    }


# The one rule whose inputs a table may lack; it then takes no part.
OPTIONAL_RULES = ("15",)
# Rules whose failure fails the policy on its own.
POLICY_RULES = ("2", "4", "5", "6", "7", "8", "9", "10", "11", "12", "15")
EXTERNAL_RULES = ("13", "14")


def apply_rules(df: DataFrame, numbers: Sequence[str] | None = None) -> DataFrame:
    """NTC_FLAG and one column per rule, by default all of them.

    Raises when an input of a rule is absent.  By default rule 15 is left out
    where its inputs are.
    """
    rules = build_rules()
    present = {"NTC_FLAG", *(c.upper() for c in df.columns)}
    chosen = numbers or [
        n for n, r in rules.items() if n not in OPTIONAL_RULES or present.issuperset(r.inputs)
    ]
    needed = {"BUREAUSCORE", *(c for n in chosen for c in rules[n].inputs)}
    if absent := sorted(needed - present):
        raise ValueError(f"rule inputs are absent: {absent}")
    flagged = df.withColumn("NTC_FLAG", new_to_credit())
    return flagged.withColumns({rules[n].output: rules[n].decision() for n in chosen})


def _any_failed(df: DataFrame, numbers: Sequence[str]) -> Column:
    rules = build_rules()
    present = {c.upper() for c in df.columns}
    failed = F.lit(False)
    for n in numbers:
        if rules[n].output in present:
            failed = failed | (F.col(rules[n].output) == FAIL)
        elif n not in OPTIONAL_RULES:
            raise ValueError(f"{rules[n].output} is absent")
    return F.coalesce(failed, F.lit(False))


def with_verdicts(df: DataFrame) -> DataFrame:
    """VERDICT_POLICY_ALONE and VERDICT_POLICY_WITH_FB from the rule columns.

    NOT_DECIDED counts as a pass.  Rule 15 takes part when it was computed; any
    other rule column that is absent raises.
    """
    alone = _any_failed(df, POLICY_RULES)
    with_external = alone | _any_failed(df, EXTERNAL_RULES)
    return df.withColumns(
        {
            "VERDICT_POLICY_ALONE": F.when(alone, F.lit(FAIL)).otherwise(F.lit(PASS)),
            "VERDICT_POLICY_WITH_FB": F.when(with_external, F.lit(FAIL)).otherwise(F.lit(PASS)),
        }
    )


def with_threshold_verdicts(
    df: DataFrame, thresholds: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Per score and threshold: the model's verdict, and policy and model together."""
    columns: dict[str, Column] = {}
    policy_failed = F.col("VERDICT_POLICY_ALONE") == FAIL
    for score, limits in thresholds.items():
        for i, limit in enumerate(limits, start=1):
            value = F.col(score)
            model = (
                F.when(value.isNull(), F.lit(NOT_DECIDED))
                .when(value > float(limit), F.lit(FAIL))
                .otherwise(F.lit(PASS))
            )
            columns[f"{score}_VERDICT_MODEL_THRESH_{i}"] = model
            columns[f"{score}_VERDICT_POLICY_AND_MODEL_THRESH_{i}"] = F.when(
                policy_failed, F.lit(FAIL)
            ).otherwise(model)
    return df.withColumns(columns)
