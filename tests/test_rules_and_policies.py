import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.operators import policies as PO
from loanlens.operators import rules as R
from loanlens.operators.policies import NUMERIC_CRITERIA, POLICIES
from loanlens.sources.scans import nan_to_null
from loanlens.sources.schemas import DECISION_COLUMNS, EXTERNAL_SCORE, RULE_COLUMNS

PASS, FAIL, OPEN = "PASS", "FAIL", "NOT_DECIDED"
TEXT = {"CUSTOMER_ID", "BRE_RUN_ID", "AUTO_DEBIT_BOUNCE_M0", "AUTO_DEBIT_BOUNCE_M1"}
GOOD = {
    "CUSTOMER_ID": "1", "BRE_RUN_ID": "r", "OVERALL_BOUNCE_M0123": 0.0,
    "AUTO_DEBIT_BOUNCE_M0": "false", "AUTO_DEBIT_BOUNCE_M1": "false", "BUREAUSCORE": 750.0,
    "WRITTEN_OFF_SETTLED_24MONTHS_CNT_FOR_RULE": 0.0, "WRITTEN_OFF_AMT_TOTAL_FOR_RULE": 0.0,
    "SUITFILED_WILFULDEFAULT_24MONTHS_FOR_RULE": 0.0, "NEGATIVEACCOUNSTATUS_24MONTHS_FOR_RULE": 0.0,
    "SUITFILEDWILLFULDEFAULTWRITTENOFFSTATUS_24MONTHS_FOR_RULE": 0.0, "MAX_DPD_2_YEARS_FOR_RULE": 0.0,
    "PAYMENTHISTORYPROFILE_12MONTHS_FOR_RULE": 0.0, EXTERNAL_SCORE: 0.01,
    "NUM_LOAN_OVERDUE_30D": 0.0, "NUM_CREDIT_CARD_OVERDUE_30D": 0.0,
    "NUM_LOAN_DEFAULT_30D": 0.0, "NUM_CREDIT_CARD_DEFAULT_30D": 0.0,
}
NAN = float("nan")


def frame(spark, rows, base=GOOD):
    names = list(base)
    schema = T.StructType(
        [T.StructField(n, T.StringType() if isinstance(base[n], str) else T.DoubleType()) for n in names]
    )
    return spark.createDataFrame([tuple({**base, **r}[n] for n in names) for r in rows], schema)


COUNTS = {
    "5": "WRITTEN_OFF_SETTLED_24MONTHS_CNT_FOR_RULE", "7": "SUITFILED_WILFULDEFAULT_24MONTHS_FOR_RULE",
    "8": "SUITFILEDWILLFULDEFAULTWRITTENOFFSTATUS_24MONTHS_FOR_RULE",
    "10": "PAYMENTHISTORYPROFILE_12MONTHS_FOR_RULE", "11": "NEGATIVEACCOUNSTATUS_24MONTHS_FOR_RULE",
}
CASES = [
    ("2", {"OVERALL_BOUNCE_M0123": 4.0}, PASS), ("2", {"OVERALL_BOUNCE_M0123": 5.0}, FAIL),
    ("2", {"OVERALL_BOUNCE_M0123": None}, OPEN), ("2", {"OVERALL_BOUNCE_M0123": NAN}, OPEN),
    ("4", {"AUTO_DEBIT_BOUNCE_M0": "true"}, PASS),
    ("4", {"AUTO_DEBIT_BOUNCE_M0": "true", "AUTO_DEBIT_BOUNCE_M1": "TRUE "}, FAIL),
    ("4", {"AUTO_DEBIT_BOUNCE_M0": None, "AUTO_DEBIT_BOUNCE_M1": "true"}, OPEN),
    ("4", {"AUTO_DEBIT_BOUNCE_M0": None, "AUTO_DEBIT_BOUNCE_M1": "false"}, PASS),
    ("6", {"WRITTEN_OFF_AMT_TOTAL_FOR_RULE": 500.0}, PASS), ("6", {"WRITTEN_OFF_AMT_TOTAL_FOR_RULE": 501.0}, FAIL),
    ("6", {"WRITTEN_OFF_AMT_TOTAL_FOR_RULE": None}, OPEN),
    ("9", {"MAX_DPD_2_YEARS_FOR_RULE": 30.0}, PASS), ("9", {"MAX_DPD_2_YEARS_FOR_RULE": 31.0}, FAIL),
    ("9", {"MAX_DPD_2_YEARS_FOR_RULE": None}, OPEN),
    ("12", {"BUREAUSCORE": 700.0}, PASS), ("12", {"BUREAUSCORE": 699.0}, FAIL), ("12", {"BUREAUSCORE": 300.0}, FAIL),
    ("12", {"BUREAUSCORE": 299.0}, OPEN), ("12", {"BUREAUSCORE": None}, OPEN), ("12", {"BUREAUSCORE": NAN}, OPEN),
    ("13", {"BUREAUSCORE": 299.0, EXTERNAL_SCORE: 0.0284}, PASS), ("13", {"BUREAUSCORE": None, EXTERNAL_SCORE: 0.0285}, FAIL),
    ("13", {"BUREAUSCORE": 300.0, EXTERNAL_SCORE: 0.5}, OPEN), ("13", {"BUREAUSCORE": None, EXTERNAL_SCORE: None}, OPEN),
    ("14", {EXTERNAL_SCORE: 0.0354}, PASS), ("14", {EXTERNAL_SCORE: 0.0355}, FAIL), ("14", {EXTERNAL_SCORE: None}, OPEN),
    ("15", {"NUM_LOAN_OVERDUE_30D": 2.0, "NUM_CREDIT_CARD_OVERDUE_30D": 1.0}, PASS),
    ("15", {"NUM_LOAN_OVERDUE_30D": 3.0, "NUM_CREDIT_CARD_OVERDUE_30D": 1.0}, FAIL),
    ("15", {"NUM_LOAN_DEFAULT_30D": 1.0, "NUM_LOAN_OVERDUE_30D": None}, FAIL),
    ("15", {"NUM_LOAN_OVERDUE_30D": None}, OPEN), ("15", {"NUM_LOAN_DEFAULT_30D": -1.0}, OPEN),
]
for number, column in COUNTS.items():
    CASES += [(number, {column: 0.0}, PASS), (number, {column: 1.0}, FAIL), (number, {column: None}, OPEN)]


def test_every_rule_at_its_boundaries(spark):
    df = frame(spark, [c for _, c, _ in CASES])
    rules = R.build_rules()
    rows = R.apply_rules(nan_to_null(df)).collect()
    got = [r[rules[n].output] for r, (n, _, _) in zip(rows, CASES)]
    wrong = [(c, g) for c, g in zip(CASES, got) if c[2] != g]
    assert wrong == []
    assert {n for n, _, _ in CASES} == set(rules)


def test_rule_columns_are_those_of_the_master(spark):
    df = R.apply_rules(frame(spark, [{}]))
    assert [c for c in df.columns if c in RULE_COLUMNS] == RULE_COLUMNS


def test_new_to_credit(spark):
    df = frame(spark, [{"BUREAUSCORE": s} for s in (299.0, 300.0, None, NAN)])
    assert [r[0] for r in df.select(R.new_to_credit()).collect()] == [1, 0, 1, 1]


def test_verdicts(spark):
    rows = [
        {},
        {"OVERALL_BOUNCE_M0123": 9.0},
        {k: None for k in GOOD if k not in ("CUSTOMER_ID", "BRE_RUN_ID")},
        {EXTERNAL_SCORE: 0.9},
        {"BUREAUSCORE": None, EXTERNAL_SCORE: 0.03},
        {"NUM_LOAN_DEFAULT_30D": 1.0},
    ]
    got = R.with_verdicts(R.apply_rules(frame(spark, rows))).collect()
    assert [r["VERDICT_POLICY_ALONE"] for r in got] == [PASS, FAIL, PASS, PASS, PASS, FAIL]
    assert [r["VERDICT_POLICY_WITH_FB"] for r in got] == [PASS, FAIL, PASS, FAIL, FAIL, FAIL]


def test_rule_fifteen_is_optional(spark):
    df = frame(spark, [{"NUM_LOAN_DEFAULT_30D": 1.0}]).drop("NUM_LOAN_OVERDUE_30D")
    ruled = R.apply_rules(df)
    assert "RULE15_NUM_LOAN_DEFAULTS_30D" not in ruled.columns
    assert R.with_verdicts(ruled).first()["VERDICT_POLICY_ALONE"] == PASS


def test_threshold_verdicts(spark):
    df = spark.createDataFrame(
        [(PASS, 0.03), (PASS, 0.031), (PASS, None), (FAIL, None), (FAIL, 0.01)],
        "VERDICT_POLICY_ALONE string, P double",
    )
    rows = R.with_threshold_verdicts(df, {"P": [0.03]}).collect()
    assert [r["P_VERDICT_MODEL_THRESH_1"] for r in rows] == [PASS, FAIL, OPEN, OPEN, PASS]
    assert [r["P_VERDICT_POLICY_AND_MODEL_THRESH_1"] for r in rows] == [PASS, FAIL, OPEN, FAIL, FAIL]


ACCEPTED = {
    **{c: (limit - 1 if op == "<" else limit) * 1.0 for c, op, limit in NUMERIC_CRITERIA.values()},
    EXTERNAL_SCORE: 0.0284, "BUREAUSCORE": "700", "AUTO_DEBIT_BOUNCE_M0": "FALSE",
    "AUTO_DEBIT_BOUNCE_M1": "FALSE", "TOTAL_CREDIT_FOR_RULE": 0.0,
}
BEYOND = {">=": -1.0, "<=": 1.0, "<": 1.0, "=": 1.0}


@pytest.mark.parametrize("policy", list(POLICIES))
def test_policy_criteria_at_their_boundaries(spark, policy):
    changes, expected = [{}], [0]
    for name in POLICIES[policy]:
        if name in NUMERIC_CRITERIA:
            column, op, limit = NUMERIC_CRITERIA[name]
            changes += [{column: ACCEPTED[column] + BEYOND[op]}, {column: None}]
            expected += [1, 1]
    bounce_counts = "no_debit_bounce" in POLICIES[policy]
    clear_m0 = "debit_clear_m0" in POLICIES[policy]
    changes += [{"AUTO_DEBIT_BOUNCE_M1": "TRUE"}, {"AUTO_DEBIT_BOUNCE_M1": None}, {"AUTO_DEBIT_BOUNCE_M0": None}]
    expected += [int(bounce_counts), 0, int(clear_m0)]
    changes += [{"TOTAL_CREDIT_FOR_RULE": None}]
    expected += [0]
    limit = 650 if "bureau_650" in POLICIES[policy] else 700 if "bureau_700" in POLICIES[policy] else None
    if limit:
        changes += [{"BUREAUSCORE": str(limit)}, {"BUREAUSCORE": str(limit - 1)}, {"BUREAUSCORE": ""},
                    {"BUREAUSCORE": None}, {"BUREAUSCORE": "NULL"}]
        expected += [0, 1, 0, 1, 1]
    rows = frame(spark, changes, ACCEPTED).select(PO.policy_reject(policy).alias("r")).collect()
    got = [r["r"] for r in rows]
    assert [(c, e, g) for c, e, g in zip(changes, expected, got) if e != g] == []


def test_external_score_limit_depends_on_the_bureau_score(spark):
    cases = [("299", 0.03, False), ("300", 0.03, True), ("699", 0.0354, True), ("699", 0.0355, False),
             ("700", 0.03, False), ("", 0.0284, True), ("", 0.03, False), (None, 0.0284, True),
             ("NULL", 0.03, False), ("500", None, False)]
    df = spark.createDataFrame([c[:2] for c in cases], f"BUREAUSCORE string, {EXTERNAL_SCORE} double")
    got = [r[0] for r in df.select(PO.criterion("external_score")).collect()]
    assert got == [c[2] for c in cases]


def test_cascade_names_the_first_policy_that_accepts(spark):
    rows = [{}, {"AMOUNT_PAST_DUE_FOR_RULE": 9999.0}, {"BUREAUSCORE": "100", EXTERNAL_SCORE: 0.5},
            {"WRITTEN_OFF_AMT_TOTAL_FOR_RULE": 9999.0}]
    df = frame(spark, rows, ACCEPTED).withColumn("VERDICT_POLICY_ALONE", F.lit("FAIL"))
    got = [(r["ACCEPTED_BY"], r["POLICY_CASCADE"]) for r in PO.with_cascade(df).collect()]
    assert got == [("w", "pass"), ("1_9_b", "pass"), ("1_8_1", "pass"), (None, "fail")]
    by_rules = PO.with_cascade(df.withColumn("VERDICT_POLICY_ALONE", F.lit("PASS"))).collect()
    assert by_rules[3]["ACCEPTED_BY"] == "1_9_a"
    assert set(DECISION_COLUMNS) >= {"OVERALL_BOUNCE_M0123"}


def test_absent_inputs_raise(spark):
    df = frame(spark, [{}])
    with pytest.raises(ValueError, match="OVERALL_BOUNCE_M0123"):
        R.apply_rules(df.drop("OVERALL_BOUNCE_M0123"))
    with pytest.raises(ValueError, match="BUREAUSCORE"):
        R.apply_rules(df.drop("BUREAUSCORE"), ["2"])
    with pytest.raises(ValueError, match="RULE9"):
        R.with_verdicts(R.apply_rules(df).drop("RULE9_MAX_DPD_2_YEARS_FOR_RULE"))


def test_rule_15_may_be_absent(spark):
    ruled = R.apply_rules(frame(spark, [{}]).drop("NUM_LOAN_DEFAULT_30D"))
    assert "RULE15_NUM_LOAN_DEFAULTS_30D" not in ruled.columns
    assert R.with_verdicts(ruled).first()["VERDICT_POLICY_ALONE"] == PASS
    with pytest.raises(ValueError):
        R.apply_rules(frame(spark, [{}]).drop("NUM_LOAN_DEFAULT_30D"), ["15"])
