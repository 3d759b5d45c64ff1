import datetime as dt
import math

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from loanlens.operators import outcomes as O
from loanlens.operators.cleaning import require_numbers
from loanlens.operators.scoring import ModuleModel
from loanlens.operators.trees import exported, tree_probability
from loanlens.operators.woe import woe_score, woe_score_rows
from loanlens.plans import decisions as D
from loanlens.sources import offers
from loanlens.sources.assets import Roles

LOANS = ("USER_ID string, LOAN_ID string, DISBURSED_DATE date, VENDOR string, STATUS string,"
         " EVER_15DPD_IN_90DAYS int, EVER_30DPD_IN_90DAYS int")  # fmt: skip


def test_one_per_loan_does_not_depend_on_the_order(spark):
    day = dt.date(2022, 1, 1)
    rows = [("u", "l", day, "v", "s", 1, 0), ("u", "l", day, "v", "s", 1, 1), ("u", "l", day, "v", "s", 0, 1)]
    for given in (rows, rows[::-1]):
        got = O.one_per_loan(spark.createDataFrame(given, LOANS).coalesce(1)).collect()
        assert [tuple(r) for r in got] == [rows[0]]


def test_trees_equal_the_fitted_model(spark):
    rows = [(float(i % 17), float(i % 5) - 2.0, float((i * 7) % 17 > 8)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, label double")
    assembled = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    model = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(assembled)
    trees = exported(model, ["x", "y"])
    got = model.transform(assembled).select(vector_to_array("probability")[1].alias("p"), tree_probability(trees).alias("q"))
    assert all(r.p == pytest.approx(r.q, abs=1e-12) for r in got.collect())


def test_a_missing_feature_has_no_tree_value(spark):
    tree = {"feature": "x", "threshold": 1.0, "low": {"value": -1.0}, "high": {"value": 1.0}}
    df = spark.createDataFrame([(1.0,), (1.5,), (None,)], "x double")
    got = [r.p for r in df.select(tree_probability([{"weight": 0.5, "root": tree}]).alias("p")).collect()]
    assert got[:2] == [pytest.approx(1 / (1 + math.e)), pytest.approx(1 / (1 + 1 / math.e))] and got[2] is None


def test_woe_scores_of_rows_and_of_a_join_agree(spark):
    encoded = spark.createDataFrame([("a", 0.5), ("b", None)], "BRE_RUN_ID string, n_woe double")
    model = [("const", -1.0), ("n_woe", 2.0)]
    joined = woe_score(encoded.select("BRE_RUN_ID"), encoded, model)
    assert sorted(map(tuple, woe_score_rows(encoded, model).collect())) == sorted(
        (r.BRE_RUN_ID, r.N_WOE, r.PRED_TRAIN) for r in joined.collect()
    )


def test_strict_jobs_raise_on_text_that_is_no_number(spark):
    day = dt.date(2022, 1, 1)
    fact = spark.createDataFrame(
        [("c", "r", day, "12", True), ("c", "s", day, "many", True)],
        "CUSTOMER_ID string, BRE_RUN_ID string, BRE_RUN_DATE date, BUREAUSCORE string, IS_BUREAU_FEATURES_AVAILBALE boolean",
    )
    model = ModuleModel(["BUREAUSCORE"], Roles(numerical=("BUREAUSCORE",)))
    keep = lambda df, c: df
    rows = D.score_module(fact, "bureau_module", day, day, model, keep).collect()
    assert [r.BUREAUSCORE for r in rows] == [12.0, None]
    with pytest.raises(ValueError, match="BUREAUSCORE"):
        D.score_module(fact, "bureau_module", day, day, model, keep, strict=True)
    assert require_numbers(fact.where("BUREAUSCORE = '12'"), ["BUREAUSCORE"]).count() == 1


def test_decided_raises_for_absent_master_columns(spark):
    from tests.test_rules_and_policies import frame

    with pytest.raises(ValueError, match="COMBINED_PD"):
        D.decided(frame(spark, [{}]))


def test_documents_that_are_left_out_are_counted(spark):
    docs = ['{"scoringServiceOutput": {"a": 1}}', '{"scoringServiceOutput": null}', "{}", '{"a": ', None, ""]
    df = spark.createDataFrame([(d,) for d in docs], "METADATA string")
    assert offers.document_counts(df).first().asDict() == {
        "OFFERS": 6, "WITHOUT_DOCUMENT": 1, "FAILED_DOCUMENTS": 2, "NOT_SCORED": 1,
    }
