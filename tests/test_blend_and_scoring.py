import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanlens.operators import blend as B
from loanlens.operators import woe as W
from loanlens.operators.scoring import (
    Calibration, ModuleModel, linear_score, prepare, score_with_function, score_with_pipeline, with_scores,
)
from loanlens.sources import schemas as S
from loanlens.sources.assets import Roles


def sig(x):
    return 1 / (1 + math.exp(-x))


def test_flags_and_types(spark):
    cases = [  # sms, bureau, days, transactions -> type
        (0, 750, 1, 50, "SMS_INSUFFICIENT"), (None, 750, 1, 50, "SMS_INSUFFICIENT"),
        (1, 300, 90, 10, "SMS_BR_TRX_SUFFICIENT"), (1, 299, 90, 10, "SMS_TRX_SUFFICIENT"),
        (1, 300, 91, 10, "SMS_BR_SUFFICIENT"), (1, 300, 90, 9, "SMS_BR_SUFFICIENT"),
        (1, None, None, 10, "SMS_SUFFICIENT"), (1, None, 5, None, "SMS_SUFFICIENT"),
    ]
    df = spark.createDataFrame(
        [tuple(None if v is None else str(v) for v in c[:4]) for c in cases],
        "NUM_READABLE_SMS_180D string, BUREAUSCORE string, DAYS_SINCE_LAST_TXN string, TOTAL_TRXNS string",
    )
    flagged = B.sufficiency_flags(df).withColumn("t", B.combination_type()).collect()
    assert [r["t"] for r in flagged] == [c[4] for c in cases]
    assert [r["IS_SMS_FEATURE"] for r in flagged] == [False, False] + [True] * 6


def test_blend_weights_and_calibration(spark):
    x, s, b = 0.4, -0.2, 1.1
    rows = [("SMS_TRX_SUFFICIENT", 0.5 * x + 0.5 * s), (" sms_br_sufficient", 0.4 * b + 0.6 * s),
            ("SMS_BR_TRX_SUFFICIENT", 0.33 * x + 0.34 * s + 0.33 * b), ("SMS_SUFFICIENT", None)]
    df = spark.createDataFrame([(t, x, s, b) for t, _ in rows],
                               "COMBINATION_TYPE string, LOGODDS_TRX double, LOGODDS_SMS double, LOGODDS_BR double")
    got = B.blend(df, Calibration(-1.0, 0.5)).collect()
    for r, (_, z) in zip(got, rows):
        if z is None:
            assert r["COMBINED_PD"] is None and r["CALIB_PD"] is None and r["RISK_BANDS"] == "Missing"
        else:
            assert r["COMBINED_PD"] == pytest.approx(sig(z))
            assert r["COMBINED_LOGODDS"] == pytest.approx(z)
            assert r["CALIB_PD"] == pytest.approx(sig(-1 + 0.5 * z))


def test_missing_part_leaves_the_blend_open(spark):
    df = spark.createDataFrame([("SMS_TRX_SUFFICIENT", None, 0.1, 0.2)],
                               "COMBINATION_TYPE string, LOGODDS_TRX double, LOGODDS_SMS double, LOGODDS_BR double")
    assert B.blend(df, Calibration()).first()["RISK_BANDS"] == "Missing"


def test_band_edges(spark):
    scores = [0.0162, 0.01621, 0.0267, 0.0268, 0.0392, 0.0393, 0.053163138, 0.0532, None]
    df = spark.createDataFrame([(s,) for s in scores], "CALIB_PD double")
    assert [r[0] for r in df.select(B.risk_band()).collect()] == list("ABBCCDDE") + ["Missing"]


def test_module_joins_keep_decisions_and_drop_duplicates(spark):
    decisions = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "BRE_RUN_ID string, v int")
    results = spark.createDataFrame([("a", 0.1, -1.0, 5), ("a", 0.1, -1.0, 5), ("b", 0.2, -2.0, 0)],
                                    "BRE_RUN_ID string, PRED_TRAIN_XGB double, LOGODDS_SCORE double, NUM_READABLE_SMS_180D int")
    rows = B.join_module_scores(decisions, results, results, results).collect()
    got = sorted(((r["BRE_RUN_ID"] or ""), r["BR_PD"], r["TRX_PD"], r["SMS_PD"]) for r in rows)
    assert got == [("", None, None, None), ("a", 0.1, 0.1, 0.1), ("b", 0.2, 0.2, None)]


def test_lr_blend_scores_complete_rows_only(spark):
    def side(flag, rows):
        return spark.createDataFrame(rows, f"BRE_RUN_ID string, PRED_TRAIN double, {flag} boolean, USER_ID string, DISBURSED_DATE string")

    act = side(S.ACTIVITY_FLAG, [(k, 0.2, True, "u", "2022-01-01") for k in "abcd"])
    txn = side(S.LEDGER_FLAG, [("a", 0.3, True, "u", "x"), ("b", 0.3, False, "u", "x"), ("c", None, True, "u", "x")])
    bur = side(S.BUREAU_FLAG, [(k, 0.4, True, "u", "x") for k in "abcd"])
    rows = {r["BRE_RUN_ID"]: r for r in B.lr_blend(B.join_lr_modules(act, txn, bur), 20, 30, 50, Calibration(0.1, 2.0)).collect()}
    z = 0.3 * math.log(0.3 / 0.7) + 0.5 * math.log(0.4 / 0.6) + 0.2 * math.log(0.2 / 0.8)
    assert rows["a"]["COMB_SCORE"] == pytest.approx(z) and rows["a"]["PD_SCORE"] == pytest.approx(sig(z))
    assert rows["a"]["CALIB_PD"] == pytest.approx(sig(0.1 + 2 * z))
    assert all(rows[k]["CALIB_PD"] is None for k in "bcd") and len(rows) == 4


BINS = {
    "n": [("missing", 9.0), ("-1", 7.0), ("[-inf,0.0)", 1.0), ("[0.0,5.5)", 2.0), ("[5.5,inf)", 3.0)],
    "c": [("a%,%b", 4.0), ("missing%,%d", 5.0)],
}


def test_woe_bins(spark):
    df = spark.createDataFrame([(-1.0, "a"), (-2.0, "b"), (0.0, "d"), (5.5, None), (None, "zz"), (5.4, "a")], "n double, c string")
    rows = W.apply_woe(df.withColumn("id", F.lit(1)), BINS, ["id"]).collect()
    assert [r["n_woe"] for r in rows] == [7.0, 1.0, 2.0, 3.0, 9.0, 2.0]
    assert [r["c_woe"] for r in rows] == [4.0, 4.0, 5.0, 5.0, None, 4.0]


def test_woe_score_keeps_all_ids(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "BRE_RUN_ID string")
    encoded = spark.createDataFrame([("a", 0.5)], "BRE_RUN_ID string, n_woe double")
    rows = {r[0]: r["PRED_TRAIN"] for r in W.woe_score(ids, encoded, [("const", -1.0), ("n_woe", 2.0)]).collect()}
    assert rows["a"] == pytest.approx(sig(0.0)) and rows["b"] is None


def test_linear_score_with_missing_input(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert df.select(linear_score(0.0, [("a", 1.0), ("b", 1.0)])).first()[0] is None


def test_outside_model_sees_features_only(spark):
    df = spark.createDataFrame([(i, float(i), None if i == 3 else 1.0) for i in range(5)], "id int, a double, b double")

    def predict(batch: pd.DataFrame) -> pd.Series:
        assert list(batch.columns) == ["a", "b"]
        return pd.Series(1 / (1 + np.exp(-(batch["a"] - batch["b"]))))

    rows = score_with_function(df, ["a", "b"], predict, Calibration(0.5, 1.0)).orderBy("id").collect()
    assert rows[2]["PRED_TRAIN"] == pytest.approx(sig(1.0)) and rows[2]["LOGODDS_SCORE"] == pytest.approx(1.0)
    assert rows[2]["PRED_TRAIN_XGB"] == pytest.approx(sig(1.5))
    assert rows[3]["PRED_TRAIN"] is None and rows[3]["PRED_TRAIN_XGB"] is None


def test_pipeline_model_equals_its_own_probability(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([(i, float(i % 10), float(i % 7), float(i % 10 > 5)) for i in range(200)], "id int, a double, b double, label double")
    fitted = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), GBTClassifier(maxIter=2, maxDepth=2, seed=1)]).fit(df)
    scored = score_with_pipeline(df, fitted, Calibration())
    assert scored.columns == ["id", "a", "b", "label", "PRED_TRAIN", "LOGODDS_SCORE", "PRED_TRAIN_XGB"]
    expected = {r["id"]: float(r["probability"][1]) for r in fitted.transform(df).collect()}
    assert all(r["PRED_TRAIN"] == pytest.approx(expected[r["id"]]) for r in scored.collect())
    means = {r["label"]: r["m"] for r in scored.groupBy("label").agg(F.avg("PRED_TRAIN").alias("m")).collect()}
    assert means[1.0] > means[0.0]


def test_prepare_fills_as_the_model_asks(spark):
    df = spark.createDataFrame([("1", None, "--"), (None, None, None)], "a string, z double, c string")
    model = ModuleModel(["a", "z", "c"], Roles(("a", "z"), ("c",)), zero_filled=["z"], missing_cat="MISSING")
    assert [tuple(r) for r in prepare(df, model).collect()] == [(1.0, 0.0, "MISSING"), (None, 0.0, None)]
    marked = ModuleModel(["a"], Roles(("a",)), missing_num=-99999)
    assert [r["a"] for r in prepare(df, marked).collect()] == [1.0, -99999.0]


def test_scores_at_the_ends(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double")
    rows = with_scores(df, F.col("p"), Calibration(0.0, 1.0)).collect()
    assert [r["PRED_TRAIN_XGB"] for r in rows] == [0.0, 1.0, None]
