import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from loanlens import functions as L
from loanlens.operators import cleaning as C
from loanlens.operators.scoring import credit_band_shares
from loanlens.sources.assets import Roles
from loanlens.sources.schemas import CREDIT_BANDS

NAN = float("nan")


def values(df, column, name="x"):
    return [r[0] for r in df.select(column.alias(name)).collect()]


def test_logit_and_sigmoid_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (-0.1,), (1.2,), (None,)], "p double")
    got = values(df, L.logit("p"))
    assert got[0] == -math.inf and got[1] == math.inf and got[2] == 0.0
    assert got[3:] == [None, None, None]
    back = values(df, L.sigmoid(L.logit("p")))
    assert back[:3] == [0.0, 1.0, 0.5]


def test_infinite_parts_cancel_to_null(spark):
    df = spark.createDataFrame([(math.inf, -math.inf)], "a double, b double")
    assert values(df, L.sigmoid(F.col("a") + F.col("b"))) == [None]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(NAN,), (1.5,), (None,)], "x double")
    assert values(df, L.null_if_nan("x")) == [None, 1.5, None]
    assert values(df, L.number("x")) == [None, 1.5, None]


def test_calibration_applies_intercept(spark):
    df = spark.createDataFrame([(0.7,), (None,)], "x double")
    got = values(df, L.calibrate("x", -1.0, 2.0))
    assert got[0] == pytest.approx(1 / (1 + math.exp(-0.4))) and got[1] is None


def test_share_of_zero_total_is_null(spark):
    df = spark.createDataFrame([tuple([0.0] * 6), (1.0, 0.0, 0.0, 0.0, 0.0, 3.0)], CREDIT_BANDS)
    rows = credit_band_shares(df).collect()
    assert rows[0]["PROP_CREDIT_TXNS_LESSTHAN_100_LAST30D"] is None
    assert rows[1]["PROP_CREDIT_TXNS_LESSTHAN_100_LAST30D"] == 0.25
    assert rows[1]["PROP_CREDIT_TXNS_GREATERTHAN_10000_LAST30D"] == 0.75


def test_half_even_rounding_and_text(spark):
    df = spark.createDataFrame([(0.0005,), (0.0015,), (0.12345,)], "x double")
    assert values(df, L.round_half_even("x", 3)) == [0.0, 0.002, 0.123]
    assert values(df, L.percent_text("x"))[2] == "12.35%"


def test_day_window_includes_both_ends(spark):
    stamps = ["2022-07-31 23:59:59", "2022-08-01 00:00:00", "2022-08-31 23:59:59", "2022-09-01 00:00:00"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(s),) for s in stamps], "t timestamp")
    assert df.where(L.in_day_window("t", "2022-08-01", "2022-08-31")).count() == 2


def test_labels_and_text_comparison(spark):
    df = spark.createDataFrame([(" TRUE ", dt.date(2022, 8, 3))], "s string, d date")
    row = df.select(
        L.same_text("s", "true").alias("same"),
        L.month_label("d").alias("m"),
        L.iso_day("d").alias("i"),
        L.day_diff(F.lit("2022-08-01").cast("date"), "d").alias("n"),
        L.trimmed("s").alias("t"),
    ).first()
    assert tuple(row) == (True, "Aug-2022", "2022-08-03", 2, "TRUE")


ROLES = Roles(numerical=("n",), categorical=("c",))
ROWS = [("1.5", "--", 1), ("x", None, 2), (None, "a", 3)]


def test_clean_fills_by_role(spark):
    df = spark.createDataFrame(ROWS, "n string, c string, id int")
    assert [tuple(r) for r in C.clean(df, ROLES, -99999, "MISSING").collect()] == [
        (1.5, "MISSING", 1), (-99999.0, "MISSING", 2), (-99999.0, "a", 3),
    ]
    kept = C.clean(df, ROLES, missing_cat="MISSING", fill_categories=False).collect()
    assert [r["c"] for r in kept] == ["MISSING", None, "a"]
    assert [r["n"] for r in kept] == [1.5, None, None]
    assert ROLES.of("id") == "Others"


def test_bad_numbers_are_counted_and_can_raise(spark):
    df = spark.createDataFrame(ROWS, "n string, c string, id int")
    assert C.failed_casts(df, ["n"]).first()["n"] == 1
    with pytest.raises(ValueError, match="n"):
        C.require_numbers(df, ["n"])
    assert C.require_numbers(df.where("id <> 2"), ["n"]).count() == 2


def test_row_and_column_filters(spark):
    df = spark.createDataFrame([(1, None, True), (2, 3.0, False), (4, 5.0, None)], "a int, b_woe double, f boolean")
    assert C.complete_rows(df).count() == 1
    assert C.not_null(df, ["b_woe"], "f").count() == 0
    assert C.not_null(df, ["b_woe"]).count() == 2
    assert C.matching_columns(df, "_woe$", ["a"]).columns == ["a", "b_woe"]
    assert [r["b_woe"] for r in C.zero_fill(df, ["b_woe"]).collect()] == [0.0, 3.0, 5.0]
