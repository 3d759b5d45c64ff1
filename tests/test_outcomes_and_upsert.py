import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loanlens.operators import outcomes as O
from loanlens.operators.upsert import latest_per_key, upsert
from loanlens.sources import scans

DAY0 = dt.date(2022, 1, 1)
LOANS = ("USER_ID string, LOAN_ID string, DISBURSED_DATE date, VENDOR string, STATUS string,"
         " EVER_15DPD_IN_90DAYS int, EVER_30DPD_IN_90DAYS int")
RUNS = "CUSTOMER_ID string, BRE_RUN_ID string, BRE_RUN_DATE date, MODEL_TYPE string"


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def random_rows(seed, n_loans=300, n_runs=200, hot=0.4):
    rnd = random.Random(seed)

    def user():
        return "hot" if rnd.random() < hot else f"u{rnd.randrange(12)}"

    loans = [(user(), f"l{rnd.randrange(120)}", day(rnd.choice([None, *range(40)])), f"v{rnd.randrange(3)}", "s",
              rnd.randrange(2), 0) for _ in range(n_loans)]
    runs = [(f" {user()} ", f"r{i}", day(rnd.choice([None, *range(40)])), "XGBOOST") for i in range(n_runs)]
    return loans, runs


def brute_as_of(loans, runs):
    best = {}
    for u, l, d, v, s, y, z in loans:
        rank = (-y, v, s)
        if (u, l, d) not in best or rank < best[u, l, d][0]:
            best[u, l, d] = (rank, (v, s, y))
    out = {}
    for (u, l, d), (_, rest) in best.items():
        seen = [(rd, rid) for c, rid, rd, _ in runs if c.strip() == u and rd and d and rd <= d]
        out[u, l, d] = (*rest, *(max(seen) if seen else (None, None)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_of_equals_brute_force(spark, seed):
    loans, runs = random_rows(seed)
    got = O.as_of_latest_run(spark.createDataFrame(loans, LOANS), spark.createDataFrame(runs, RUNS)).collect()
    expected = brute_as_of(loans, runs)
    assert len(got) == len(expected)
    for r in got:
        v, s, y, rd, rid = expected[r["USER_ID"], r["LOAN_ID"], r["DISBURSED_DATE"]]
        assert (r["VENDOR"], r["STATUS"], r["EVER_15DPD_IN_90DAYS"], r["BRE_RUN_DATE"], r["BRE_RUN_ID"]) == (v, s, y, rd, rid)
        assert r["DAYS_DIFF"] == (None if rd is None else (r["DISBURSED_DATE"] - rd).days)


def test_same_day_run_counts_and_later_does_not(spark):
    loans = [("a", "1", day(5), "v", "s", 1, 0), ("a", "2", day(4), "v", "s", 0, 0), ("b", "3", day(5), "v", "s", 0, 0)]
    runs = [("a", "r1", day(5), "X"), ("a", "r2", day(5), "X"), ("a", "r9", day(6), "X")]
    got = {r["LOAN_ID"]: r["BRE_RUN_ID"] for r in O.as_of_latest_run(spark.createDataFrame(loans, LOANS), spark.createDataFrame(runs, RUNS)).collect()}
    assert got == {"1": "r2", "2": None, "3": None}


def test_master_dates_may_be_text(spark):
    loans = spark.createDataFrame([("a", "1", day(5), "v", "s", 1, 0)], LOANS)
    runs = spark.createDataFrame([("a", "r1", day(3), "X")], RUNS).withColumn("BRE_RUN_DATE", F.col("BRE_RUN_DATE").cast("string"))
    assert O.as_of_latest_run(loans, runs).first()["BRE_RUN_ID"] == "r1"


@pytest.mark.parametrize("seed", [4, 5])
def test_labelled_master_equals_brute_force(spark, seed):
    loans, runs = random_rows(seed)
    start, end, since = day(3), day(35), day(8)
    master = spark.createDataFrame(runs, RUNS)
    as_of = O.as_of_latest_run(spark.createDataFrame(loans, LOANS), master)
    got = O.labelled_master(master, as_of, start, end, since).collect()
    paid = {}
    for (u, l, d), (v, s, y, rd, rid) in brute_as_of(loans, runs).items():
        if rid and start <= d <= end:
            paid.setdefault((u, rid), []).append((l, v, s, y, d))
    expected = []
    for c, rid, rd, m in runs:
        own = paid.get((c.strip(), rid), []) if rd and rd >= since else []
        expected += [(c, rid, rd, m, *loan) for loan in own or [(None,) * 5]]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, expected))
    assert got[0].__fields__ == ["CUSTOMER_ID", "BRE_RUN_ID", "BRE_RUN_DATE", "MODEL_TYPE", "LOAN_ID", "VENDOR", "STATUS",
                                 "EVER_15DPD_IN_90DAYS", "DISBURSED_DATE"]


def test_matured_and_guard(spark):
    df = spark.createDataFrame([(dt.date(2022, 3, 14),), (dt.date(2022, 3, 15),), (None,)], "DISBURSED_DATE date")
    kept = scans.matured(df, "2022-06-15")
    assert [r[0] for r in kept.collect()] == [dt.date(2022, 3, 14)]
    assert scans.require_rows(kept, "x") is kept
    with pytest.raises(ValueError, match="nothing"):
        scans.require_rows(df.where("false"), "nothing")


def test_incremental_window(spark):
    log = spark.createDataFrame([(dt.date(2022, 1, 5), True), (dt.date(2022, 1, 9), False)], "RUN_DATE date, SUCCEEDED boolean")
    today = "2022-02-01"
    assert scans.incremental_window(log, today, "2020-01-01") == (dt.date(2022, 1, 5), dt.date(2022, 2, 1))
    assert scans.incremental_window(log, today, "2020-01-01", "2021-07-07")[0] == dt.date(2021, 7, 7)
    assert scans.incremental_window(log.where("false"), today, "2020-01-01")[0] == dt.date(2020, 1, 1)


def test_features_for_master_keeps_every_master_row(spark):
    fact = spark.createDataFrame([("1 ", " r1", 5), ("9", "r9", 7)], "CUSTOMER_ID string, BRE_RUN_ID string, F int")
    master = spark.createDataFrame([(" 1", "r1", "A"), (" 1", "r1", "B"), ("2", "r2", "A"), (None, "r2", "A")],
                                   "CUSTOMER_ID string, BRE_RUN_ID string, MODEL_TYPE string")
    got = sorted(map(repr, (tuple(r) for r in O.features_for_master(master, fact).collect())))
    assert got == sorted(map(repr, [("1 ", " r1", 5, "A"), ("1 ", " r1", 5, "B"), (None, None, None, "A"), (None, None, None, "A")]))


ROW = "CUSTOMER_ID string, BRE_RUN_ID string, MODEL_TYPE string, BRE_RUN_DATE date, V string"
TARGET = [("1", "a", "X", day(1), "old"), ("2", "b", "X", day(1), "old"), (None, "c", "X", day(1), "old")]
SOURCE = [(" 1", "a ", "X", day(2), "new"), ("1", "a", "X", day(1), "stale"), ("3", "d", "X", day(2), "new"),
          (None, "c", "X", day(2), "new"), (None, "c", "X", day(2), "new")]


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_upsert_replaces_adds_and_keeps(spark):
    target, source = spark.createDataFrame(TARGET, ROW), spark.createDataFrame(SOURCE, ROW)
    merged = upsert(target, source)
    assert rows_of(merged) == sorted(map(repr, [
        (" 1", "a ", "X", day(2), "new"), ("2", "b", "X", day(1), "old"), ("3", "d", "X", day(2), "new"),
        (None, "c", "X", day(1), "old"), (None, "c", "X", day(2), "new"), (None, "c", "X", day(2), "new")]))


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame(TARGET, ROW)
    source = spark.createDataFrame(SOURCE, ROW).where("CUSTOMER_ID is not null")
    once = upsert(target, source)
    assert rows_of(upsert(once, source)) == rows_of(once)


def test_upsert_checks_and_widens_columns(spark):
    target = spark.createDataFrame(TARGET, ROW)
    source = spark.createDataFrame(SOURCE, ROW)
    with pytest.raises(ValueError, match="MODEL_TYPE"):
        upsert(target, source.drop("MODEL_TYPE"))
    partial = upsert(target, source.drop("V").where("CUSTOMER_ID is not null"))
    assert {(r["CUSTOMER_ID"], r["V"]) for r in partial.collect()} == {(" 1", "old"), ("2", "old"), (None, "old"), ("3", None)}
    wide = upsert(target, source.withColumn("RULE", F.lit("PASS")), new_columns=["RULE"])
    assert wide.columns[-1] == "RULE"
    assert {(r["V"], r["RULE"]) for r in wide.collect()} == {("old", None), ("new", "PASS")}


def test_every_matched_target_row_is_updated(spark):
    target = spark.createDataFrame([("1", "a", "X", day(1), "old")] * 3, ROW)
    merged = upsert(target, spark.createDataFrame(SOURCE[:1], ROW))
    assert rows_of(merged) == [repr((" 1", "a ", "X", day(2), "new"))] * 3


def test_latest_per_key_takes_the_latest(spark):
    got = latest_per_key(spark.createDataFrame(SOURCE[:3], ROW), ["CUSTOMER_ID", "BRE_RUN_ID"]).collect()
    assert sorted(r["V"] for r in got) == ["new", "new"]
