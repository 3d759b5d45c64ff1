"""Hot keys: results stay the same, and the plans split them."""

import contextlib
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from loanlens.operators import outcomes as O
from loanlens.operators.gini import GINI_SCORES, gini, gini_metrics
from loanlens.operators.ks import KS_SCORES
from loanlens.operators.ranges import in_fixed_range
from loanlens.operators.skew import hot_buckets, left_join, left_join_many, left_joins
from loanlens.operators import upsert as upserts
from loanlens.operators.upsert import upsert
from loanlens.plans import decisions, monitoring
from loanlens.sources import scans, versions
from testbed import q_monitoring
from testbed.q_decisions import _blended

SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@contextlib.contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    rows = df.collect()
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return rows, text.split("Initial Plan")[0]


def rows_of(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


def keyed(spark, n=6000):
    """A third of the rows under one key, some under NULL."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))
    )
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"))


def test_hot_buckets_finds_the_hot_keys_and_nothing_else(spark):
    found = hot_buckets(keyed(spark), ["k"])
    assert len(found) == 2 and max(found.values()) == pytest.approx(1 / 3, abs=0.01)
    even = spark.range(0, 20000, 1, 8).select(F.col("id").cast("string").alias("k"))
    assert hot_buckets(even, ["k"]) == {}
    assert hot_buckets(even.where("false"), ["k"]) == {}


def test_left_joins_with_hot_keys_equal_plain_joins(spark):
    big = keyed(spark)
    one = spark.createDataFrame([("hot", 1), ("k5", 2), ("k5", 3), (None, 9)], "k string, a int")
    two = spark.createDataFrame([("hot", 7), ("hot", 8), ("k6", 2)], "k string, b int")
    got = left_joins(big, [one, two], ["k"])
    plain = big.join(one, ["k"], "left").join(two, ["k"], "left")
    assert rows_of(got.collect()) == rows_of(plain.collect())
    assert got.columns == plain.columns


def test_left_joins_spread_the_hot_key_over_tasks(spark):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                          "spark.sql.shuffle.partitions": "16"}):
        big = keyed(spark)
        one = spark.createDataFrame([("hot", 1)], "k string, a int")
        two = spark.createDataFrame([("hot", 2)], "k string, b int")
        sizes = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        spread = sizes(left_joins(big, [one, two], ["k"]))
        plain = sizes(big.join(one, ["k"], "left").join(two, ["k"], "left"))
    assert plain > 2000 and spread < plain / 2


@pytest.mark.parametrize("hot_side", ["kept", "many"])
def test_left_join_many_equals_a_left_join(spark, hot_side):
    other = spark.createDataFrame([("hot", 1), ("hot", 2), ("k5", 3), ("none", 4), (None, 5)], "k string, w int")
    kept, many = (keyed(spark), other) if hot_side == "kept" else (other, keyed(spark))
    got, plain = left_join_many(kept, many, ["k"]), kept.join(many, ["k"], "left")
    assert rows_of(got.select(plain.columns).collect()) == rows_of(plain.collect())


def test_left_join_takes_the_split_plan_only_for_a_hot_lookup(spark):
    kept = spark.createDataFrame([("hot", 1), ("k5", 3), ("none", 4), (None, 5)], "k string, w int")
    lookup = keyed(spark)
    got, plain = left_join(kept, lookup, ["k"]), kept.join(lookup, ["k"], "left")
    assert rows_of(got.select(plain.columns).collect()) == rows_of(plain.collect())
    assert "LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()
    even = spark.range(0, 5000, 1, 8).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    assert "LeftAnti" not in left_join(kept, even, ["k"])._jdf.queryExecution().optimizedPlan().toString()


def loans_and_runs(spark):
    day = F.date_add(F.lit(dt.date(2022, 1, 1)), (F.col("id") % 50).cast("int"))
    user = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string"))
    runs = spark.range(0, 4000, 1, 8).select(
        user.alias("CUSTOMER_ID"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("BRE_RUN_ID"),
        day.alias("BRE_RUN_DATE"), F.lit("X").alias("MODEL_TYPE"),
    )
    # a third of all loans: one user, one day
    loans = spark.range(0, 12000, 1, 8).select(
        user.alias("USER_ID"), F.col("id").cast("string").alias("LOAN_ID"),
        F.when(F.col("id") % 3 == 0, F.lit(dt.date(2022, 2, 1))).otherwise(day).alias("DISBURSED_DATE"),
        F.lit("v").alias("VENDOR"), F.lit("s").alias("STATUS"), (F.col("id") % 2).cast("int").alias("EVER_15DPD_IN_90DAYS"),
        F.lit(0).alias("EVER_30DPD_IN_90DAYS"),
    )
    return loans, runs


def test_as_of_join_splits_a_hot_user_and_day(spark):
    loans, runs = loans_and_runs(spark)
    expected = rows_of(O.as_of_latest_run(loans, runs).collect())
    with settings(spark, SPLITTING):
        rows, plan = final_plan(O.as_of_latest_run(loans, runs))
    assert rows_of(rows) == expected and len(rows) == 12000
    assert "skew=true" in plan


def test_as_of_window_sees_one_row_per_user_and_day(spark):
    loans, runs = loans_and_runs(spark)
    answers = O.latest_run_per_day(loans, runs)
    assert answers.count() == answers.select("_user", "_day").distinct().count()
    assert answers.where("_user = 'hot'").count() == 1


def test_labelled_master_splits_a_run_with_a_third_of_the_loans(spark):
    loans, runs = loans_and_runs(spark)
    args = ("2022-01-01", "2022-12-31", "2022-01-01")
    with settings(spark, SPLITTING):
        rows, plan = final_plan(O.labelled_master(runs, O.as_of_latest_run(loans, runs), *args))
    assert "skew=true" in plan
    assert max(c for c in _count(r["BRE_RUN_ID"] for r in rows).values()) == 4000
    assert sum(r["LOAN_ID"] is not None for r in rows) == sum(
        r["BRE_RUN_ID"] is not None for r in O.as_of_latest_run(loans, runs).collect())


def _count(values):
    out = {}
    for v in values:
        out[v] = out.get(v, 0) + 1
    return out


def test_upsert_splits_a_hot_key_of_the_target(spark):
    row = spark.range(0, 9000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("CUSTOMER_ID"),
        F.lit("r").alias("BRE_RUN_ID"), F.lit("X").alias("MODEL_TYPE"),
        F.lit(dt.date(2022, 1, 1)).alias("BRE_RUN_DATE"), F.col("id").alias("V"),
    )
    source = row.where("V % 100 = 1").withColumn("V", -F.col("V"))
    with settings(spark, SPLITTING):
        rows, plan = final_plan(upsert(row, source))
    assert len(rows) == 9000 and "skew=true" in plan
    assert sum(r["V"] < 0 for r in rows) == 3000 + 60


def test_repeated_rows_shrink_before_the_shuffle(spark):
    loans, _ = loans_and_runs(spark)
    plan = O.one_per_loan(loans)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them before the exchange


def test_gini_window_is_cut_into_ranges(spark):
    df = spark.range(0, 20000, 1, 8).select(
        F.lit("one").alias("g"), (F.rand(3) * 1e-6).alias("s"), (F.col("id") % 2).alias("y")
    )
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        out = gini(df, ["g"], "s", "y", 64)
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan and ("ScalarSubquery" in plan or "Subquery" in plan)
    assert abs(out.first()["GINI"]) < 0.05


def test_gini_metrics_deal_their_counts_once(spark):
    day = F.date_add(F.lit(dt.date(2022, 9, 1)), (F.col("id") % 90).cast("int"))
    scores = [(F.rand(i) * 1e-3).alias(s) for i, (s, _) in enumerate(GINI_SCORES)]
    flags = [F.lit(True).alias(f) for _, f in GINI_SCORES if f]
    df = spark.range(0, 3000, 1, 8).select(
        F.lit("X").alias("MODEL_TYPE"), day.alias("DISBURSED_DATE"), (F.col("id") % 2).cast("int").alias("EVER_15DPD_IN_90DAYS"),
        *scores, *flags,
    )
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = gini_metrics(df)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_range" in line]
    assert len(dealt) == 1 and "_of" in dealt[0] and "_metric" not in dealt[0]


@pytest.mark.parametrize("count", [0, 1, 2, 7, 8, 200])
def test_ranges_are_found_by_binary_search(spark, count):
    cuts = [i / 7.0 for i in range(count)]
    df = spark.createDataFrame([(i / 14.0 - 0.5,) for i in range(460)] + [(None,)], "v double")
    with_number = df.select("v", in_fixed_range("v", cuts).alias("r"))
    assert all(r.r == sum(r.v is not None and c < r.v for c in cuts) for r in with_number.collect())
    text = with_number._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in text or "filter(" not in text  # no look at every cut


def test_as_of_by_user_moves_the_loans_once(spark):
    loans, runs = loans_and_runs(spark)
    day = F.when(F.col("LOAN_ID").cast("int") % 50 != 7, F.col("DISBURSED_DATE"))
    user = F.when(F.col("LOAN_ID").cast("int") % 40 != 3, F.concat(F.lit(" "), "USER_ID"))
    odd = loans.withColumn("DISBURSED_DATE", day).withColumn("USER_ID", user)
    loans = odd.unionByName(odd.where("LOAN_ID % 5 = 0").withColumn("VENDOR", F.lit("u")))
    got, plain = O.as_of_latest_run(loans, runs, {}), O.as_of_latest_run(loans, runs)
    assert got.columns == plain.columns and rows_of(got.collect()) == rows_of(plain.collect())
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = O.as_of_latest_run(loans, runs, {})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # runs by user and day, then all by user


@pytest.mark.parametrize("hot", [True, False])
def test_left_joins_of_distinct_rows_move_them_once(spark, hot):
    big = keyed(spark) if hot else spark.range(0, 6000, 1, 8).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    twice = big.unionByName(big.where("v % 3 < 2"))
    lookup = big.select("k").distinct().where("k is not null").select("k", F.length("k").alias("n"))
    got = left_joins(twice, [lookup], ["k"], distinct=True)
    assert rows_of(got.select("k", "v", "n").collect()) == rows_of(big.join(lookup, ["k"], "left").select("k", "v", "n").collect())
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = left_joins(twice, [lookup], ["k"], distinct=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "hashpartitioning(k#" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "v#" in line.split("hashpartitioning(")[1].split(")")[0]]


def test_outcomes_are_attached_without_storing_where_no_user_is_hot(spark, monkeypatch):
    loans, runs = loans_and_runs(spark)
    even = F.concat(F.lit("u"), (F.substring("BRE_RUN_ID", 2, 9).cast("int") % 1500).cast("string"))
    runs = runs.withColumn("CUSTOMER_ID", even)
    loans = loans.withColumn("USER_ID", F.concat(F.lit("u"), (F.col("LOAN_ID").cast("int") % 1500).cast("string")))
    args = ("2022-01-01", "2022-12-31", "2022-01-10")
    expected = O.labelled_master(runs, O.as_of_latest_run(loans, runs), *args)

    def storing(*_):
        raise AssertionError("stored")

    monkeypatch.setattr(monitoring, "stored_with_hot", storing)
    got = monitoring.attach_outcomes(runs, loans, *args)
    assert got.columns == expected.columns and rows_of(got.collect()) == rows_of(expected.collect())


def test_decided_rows_are_compiled(spark):
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        rows = decisions.decided(_blended(spark, "/root/testdata/sf0.001"))
        code = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000  # the JVM interprets longer methods


def even_loans_and_runs(spark):
    """Of 1,500 users, a run twice on two days, runs and loans without a day, keys with spaces."""
    loans, runs = loans_and_runs(spark)
    even = F.concat(F.lit(" u"), (F.substring("BRE_RUN_ID", 2, 9).cast("int") % 1500).cast("string"))
    runs = runs.withColumn("CUSTOMER_ID", even).withColumn("BRE_RUN_DATE", F.expr("if(BRE_RUN_ID like '%77', null, BRE_RUN_DATE)"))
    again = runs.where("BRE_RUN_ID like '%3'").withColumn("BRE_RUN_DATE", F.date_add("BRE_RUN_DATE", 5))
    loans = loans.withColumn("USER_ID", F.concat(F.lit("u"), (F.col("LOAN_ID").cast("int") % 1500).cast("string")))
    loans = loans.withColumn("DISBURSED_DATE", F.expr("if(LOAN_ID like '%55', null, DISBURSED_DATE)"))
    return loans, runs.unionByName(again)


def test_the_master_moves_once_for_outcomes_and_features(spark):
    loans, runs = even_loans_and_runs(spark)
    fact = runs.where("BRE_RUN_ID not like '%1'").select("CUSTOMER_ID", F.concat("BRE_RUN_ID", F.lit(" ")).alias("BRE_RUN_ID"), F.lit(1).alias("A"))
    args = ("2022-01-05", "2022-02-10", "2022-01-10")
    expected = O.features_for_master(O.labelled_master(runs, O.as_of_latest_run(loans, runs), *args), fact)
    got = monitoring.features_with_outcomes(runs, loans, fact, *args)
    assert got.columns == expected.columns and rows_of(got.collect()) == rows_of(expected.collect())
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = monitoring.features_with_outcomes(runs, loans, fact, *args)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_run#" in line.split("ENSURE")[0]]
    assert len(moved) == 3  # master, loans and fact, each once


def test_flags_do_not_move_with_the_decisions(spark):
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = decisions.decided(_blended(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "HashAggregate(keys" in line and "BUREAUSCORE" in line]
    assert grouped and not any("COMBINATION_TYPE" in line or "IS_BR_SUFF" in line for line in grouped)


def test_upsert_table_moves_an_even_source_once_and_stores_nothing(spark, tmp_path, monkeypatch):
    row = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 1000 == 1, None).otherwise((F.col("id") % 1500).cast("string")).alias("CUSTOMER_ID"),
        F.lit("r").alias("BRE_RUN_ID"), F.lit("X").alias("MODEL_TYPE"),
        F.date_add(F.lit(dt.date(2022, 1, 1)), (F.col("id") % 700).cast("int")).alias("BRE_RUN_DATE"), F.col("id").alias("V"),
    )
    target = row.where("V < 2000")  # some keys twice, some NULL
    fresh = row.where("V % 3 = 0 or CUSTOMER_ID is null").withColumn("CUSTOMER_ID", F.concat("CUSTOMER_ID", F.lit(" ")))
    source = fresh.select("CUSTOMER_ID", "BRE_RUN_ID", "MODEL_TYPE", "BRE_RUN_DATE", (F.col("V") + 10000).alias("N"))
    source = source.unionByName(source.where("N % 5 = 0").withColumn("BRE_RUN_DATE", F.date_sub("BRE_RUN_DATE", 1)))
    expected = upsert(target, source, new_columns=["N"])
    versions.replace(target, str(tmp_path), {"Y": "year(BRE_RUN_DATE)"})

    def storing(*_):
        raise AssertionError("stored")

    monkeypatch.setattr(upserts, "stored", storing)
    upserts.upsert_table(str(tmp_path), source, new_columns=["N"], source_stored=True)
    got = versions.read(spark, str(tmp_path))
    assert got.columns == expected.columns and rows_of(got.collect()) == rows_of(expected.collect())


def test_matured_outcomes_leave_other_loans_before_the_joins(spark):
    loans, runs = even_loans_and_runs(spark)
    runs = runs.withColumn("MODEL_TYPE", F.lit("X"))
    days, since, as_of = ("2022-01-05", "2022-02-10"), "2022-01-10", "2022-05-01"
    expected = scans.matured(O.labelled_master(runs, O.as_of_latest_run(loans, runs), *days, since), as_of)
    got = monitoring.matured_outcomes(runs, loans, *days, as_of, since)
    assert got.columns == expected.columns and rows_of(got.collect()) == rows_of(expected.collect())
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = got._jdf.queryExecution().executedPlan().toString()
    dated = [i for i, line in enumerate(plan.splitlines()) if "Filter" in line and "2022-02-01" in line]
    windows = [i for i, line in enumerate(plan.splitlines()) if " Window [last" in line]
    assert windows and max(dated) > max(windows)  # below the as-of window


def test_a_job_stores_only_the_columns_it_reads(spark):
    master = q_monitoring._master(spark, "/root/testdata/sf0.001", KS_SCORES)
    assert set(master.columns) == {"CUSTOMER_ID", "BRE_RUN_ID", "BRE_RUN_DATE", "MODEL_TYPE", *KS_SCORES}
