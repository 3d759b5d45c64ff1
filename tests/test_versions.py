import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loanlens.operators.checks import checked_numbers, checked_rows
from loanlens.operators.outcomes import RUN_KEYS, features_for_master
from loanlens.operators.skew import hot_buckets
from loanlens.operators.trees import from_dump, tree_probability, tree_value
from loanlens.operators.upsert import upsert, upsert_table
from loanlens.session import run_folder, shared_folder, stored
from loanlens.sources import sinks, versions

ROW = "CUSTOMER_ID string, BRE_RUN_ID string, MODEL_TYPE string, BRE_RUN_DATE date, V string"


def row(c, r, day, v, m="XG"):
    return (c, r, m, dt.date.fromisoformat(day), v)


TARGET = [
    row("a", "1", "2021-03-01", "old"), row("b", "2", "2021-05-01", "old"), row("c", "3", "2022-01-01", "old"),
    row("d", "4", "2023-01-01", "old"), row("d", "4", "2023-02-01", "old"), row(None, "5", "2024-01-01", "old"),
    row("e", "6", "2025-06-01", "old"),
]
SOURCE = [
    row(" a ", "1", "2021-03-02", "new"), row("a", "1", "2021-03-01", "stale"),
    row("c", "3", "2025-01-01", "moved"),  # to another partition
    row("d", "4", "2023-03-01", "both"), row("f", "7", "2020-01-01", "added"), row(None, "5", "2024-01-01", "unmatched"),
    row(None, "5", "2024-01-01", "unmatched"),
]
YEAR = {"Y": "year(BRE_RUN_DATE)"}


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def files(root):
    found = {}
    for folder, _, names in os.walk(root):
        found |= {os.path.join(folder, n): os.path.getmtime(os.path.join(folder, n)) for n in names if n.endswith(".parquet")}
    return found


def failing(df):
    """Rows of which the last can not be worked out."""
    return df.withColumn("V", F.when(F.col("CUSTOMER_ID") == "e", F.raise_error(F.lit("broken"))).otherwise(F.col("V")))


@pytest.mark.parametrize("by", [YEAR, ["MODEL_TYPE"], ["BRE_RUN_DATE"], []])
def test_merge_into_a_table_equals_the_merge_of_frames(spark, tmp_path, by):
    root, target = str(tmp_path / "t"), spark.createDataFrame(TARGET, ROW)
    source = spark.createDataFrame(SOURCE, ROW)
    versions.replace(target, root, by)
    upsert_table(root, source)
    expected = upsert(target, source)
    got = versions.read(spark, root)
    assert rows_of(got) == rows_of(expected) and got.columns == target.columns
    upsert_table(root, source.where("CUSTOMER_ID is not null"))  # once more changes nothing
    assert rows_of(versions.read(spark, root)) == rows_of(expected)


def test_untouched_files_keep_their_names(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace(spark.createDataFrame(TARGET, ROW), root, YEAR)
    before = files(root)
    done = upsert_table(root, spark.createDataFrame(SOURCE, ROW))
    after = files(root)
    assert before.items() <= after.items()  # the version before is still whole
    used = {f for f in after if any(folder in f for folder in done.all_folders())}
    kept = {f for f in before if f in used}
    # 2021, 2022 and 2023 hold a key of the source; 2025 got a row more and 2024 a second folder
    assert {f.split("Y=")[1][:4] for f in kept} == {"2024", "2025"}
    assert {p: len(fs) for p, fs in done.folders.items()} == {"Y=2020": 1, "Y=2021": 1, "Y=2023": 1, "Y=2024": 2, "Y=2025": 2}


def test_new_columns_and_missing_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    source = spark.createDataFrame(SOURCE[:1], ROW).withColumn("RULE", F.lit("PASS"))
    with pytest.raises(FileNotFoundError):
        upsert_table(root, source)
    versions.replace(spark.createDataFrame(TARGET, ROW), root, YEAR)
    upsert_table(root, source, new_columns=["RULE"])
    got = {(r.BRE_RUN_ID, r.RULE) for r in versions.read(spark, root).collect()}
    assert ("1", "PASS") in got and ("6", None) in got and len(got) == 6
    with pytest.raises(ValueError, match="source lacks"):
        upsert_table(root, source.drop("MODEL_TYPE"))


def test_partitions_with_awkward_names(spark, tmp_path):
    kinds = ["a b", "é/x", "100%", "x=y", "", None, "plain"]
    target = spark.createDataFrame([row(f"c{i}", "1", "2021-01-01", "old", m) for i, m in enumerate(kinds)], ROW)
    source = spark.createDataFrame([row(f"c{i}", "1", "2021-01-02", "new", m) for i, m in enumerate(kinds)], ROW)
    root = str(tmp_path / "t")
    versions.replace(target, root, ["MODEL_TYPE"])
    stored = versions.read(spark, root)  # an empty name is stored as NULL
    upsert_table(root, source)
    assert rows_of(versions.read(spark, root)) == rows_of(upsert(stored, source).withColumn(
        "MODEL_TYPE", F.when(F.col("MODEL_TYPE") != "", F.col("MODEL_TYPE"))))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    target = spark.createDataFrame(TARGET, ROW)
    path = sinks.overwrite_path(target, str(tmp_path), "master", "T")
    for broken in (failing(target), failing(target).repartition(4)):
        with pytest.raises(Exception, match="broken"):
            sinks.overwrite_path(broken, str(tmp_path), "master", "T")
        with pytest.raises(Exception, match="broken"):
            upsert_table(path, broken.withColumn("BRE_RUN_DATE", F.current_date()))
        assert rows_of(sinks.read_path(spark, path)) == rows_of(target)
    sinks.overwrite_path(target.limit(2), str(tmp_path), "master", "T")
    assert sinks.read_path(spark, path).count() == 2


def test_a_failed_write_leaves_the_catalog_name(spark, tmp_path):
    target = spark.createDataFrame(TARGET, ROW)
    folder = os.path.basename(str(tmp_path)).replace("-", "_")
    name = sinks.overwrite_table(target, folder, "MASTER", ["MODEL_TYPE"])
    try:
        with pytest.raises(Exception, match="broken"):
            sinks.overwrite_table(failing(target), folder, "MASTER")
        assert rows_of(spark.table(name)) == rows_of(target.select(spark.table(name).columns))
        held = spark.table(name)  # a reader of the version before
        sinks.overwrite_table(target.where("V = 'none'"), folder, "MASTER", ["MODEL_TYPE"])
        assert spark.table(name).count() == 0 and spark.table(name).dtypes == target.dtypes
        assert held.count() == len(TARGET)
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}")


def test_old_versions_go_after_a_grace_count(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(4):
        versions.replace(spark.range(n + 1), root)
    assert versions.version(spark, root).number == 4
    assert versions.read(spark, root).count() == 4 and versions.read(spark, root, 3).count() == 3
    assert versions.version(spark, root, 2) is None and len(os.listdir(f"{root}/data")) == 2


def test_of_two_writers_from_one_version_the_second_fails(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace(spark.createDataFrame(TARGET, ROW), root, YEAR)
    before = versions.version(spark, root)
    changed = spark.createDataFrame(SOURCE[4:5], ROW)
    versions.follow(spark, root, before, changed, [])
    with pytest.raises(versions.Conflict):
        versions.follow(spark, root, before, changed, [])
    assert versions.read(spark, root).count() == len(TARGET) + 1


# --- checks that the write itself counts ------------------------------------------


def jobs_of(spark, run):
    """What a call returns, and the number of jobs it started."""
    group = f"g{id(run)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_key_counts_are_kept_with_the_table(spark, tmp_path):
    """Counted by the writes, merged over the runs of a version, and read without a job."""
    root, keys = str(tmp_path / "t"), {"run": RUN_KEYS}
    many = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 4 == 0, F.lit(" hot ")).when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("c"), "id")).alias("CUSTOMER_ID"),
        F.when(F.col("id") % 4 == 0, F.lit("1")).otherwise(F.col("id").cast("string")).alias("BRE_RUN_ID"),
        F.lit("XG").alias("MODEL_TYPE"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("BRE_RUN_DATE"),
        F.lit("v").alias("V"),
    )
    done = versions.replace(many, root, YEAR, key_counts=keys)
    (bucket, share), = versions.hot_buckets(done, "run").items()
    assert share == pytest.approx(1000 / 3920, abs=0.001)
    exact = hot_buckets(versions.read(spark, root).selectExpr(*[f"{e} AS k{i}" for i, e in enumerate(RUN_KEYS)]).dropna(), ["k0", "k1"])
    assert exact.keys() == {bucket} and exact[bucket] == pytest.approx(share)
    assert versions.hot_buckets(versions.version(spark, root), "run") == {bucket: share}
    upsert_table(root, spark.createDataFrame([row("c2", "2", "2021-01-03", "new"), row("z", "9", "2030-01-01", "new")], ROW))
    after = versions.version(spark, root)
    assert after.keys == {"run": list(RUN_KEYS)} and set(after.counted) == set(after.runs())
    assert versions.hot_buckets(after, "run").keys() == {bucket}
    with pytest.raises(KeyError):
        versions.hot_buckets(after, "other")
    plain = versions.replace(many.limit(0), root)
    assert plain.counted == {} and versions.hot_buckets(versions.replace(many.limit(0), root, key_counts=keys), "run") == {}


def test_joins_with_kept_counts_start_no_job(spark, tmp_path):
    root = str(tmp_path / "fact")
    fact = spark.createDataFrame([("hot", "1", i) for i in range(300)] + [(f"c{i}", str(i), i) for i in range(300)], "CUSTOMER_ID string, BRE_RUN_ID string, F long")
    master = spark.createDataFrame([(" hot", "1", 0.5), ("c7", "7 ", 0.1), ("none", "0", 0.2)], "CUSTOMER_ID string, BRE_RUN_ID string, PD double")
    hot = versions.hot_buckets(versions.replace(fact, root, key_counts={"run": RUN_KEYS}), "run")
    read = versions.read(spark, root)
    group = f"kept-{root}"
    spark.sparkContext.setJobGroup(group, "plan")
    try:
        joined = features_for_master(master, read, hot=hot)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        features_for_master(master, read)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert "LeftAnti" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(joined) == rows_of(features_for_master(master, read, hot={})) and joined.count() == 302


def test_failed_casts_are_counted_by_the_write(spark, tmp_path):
    good = spark.createDataFrame([("r", "1"), ("s", None), ("t", "2.5")], "BRE_RUN_ID string, X string")
    bad = good.unionByName(spark.createDataFrame([("u", "many")], "BRE_RUN_ID string, X string"))
    plain = lambda df: sinks.overwrite_path(df, str(tmp_path), "plain", "T")
    _, alone = jobs_of(spark, lambda: plain(good))

    def checked(df):
        numbers, check = checked_numbers(df, ["X"])
        return sinks.overwrite_path(numbers, str(tmp_path), "checked", "T", checks=[check]), check

    (path, check), together = jobs_of(spark, lambda: checked(good))
    assert check.counts() == {"c0": 0} and together == alone
    with pytest.raises(ValueError, match="'X': 1"):
        checked(bad)
    assert sorted(r.X for r in sinks.read_path(spark, path).collect() if r.X) == [1.0, 2.5]


def test_rows_are_counted_by_the_write(spark, tmp_path):
    rows, check = checked_rows(spark.range(3), "scores")
    path = sinks.overwrite_path(rows, str(tmp_path), "rows", "T", checks=[check])
    assert check.counts() == {"n": 3}
    none, check = checked_rows(spark.range(3).where("id > 5"), "scores")
    with pytest.raises(ValueError, match="scores: 0 rows"):
        sinks.overwrite_path(none, str(tmp_path), "rows", "T", checks=[check])
    assert sinks.read_path(spark, path).count() == 3


# --- trees with directions for missing values ------------------------------------

SPLITS = {
    "feature": "x", "threshold": 1.0, "missing": "high",
    "low": {"feature": "k", "categories": ["a", "it's"], "missing": "low", "low": {"value": 1.0}, "high": {"value": 2.0}},
    "high": {"feature": "y", "threshold": 0.0, "strict": True, "missing": "low", "low": {"value": 3.0}, "high": {"value": 4.0}},
}


def test_missing_values_and_categories_go_their_ways(spark):
    cases = [
        (0.0, 0.0, "a", 1.0), (1.0, 0.0, "it's", 1.0), (1.0, 0.0, None, 1.0), (1.0, 0.0, "z", 2.0),
        (None, -1.0, "a", 3.0), (None, None, None, 3.0), (2.0, 0.0, "a", 4.0), (2.0, -0.5, "a", 3.0),
    ]
    df = spark.createDataFrame(cases, "x double, y double, k string, expected double")
    assert [r.v for r in df.select(tree_value(SPLITS).alias("v")).collect()] == [c[3] for c in cases]
    with pytest.raises(ValueError, match="low or high"):
        tree_value({**SPLITS, "missing": "left"})


def test_a_dump_of_numbered_nodes(spark):
    dump = {
        "nodeid": 0, "split": "x", "split_condition": 1.0, "yes": 1, "no": 2, "missing": 2,
        "children": [
            {"nodeid": 1, "split": "k", "split_condition": ["a"], "yes": 3, "no": 4, "missing": 3,
             "children": [{"nodeid": 3, "leaf": 0.1}, {"nodeid": 4, "leaf": 0.2}]},
            {"nodeid": 2, "leaf": 0.3},
        ],
    }
    df = spark.createDataFrame([(0.5, "a"), (0.5, "b"), (0.5, None), (1.0, "a"), (None, "a")], "x double, k string")
    got = df.select(tree_value(from_dump([dump])[0]["root"]).alias("v")).collect()
    assert [r.v for r in got] == [0.2, 0.1, 0.1, 0.3, 0.3]


def test_many_deep_trees_compile(spark):
    def grown(depth, seed):
        if not depth:
            return {"value": (seed % 7) / 10}
        kids = {"low": grown(depth - 1, seed * 2), "high": grown(depth - 1, seed * 2 + 1)}
        return {"feature": f"f{seed % 5}", "threshold": float(seed % 11), "missing": "high", **kids}

    trees = [{"weight": 0.1, "root": grown(6, n)} for n in range(1, 101)]
    df = spark.range(1000).select(*[F.when(F.col("id") % (i + 2) > 0, F.col("id") % 13).cast("double").alias(f"f{i}") for i in range(5)])

    def walked(r, node):
        while "value" not in node:
            v = r[node["feature"]]
            node = node["high" if v is None or v > node["threshold"] else "low"]
        return node["value"]

    import math

    for r in df.select("*", tree_probability(trees, 1.0, -2.0).alias("p")).collect():
        z = -2.0 + sum(0.1 * walked(r, t["root"]) for t in trees)
        assert r.p == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)


def test_a_run_leaves_no_stored_rows(spark):
    with run_folder(spark) as folder:
        first = stored(spark.range(5), "numbers")
        with run_folder(spark) as inner:
            assert inner.startswith(folder) and stored(spark.range(3), "more").count() == 3 and os.path.isdir(inner)
        assert not os.path.exists(inner) and first.count() == 5
    assert not os.path.exists(folder)
    with pytest.raises(ZeroDivisionError), run_folder(spark) as folder:
        stored(spark.range(5), "numbers")
        raise ZeroDivisionError
    assert not os.path.exists(folder) and not shared_folder(spark).startswith(folder)
