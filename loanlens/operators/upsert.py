"""Upsert of verdicts into the master, as a left join for updates and an anti join for inserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions import trimmed
from loanlens.operators.skew import hot_buckets
from loanlens.session import stored
from loanlens.sources import versions
from loanlens.sources.schemas import MASTER_KEYS


def _with_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"_key_{k.lower()}" for k in keys]
    return df.select("*", *[trimmed(k).alias(n) for k, n in zip(keys, names)]), names


def latest_per_key(
    df: DataFrame, keys: Sequence[str], latest_by: str = "BRE_RUN_DATE"
) -> DataFrame:
    """The latest row per key.  Rows with a NULL key match nothing and all stay.

    Ties on the date are settled by a hash of the row, so reruns agree.  The
    rows are read once: each with a NULL key is a group of its own, and of the
    other groups Spark keeps one row in each map task before the shuffle.
    """
    keyed, names = _with_keys(df, keys)
    return _latest(keyed, names, df.columns, latest_by).drop(*names)


def _latest(keyed: DataFrame, names: Sequence[str], columns: Sequence[str], latest_by: str) -> DataFrame:
    """The same of rows that have their trimmed keys beside them."""
    any_null = F.lit(False)
    for n in names:
        any_null = any_null | F.col(n).isNull()
    numbered = keyed.withColumn("_alone", F.when(any_null, F.monotonically_increasing_id()))
    order = Window.partitionBy(*names, "_alone").orderBy(
        F.col(latest_by).desc_nulls_last(), F.xxhash64(*[F.col(c) for c in columns])
    )
    latest = numbered.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return latest.drop("_n", "_alone")


def _carried(target: Sequence[str], source: DataFrame, keys: Sequence[str], new_columns: Sequence[str]) -> list[str]:
    """The columns of the merged rows that the source has."""
    given = {c.upper() for c in source.columns}
    missing = [c for c in [*keys, *new_columns] if c.upper() not in given]
    if missing:
        raise ValueError(f"source lacks {missing}")
    return [c for c in [*target, *new_columns] if c.upper() in given]


def _updated(
    target: DataFrame, fresh: DataFrame, names: Sequence[str], columns: Sequence[str],
    carried: Sequence[str], new_columns: Sequence[str], how: str = "left",
) -> DataFrame:
    """The target's rows, with the source's values where a key matches; the target is on the left.

    With ``how`` as ``full`` the source's other rows too.
    """
    changes = fresh.select(*names, F.struct(*carried).alias("_new"))
    joined = target.join(changes, list(names), how)
    matched = F.col("_new").isNotNull()

    def value(c: str) -> Column:
        if c in new_columns:
            return F.when(matched, F.col("_new")[c])
        if c in carried:
            return F.when(matched, F.col("_new")[c]).otherwise(F.col(c))
        return F.col(c)

    return joined.select(*[value(c).alias(c) for c in columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = tuple(MASTER_KEYS),
    latest_by: str = "BRE_RUN_DATE",
    new_columns: Sequence[str] = (),
) -> DataFrame:
    """The target after the merge: matched rows take the source's values, new keys are added.

    Keys are compared trimmed; of several source rows with one key the latest
    counts.  Every matched target row is updated and stays one row.  Columns
    the source lacks keep the target's value, NULL on added rows.
    ``new_columns`` are source columns an older target lacks, NULL on rows kept.
    Both joins have the larger side on the left, where a hot key can be split.
    """
    columns = [*target.columns, *new_columns]
    carried = _carried(target.columns, source, keys, new_columns)
    keyed_target, names = _with_keys(target, keys)
    fresh, _ = _with_keys(latest_per_key(source, keys, latest_by).select(*carried), keys)
    updated = _updated(keyed_target, fresh, names, columns, carried, new_columns)
    added = fresh.join(keyed_target.select(*names).distinct(), names, "left_anti").drop(*names)
    return updated.unionByName(added, allowMissingColumns=True).select(*columns)


def upsert_table(
    root: str,
    source: DataFrame,
    keys: Sequence[str] = tuple(MASTER_KEYS),
    latest_by: str = "BRE_RUN_DATE",
    new_columns: Sequence[str] = (),
    source_stored: bool = False,
) -> versions.Version:
    """The merge of ``upsert`` into a stored table (see ``sources.versions``), where only what changes is written.

    The target's key columns are read twice, to count them and to find the folders that hold a
    key of the source; those folders' rows are read and written anew, and all
    other files stay under their names.  Added rows, and updated ones that now
    belong to another partition, become new files beside those that are there.
    As many folder names as the table has come to the driver.  Readers see the
    old rows until the whole merge is written; Conflict is raised, and nothing
    changed, if another writer was faster.

    The keys of both sides are counted first.  Where none is hot, the source's
    rows move once, by key: the latest of each is taken where it meets the
    target's.  Otherwise the latest are stored first and joined such that
    adaptive execution can split a hot key.  ``source_stored`` says that the
    source reads stored rows, so reading it several times is cheap and gives the
    same; any other source is stored here.
    """
    spark = source.sparkSession
    before = versions.version(spark, root)
    if before is None:
        raise FileNotFoundError(f"no table under {root}")
    columns = [*before.schema.names, *new_columns]
    carried = _carried(before.schema.names, source, keys, new_columns)
    if not source_stored:
        source = stored(source, "upsert_source")
    everywhere = versions.rows_in(spark, root, before, before.all_folders(), "_folder")
    places, names = _with_keys(everywhere, keys)
    given = _with_keys(source, keys)[0].select(*names)
    if not hot_buckets(places.select(*names), names) and not hot_buckets(given, names):
        seen = places.select(*names, "_folder").join(given, names, "left_semi").select("_folder").distinct().collect()
        touched = versions.named(before, [r["_folder"] for r in seen])
        affected, _ = _with_keys(versions.rows_in(spark, root, before, touched), keys)
        dealt = _with_keys(source, keys)[0].repartition(*names)
        fresh = _latest(dealt, names, source.columns, latest_by)
        merged = _updated(affected, fresh, names, columns, carried, new_columns, "full")
        return versions.follow(spark, root, before, merged, touched)
    latest = stored(latest_per_key(source, keys, latest_by).select(*carried), "upsert_latest")
    fresh, _ = _with_keys(latest, keys)
    hits = stored(
        places.select(*names, "_folder").join(fresh.select(*names), names, "left_semi").distinct(), "upsert_hits"
    )
    touched = versions.named(before, [r["_folder"] for r in hits.select("_folder").distinct().collect()])
    affected, _ = _with_keys(versions.rows_in(spark, root, before, touched), keys)
    updated = _updated(affected, fresh, names, columns, carried, new_columns)
    added = fresh.join(hits.select(*names).distinct(), names, "left_anti").drop(*names)
    merged = updated.unionByName(added, allowMissingColumns=True).select(*columns)
    return versions.follow(spark, root, before, merged, touched)
