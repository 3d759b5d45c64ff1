"""Writing result tables and snapshots of the master."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.sources import versions

_WIDENED = {
    T.ByteType: "bigint",
    T.ShortType: "bigint",
    T.IntegerType: "bigint",
    T.LongType: "bigint",
    T.FloatType: "double",
    T.DoubleType: "double",
    T.StringType: "string",
    T.BooleanType: "boolean",
    T.DateType: "date",
    T.TimestampType: "timestamp",
    T.TimestampNTZType: "timestamp_ntz",
}


def table_name(identifier: str, dataset: str) -> str:
    """The one name under which a result is both written and read."""
    return f"{identifier}_{dataset.lower()}_dag_version_two"


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def warehouse_types(df: DataFrame) -> DataFrame:
    """Integers as bigint, floats as double; other types but text, flags and dates raise."""
    columns = []
    for field in df.schema:
        target = _WIDENED.get(type(field.dataType))
        if target is None:
            raise TypeError(f"{field.name}: no table type for {field.dataType.simpleString()}")
        columns.append(F.col(field.name).cast(target).alias(field.name))
    return df.select(*columns)


def _as_stored(df: DataFrame) -> DataFrame:
    return upper_columns(warehouse_types(df))


def overwrite_table(
    df: DataFrame, identifier: str, dataset: str, partition_by: Sequence[str] = ()
) -> str:
    """Create or replace a catalog name and return it.

    The rows are written as a new version beside the old one, in the warehouse
    folder, and the name is then pointed at it in one step: readers never see
    an empty or half-written table, and a failed write changes nothing.  The
    version before stays for those who still read it.
    """
    spark, name = df.sparkSession, table_name(identifier, dataset)
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions"
    by = [c.upper() for c in partition_by]
    done = versions.replace(_as_stored(df), root, by)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE `{name}`")  # from before tables had versions
    typed = ", ".join(f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in done.schema)
    run = "/".join(done.all_folders()[0].split("/")[:2]) if done.folders else None
    if run is None:
        nothing = ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in done.schema)
        rows = f"SELECT {nothing} WHERE false"
    else:
        rows = f"SELECT {typed} FROM parquet.`{root}/{run}`"
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS {rows}")
    return name


def overwrite_path(
    df: DataFrame,
    root: str,
    identifier: str,
    dataset: str,
    partition_by: Sequence[str] = (),
    checks: Sequence[versions.Verified] = (),
) -> str:
    """The same as files under a shared folder; returns the path, for ``read_path``.

    ``checks`` are verified after the write; a failed one raises, and the old
    rows stay.
    """
    path = f"{root.rstrip('/')}/{table_name(identifier, dataset)}"
    versions.replace(_as_stored(df), path, [c.upper() for c in partition_by], checks=checks)
    return path


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """The last version of what ``overwrite_path`` or an upsert wrote."""
    return versions.read(spark, path)


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new snapshot next to the one being read; an existing one is never touched.

    An upsert reads its target while it writes, so each run writes a path of
    its own and readers switch once the write has finished.
    """
    writer = _as_stored(df).write.format("parquet").mode("errorifexists")
    by = [c.upper() for c in partition_by]
    (writer.partitionBy(*by) if by else writer).save(path)
    return path
