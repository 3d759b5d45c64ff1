"""Column helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The listed columns of a driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once per row, however often it is used.

    A plain column would be put in at every place, inside lambdas even once for
    each element.
    """
    return F.get(F.transform(F.array(value), use), 0)


def blank_split(text: Column) -> Column:
    """Words between blanks (space, and U+0009 to U+000D), in order."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column: pa.Array) -> pa.Array:
    """A string column as binary; nulls become empty."""
    return pc.fill_null(pc.cast(column, pa.large_binary()), b"")


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a text column holds about ``most_bytes`` in each.

    One longer text makes a slice of its own; no text is cut.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
