"""From raw documents to token ids: judged, cleaned, deduplicated, decontaminated, encoded.

Every stage takes (spark, docs, sf_dir) and returns what the next one reads;
all but the last return the columns of ``docs``.  ``run`` writes each stage's
result to the shared folder and reads it again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import sentencepiece_codec, simhash
from loanlens.llm.common import BLANKS, table
from loanlens.llm.decontamination import decontaminate
from loanlens.llm.line_dedup import line_dedup
from loanlens.llm.quality_rules import keep_good
from loanlens.session import stored, use_recommended

# XXH64 fingerprints have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _set_up(stage: Stage) -> Stage:
    """The stage, run with the settings the library recommends."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(use_recommended(spark), docs, sf_dir)

    return run


def _with_text(cleaned: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``row``, with the text ``clean`` and its length."""
    columns = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == "text":
            value = F.col("clean")
        elif c == "n_chars":
            # as it came where the text did not change
            same = F.col("clean").eqNullSafe(F.col("row.text"))
            value = F.when(same, value).otherwise(F.length("clean").cast(docs.schema[c].dataType))
        columns.append(value.alias(c))
    return cleaned.select(*columns)


@_set_up
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null, empty or very short text fails; repeated rows are judged alike, keys
    are not read; an empty table stays empty.
    """
    return keep_good(docs)


@_set_up
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines are cut; a document that loses all its words goes.

    Of equal lines that of the smallest key stays, so ties and repeated rows are
    settled by the key and text.  Null and empty texts stay; an empty table
    stays empty.
    """
    cleaned = line_dedup(docs)
    empty = (F.col("n_removed") > 0) & ~F.coalesce(F.col("clean"), F.lit("")).rlike(f"[^{BLANKS}]")
    return _with_text(cleaned.where(~empty), docs)


@_set_up
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component, that of the smallest key.

    Texts without words, null ones too, are one fingerprint and so one
    component; of repeated rows one stays; null keys are larger than any other.
    """
    return simhash.keep_first(docs)


@_set_up
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; a document that is mostly such passages goes.

    Null and empty texts have no hits and stay; repeated rows are treated alike;
    without items, or documents, nothing changes.
    """
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return _with_text(decontaminate(docs, items), docs)


@_set_up
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left.

    A null text has null ids, an empty one none; null and repeated keys stay.
    """
    coded = sentencepiece_codec.encode(docs, keep=["doc_id"])
    return coded.select(
        "row.doc_id", "coded.n_tokens", "coded.n_byte_tokens", "coded.ids", "coded.round_trip"
    )


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
