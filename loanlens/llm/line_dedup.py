"""Boilerplate lines, told by how many distinct sites repeat them.

A HyperLogLog sketch of the sites is built per line hash in the map tasks and
merged by the aggregation, so a line that a third of all rows repeat reaches
the shuffle as one sketch per task.  Estimates clearly above or below the
threshold decide; lines within the sketches' error of it get an exact distinct
count.  Column functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import BLANKS, bind
from loanlens.session import stored

MIN_SITES = 5
LG_K = 12
_LINE = ["_h", "_c"]


def _has_word(line: Column) -> Column:
    return line.rlike(f"[^{BLANKS}]")


def site_spread(lines: DataFrame, site: str, lg_k: int = LG_K) -> DataFrame:
    """Per line hash: the estimated number of sites, the number of places, the first place."""
    return lines.groupBy(*_LINE).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(F.col(site), F.lit(lg_k))).alias("_sites"),
        F.count("*").alias("_n"),
        F.min("_place").alias("_first"),
    )


def boilerplate(lines: DataFrame, site: str, min_sites: int, lg_k: int = LG_K) -> DataFrame:
    """Line hashes on at least ``min_sites`` distinct sites, with their first place.

    The band of exact counts is four standard errors of the sketch plus one.
    """
    band = 4 * 1.04 / math.sqrt(2**lg_k) * min_sites + 1
    # a line in fewer places than that has fewer sites
    likely = site_spread(lines, site, lg_k).where(
        (F.col("_n") >= min_sites) & (F.col("_sites") >= min_sites - band)
    )
    likely = stored(likely, "line_spread")
    sure, near = F.col("_sites") > min_sites + band, F.col("_sites") <= min_sites + band
    exact = (
        lines.join(likely.where(near).select(*_LINE), _LINE, "left_semi")
        .groupBy(*_LINE)
        .agg(F.count_distinct(site).alias("_exact"))
        .where(F.col("_exact") >= min_sites)
        .select(*_LINE)
    )
    counted = likely.where(near).join(exact, _LINE, "left_semi")
    return likely.where(sure).unionByName(counted).select(*_LINE, "_first")


def _without(lines: Column, places: Column) -> Column:
    """The lines that are not at the sorted places, as slices between them."""
    last = F.size(places)

    def run(i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(places, i - 1) + 1)
        end = F.when(i == last, F.size(lines)).otherwise(F.get(places, i))
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), last), run))


def line_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    lg_k: int = LG_K,
) -> DataFrame:
    """Removes lines found on ``min_sites`` or more distinct sites, but for their first place.

    Returns ``row`` (a struct of all columns as they came), ``clean`` (the text
    that is left), ``n_lines`` and ``n_removed``.  The first place is that with
    the smallest key, then text hash, then line number; it stays, so a document
    that others copied keeps its text.

    Lines are compared whole; lines without a word are never removed.  A null
    text stays null with no lines, an empty one has one empty line.  A null site
    counts as no site; a null key is smaller than any other.  Rows with equal
    key and text are treated alike.  An empty table gives an empty result.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(key).alias("_key"),
        F.xxhash64(text).alias("_text"),
        F.col(text).alias("_whole"),
    )
    lines = (
        docs.select(
            F.col(key).alias("_key"),
            F.xxhash64(text).alias("_text"),
            F.col(site).cast("string").alias("_site"),
            F.posexplode(F.split(F.col(text), "\n")).alias("_at", "_line"),
        )
        .where(_has_word(F.col("_line")))
        .select(
            "_site",
            F.struct("_key", "_text", "_at").alias("_place"),
            F.xxhash64("_line").alias("_h"),
            F.hash("_line").alias("_c"),
        )
    )
    found = boilerplate(lines, "_site", min_sites, lg_k)
    removed = (
        lines.select("_place", *_LINE)
        .join(found, _LINE)
        .where(F.col("_place") != F.col("_first"))
        .groupBy(F.col("_place._key").alias("_k"), F.col("_place._text").alias("_t"))
        .agg(F.sort_array(F.collect_set("_place._at")).alias("_out"))
    )
    joined = rows.join(
        removed, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_text") == F.col("_t")), "left"
    )
    kept = bind(F.split("_whole", "\n"), lambda x: F.array_join(_without(x, F.col("_out")), "\n"))
    return joined.select(
        "row",
        F.when(F.col("_out").isNull(), F.col("_whole")).otherwise(kept).alias("clean"),
        F.coalesce(F.size(F.split("_whole", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_out"), F.lit(0)).cast("long").alias("n_removed"),
    )
