"""SimHash near-duplicates, found by covering locality-sensitive hashing.

For a radius r every bit position gets a nonzero vector of r + 1 bits, and each
nonzero vector v gives one table, whose mask keeps the positions with an odd
inner product with v.  The at most r vectors of the differing positions leave
some v orthogonal to all of them, so two fingerprints within the radius agree
under that table's mask: every such pair meets in a bucket.

Only distinct fingerprints are compared.  A bucket of few members is compared
in one row and yields a tree, not its pairs.  A bucket of more members is not
compared: each of its fingerprints is filed under every fingerprint within
half the radius of it, and two within the radius of each other share one, so
groups of any size are linked without forming pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.common import as_bytes, slices
from loanlens.llm.components import connected
from loanlens.session import stored

SHINGLE = 3
RADIUS = 2
MOST_COMPARED = 64
BITS = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the UTF-8 text: a bit is 1 if set in over half the shingle hashes."""
    words = text.lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    hashes = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    found = np.array(hashes, np.uint64)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(found), 1 << 16):
        part = found[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(found), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """Replaces the text by ``_print``, the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 << 20):
            prints = [fingerprint(t, shingle) for t in as_bytes(batch.column(text)).to_pylist()]
            signed = np.array(prints, np.uint64).view(np.int64)
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(signed)], [*kept, "_print"])

    kept = [c for c in docs.columns if c != text]
    schema = T.StructType([*[f for f in docs.schema if f.name != text], T.StructField("_print", T.LongType())])
    return docs.mapInArrow(run, schema)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask for each nonzero vector of radius + 1 bits."""
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(BITS) if bin((i % vectors + 1) & v).count("1") % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _trees(members: list[list[int]], radius: int) -> tuple[list[int], list[int]]:
    """For each list, links from linked members to the smallest of their component."""
    a, b = [], []
    for group in members:
        root = {x: x for x in group}

        def find(x: int, root=root) -> int:
            while root[x] != x:
                x = root[x]
            return x

        for x, y in combinations(sorted(root), 2):
            if ((x ^ y) & (2**64 - 1)).bit_count() <= radius:
                p, q = find(x), find(y)
                root[max(p, q)] = min(p, q)
        for x in root:
            if (r := find(x)) != x:
                a.append(x)
                b.append(r)
    return a, b


def _linked(groups: DataFrame, radius: int) -> DataFrame:
    """Links inside bounded groups of fingerprints (column ``members``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _trees(batch.column("members").to_pylist(), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return groups.select("members").mapInArrow(run, "a long, b long")


def _near(x: Column, distance: int) -> Column:
    """All fingerprints within a distance of x, itself included."""
    flips = [0]
    for k in range(1, distance + 1):
        flips += [sum(1 << i for i in bits) for bits in combinations(range(BITS), k)]
    masks = F.split(F.lit(",".join(str(_signed(f)) for f in flips)), ",").cast("array<long>")
    return F.transform(masks, lambda m: x.bitwiseXOR(m))


def links(prints: DataFrame, radius: int = RADIUS, most: int = MOST_COMPARED) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (``_print``) within the radius.

    Fingerprints of buckets with more than ``most`` members are filed under
    their neighbours within half the radius (rounded up) instead.  That many
    rows per fingerprint is a constant: 65 for a radius of 2.
    """
    tables = [
        F.struct(F.lit(t).alias("t"), F.col("_print").bitwiseAND(F.lit(_signed(mask))).alias("v"))
        for t, mask in enumerate(covering_masks(radius))
    ]
    filed = prints.select("_print", F.explode(F.array(*tables)).alias("_k")).select("_print", "_k.*")
    sizes = filed.groupBy("t", "v").agg(F.count("*").alias("n")).where("n > 1")
    placed = filed.join(sizes, ["t", "v"])
    few = placed.where(F.col("n") <= most).groupBy("t", "v").agg(F.collect_list("_print").alias("members"))
    half = (radius + 1) // 2
    many = placed.where(F.col("n") > most).select("_print").distinct()
    # a group has at most as many members as there are fingerprints within half the radius
    around = (
        many.select("_print", F.explode(_near(F.col("_print"), half)).alias("z"))
        .groupBy("z")
        .agg(F.collect_list("_print").alias("members"))
        .where(F.size("members") > 1)
    )
    return _linked(few.select("members").unionByName(around.select("members")), radius)


def components(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE, radius: int = RADIUS):
    """(documents with ``_print``, fingerprints with ``_first`` of their component).

    ``_first`` is the smallest (key is null, key, text hash) in the component.
    """
    slim = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_text"), F.col(text).alias("_whole"))
    prints = stored(with_fingerprint(slim, "_whole", shingle), "fingerprints")
    order = F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), F.col("_text").alias("text"))
    distinct = stored(prints.groupBy("_print").agg(F.min(order).alias("_least")), "distinct_prints")
    roots = connected(links(distinct, radius)).select(F.col("a").alias("_print"), F.col("b").alias("_root"))
    nodes = distinct.join(roots, "_print", "left").withColumn("_root", F.coalesce("_root", "_print"))
    firsts = nodes.groupBy("_root").agg(F.min("_least").alias("_first"))
    return prints, nodes.join(firsts, "_root").select("_print", "_first")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """The key, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    Components link fingerprints that differ in at most ``radius`` bits; their
    id is the smallest key in them.  A text of fewer words than a shingle is one
    shingle; without words (null, empty, blank) the fingerprint is zero and is
    linked like any other.  A null key is larger than any other, so an id is
    null only when all keys of the component are.  Repeated rows each give a
    row.  Other columns are not read; an empty table gives an empty result.
    """
    prints, found = components(docs, key, text, shingle, radius)
    return prints.join(found, "_print").select(
        F.col("_key").alias(key),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        F.col("_first.key").alias("component_id"),
    )


def keep_first(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One document of each component, that with the smallest key, with its columns.

    Of rows with equal key and text one stays.
    """
    _, found = components(docs, key, text, shingle, radius)
    firsts = found.select(F.struct("_first.key", "_first.text").alias("_id")).distinct()
    rows = docs.select(
        F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text")).alias("_id"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    return rows.join(firsts, "_id", "left_semi").dropDuplicates(["_id"]).select("row.*")
