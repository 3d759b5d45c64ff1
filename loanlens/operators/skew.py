"""Joins that stay balanced when one key holds a large part of the rows.

A single equi-join needs no help: adaptive execution splits a hot partition of
the left side of left, inner and anti joins, and of either side of inner joins.
Two cases need a different plan and are built here: several joins in a row on
one key, where adaptive execution cannot split, and left joins whose right side
is the hot one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loanlens.session import stored

BUCKETS = 65_536
HOT_SHARE = 0.005
MOST_COUNTED = 400  # of a sketch's buckets that are kept; no more than 1 / HOT_SHARE of them can be hot
SKETCH_ITEMS = 16_384  # that a sketch tracks: its counts are off by less than 0.03 % of the rows

Hot = Mapping[int, float]


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS))


def hot_buckets(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> dict[int, float]:
    """Hash buckets of the keys that hold more than ``share`` of the rows, with their shares.

    Runs when it is called: it reads the key columns alone and counts in the map
    tasks; one row with at most 1 / share buckets comes back.  An even key has
    no such bucket.
    """
    counts = df.groupBy(_bucket(keys).alias("b")).agg(F.count("*").alias("n"))
    row = (
        counts.agg(F.sum("n").alias("total"), F.array_agg(F.struct("n", "b")).alias("all"))
        .selectExpr(f"transform(filter(all, x -> x.n > total * {share}D), x -> struct(x.b as b, x.n / total as s)) as hot")
        .first()
    )
    return {r["b"]: r["s"] for r in row["hot"] or []}


@dataclass(frozen=True)
class KeyCounts:
    """Counts of the rows by hash bucket of some keys, which the job that writes the rows makes.

    Each task keeps a sketch of the most frequent buckets, and the sketches are
    merged.  A task that ran twice, after a lost executor, counts twice: good
    enough to choose a plan, which is all that these counts are for.
    """

    observation: Observation
    names: Sequence[str]

    def counts(self) -> dict[str, dict]:
        """By name of the keys ``rows`` and ``buckets``, the largest first; waits for the job."""
        seen = self.observation.get
        return {
            name: {"rows": seen[f"n{i}"], "buckets": {str(b["item"]): b["count"] for b in seen[f"b{i}"] if b["item"] is not None}}
            for i, name in enumerate(self.names)
        }


def counted_keys(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> tuple[DataFrame, KeyCounts]:
    """The rows, and counts of keys (SQL expressions by name) that the next job over them makes.

    Rows with a NULL in the key are left out: as a join's right side they never match.
    """
    seen, metrics = Observation(), []
    for i, parts in enumerate(keys.values()):
        columns = [F.expr(e) for e in parts]
        given = F.lit(True)
        for c in columns:
            given = given & c.isNotNull()
        bucket = F.when(given, F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)))
        metrics += [
            F.count(bucket).alias(f"n{i}"),
            F.call_function("approx_top_k", bucket, F.lit(MOST_COUNTED), F.lit(SKETCH_ITEMS)).alias(f"b{i}"),
        ]
    return (df.observe(seen, *metrics) if metrics else df), KeyCounts(seen, list(keys))


def merged_hot(counts: Sequence[Mapping], share: float = HOT_SHARE) -> dict[int, float]:
    """Hot buckets of rows that several jobs wrote, from the counts of each.

    A bucket that is hot in all of them together is so in one at least, and
    that one kept it.
    """
    total, sums = sum(c["rows"] for c in counts), {}
    for c in counts:
        for b, n in c["buckets"].items():
            sums[int(b)] = sums.get(int(b), 0) + n
    return {b: n / total for b, n in sums.items() if n > total * share}


def stored_with_hot(
    df: DataFrame, name: str, keys: Sequence[str], share: float = HOT_SHARE
) -> tuple[DataFrame, dict[int, float]]:
    """``session.stored``, and the hot buckets of the keys (SQL expressions), counted by that write."""
    counted, kept = counted_keys(df, {"keys": keys})
    rows = stored(counted, name)
    return rows, merged_hot([kept.counts()["keys"]], share)


def left_joins(
    big: DataFrame,
    lookups: Sequence[DataFrame],
    keys: Sequence[str],
    counted: DataFrame | None = None,
    share: float = HOT_SHARE,
    distinct: bool = False,
) -> DataFrame:
    """Left joins of ``big`` with each lookup on the same keys; ``big`` moves once.

    With ``distinct``, equal rows of ``big`` count once.  They meet where the
    joins need them, also under a hot key, whose groups go by a hash of the row.

    Rows under a hot key (a NULL key may be one) are spread over groups by a
    hash of the row, and the lookup rows of that bucket are repeated once per
    group; all other rows stay in group 0 and nothing is repeated for them.  A
    bucket gets twice as many groups as its share of the rows is worth in
    shuffle partitions, so a group is smaller than a usual partition.

    The plan depends on the data: which buckets hold more than ``share`` of the
    rows is counted, when this is called, on ``counted``, a cheaper frame with
    the same keys, or on ``big``.  The result is exact either way.
    """
    on = list(keys)
    hot = hot_buckets(big if counted is None else counted, on, share)
    if not hot:
        if distinct:
            big = big.repartition(*on).distinct()
        for lookup in lookups:
            big = big.join(lookup, on, "left")
        return big
    partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.create_map(
        *[F.lit(x).cast(t) for b, s in hot.items() for x, t in ((b, "bigint"), (max(2, math.ceil(2 * s * partitions)), "int"))]
    )
    salts = F.coalesce(F.element_at(spread, _bucket(on)), F.lit(1))
    row_hash = F.xxhash64(F.lit("group"), *[F.col(c) for c in big.columns])
    groups = F.sequence(F.lit(0), salts - 1)
    joined = big.withColumn("_group", F.pmod(row_hash, salts).cast("int"))
    if distinct:
        joined = joined.repartition(*on, "_group").distinct()
    for lookup in lookups:
        repeated = lookup.select("*", F.explode(groups).alias("_group"))
        joined = joined.join(repeated, [*on, "_group"], "left")
    return joined.drop("_group")


def left_join(
    kept: DataFrame, lookup: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, hot: Hot | None = None
) -> DataFrame:
    """A plain left join, unless one key holds much of the lookup (see ``left_join_many``).

    The plan depends on the data.  ``hot`` gives the lookup's hot buckets where
    they are known, from ``versions.hot_buckets`` or ``stored_with_hot``; then
    no job runs here.  Without it the key columns of the lookup are counted when
    this is called, to see whether a bucket holds more than ``share`` of it.
    """
    if hot is None:
        hot = hot_buckets(lookup, keys, share)
    if hot:
        return left_join_many(kept, lookup, keys)
    return kept.join(lookup, list(keys), "left")


def left_join_many(kept: DataFrame, many: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``kept`` with a right side that may hold many rows per key.

    As an inner join, whose hot side adaptive execution can split, and an anti
    join with the distinct keys for the rows without a match.  A plain left
    join could not split its right side.
    """
    on = list(keys)
    matched = kept.join(many, on)
    unmatched = kept.join(many.select(*on).distinct(), on, "left_anti")
    columns = [*kept.columns, *[c for c in many.columns if c not in on]]
    return matched.select(*columns).unionByName(unmatched, allowMissingColumns=True)
