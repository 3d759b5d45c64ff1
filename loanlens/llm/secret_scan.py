"""Secrets in texts, told from widely copied examples by who owns them.

Patterns find candidates; their values are hashed and counted over the whole
corpus by distinct owners and repositories.  A value that several owners hold
in several repositories is an example that was copied; one that stays with its
owner and looks random is taken as live.  The base kinds are reported in any
case; the other kinds only where the ownership says that they are live.
Column functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import bind
from loanlens.operators.skew import left_joins
from loanlens.session import stored

MIN_OWNERS = 3
MIN_REPOSITORIES = 3
MIN_DISTINCT = 8  # characters of a live value

_KEYWORDS = "password|passwd|secret|token|api_?key"
_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _KEYWORDS)
_ASSIGN = rf"""({_ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# kind, pattern, group of the value, least characters of the value; fixed values
BASE = [
    ("assign", _ASSIGN, 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
]
# further kinds by the shape of their values; fixed formats
ADDED = [
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/= ]*"),
    ("url", r"://[A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%+!$&*-]+@"),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    ("forge", "gh[pousr]_[A-Za-z0-9]{36,}"),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("payment", "[rs]k_live_[A-Za-z0-9]{16,}"),
    ("opaque", "[A-Za-z0-9+/_-]{20,}"),
]
KINDS = [k for k, *_ in BASE] + [k for k, _ in ADDED]
# base matches take their places first, so no further kind reports a part of one
_BASE_TAKEN = "|".join([_ASSIGN, "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"])
ADDED_PATTERN = "|".join([_BASE_TAKEN, *[p for _, p in ADDED]])
# a text without any of these holds nothing to report
_LIKELY = {
    "assign": f"""(?:{_ANY_CASE})["']?\\x20*[:=]""",
    "access": "AKIA[A-Z0-9]{12}",
    "hex": "[0-9a-f]{32}",
    "added": "[A-Za-z0-9+/_-]{20}|PRIVATE KEY-----|xox[abprs]-|[rs]k_live_|://[^/@]*:[^/@]*@|eyJ",
}
_SLICE = 1024


def running(sizes: Column) -> Column:
    """Sums of all elements up to each.  Worked out a slice at a time, so that no long array is copied for each element."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def within(total: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(total.alias("total"), none.alias("out")),
            lambda a, x: F.struct((a["total"] + x).alias("total"), F.concat(a["out"], F.array(a["total"] + x)).alias("out")),
        )

    def add(a: Column, k: Column) -> Column:
        part = F.slice(sizes, k * _SLICE + 1, F.lit(_SLICE))
        done = within(a["total"], part)
        return bind(
            done, lambda d: F.struct(d["total"].alias("total"), F.concat(a["out"], F.array(d["out"])).alias("out"))
        )

    slices = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _SLICE).cast("int"))
    start = F.struct(zero.alias("total"), F.array().cast("array<array<bigint>>").alias("out"))
    return F.when(F.size(sizes) > 0, F.flatten(F.aggregate(slices, start, add)["out"])).otherwise(none)


_SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _matches(text: Column, pattern: str, group: int, kind) -> Column:
    """All matches from left to right as (start, kind, end, value); code points, end excluded.

    ``kind`` gives a match's number from its value, or null to leave it out.
    """
    p = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda s: F.length(s).cast("long"))
    found, values = F.regexp_extract_all(text, p, 0), F.regexp_extract_all(text, p, group)

    def spans(sizes: Column) -> Column:
        return bind(running(sizes), lambda ends: F.transform(values, lambda v, i: F.struct(
            (F.get(ends, 2 * i)).alias("start"),
            kind(v).cast("int").alias("kind"),
            (F.get(ends, 2 * i + 1)).alias("end"),
            v.alias("value"),
        )))

    # sizes of gap, match, gap, match and so on
    sizes = F.flatten(F.zip_with(gaps, found, lambda g, m: F.array(g, F.coalesce(F.length(m), F.lit(0)).cast("long"))))
    return F.filter(bind(sizes, spans), lambda s: s["kind"].isNotNull())


def _kind_of_added(match: Column) -> Column:
    """The number of the further kind a match is of; null for base matches and for what cannot be live.

    A live value has at least ``MIN_DISTINCT`` characters; an opaque one also
    has small and capital letters and digits.
    """
    base = match.rlike(f"^(?:{_BASE_TAKEN})$")
    distinct = F.size(F.array_distinct(F.split(match, "")))
    kind = F.when(base | (distinct < MIN_DISTINCT), F.lit(None))
    for number, (name, pattern) in enumerate(ADDED, len(BASE)):
        fits = match.rlike(f"^(?:{pattern})$")
        if name == "opaque":
            fits = fits & match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")
        kind = kind.when(fits, F.lit(number))
    return kind


def candidates(text: Column) -> Column:
    """All candidate spans of a text by start and kind; an empty array for none, also for null."""
    none = F.array().cast(_SPAN)
    parts = []
    for number, (name, pattern, group, least) in enumerate(BASE):
        kind = lambda v, number=number, least=least: F.when(F.length(v) >= least, F.lit(number))
        # shorter runs are no matches, and their places end no other match of these kinds
        pattern = {"hex": "[0-9a-f]{32,}", "access": "AKIA[A-Z0-9]{12,}"}.get(name, pattern)
        parts.append(F.when(text.rlike(_LIKELY[name]), _matches(text, pattern, group, kind)).otherwise(none))
    parts.append(F.when(text.rlike(_LIKELY["added"]), _matches(text, ADDED_PATTERN, 0, _kind_of_added)).otherwise(none))
    return F.array_sort(F.concat(*[F.coalesce(p, none) for p in parts]))


def ownership(found: DataFrame) -> DataFrame:
    """Per ``value`` hash: the distinct ``owner``s and the distinct repositories.

    Counted in three steps, each added up in the map tasks, so that a value which
    a third of all rows hold reaches no task as that many rows.  A repository
    belongs to its owner; a null owner or repository counts as none.
    """
    places = found.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = places.groupBy("value", "owner").agg(F.count("repository").alias("n"))
    return owners.groupBy("value").agg(
        F.count("owner").alias("n_owners"), F.sum("n").cast("long").alias("n_repositories")
    )


def secret_scan(
    docs: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    keep: Sequence[str] | None = None,
    min_owners: int = MIN_OWNERS,
    min_repositories: int = MIN_REPOSITORIES,
) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, default all) with ``secrets``.

    ``secrets`` lists, by start and then kind as in ``KINDS``, every candidate:
    kind, start and end in code points (end excluded), the value's SHA-256,
    ``n_owners`` and ``n_repositories`` over the corpus, ``copied`` (at least
    ``min_owners`` owners and ``min_repositories`` repositories hold the value)
    and ``reported``: base kinds always, further kinds if not copied.

    A null or empty text has no secrets.  A null owner or repository counts as
    none.  Repeated rows have the same secrets and add no owner; rows of one key
    and different texts are told apart.  An empty table gives an empty result.
    """
    kept = docs.columns if keep is None else list(keep)
    whole = F.col(f"`{text}`")
    found = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
            F.col(f"`{owner}`").cast("string").alias("owner"),
            F.col(f"`{repository}`").cast("string").alias("repository"),
            F.transform(
                candidates(whole),
                lambda s: F.struct(s["start"], s["kind"], s["end"], F.sha2(s["value"].cast("binary"), 256).alias("value")),
            ).alias("spans"),
            F.monotonically_increasing_id().alias("id"),  # fixed by the write
        ),
        "secret_spans",
    )
    holds = F.size("spans") > 0
    spread = found.where(holds).select("id", "owner", "repository", F.posexplode("spans").alias("at", "span"))
    spread = spread.select("id", "owner", "repository", "at", "span", F.col("span.value").alias("value"))
    counted = stored(ownership(spread.select("value", "owner", "repository")), "secret_owners")
    known = left_joins(spread.select("id", "at", "span", "value"), [counted], ["value"])
    copied = (F.col("n_owners") >= min_owners) & (F.col("n_repositories") >= min_repositories)
    names = F.array(*[F.lit(k) for k in KINDS])
    secret = F.struct(
        "at",
        F.get(names, F.col("span.kind")).alias("kind"),
        F.col("span.start").alias("start"),
        F.col("span.end").alias("end"),
        F.col("value").alias("sha256"),
        "n_owners",
        "n_repositories",
        copied.alias("copied"),
        ((F.col("span.kind") < len(BASE)) | ~copied).alias("reported"),
    )
    told = known.groupBy("id").agg(F.array_sort(F.collect_list(secret)).alias("secrets"))
    none = F.filter(F.array(F.lit(None).cast(told.schema["secrets"].dataType.elementType)), lambda _: F.lit(False))
    with_any = found.where(holds).select("id", "row").join(told, "id").select("row", "secrets")
    return with_any.unionByName(found.where(~holds).select("row", none.alias("secrets")))
