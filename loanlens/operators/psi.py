"""Population stability index of features and scores against a baseline.

Numbers: ten buckets from the baseline (quantiles or equal width) and one for
missing.  Categories: the categories of the baseline.  A share of zero counts
as 0.0001.  New values outside the baseline's range are in no bucket but count
in the total.  NULL marks a missing number.

Everything is counted before it meets: the new rows are read once for all
modules, months and variables, and the joins see only counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.operators.quantiles import exact_quantiles, sketched_quantiles
from loanlens.session import stored
from loanlens.sources.assets import Roles

BUCKETS = 10
TINY = 0.0001
OVERALL = "OVERALL"
PLACEHOLDER = "--"
BLOCK = 24
NUMBER, CATEGORY = "number", "category"
_VARIABLE = ("MODULE", "VAR", "KIND")

Edges = dict[tuple[str, str], list[float]]


@dataclass(frozen=True)
class DriftModule:
    """One module of the drift report: its score, flag, dictionary and baseline.

    ``prefix`` stands before the names of its columns in the new rows, where
    modules with equal feature names share one frame.
    """

    name: str
    score: str | None
    roles: Roles
    baseline: DataFrame
    flag: str | None = None
    missing_cat: str = "MISSING"
    prefix: str = ""

    def asked(self) -> Roles:
        return self.roles.plus_numerical(self.score) if self.score else self.roles

    def counts_row(self) -> Column:
        """New rows count where the score is given and the flag is true."""
        given = F.col(self.prefix + self.score).isNotNull() if self.score else F.lit(True)
        return given & F.coalesce(F.col(self.flag), F.lit(False)) if self.flag else given


Chosen = Sequence[tuple[DriftModule, Roles]]


def _by_baseline(specs: Chosen) -> list[tuple[DataFrame, list[tuple[DriftModule, Roles]]]]:
    """The modules of each baseline, so that a shared one is read once."""
    shared: dict[int, tuple[DataFrame, list[tuple[DriftModule, Roles]]]] = {}
    for spec, roles in specs:
        shared.setdefault(id(spec.baseline), (spec.baseline, []))[1].append((spec, roles))
    return list(shared.values())


def fit_edges(
    specs: Chosen,
    buckettype: str = "quantiles",
    buckets: int = BUCKETS,
) -> Edges:
    """Bucket edges per module and numeric column, from the whole baselines.

    ``"quantiles"`` takes exact quantiles, ``"approx_quantiles"`` those of a
    sketch (one pass, ranks within ``SKETCH_RANK_ERROR``), ``"bins"`` equal
    widths between the least and the greatest value.  The result has one short list per column and
    is kept on the driver, like the splits of a fitted bucketizer.  Columns
    without any value in the baseline are left out.
    """
    long = _union(
        [
            _long(
                baseline, [], members,
                lambda spec, c, value: (
                    f"named_struct('MODULE', {_text(spec.name)}, 'VAR', {_text(c)}, 'V', {value})"
                ),
                lambda roles: roles.numerical,
                lambda spec, c: _number_sql,
                new=False,
            )
            for baseline, members in _by_baseline(specs)
        ]
    )
    keys = ["MODULE", "VAR"]
    if buckettype in ("quantiles", "approx_quantiles"):
        steps = [i / buckets for i in range(buckets + 1)]
        quantiles = exact_quantiles if buckettype == "quantiles" else sketched_quantiles
        fitted = quantiles(long, keys, "V", steps)
        return {(r["MODULE"], r["VAR"]): list(r["QUANTILES"]) for r in fitted.collect()}
    if buckettype != "bins":
        raise ValueError(f"unknown buckettype {buckettype!r}")
    spans = (
        long.where("V is not null")
        .groupBy(*keys)
        .agg(F.min("V").alias("low"), F.max("V").alias("high"))
    )
    percents = [i / buckets * 100.0 for i in range(buckets + 1)]
    edges: Edges = {}
    for r in spans.collect():
        low, high = r["low"], r["high"]
        scale = percents[-1] / (high - low) if high > low else float("inf")
        edges[r["MODULE"], r["VAR"]] = [p / scale + low for p in percents]
    return edges


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number_sql(column: str) -> str:
    """Number or NULL, as ``functions.number``."""
    return f"nanvl(try_cast({column} as double), cast(null as double))"


def bucket_sql(value: str, edges: Sequence[float]) -> str:
    """Index of the last edge (but the final one) at or below the value, as SQL.

    NULL outside the edges.  Equal edges leave the buckets between them empty.
    """
    number_of = [f"double('{e!r}')" for e in edges]
    steps = " ".join(
        f"when {value} >= {number_of[i]} then {i}" for i in range(len(edges) - 2, -1, -1)
    )
    return f"case when {value} > {number_of[-1]} then null {steps} end"


def _long(
    df: DataFrame, groups: Sequence[str], members: Chosen, entry_of, columns_of, value_of, new: bool
) -> DataFrame:
    """One row per counted row, module and variable.

    Variables are unpivoted in blocks: a block stays within the size up to which
    Spark compiles a stage, and a columnar table is read once over all blocks,
    since each reads its own columns.  Entries of modules a row does not count
    for are dropped.  They are one SQL text per block, which keeps the plan small.
    """
    variables = [(spec, c) for spec, roles in members for c in columns_of(roles)]
    blocks = []
    for start in range(0, len(variables), BLOCK):
        block = variables[start : start + BLOCK]
        flags: dict[str, Column] = {}
        values: dict[str, str] = {}
        entries: list[str] = []
        for spec, c in block:
            name = (spec.prefix if new else "") + c
            flag = f"_in {spec.name}"
            flags[flag] = spec.counts_row() if new else F.lit(True)
            values[f"_v {name}"] = value_of(spec, c)(_quoted(name))
            entry = entry_of(spec, c, _quoted(f"_v {name}"))
            entries.append(f"if({_quoted(flag)}, {entry}, null)")
        prepared = df.withColumns(flags).selectExpr(
            *[_quoted(n) for n in (*groups, *flags)],
            *[f"{text} as {_quoted(n)}" for n, text in values.items()],
        )
        rows = prepared.selectExpr(
            *[_quoted(n) for n in groups], f"inline(array({', '.join(entries)}))"
        )
        blocks.append(rows.where("MODULE is not null"))
    return _union(blocks)


def _entry_of(edges: Edges, buckets: int):
    """(MODULE, VAR, KIND, KEY) of a value: its bucket's number, or its category."""

    def entry(spec: DriftModule, c: str, value: str) -> str:
        if c in spec.asked().numerical:
            fitted = edges.get((spec.name, c))
            inside = bucket_sql(value, fitted) if fitted else "cast(null as int)"
            key, kind = f"cast(if({value} is null, {buckets}, {inside}) as string)", NUMBER
        else:
            key, kind = f"coalesce({value}, {_text(spec.missing_cat)})", CATEGORY
        return f"named_struct('MODULE', {_text(spec.name)}, 'VAR', {_text(c)}, 'KIND', '{kind}', 'KEY', {key})"

    return entry


def _category_sql(column: str) -> str:
    """A category as text; the placeholder is no category."""
    return f"nullif(cast({column} as string), {_text(PLACEHOLDER)})"


def _counts(
    df: DataFrame, groups: Sequence[str], members: Chosen, edges: Edges, buckets: int, new: bool
) -> DataFrame:
    """COUNT of rows per group, MODULE, VAR, KIND and KEY: buckets and categories in one pass.

    A number outside the edges has a NULL key, which counts in the total alone.
    """
    long = _long(
        df, groups, members, _entry_of(edges, buckets), lambda roles: (*roles.numerical, *roles.categorical),
        lambda spec, c: _number_sql if c in spec.asked().numerical else _category_sql, new,
    )
    return long.groupBy(*groups, *_VARIABLE, "KEY").agg(F.count("*").alias("COUNT"))


def _labels(month: str) -> Column:
    """The labels a row counts under: its month, if it has one, and OVERALL."""
    return F.array_compact(F.array(F.upper(F.col(month)), F.lit(OVERALL)))


def _term(base: Column, new: Column) -> Column:
    e = F.when(base == 0, F.lit(TINY)).otherwise(base)
    a = F.when(new == 0, F.lit(TINY)).otherwise(new)
    return (e - a) * F.ln(e / a)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class Baseline:
    """What a report needs of the baselines: bucket edges, and the share of every bucket and category.

    ``shares`` comes from a stored table of counts (MODULE, VAR, KIND, KEY, COUNT, SHARE);
    later reports over the same baseline take it as it is and do not read the
    baseline's rows again.
    """

    edges: Edges
    shares: DataFrame
    buckets: int = BUCKETS


def fit_baseline(specs: Chosen, buckettype: str = "quantiles", buckets: int = BUCKETS) -> Baseline:
    """Edges from the baselines' numbers, then one counting pass over each baseline."""
    numeric = [(spec, roles) for spec, roles in specs if roles.numerical]
    edges = fit_edges(numeric, buckettype, buckets) if numeric else {}
    counted = stored(
        _union([_counts(df, [], members, edges, buckets, new=False) for df, members in _by_baseline(specs)]),
        "baseline_counts",
    )
    return Baseline(edges, _shares(counted, buckets), buckets)


def _shares(counted: DataFrame, buckets: int) -> DataFrame:
    """Counts with SHARE of all rows; a number has a row for each bucket, also for the empty ones."""
    slots = F.explode(F.sequence(F.lit(0), F.lit(buckets)).cast("array<string>"))
    numbers = counted.where(F.col("KIND") == NUMBER).select(*_VARIABLE).distinct().select(*_VARIABLE, slots.alias("KEY"))
    filled = counted.where("KEY is not null").unionByName(numbers.withColumn("COUNT", F.lit(0).cast("long")))
    filled = filled.groupBy(*_VARIABLE, "KEY").agg(F.sum("COUNT").alias("COUNT"))
    # one row for each column of the table bounds the broadcast
    totals = counted.groupBy(*_VARIABLE).agg(F.sum("COUNT").alias("_all"))
    return filled.join(F.broadcast(totals), [*_VARIABLE]).select(
        *_VARIABLE, "KEY", "COUNT", (F.col("COUNT").cast("double") / F.col("_all")).alias("SHARE")
    )


def category_shares(df: DataFrame, columns: Sequence[str], missing_cat: str = "MISSING") -> DataFrame:
    """VAR, CATEGORY, COUNT and SHARE of all rows."""
    roles = Roles(categorical=tuple(columns))
    spec = DriftModule("", None, roles, df, missing_cat=missing_cat)
    shares = _shares(_counts(df, [], [(spec, roles)], {}, BUCKETS, new=False), BUCKETS)
    return shares.select("VAR", F.col("KEY").alias("CATEGORY"), "COUNT", "SHARE")


def _new_counts(specs: Chosen, new: DataFrame, month: str, baseline: Baseline) -> DataFrame:
    """Counts ``_c`` of the new rows by variable, month and KEY, from one pass over them; stored."""
    return stored(
        _counts(new, [month], specs, baseline.edges, baseline.buckets, new=True)
        .select(*_VARIABLE, "KEY", "COUNT", F.explode(_labels(month)).alias("PSI_MONTH"))
        .groupBy(*_VARIABLE, "PSI_MONTH", "KEY")
        .agg(F.sum("COUNT").alias("_c")),
        "drift_counts",
    )


def _report(specs: Chosen, new: DataFrame, month: str, baseline: Baseline) -> DataFrame:
    """MODULE, PSI_MONTH, VAR, PSI, from counts of the new rows and the baseline's shares.

    A bucket or category that the new rows lack adds the term of share 0.0001.
    Those terms are summed once per variable; one that both sides have replaces
    its own.  So no table of months x categories is built, and the totals come
    from the same counts: every row counts once for each variable.
    """
    counted = _new_counts(specs, new, month, baseline)
    base = baseline.shares.select(*_VARIABLE, "KEY", F.col("SHARE").alias("_e"))
    absent = base.groupBy(*_VARIABLE).agg(F.sum(_term(F.col("_e"), F.lit(0.0))).alias("_absent"))
    totals = counted.groupBy(*_VARIABLE, "PSI_MONTH").agg(F.sum("_c").alias("_n"))
    e, a = F.col("_e"), F.col("_c").cast("double") / F.col("_n")
    present = (
        counted.join(base, [*_VARIABLE, "KEY"])
        .join(totals, [*_VARIABLE, "PSI_MONTH"])
        .groupBy(*_VARIABLE, "PSI_MONTH")
        .agg(F.sum(_term(e, a) - _term(e, F.lit(0.0))).alias("_present"))
    )
    known = [f"{module}/{c}" for module, c in baseline.edges]
    fitted = (F.col("KIND") == CATEGORY) | (F.concat_ws("/", "MODULE", "VAR").isin(known) if known else F.lit(False))
    # ``absent`` has one row per column of the table, which bounds the broadcast
    return (
        totals.join(F.broadcast(absent), [*_VARIABLE], "left")
        .where((F.col("KIND") == NUMBER) | F.col("_absent").isNotNull())
        .join(present, [*_VARIABLE, "PSI_MONTH"], "left")
        .select(
            "MODULE", "PSI_MONTH", "VAR",
            F.when(fitted, F.col("_absent") + F.coalesce(F.col("_present"), F.lit(0.0))).alias("PSI"),
        )
    )


def compared(specs: Sequence[DriftModule], new: DataFrame) -> tuple[Chosen, list[tuple]]:
    """The modules with the columns that both sides have, and rows for those that one side has."""
    chosen, one_sided = [], []
    for spec in specs:
        asked = spec.asked()
        old_has = set(spec.baseline.columns)
        new_has = {c for c in (*asked.numerical, *asked.categorical) if spec.prefix + c in new.columns}
        roles = asked.within([c for c in new_has if c in old_has])
        if roles.numerical or roles.categorical:
            chosen.append((spec, roles))
        one_sided += [
            (spec.name, OVERALL, c, None)
            for c in (*asked.numerical, *asked.categorical)
            if (c in old_has) != (c in new_has)
        ]
    return chosen, one_sided


def psi_report(
    specs: Sequence[DriftModule],
    new: DataFrame,
    month: str = "MONTH_YEAR",
    buckettype: str = "quantiles",
    buckets: int = BUCKETS,
    baseline: Baseline | None = None,
) -> DataFrame:
    """COL_MODULE, PSI_MONTH (each month and OVERALL), PSI_VAR, PSI.

    Give stored frames when there are many variables: each block of them scans
    its own columns (see ``_long``).  ``baseline`` is what ``fit_baseline`` gave
    for the same modules; with it the baselines' rows are not read.
    Dictionary features that only the baseline or only the new rows have are
    reported once with NULL; so are numbers the baseline holds no value of.
    """
    chosen, one_sided = compared(specs, new)
    parts = []
    if chosen:
        if baseline is None:
            baseline = fit_baseline(chosen, buckettype, buckets)
        parts.append(_report(chosen, new, month, baseline))
    if one_sided:
        parts.append(
            new.sparkSession.createDataFrame(
                one_sided, "MODULE string, PSI_MONTH string, VAR string, PSI double"
            )
        )
    return _union(parts).select(
        F.upper("MODULE").alias("COL_MODULE"), "PSI_MONTH", F.col("VAR").alias("PSI_VAR"), "PSI"
    )


def divergence_report(
    specs: Sequence[DriftModule],
    new: DataFrame,
    month: str = "MONTH_YEAR",
    buckettype: str = "quantiles",
    buckets: int = BUCKETS,
    baseline: Baseline | None = None,
) -> DataFrame:
    """COL_MODULE, KL_MONTH (each month and OVERALL), KL_VAR, KL of all variables from the drift counts.

    KL is the sum of p * log2(p / q) over the baseline's buckets and categories,
    with the baseline's share as p and that of the new rows as q.  It is NULL
    where the new rows lack a bucket that the baseline has, and for a variable
    without edges.  New values outside the edges are in no bucket and do not
    count.  ``baseline`` and the columns compared are those of ``psi_report``.
    """
    chosen, _ = compared(specs, new)
    if not chosen:
        return new.sparkSession.createDataFrame([], "COL_MODULE string, KL_MONTH string, KL_VAR string, KL double")
    if baseline is None:
        baseline = fit_baseline(chosen, buckettype, buckets)
    counted = _new_counts(chosen, new, month, baseline)
    variable = [*_VARIABLE, "PSI_MONTH"]
    base = baseline.shares.where("SHARE > 0").select(*_VARIABLE, "KEY", F.col("SHARE").alias("_p"))
    wanted = base.groupBy(*_VARIABLE).agg(F.count("*").alias("_wanted"))
    totals = counted.groupBy(*variable).agg(F.sum(F.when(F.col("KEY").isNotNull(), F.col("_c"))).alias("_n"))
    p, q = F.col("_p"), F.col("_c").cast("double") / F.col("_n")
    met = (
        counted.join(base, [*_VARIABLE, "KEY"])
        .join(totals, variable)
        .groupBy(*variable)
        .agg(F.sum(p * F.log2(p / q)).alias("_kl"), F.count("*").alias("_met"))
    )
    # ``wanted`` has one row per column of the table, which bounds the broadcast
    return (
        totals.join(F.broadcast(wanted), [*_VARIABLE], "left")
        .join(met, variable, "left")
        .select(
            F.upper("MODULE").alias("COL_MODULE"),
            F.col("PSI_MONTH").alias("KL_MONTH"),
            F.col("VAR").alias("KL_VAR"),
            F.when(F.col("_met") == F.col("_wanted"), F.col("_kl")).alias("KL"),
        )
    )


def numeric_psi(
    baseline: DataFrame,
    new: DataFrame,
    columns: Sequence[str],
    month: str = "MONTH_YEAR",
    buckettype: str = "quantiles",
    buckets: int = BUCKETS,
) -> DataFrame:
    """PSI of numeric columns alone."""
    spec = DriftModule("", None, Roles(numerical=tuple(columns)), baseline)
    return psi_report([spec], new, month, buckettype, buckets).drop("COL_MODULE")


def categorical_psi(
    baseline: DataFrame,
    new: DataFrame,
    columns: Sequence[str],
    month: str = "MONTH_YEAR",
    missing_cat: str = "MISSING",
) -> DataFrame:
    """PSI of categorical columns alone."""
    spec = DriftModule(
        "", None, Roles(categorical=tuple(columns)), baseline, missing_cat=missing_cat
    )
    return psi_report([spec], new, month).drop("COL_MODULE")
