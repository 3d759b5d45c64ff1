"""Gini, KS, PSI and KL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.operators import gini as G
from loanlens.operators import ks as K
from loanlens.operators import psi as PSI
from loanlens.operators.kl import aligned_shares, kl_divergence
from loanlens.operators.quantiles import SKETCH_RANK_ERROR, sketched_quantiles
from loanlens.sources import schemas as S
from loanlens.sources.assets import Roles
from testbed import proxies as P
from testbed.registry import CTES, query, rounded, s6, with_ctes

SINCE = "1998-01-01"
_E = S.EXTERNAL_SCORE
_Y = S.OUTCOME_LABEL

# --- Gini -------------------------------------------------------------------

_MONTH = "strftime(DISBURSED_DATE, '%b-%Y')"
_FLAGS = {"SMS_PD": S.SMS_FLAG, "TRX_PD": S.LEDGER_FLAG, "BR_PD": S.BUREAU_FLAG}


def _rows_sql(score):
    return f"{score} IS NOT NULL" + (f" AND coalesce({_FLAGS[score]}, false)" if score in _FLAGS else "")


def _gini_specs():
    for score, _ in G.GINI_SCORES:
        yield f"{score}_GINI_OVERALL", score, False, f"{_rows_sql(score)} AND DISBURSED_DATE >= date '{SINCE}'"
        yield f"{score}_GINI", score, True, f"{_rows_sql(score)} AND DISBURSED_DATE IS NOT NULL"
        if score != _E:
            own = _rows_sql(score) if score == "BR_PD" else f"{score} IS NOT NULL"
            yield (
                f"{score}_AND_FB_SCORE_GINI", _E, True,
                f"{own} AND {_E} IS NOT NULL AND DISBURSED_DATE IS NOT NULL",
            )


def gini_ctes(tag, source):
    """Names of the inputs that end in {tag}_values, from the scored rows of a source."""
    CTES[f"{tag}_long"] = " UNION ALL ".join(
        f"SELECT '{metric}' AS METRIC, MODEL_TYPE, {_MONTH if monthly else 'NULL'} AS MONTH_YEAR,"
        f" {score} AS SCORE, {_Y} AS Y FROM {source} WHERE {rows}"
        for metric, score, monthly, rows in _gini_specs()
    )
    CTES[f"{tag}_counts"] = (
        "SELECT METRIC, MODEL_TYPE, MONTH_YEAR, SCORE, sum(Y) AS B, count(*) - sum(Y) AS G"
        f" FROM {tag}_long GROUP BY ALL"
    )
    CTES[f"{tag}_below"] = (
        "SELECT *, coalesce(sum(G) OVER (PARTITION BY METRIC, MODEL_TYPE, MONTH_YEAR ORDER BY SCORE"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS L FROM {tag}_counts"
    )
    CTES[f"{tag}_values"] = (
        "SELECT METRIC, MODEL_TYPE, MONTH_YEAR, cast(sum(B) AS bigint) AS BADS, cast(sum(G) AS bigint) AS GOODS,"
        " 2 * sum(B::double * (L + G / 2.0)) / nullif(sum(B)::double * sum(G), 0) - 1 AS GINI"
        f" FROM {tag}_below GROUP BY ALL"
    )
    return tuple(f"{tag}_{part}" for part in ("long", "counts", "below", "values"))


_GINI = ("scored", *gini_ctes("gini", "scored"))


def _gini_query(name, pattern, columns):
    sql = (
        f"SELECT {columns}, BADS, GOODS, {s6('GINI')} AS GINI FROM gini_values WHERE METRIC LIKE '{pattern}'"
    )

    def run(spark, sf):
        figures = G.gini_metrics(P.scored(spark, sf), SINCE).where(F.col("METRIC").like(pattern))
        return rounded(figures.select(*[c.strip() for c in columns.split(",")], "BADS", "GOODS", "GINI"))

    query(name, with_ctes(sql, *_GINI))(run)


_gini_query("gini_overall", "%_GINI_OVERALL", "METRIC, MODEL_TYPE")
_gini_query("gini_monthly", "%_PD_GINI", "METRIC, MODEL_TYPE, MONTH_YEAR")
_gini_query("gini_vs_external", "%_AND_FB_SCORE_GINI", "METRIC, MODEL_TYPE, MONTH_YEAR")

_WRITTEN = ", ".join(
    f"CASE WHEN {rows} THEN (SELECT any_value(GINI) FROM gini_values g WHERE g.METRIC = '{metric}'"
    f" AND g.MODEL_TYPE = s.MODEL_TYPE"
    + (f" AND g.MONTH_YEAR = {_MONTH}" if monthly else "")
    + f") END AS {metric}"
    for metric, _, monthly, rows in _gini_specs()
)
CTES["gini_written"] = f"SELECT BRE_RUN_ID, {_MONTH} AS MONTH_YEAR, {_WRITTEN} FROM scored s"


@query(
    "gini_row_writeback",
    with_ctes(
        "SELECT BRE_RUN_ID, MONTH_YEAR, "
        + ", ".join(f"{s6(m)} AS {m}" for m, _, _, _ in _gini_specs())
        + " FROM gini_written",
        *_GINI, "gini_written",
    ),
)
def gini_row_writeback(spark, sf):
    rows = G.with_gini_columns(P.scored(spark, sf), SINCE)
    return rounded(rows.select("BRE_RUN_ID", "MONTH_YEAR", *[m for m, _, _, _ in _gini_specs()]))


@query(
    "gini_by_segment",
    with_ctes(
        "SELECT MODEL_TYPE, cast(sum(B) AS bigint) AS BADS, cast(sum(G) AS bigint) AS GOODS,"
        f" {s6('2 * sum(B::double * (L + G / 2.0)) / (sum(B)::double * sum(G)) - 1')} AS GINI FROM (SELECT *,"
        " coalesce(sum(G) OVER (PARTITION BY MODEL_TYPE ORDER BY S ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS L"
        f" FROM (SELECT MODEL_TYPE, CALIB_PD AS S, sum({_Y}) AS B, count(*) - sum({_Y}) AS G FROM scored"
        " WHERE CALIB_PD IS NOT NULL GROUP BY ALL)) GROUP BY MODEL_TYPE",
        "scored",
    ),
)
def gini_by_segment(spark, sf):
    return rounded(G.gini(P.scored(spark, sf), ["MODEL_TYPE"], "CALIB_PD", _Y))


# --- KS ---------------------------------------------------------------------

_SCORES = list(K.KS_SCORES)
_EDGES = {
    s: f"(SELECT list_transform(range(1, 10), lambda i: i::double * ((max({s}) - min({s})) / 10e0) + min({s})) FROM scored)"
    for s in _SCORES
}
CTES["ks_long_fixed"] = " UNION ALL ".join(
    f"SELECT '{s}' AS SCORE, MODEL_TYPE, {s} AS P, {_Y} AS Y, CASE WHEN {s} IS NULL THEN NULL"
    f" WHEN {s} <= 0.0162 THEN 1 WHEN {s} <= 0.026 THEN 2 WHEN {s} <= 0.0392 THEN 3 WHEN {s} <= 0.0532 THEN 4"
    " ELSE 5 END AS B FROM scored"
    for s in _SCORES
)
CTES["ks_long_width"] = " UNION ALL ".join(
    f"SELECT '{s}' AS SCORE, MODEL_TYPE, {s} AS P, {_Y} AS Y, CASE WHEN {s} IS NULL THEN NULL ELSE"
    f" 1 + len(list_filter({_EDGES[s]}, lambda e: e < {s})) END AS B FROM scored"
    for s in _SCORES
)


def _ks_ctes(kind, n, order, sign):
    CTES[f"ks_counts_{kind}"] = (
        "SELECT SCORE, MODEL_TYPE, B AS BUCKET, min(P) AS MIN_PROB, max(P) AS MAX_PROB, sum(Y) AS BADS,"
        f" sum(1 - Y) AS GOODS FROM ks_long_{kind} GROUP BY ALL"
    )
    CTES[f"ks_totals_{kind}"] = (
        f"SELECT SCORE, MODEL_TYPE, sum(Y)::double AS TB, sum(1 - Y)::double AS TG FROM ks_long_{kind} GROUP BY ALL"
    )
    CTES[f"ks_rows_{kind}"] = (
        "SELECT t.SCORE, t.MODEL_TYPE, TB, TG, i.BUCKET, MIN_PROB, MAX_PROB, coalesce(BADS, 0) AS BADS,"
        f" coalesce(GOODS, 0) AS GOODS FROM ks_totals_{kind} t CROSS JOIN (SELECT unnest(range(1, {n + 1})) AS BUCKET) i"
        f" LEFT JOIN ks_counts_{kind} c ON c.SCORE = t.SCORE AND c.MODEL_TYPE = t.MODEL_TYPE AND c.BUCKET = i.BUCKET"
    )
    window = (
        f"OVER (PARTITION BY SCORE, MODEL_TYPE ORDER BY MIN_PROB {order} NULLS LAST, BUCKET"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    CTES[f"ks_running_{kind}"] = (
        f"SELECT *, row_number() {window} AS DECILE, sum(BADS) {window} AS CUM_BADS, sum(GOODS) {window} AS CUM_GOODS,"
        f" BADS / TB AS DB, GOODS / TG AS DG, sum(BADS / TB) {window} AS CB, sum(GOODS / TG) {window} AS CG"
        f" FROM ks_rows_{kind}"
    )
    CTES[f"ks_{kind}"] = (
        "SELECT SCORE || '_' || MODEL_TYPE AS PRED_COL, SCORE, MODEL_TYPE, cast(DECILE AS integer) AS DECILE,"
        f" cast(BUCKET AS integer) AS BUCKET, {s6('MIN_PROB')} AS MIN_PROB, {s6('MAX_PROB')} AS MAX_PROB,"
        " cast(BADS AS bigint) AS BADS, cast(GOODS AS bigint) AS GOODS,"
        f" {s6('DB')} AS DISTRIBUTION_BADS, {s6('DG')} AS DISTRIBUTION_GOODS, cast(CUM_BADS AS bigint) AS CUM_BADS,"
        f" cast(CUM_GOODS AS bigint) AS CUM_GOODS, {s6('CB')} AS CUM_BADS_SHARE, {s6('CG')} AS CUM_GOODS_SHARE,"
        f" {s6(f'round_even(({sign}(CG - CB)) * 1000, 0) / 1000 * 100')} AS CUM_DIFFERENCE FROM ks_running_{kind}"
    )
    return ("scored",) + tuple(f"ks_{p}_{kind}" for p in ("long", "counts", "totals", "rows", "running")) + (f"ks_{kind}",)


_KS_FIXED = _ks_ctes("fixed", 5, "ASC", "")
_KS_WIDTH = _ks_ctes("width", 10, "DESC", "-")


@query("ks_fixed", with_ctes("SELECT * FROM ks_fixed", *_KS_FIXED))
def ks_fixed(spark, sf):
    return rounded(K.ks_table(P.scored(spark, sf)))


@query("ks_equal_width", with_ctes("SELECT * FROM ks_width", *_KS_WIDTH))
def ks_equal_width(spark, sf):
    return rounded(K.ks_table(P.scored(spark, sf), buckets="equal_width"))


@query(
    "ks_argmax",
    with_ctes(
        "SELECT PRED_COL, SCORE, MODEL_TYPE, CUM_DIFFERENCE AS KS, DECILE FROM ks_fixed"
        " QUALIFY row_number() OVER (PARTITION BY PRED_COL ORDER BY CUM_DIFFERENCE DESC, DECILE) = 1",
        *_KS_FIXED,
    ),
)
def ks_argmax(spark, sf):
    return rounded(K.ks_statistic(K.ks_table(P.scored(spark, sf))))


# --- PSI --------------------------------------------------------------------

_SPLIT = f"date '{P.DRIFT_SPLIT}'"
NUMBERS = ["TOTAL_PRICE", "BALANCE", "SMALL_COUNT"]
CATEGORIES = ["PRIORITY", "SEGMENT"]


def _term_sql(e, a):
    e, a = f"CASE WHEN {e} = 0 THEN 1e-4 ELSE {e} END", f"CASE WHEN {a} = 0 THEN 1e-4 ELSE {a} END"
    return f"(({e}) - ({a})) * ln(({e}) / ({a}))"


def _long_sql(items, source):
    """(MODULE, VAR, MONTH, V) for (module, column, condition)."""
    return " UNION ALL ".join(
        f"SELECT '{module}' AS MODULE, '{c}' AS VAR, upper(strftime(DAY, '%b-%Y')) AS MONTH, {c} AS V"
        f" FROM {source} WHERE {rows}"
        for module, c, rows in items
    )


def numeric_psi_ctes(tag, base_items, new_items, source, kind):
    """Names of the inputs that end in psi_num_{tag}."""
    CTES[f"nb_{tag}"] = _long_sql(base_items, source)
    CTES[f"nn_{tag}"] = _long_sql(new_items, source)
    if kind == "quantiles":
        CTES[f"nr_{tag}"] = (
            "SELECT MODULE, VAR, V, row_number() OVER (PARTITION BY MODULE, VAR ORDER BY V) - 1 AS r,"
            f" count(*) OVER (PARTITION BY MODULE, VAR) AS n FROM nb_{tag} WHERE V IS NOT NULL"
        )
        CTES[f"ne_{tag}"] = (
            "SELECT MODULE, VAR, i, min(V) FILTER (WHERE r = floor((n-1) * (i::double / 10e0))) AS lo,"
            " min(V) FILTER (WHERE r = least(floor((n-1) * (i::double / 10e0)) + 1, n - 1)) AS hi,"
            " any_value((n-1) * (i::double / 10e0) - floor((n-1) * (i::double / 10e0))) AS t"
            f" FROM nr_{tag} CROSS JOIN (SELECT unnest(range(0, 11)) AS i) GROUP BY MODULE, VAR, i"
        )
        CTES[f"nl_{tag}"] = (
            "SELECT MODULE, VAR, list(CASE WHEN t < 0.5 THEN lo + (hi - lo) * t ELSE hi - (hi - lo) * (1 - t) END"
            f" ORDER BY i) AS es FROM ne_{tag} GROUP BY MODULE, VAR"
        )
        steps = (f"nr_{tag}", f"ne_{tag}", f"nl_{tag}")
    else:
        CTES[f"nl_{tag}"] = (
            "SELECT MODULE, VAR, list_transform(range(0, 11), lambda i: (i::double / 10e0 * 100e0)"
            f" / (100e0 / (max(V) - min(V))) + min(V)) AS es FROM nb_{tag} GROUP BY MODULE, VAR"
        )
        steps = (f"nl_{tag}",)
    bucket = (
        "CASE WHEN V IS NULL THEN 10 WHEN V < es[1] OR V > es[11] THEN NULL"
        " ELSE len(list_filter(es[1:10], lambda x: x <= V)) - 1 END"
    )
    CTES[f"nbk_{tag}"] = (
        f"SELECT MODULE, VAR, {bucket} AS k, count(*) AS c FROM nb_{tag} JOIN nl_{tag} USING (MODULE, VAR) GROUP BY ALL"
    )
    CTES[f"nnk_{tag}"] = (
        f"SELECT MODULE, VAR, L, k, count(*) AS c FROM (SELECT MODULE, VAR, unnest([MONTH, 'OVERALL']) AS L,"
        f" {bucket} AS k FROM nn_{tag} JOIN nl_{tag} USING (MODULE, VAR)) GROUP BY ALL"
    )
    CTES[f"nbt_{tag}"] = f"SELECT MODULE, VAR, sum(c) AS n FROM nbk_{tag} GROUP BY ALL"
    CTES[f"nnt_{tag}"] = f"SELECT MODULE, VAR, L, sum(c) AS n FROM nnk_{tag} GROUP BY ALL"
    CTES[f"psi_num_{tag}"] = (
        "SELECT t.MODULE, t.VAR, t.L, sum("
        + _term_sql("coalesce(b.c, 0)::double / bt.n", "coalesce(a.c, 0)::double / t.n")
        + f") AS PSI FROM nnt_{tag} t JOIN nbt_{tag} bt ON bt.MODULE = t.MODULE AND bt.VAR = t.VAR"
        " CROSS JOIN (SELECT unnest(range(0, 11)) AS i) s"
        f" LEFT JOIN nbk_{tag} b ON b.MODULE = t.MODULE AND b.VAR = t.VAR AND b.k = s.i"
        f" LEFT JOIN nnk_{tag} a ON a.MODULE = t.MODULE AND a.VAR = t.VAR AND a.L = t.L AND a.k = s.i GROUP BY ALL"
    )
    return (f"nb_{tag}", f"nn_{tag}", *steps, f"nbk_{tag}", f"nnk_{tag}", f"nbt_{tag}", f"nnt_{tag}", f"psi_num_{tag}")


def category_psi_ctes(tag, base_items, new_items, source):
    clean = "CASE WHEN V IS NULL OR V = '--' THEN 'MISSING' ELSE V END"
    CTES[f"cb_{tag}"] = _long_sql(base_items, source)
    CTES[f"cn_{tag}"] = _long_sql(new_items, source)
    CTES[f"cbk_{tag}"] = (
        f"SELECT MODULE, VAR, {clean} AS k, count(*)::double / any_value(n) AS e FROM (SELECT *, count(*) OVER"
        f" (PARTITION BY MODULE, VAR) AS n FROM cb_{tag}) GROUP BY ALL"
    )
    CTES[f"cnk_{tag}"] = (
        f"SELECT MODULE, VAR, L, k, count(*) AS c FROM (SELECT MODULE, VAR, unnest([MONTH, 'OVERALL']) AS L,"
        f" {clean} AS k FROM cn_{tag}) GROUP BY ALL"
    )
    CTES[f"cnt_{tag}"] = f"SELECT MODULE, VAR, L, sum(c) AS n FROM cnk_{tag} GROUP BY ALL"
    CTES[f"psi_cat_{tag}"] = (
        "SELECT t.MODULE, t.VAR, t.L, sum(" + _term_sql("b.e", "coalesce(a.c, 0)::double / t.n")
        + f") AS PSI FROM cnt_{tag} t JOIN cbk_{tag} b ON b.MODULE = t.MODULE AND b.VAR = t.VAR"
        f" LEFT JOIN cnk_{tag} a ON a.MODULE = t.MODULE AND a.VAR = t.VAR AND a.L = t.L AND a.k = b.k GROUP BY ALL"
    )
    return (f"cb_{tag}", f"cn_{tag}", f"cbk_{tag}", f"cnk_{tag}", f"cnt_{tag}", f"psi_cat_{tag}")


_BASE, _NEW = f"DAY < {_SPLIT}", f"DAY >= {_SPLIT}"


def _items(columns, rows):
    return [("m", c, rows) for c in columns]


_PSI_OUT = f"SELECT L AS PSI_MONTH, VAR AS PSI_VAR, {s6('PSI')} AS PSI FROM "
_Q = numeric_psi_ctes("q", _items(NUMBERS, _BASE), _items(NUMBERS, _NEW), "drift_rows", "quantiles")
_B = numeric_psi_ctes("b", _items(NUMBERS, _BASE), _items(NUMBERS, _NEW), "drift_rows", "bins")
_C = category_psi_ctes("c", _items(CATEGORIES, _BASE), _items(CATEGORIES, _NEW), "drift_rows")


@query("psi_numeric_quantile", with_ctes(_PSI_OUT + "psi_num_q", "drift_rows", *_Q))
def psi_numeric_quantile(spark, sf):
    return rounded(PSI.numeric_psi(*P.drift(spark, sf), NUMBERS))


@query(
    "sketch_edge_ranks",
    with_ctes(
        "SELECT VAR, cast(EDGE AS integer) AS EDGE, N, true AS WITHIN FROM (SELECT VAR, count(V) AS N FROM nb_q GROUP BY VAR),"
        " (SELECT unnest(range(0, 11)) AS EDGE)",
        "drift_rows", "nb_q",
    ),
)
def sketch_edge_ranks(spark, sf):
    """Every bucket edge from a sketch has its wanted rank within the stated error, counted over all rows."""
    entries = F.array(*[F.struct(F.lit(c).alias("VAR"), F.col(c).cast("double").alias("V")) for c in NUMBERS])
    long = P.drift(spark, sf)[0].select(F.inline(entries)).where("V is not null")
    edges = sketched_quantiles(long, ["VAR"], "V", [i / 10 for i in range(11)])
    counted = long.join(F.broadcast(edges), ["VAR"]).groupBy("VAR", "N").agg(  # one row for each variable
        *[F.count_if(F.col("V") < F.col("QUANTILES")[i]).alias(f"below{i}") for i in range(11)],
        *[F.count_if(F.col("V") <= F.col("QUANTILES")[i]).alias(f"until{i}") for i in range(11)],
    )
    error = SKETCH_RANK_ERROR * F.col("N") + 1
    within = [
        F.struct(
            F.lit(i).alias("EDGE"),
            ((F.col(f"below{i}") - error <= F.col("N") * i / 10) & (F.col("N") * i / 10 <= F.col(f"until{i}") + error)).alias("WITHIN"),
        )
        for i in range(11)
    ]
    return counted.select("VAR", "N", F.inline(F.array(*within)))


@query("psi_numeric_width", with_ctes(_PSI_OUT + "psi_num_b", "drift_rows", *_B))
def psi_numeric_width(spark, sf):
    return rounded(PSI.numeric_psi(*P.drift(spark, sf), NUMBERS, buckettype="bins"))


@query("psi_categorical", with_ctes(_PSI_OUT + "psi_cat_c", "drift_rows", *_C))
def psi_categorical(spark, sf):
    return rounded(PSI.categorical_psi(*P.drift(spark, sf), CATEGORIES))


@query(
    "category_share",
    with_ctes(
        f"SELECT VAR, k AS CATEGORY, {s6('e')} AS SHARE FROM cbk_c", "drift_rows", "cb_c", "cbk_c"
    ),
)
def category_share(spark, sf):
    shares = PSI.category_shares(P.drift(spark, sf)[0], CATEGORIES)
    return rounded(shares.select("VAR", "CATEGORY", "SHARE"))


CTES["report_rows"] = (
    "SELECT r.*, s.TRX_PD, s.BR_PD, s.SMS_PD, s.CALIB_PD, s.MODEL_TYPE,"
    f" s.{S.LEDGER_FLAG}, s.{S.BUREAU_FLAG} FROM (SELECT 'R' || cast(o_orderkey AS string) AS BRE_RUN_ID, d.* FROM ("
    + P.SQL["drift_rows"].replace("SELECT ", "SELECT o_orderkey, ", 1)
    + ") d) r JOIN scored s USING (BRE_RUN_ID)"
)
REPORT_MODULES = {
    "transaction_module": ("TRX_PD", S.LEDGER_FLAG, ["TOTAL_PRICE", "SMALL_COUNT"], ["PRIORITY"]),
    "bureau_module": ("BR_PD", S.BUREAU_FLAG, ["BALANCE"], ["SEGMENT"]),
    "combination_module_xg": ("CALIB_PD", None, ["TRX_PD", "SMS_PD", "BR_PD"], []),
}


def _report_items(index, rows):
    items = []
    for name, spec in REPORT_MODULES.items():
        score, flag = spec[0], spec[1]
        columns = [*spec[2], score] if index == 2 else spec[3]
        condition = rows
        if rows == _NEW:
            condition += f" AND MODEL_TYPE = 'XGBOOST' AND {score} IS NOT NULL" + (f" AND {flag}" if flag else "")
        items += [(name, c, condition) for c in columns]
    return items


_RN = numeric_psi_ctes("r", _report_items(2, _BASE), _report_items(2, _NEW), "report_rows", "quantiles")
_RC = category_psi_ctes("rc", _report_items(3, _BASE), _report_items(3, _NEW), "report_rows")


def report_rows(spark, sf):
    orders, customers = P.table(spark, sf, "orders"), P.table(spark, sf, "customer")
    exprs = {**P.SCORED, **P.DRIFT}
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return joined.selectExpr(*[f"{e} as {c}" for c, e in exprs.items()])


@query(
    "psi_monthly_report",
    with_ctes(
        f"SELECT upper(MODULE) AS COL_MODULE, L AS PSI_MONTH, VAR AS PSI_VAR, {s6('PSI')} AS PSI"
        " FROM (SELECT * FROM psi_num_r UNION ALL SELECT * FROM psi_cat_rc)",
        "scored", "report_rows", *_RN, *_RC,
    ),
)
def psi_monthly_report(spark, sf):
    rows = report_rows(spark, sf)
    baseline = rows.where(F.col("DAY") < P.DRIFT_SPLIT)
    new = rows.where((F.col("DAY") >= P.DRIFT_SPLIT) & (F.col("MODEL_TYPE") == "XGBOOST"))
    specs = [
        PSI.DriftModule(name, score, Roles(tuple(numbers), tuple(categories)), baseline, flag)
        for name, (score, flag, numbers, categories) in REPORT_MODULES.items()
    ]
    return rounded(PSI.psi_report(specs, new.withColumn("MONTH_YEAR", F.date_format("DAY", "MMM-yyyy"))))


# --- KL ---------------------------------------------------------------------


@query(
    "kl_divergence",
    with_ctes(
        f"SELECT {s6('CASE WHEN bool_or(p > 0 AND q = 0) THEN NULL ELSE sum(CASE WHEN p > 0 AND q > 0 THEN p * log2(p / q) ELSE 0 END) END')} AS KL"
        f" FROM (SELECT count(*) FILTER (WHERE {_BASE})::double / sum(count(*) FILTER (WHERE {_BASE})) OVER () AS p,"
        f" count(*) FILTER (WHERE {_NEW})::double / sum(count(*) FILTER (WHERE {_NEW})) OVER () AS q"
        " FROM drift_rows WHERE PRIORITY IS NOT NULL GROUP BY PRIORITY)",
        "drift_rows",
    ),
)
def kl(spark, sf):
    baseline, new = P.drift(spark, sf)
    return rounded(kl_divergence(aligned_shares(baseline, new, "PRIORITY")))


_KL = "CASE WHEN bool_or(q IS NULL) THEN NULL ELSE sum(p * log2(p / q)) END"
CTES["kl_numbers"] = (
    f"SELECT VAR, L, {_KL} AS KL FROM (SELECT t.VAR, t.L, b.c::double / bt.n AS p, a.c::double / t.n AS q"
    " FROM (SELECT VAR, L, sum(c) AS n FROM nnk_q WHERE k IS NOT NULL GROUP BY ALL) t"
    " JOIN nbk_q b ON b.VAR = t.VAR JOIN nbt_q bt ON bt.VAR = t.VAR"
    " LEFT JOIN nnk_q a ON a.VAR = t.VAR AND a.L = t.L AND a.k = b.k) GROUP BY ALL"
)
CTES["kl_categories"] = (
    f"SELECT VAR, L, {_KL} AS KL FROM (SELECT t.VAR, t.L, b.e AS p, a.c::double / t.n AS q FROM cnt_c t"
    " JOIN cbk_c b ON b.VAR = t.VAR LEFT JOIN cnk_c a ON a.VAR = t.VAR AND a.L = t.L AND a.k = b.k) GROUP BY ALL"
)


@query(
    "kl_drift_report",
    with_ctes(
        f"SELECT 'M' AS COL_MODULE, L AS KL_MONTH, VAR AS KL_VAR, {s6('KL')} AS KL"
        " FROM (SELECT * FROM kl_numbers UNION ALL SELECT * FROM kl_categories)",
        "drift_rows", *_Q, *_C, "kl_numbers", "kl_categories",
    ),
)
def kl_drift_report(spark, sf):
    """The divergence of all drift variables, overall and by month, from one count of each side."""
    baseline, new = P.drift(spark, sf)
    spec = PSI.DriftModule("m", None, Roles(numerical=tuple(NUMBERS), categorical=tuple(CATEGORIES)), baseline)
    return rounded(PSI.divergence_report([spec], new))
