"""Jobs from scan to result: module scores, prepared tables, the full-width upsert, catalog tables."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from loanlens.operators import ks as K
from loanlens.operators.checks import checked_numbers, checked_rows
from loanlens.operators.cleaning import clean
from loanlens.operators.scoring import ModuleModel, linear_score, with_scores
from loanlens.operators.trees import tree_probability
from loanlens.operators.upsert import upsert_table
from loanlens.plans import decisions as D
from loanlens.plans.monitoring import features_with_outcomes
from loanlens.session import shared_folder, stored
from loanlens.sources import scans, sinks, versions
from loanlens.sources import schemas as S
from loanlens.sources.assets import Roles
from testbed import proxies as P
from testbed.q_decisions import (
    _FULL,
    _MASTER_SQL,
    _TO_BANDED,
    _TX,
    _blended,
    _calibrated_sql,
    _tx_model,
    CALIBRATION,
    END,
    START,
)
from testbed.q_metrics import _KS_FIXED
from testbed.q_outcomes import _AS_OF, LABELLED_SINCE, PAID_FROM, PAID_TO
from testbed.q_sources import activity_roles
from testbed.registry import CTES, logit_sql, query, rounded, s6, sigmoid_sql, with_ctes

# --- module scores, scan to calibrated score ---------------------------------


def _scored_sql(probability: str, source: str) -> str:
    return (
        f"SELECT BRE_RUN_ID, {s6(probability)} AS PRED_TRAIN, {s6(logit_sql(probability))} AS LOGODDS_SCORE,"
        f" {s6(_calibrated_sql(logit_sql(probability), CALIBRATION))} AS PRED_TRAIN_XGB FROM {source}"
    )


def _z_sql(intercept: float, terms) -> str:
    return f"{intercept:e}" + "".join(f" + {w:e} * {value}" for value, w in terms)


def _linear(intercept, terms):
    return lambda df, c: with_scores(df, linear_score(intercept, terms), c)


def _score(spark, sf, part, module, model, scorer, columns=None):
    rows = D.score_module(P.fact(spark, sf, part), module, START, END, model, scorer, columns)
    return rounded(rows.select("BRE_RUN_ID", "PRED_TRAIN", "LOGODDS_SCORE", "PRED_TRAIN_XGB"))


_BUREAU = [("BUREAUSCORE", -0.002), ("CURRENT_BALANCE_SUM", 0.004), ("MAX_DPD_LAST_3_MONTHS", 0.009), ("CAPSLAST30DAYS", -0.005)]


@query(
    "bureau_module_score",
    with_ctes(
        _scored_sql(sigmoid_sql(_z_sql(-1.0, [(f"coalesce({c}, -1)", w) for c, w in _BUREAU])), f"fact_bureau WHERE {S.BUREAU_FLAG}"),
        "fact_bureau",
    ),
)
def bureau_module_score(spark, sf):
    names = [c for c, _ in _BUREAU]
    model = ModuleModel(names, Roles(numerical=tuple(names)), CALIBRATION, missing_num=-1.0)
    return _score(spark, sf, "bureau", "bureau_module", model, _linear(-1.0, _BUREAU))


_SMS = [("AVG_DEBIT_AMOUNT_LAST30D", 0.006), ("NUM_CREDIT_TXNS_LAST30D", -0.008)]
_SHARES = [
    ("PROP_CREDIT_TXNS_LESSTHAN_100_LAST30D", 1.5), ("PROP_CREDIT_TXNS_GREATERTHAN_10000_LAST30D", -0.7)
]
_ALL_BANDS = "(" + " + ".join(S.CREDIT_BANDS) + ")"
_SMS_Z = _z_sql(
    -1.5,
    [(f"coalesce({c}, 0)", w) for c, w in _SMS]
    + [(f"({band} / nullif({_ALL_BANDS}, 0))", w) for band, (_, w) in zip((S.CREDIT_BANDS[0], S.CREDIT_BANDS[-1]), _SHARES)],
)


@query(
    "sms_module_score",
    with_ctes(_scored_sql(sigmoid_sql(_SMS_Z), f"fact_sms WHERE {S.SMS_FLAG}"), "fact_sms"),
)
def sms_module_score(spark, sf):
    """With the shares of the smallest and the largest credit band."""
    names = [c for c, _ in _SMS]
    model = ModuleModel(
        [*names, *[c for c, _ in _SHARES]], Roles(numerical=tuple(names)), CALIBRATION,
        zero_filled=names, credit_shares=True,
    )
    return _score(
        spark, sf, "sms", "sms_module", model, _linear(-1.5, [*_SMS, *_SHARES]), [*names, *S.CREDIT_BANDS]
    )


_ACTIVITY = [("LAST_1_MONTH_CUSTOMERS", 0.01), ("TOTAL_APPS", -0.004), ("PRICE", 0.002)]


@query(
    "activity_module_score",
    with_ctes(
        _scored_sql(
            sigmoid_sql(
                _z_sql(-0.5, [(f"coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 5)", w) for c, w in _ACTIVITY])
            ),
            "fact_activity",
        ),
        "fact_activity",
    ),
)
def activity_module_score(spark, sf):
    names = [c for c, _ in _ACTIVITY]
    model = ModuleModel(names, Roles(numerical=tuple(names)), CALIBRATION, missing_num=5.0)
    return _score(spark, sf, "activity", "activity_module", model, _linear(-0.5, _ACTIVITY))


# --- boosted trees from a table of nodes --------------------------------------

with open(os.path.join(os.path.dirname(__file__), "assets", "transaction_trees.json")) as _f:
    TREES = json.load(_f)


def _node_sql(node) -> str:
    """One tree as nested CASE, written from the nodes and not from the library's column."""
    if "value" in node:
        return f"{node['value']!r}e0" if "e" not in repr(node["value"]) else repr(node["value"])
    name = node["feature"]
    value = f"coalesce({'round(' + name + ', 2)' if name.startswith('RATIO') else name}, {0 if name == 'D_30_TXNS' else -99999})"
    return f"CASE WHEN {value} <= {node['threshold']!r} THEN {_node_sql(node['low'])} ELSE {_node_sql(node['high'])} END"


_MARGIN = " + ".join(f"{tree['weight']!r} * ({_node_sql(tree['root'])})" for tree in TREES)


@query(
    "module_scoring_trees",
    with_ctes(
        _scored_sql(sigmoid_sql(f"2e0 * ({_MARGIN})"), "fact_transaction WHERE DAYS_SINCE_LAST_TXN <= 90"),
        "fact_transaction",
    ),
)
def module_scoring_trees(spark, sf):
    """The trained boosted trees applied from scan to calibrated score."""
    return _score(
        spark, sf, "transaction", "transaction_module", _tx_model(spark, missing_num=-99999),
        lambda df, c: with_scores(df, tree_probability(TREES), c), _TX,
    )


# --- boosted trees with directions for missing values and splits on categories ---

with open(os.path.join(os.path.dirname(__file__), "assets", "activity_trees.json")) as _f:
    MISSING_TREES = json.load(_f)
_TREE_FEATURES = [*[c for c, _ in _ACTIVITY], "DEVICE_BRAND_GD"]


def _node_rows() -> list[str]:
    """The nodes as rows; node 0 is each tree's root."""
    rows = []
    for number, tree in enumerate(MISSING_TREES["trees"]):
        waiting, count = [(0, tree["root"])], 1
        for place, node in waiting:
            if "value" in node:
                rows.append(f"({number}, {place}, NULL, NULL, NULL, NULL, NULL, NULL, {node['value']:e})")
                continue
            waiting += [(count, node["low"]), (count + 1, node["high"])]
            listed = str(node["categories"]) if "categories" in node else "NULL"
            limit = f"{node['threshold']:e}" if "threshold" in node else "NULL"
            missing = node["missing"] == "low"
            rows.append(f"({number}, {place}, '{node['feature']}', {limit}, {listed}, {missing}, {count}, {count + 1}, NULL)")
            count += 2
    return rows


_WALKED = f"""
nodes(tree, node, feature, threshold, listed, missing_low, low, high, leaf) AS (VALUES {", ".join(_node_rows())}),
given AS (
  {" UNION ALL ".join(
      f"SELECT BRE_RUN_ID, '{c}' AS feature, CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS number, CAST(NULL AS VARCHAR) AS kind FROM fact_activity"
      for c in _TREE_FEATURES[:-1]
  )}
  UNION ALL SELECT BRE_RUN_ID, 'DEVICE_BRAND_GD', CAST(NULL AS DOUBLE), DEVICE_BRAND_GD FROM fact_activity),
walk AS (
  SELECT BRE_RUN_ID, tree, 0 AS node FROM fact_activity, (SELECT DISTINCT tree FROM nodes)
  UNION ALL SELECT w.BRE_RUN_ID, w.tree, CASE WHEN CASE
      WHEN g.number IS NULL AND g.kind IS NULL THEN n.missing_low
      WHEN n.listed IS NOT NULL THEN list_contains(n.listed, g.kind) ELSE g.number <= n.threshold END THEN n.low ELSE n.high END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node
  JOIN given g ON g.BRE_RUN_ID = w.BRE_RUN_ID AND g.feature = n.feature),
margins AS (
  SELECT BRE_RUN_ID, {MISSING_TREES["bias"]:e} + sum(leaf) AS z FROM walk JOIN nodes USING (tree, node)
  WHERE leaf IS NOT NULL GROUP BY BRE_RUN_ID)
"""


@query(
    "module_scoring_trees_missing",
    with_ctes(_WALKED.strip() + "\n" + _scored_sql(sigmoid_sql("z"), "margins"), "fact_activity")
    .replace("WITH ", "WITH RECURSIVE ", 1)
    .replace(")\nnodes(", "),\nnodes(", 1),
)
def module_scoring_trees_missing(spark, sf):
    """Trees that send missing values and sets of categories their own ways, over features that nobody filled."""
    numbers = tuple(_TREE_FEATURES[:-1])
    model = ModuleModel(_TREE_FEATURES, Roles(numerical=numbers, categorical=("DEVICE_BRAND_GD",)), CALIBRATION)
    probability = tree_probability(MISSING_TREES["trees"], scale=1.0, bias=MISSING_TREES["bias"])
    return _score(spark, sf, "activity", "activity_module", model, lambda df, c: with_scores(df, probability, c))


# --- prepared table, catalog, full-width upsert -------------------------------

_PREPARED = ["LAST_1_MONTH_CUSTOMERS", "TOTAL_APPS", "PRICE"]


@query(
    "activity_prepared_table",
    with_ctes(
        "SELECT CUSTOMER_ID AS USER_ID, BRE_RUN_ID, cast(BRE_RUN_DATE AS string) AS DISBURSED_DATE, "
        + ", ".join(
            f"{s6(f'coalesce(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, -99999)')} AS {c}" for c in _PREPARED
        )
        + ", CASE WHEN DEVICE_BRAND_GD IS NULL OR DEVICE_BRAND_GD = '--' THEN 'MISSING' ELSE DEVICE_BRAND_GD END AS DEVICE_BRAND_GD"
        " FROM fact_activity",
        "fact_activity",
    ),
)
def activity_prepared_table(spark, sf):
    """Scanned, cleaned, written as its table, with failed casts and rows counted by the write, and read back."""
    rows = scans.module_scan(P.fact(spark, sf, "activity"), "activity_module", START, END)
    rows, given = checked_rows(rows, "activity rows")
    rows, numeric = checked_numbers(rows, _PREPARED)
    prepared = clean(rows, activity_roles(spark), -99999, "MISSING")
    path = sinks.overwrite_path(prepared, shared_folder(spark), "prepared", "ACTIVITY_MODULE", checks=[given, numeric])
    return rounded(sinks.read_path(spark, path).select(*S.ID_COLUMNS, *_PREPARED, "DEVICE_BRAND_GD"))


@query(
    "catalog_overwrite_scan",
    with_ctes(
        "SELECT BRE_RUN_ID, cast(BRE_RUN_DATE AS string) AS BRE_RUN_DATE, OVERALL_BOUNCE_M0123 FROM fact_decision",
        "fact_decision",
    ),
)
def catalog_overwrite_scan(spark, sf):
    """Created in the catalog, replaced by other rows, and scanned by its name."""
    rows = P.fact(spark, sf).select("BRE_RUN_ID", "BRE_RUN_DATE", "OVERALL_BOUNCE_M0123")
    name = os.path.basename(shared_folder(spark)).replace("-", "_")
    sinks.overwrite_table(rows.where("OVERALL_BOUNCE_M0123 > 3"), name, "DECISIONS")
    return rounded(scans.table_scan(spark, sinks.overwrite_table(rows, name, "DECISIONS")))


_OLD = "cast(substr(BRE_RUN_ID, 2) AS bigint) % 3 = 0"
_FRESH = "cast(substr(BRE_RUN_ID, 2) AS bigint) % 2 = 0"
_OLD_VALUES = {"VERDICT_POLICY_ALONE": "'OLD'", "CALIB_PD": "0.5e0", "RISK_BANDS": "NULL"}
CTES["full_rows"] = f"SELECT {_MASTER_SQL} FROM full_verdicts"
CTES["full_merged"] = (
    f"SELECT * REPLACE ({', '.join(f'{v} AS {c}' for c, v in _OLD_VALUES.items())}) FROM full_rows"
    f" WHERE {_OLD} AND NOT ({_FRESH}) UNION ALL SELECT * FROM full_rows WHERE {_FRESH}"
)


@query("upsert_full_master", with_ctes("SELECT * FROM full_merged", *_TO_BANDED, *_FULL, "full_rows", "full_merged"))
def upsert_full_master(spark, sf):
    """Verdicts merged into an older master with all its columns; only the years that change are written."""
    rows = stored(D.decided(_blended(spark, sf)), "decided")
    old = rows.where(_OLD).withColumns(
        {c: F.expr(v).cast(rows.schema[c].dataType) for c, v in _OLD_VALUES.items()}
    )
    root = f"{shared_folder(spark)}/master"
    versions.replace(old, root, {"RUN_YEAR": "year(BRE_RUN_DATE)"})
    upsert_table(root, rows.where(_FRESH), source_stored=True)
    return rounded(sinks.read_path(spark, root).select(*S.MASTER_COLUMNS))


_SHARE_TEXT = ("DISTRIBUTION_BADS", "DISTRIBUTION_GOODS", "CUM_BADS_SHARE", "CUM_GOODS_SHARE")


@query(
    "ks_display",
    with_ctes(
        "SELECT PRED_COL, DECILE, "
        + ", ".join(f"printf('%.2f%%', {c} * 100) AS {c}" for c in _SHARE_TEXT)
        + " FROM (SELECT SCORE || '_' || MODEL_TYPE AS PRED_COL,"
        " cast(DECILE AS integer) AS DECILE, DB AS DISTRIBUTION_BADS, DG AS DISTRIBUTION_GOODS,"
        " CB AS CUM_BADS_SHARE, CG AS CUM_GOODS_SHARE FROM ks_running_fixed)",
        *_KS_FIXED,
    ),
)
def ks_display(spark, sf):
    shown = K.as_display(K.ks_table(P.scored(spark, sf)))
    return shown.select("PRED_COL", "DECILE", *_SHARE_TEXT)


# --- fact columns for the whole master -----------------------------------------

_FACT_DOUBLES = {S.EXTERNAL_SCORE, "WRITTEN_OFF_AMT_TOTAL_FOR_RULE"}
_OUTCOMES = ["LOAN_ID", "VENDOR", "STATUS", "EVER_15DPD_IN_90DAYS", "DISBURSED_DATE"]
_FROM_MASTER = [*[c for c in S.MASTER_COLUMNS if c not in S.DECISION_COLUMNS], *_OUTCOMES]
CTES["full_labelled"] = (
    "SELECT a.*, p.LOAN_ID, p.VENDOR, p.STATUS, p.EVER_15DPD_IN_90DAYS, p.DISBURSED_DATE FROM full_rows a"
    f" LEFT JOIN (SELECT * FROM latest WHERE DISBURSED_DATE >= date '{PAID_FROM}' AND DISBURSED_DATE <= date '{PAID_TO}') p"
    f" ON trim(a.CUSTOMER_ID) = p.USER_ID AND a.BRE_RUN_ID = p.BRE_RUN_ID AND a.BRE_RUN_DATE >= '{LABELLED_SINCE}'"
)


def _fact_column(c: str) -> str:
    if c == "BRE_RUN_DATE":
        return "cast(f.BRE_RUN_DATE AS string) AS BRE_RUN_DATE"
    return f"{s6('f.' + c)} AS {c}" if c in _FACT_DOUBLES else f"f.{c}"


@query(
    "fact_right_join_full",
    with_ctes(
        f"SELECT {', '.join(map(_fact_column, S.DECISION_COLUMNS))}, "
        + ", ".join("cast(b.DISBURSED_DATE AS string) AS DISBURSED_DATE" if c == "DISBURSED_DATE" else f"b.{c}" for c in _FROM_MASTER)
        + " FROM fact_decision f RIGHT JOIN full_labelled b ON trim(f.CUSTOMER_ID) = trim(b.CUSTOMER_ID)"
        " AND trim(f.BRE_RUN_ID) = trim(b.BRE_RUN_ID)",
        *_TO_BANDED, *_FULL, "full_rows", *[c for c in _AS_OF if c not in _TO_BANDED], "full_labelled",
    ),
)
def fact_right_join_full(spark, sf):
    """The whole decision list of the unfiltered fact beside all other master and outcome columns."""
    own = [c for c in S.MASTER_COLUMNS if c not in S.DECISION_COLUMNS]
    master = stored(D.decided(_blended(spark, sf)).select("CUSTOMER_ID", "BRE_RUN_ID", "BRE_RUN_DATE", *own), "master")
    fact = P.fact(spark, sf).select(*S.DECISION_COLUMNS)
    rows = features_with_outcomes(master, P.repayments(spark, sf), fact, PAID_FROM, PAID_TO, LABELLED_SINCE)
    return rounded(rows)
