"""Offers with nested JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.plans.monitoring import offer_drift
from loanlens.session import stored
from loanlens.sources import offers as O
from loanlens.sources.assets import Roles
from testbed import proxies as P
from testbed.q_metrics import category_psi_ctes, numeric_psi_ctes
from testbed.registry import CTES, query, rounded, s6, with_ctes

_OUT = "$.scoringServiceOutput"


def _json(path, kind="string"):
    return f"cast(json_extract_string(METADATA, '{path}') AS {kind})"


CTES["scored_offers"] = f"SELECT * FROM offers WHERE json_extract(METADATA, '{_OUT}') IS NOT NULL"
_TEXT = [c for c in O.OFFER_COLUMNS if not c.endswith("_AT")]
_PATHS = [(n, p, k) for n, p, k in O.OFFER_PATHS if n not in ("MODEL_INPUT", "MODEL_OUTPUT")]


@query(
    "json_path_extract",
    with_ctes(
        f"SELECT {', '.join(_TEXT)}, strftime(CREATED_AT, '%Y-%m-%d %H:%M:%S') AS CREATED_AT, 'XGBOOST' AS MODEL_TYPE, "
        + ", ".join(f"{_json(p, k)} AS {n}" for n, p, k in _PATHS)
        + " FROM scored_offers",
        "offers", "scored_offers",
    ),
)
def json_path_extract(spark, sf):
    rows = O.offer_scan(P.offers(spark, sf))
    return rows.select(
        *_TEXT, F.date_format("CREATED_AT", "yyyy-MM-dd HH:mm:ss").alias("CREATED_AT"), "MODEL_TYPE",
        *[n for n, _, _ in _PATHS],
    )


@query(
    "json_output_present",
    with_ctes(
        f"SELECT json_extract(METADATA, '{_OUT}') IS NOT NULL AS PRESENT,"
        f" json_type(METADATA, '{_OUT}') = 'NULL' AND json_extract(METADATA, '{_OUT}') IS NOT NULL AS IS_JSON_NULL,"
        " count(*) AS N FROM (SELECT METADATA FROM offers) GROUP BY ALL"
        .replace("json_type(METADATA, '$.scoringServiceOutput') = 'NULL'",
                 "coalesce(json_type(METADATA, '$.scoringServiceOutput') = 'NULL', false)"),
        "offers",
    ),
)
def json_output_present(spark, sf):
    doc = P.offers(spark, sf).select(F.try_parse_json("METADATA").alias("d"))
    out = F.try_variant_get("d", _OUT, "variant")
    return doc.select(
        O.has_path(F.col("d"), _OUT).alias("PRESENT"),
        F.coalesce(F.is_variant_null(out), F.lit(False)).alias("IS_JSON_NULL"),
    ).groupBy("PRESENT", "IS_JSON_NULL").agg(F.count("*").alias("N"))


# Some documents lost their last brace, some are missing.
CTES["damaged_offers"] = (
    "SELECT CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN METADATA[:-2] ELSE METADATA END AS METADATA"
    " FROM (SELECT ID AS event_id, METADATA FROM offers)"
)


@query(
    "failed_documents",
    with_ctes(
        "SELECT count(*) AS OFFERS, count(*) FILTER (WHERE METADATA IS NULL) AS WITHOUT_DOCUMENT,"
        " count(*) FILTER (WHERE NOT json_valid(METADATA)) AS FAILED_DOCUMENTS,"
        f" count(*) FILTER (WHERE json_valid(METADATA) AND json_extract(CASE WHEN json_valid(METADATA) THEN METADATA END, '{_OUT}') IS NULL)"
        " AS NOT_SCORED FROM damaged_offers",
        "offers", "damaged_offers",
    ),
)
def failed_documents(spark, sf):
    damaged = F.when(F.col("ID") % 17 == 0, None).when(
        F.col("ID") % 13 == 0, F.expr("substr(METADATA, 1, length(METADATA) - 1)")
    )
    return O.document_counts(P.offers(spark, sf).withColumn("METADATA", damaged.otherwise(F.col("METADATA"))))


_FEATURES = "$.scoringServiceInput.features"
_PD_PATH = {"sms": "SMS_PD", "ledger": "Trx_PD", "bureau": "Br_PD"}
CTES["offer_records"] = " UNION ALL ".join(
    f"SELECT ID, '{table}' AS MODULE, strftime(CREATED_AT, '%Y-%m-%d') AS CREATED_AT, CREATED_AT AS TS,"
    f" strftime(CREATED_AT, '%b-%Y') AS MONTH_YEAR, USER_ID, LOAN_APPLICATION_ID,"
    f" {_json(_OUT + '.raw_output.' + _PD_PATH[source], 'double')} AS MODULE_PD,"
    f" json_extract(METADATA, '{_FEATURES}.{source}') AS F FROM scored_offers"
    f" WHERE len(json_keys(METADATA, '{_FEATURES}.{source}')) > 0"
    for source, table, _ in O.OFFER_MODULES
)
_RECORDS = ("offers", "scored_offers", "offer_records")


@query(
    "json_module_explode",
    with_ctes(
        "SELECT ID, MODULE, CREATED_AT, MONTH_YEAR, USER_ID, LOAN_APPLICATION_ID,"
        f" {s6('MODULE_PD')} AS MODULE_PD, len(json_keys(F)) AS N_FEATURES FROM offer_records",
        *_RECORDS,
    ),
)
def json_module_explode(spark, sf):
    records = O.module_records(P.offers(spark, sf))
    return rounded(records.select("*", F.size("FEATURES").alias("N_FEATURES")).drop("FEATURES"))


@query(
    "json_combination_records",
    with_ctes(
        "SELECT ID, strftime(CREATED_AT, '%Y-%m-%d') AS CREATED_AT, strftime(CREATED_AT, '%b-%Y') AS MONTH_YEAR,"
        f" USER_ID, LOAN_APPLICATION_ID, {_json(_OUT + '.raw_output.Calib_PD', 'double')} AS CALIB_PD, "
        + ", ".join(
            f"CASE WHEN len(json_keys(METADATA, '{_FEATURES}.{source}')) > 0 THEN"
            f" {_json(_OUT + '.raw_output.' + _PD_PATH[source], 'double')} END AS {pd}"
            for source, _, pd in O.OFFER_MODULES
        )
        + " FROM scored_offers",
        "offers", "scored_offers",
    ),
)
def json_combination_records(spark, sf):
    return O.combination_records(P.offers(spark, sf))


@query(
    "json_module_table",
    with_ctes(
        "SELECT ID, CREATED_AT, MONTH_YEAR, USER_ID, LOAN_APPLICATION_ID, json_extract_string(F, '$.amt') AS amt,"
        " json_extract_string(F, '$.kind') AS kind, MODULE_PD AS SMS_PD FROM offer_records WHERE MODULE = 'sms_module'",
        *_RECORDS,
    ),
)
def json_module_table(spark, sf):
    """The columns are the feature names found in the records."""
    return O.module_union(O.module_records(P.offers(spark, sf)), "sms_module")


@query(
    "json_module_long",
    with_ctes(
        "SELECT ID, MODULE, CREATED_AT, MONTH_YEAR, USER_ID, LOAN_APPLICATION_ID, MODULE_PD, k AS FEATURE,"
        " json_extract_string(F, '$.\"' || k || '\"') AS VALUE FROM (SELECT *, unnest(json_keys(F)) AS k FROM offer_records)",
        *_RECORDS,
    ),
)
def json_module_long(spark, sf):
    """All modules' features as rows, whatever their names and number."""
    return rounded(O.module_long(O.module_records(P.offers(spark, sf))))


def _listed_table(table, key, pd):
    """A module's table with its features as listed, not as found."""
    name = f"json_{table}_table"

    @query(
        name,
        with_ctes(
            "SELECT ID, CREATED_AT, MONTH_YEAR, USER_ID, LOAN_APPLICATION_ID,"
            f" json_extract_string(F, '$.{key}') AS {key}, MODULE_PD AS {pd} FROM offer_records WHERE MODULE = '{table}'",
            *_RECORDS,
        ),
    )
    def run(spark, sf):
        return O.module_table(O.module_records(P.offers(spark, sf)), table, [key])


_listed_table("transaction_module", "n", "TRX_PD")
_listed_table("bureau_module", "score", "BR_PD")

_IN = "$.scoringServiceInput.features"
_INPUT_TEXT = (
    "'{\"features\":{\"bureau\":' || " + f"json_extract(METADATA, '{_IN}.bureau')"
    + " || ',\"ledger\":' || " + f"json_extract(METADATA, '{_IN}.ledger')"
    + " || ',\"sms\":' || " + f"json_extract(METADATA, '{_IN}.sms')" + " || '}}'"
)


@query(
    "json_all_paths",
    with_ctes(
        "SELECT ID, strftime(EXPIRE_AT, '%Y-%m-%d %H:%M:%S') AS EXPIRE_AT, strftime(UPDATED_AT, '%Y-%m-%d %H:%M:%S') AS UPDATED_AT,"
        f" {_INPUT_TEXT} AS MODEL_INPUT, json_extract_string(METADATA, '{_OUT}.raw_output.Risk_bands') AS OUTPUT_BAND,"
        f" json_extract_string(METADATA, '{_OUT}.model_config.model_version') AS OUTPUT_VERSION FROM scored_offers",
        "offers", "scored_offers",
    ),
)
def json_all_paths(spark, sf):
    """Both documents and the times: the input as text with sorted names, the output parsed again."""
    rows = O.offer_scan(P.offers(spark, sf))
    again = F.try_parse_json("MODEL_OUTPUT")
    return rows.select(
        "ID",
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("EXPIRE_AT", "UPDATED_AT")],
        "MODEL_INPUT",
        O.json_value(again, "$.raw_output.Risk_bands", "string").alias("OUTPUT_BAND"),
        O.json_value(again, "$.model_config.model_version", "string").alias("OUTPUT_VERSION"),
    )


SPLIT = "2024-01-16"
CTES["offer_features"] = (
    "SELECT MODULE, CREATED_AT, TS AS DAY, MODULE_PD, try_cast(json_extract_string(F, '$.amt') AS double) AS amt,"
    " json_extract_string(F, '$.kind') AS kind, try_cast(json_extract_string(F, '$.n') AS double) AS n,"
    " try_cast(json_extract_string(F, '$.score') AS double) AS score,"
    " CASE WHEN MODULE = 'sms_module' THEN MODULE_PD END AS SMS_PD,"
    " CASE WHEN MODULE = 'transaction_module' THEN MODULE_PD END AS TRX_PD,"
    " CASE WHEN MODULE = 'bureau_module' THEN MODULE_PD END AS BR_PD, NULL::double AS CALIB_PD FROM offer_records"
)
CTES["offer_rows"] = (
    "SELECT * FROM offer_features UNION ALL BY NAME SELECT 'combination_module_xg' AS MODULE,"
    " strftime(CREATED_AT, '%Y-%m-%d') AS CREATED_AT, CREATED_AT AS DAY, NULL::double AS MODULE_PD,"
    f" {_json(_OUT + '.raw_output.Calib_PD', 'double')} AS CALIB_PD, "
    + ", ".join(
        f"CASE WHEN len(json_keys(METADATA, '{_FEATURES}.{source}')) > 0 THEN"
        f" {_json(_OUT + '.raw_output.' + _PD_PATH[source], 'double')} END AS {pd}"
        for source, _, pd in O.OFFER_MODULES
    )
    + " FROM scored_offers"
)
_MODULES = {
    "sms_module": ("SMS_PD", ["amt"], ["kind"]),
    "transaction_module": ("TRX_PD", ["n"], []),
    "bureau_module": ("BR_PD", ["score"], []),
    "combination_module_xg": ("CALIB_PD", ["TRX_PD", "SMS_PD", "BR_PD"], []),
}


def _drift_items(index, new):
    items = []
    for module, spec in _MODULES.items():
        columns = [*spec[1], spec[0]] if index == 1 else spec[2]
        rows = f"MODULE = '{module}' AND CREATED_AT {'>=' if new else '<'} '{SPLIT}'"
        if new:
            rows += f" AND {spec[0]} IS NOT NULL"
        items += [(module, c, rows) for c in columns]
    return items


_ON = numeric_psi_ctes("o", _drift_items(1, False), _drift_items(1, True), "offer_rows", "quantiles")
_OC = category_psi_ctes("oc", _drift_items(2, False), _drift_items(2, True), "offer_rows")


@query(
    "offer_drift_report",
    with_ctes(
        f"SELECT upper(MODULE) AS COL_MODULE, L AS PSI_MONTH, VAR AS PSI_VAR, {s6('PSI')} AS PSI"
        " FROM (SELECT * FROM psi_num_o UNION ALL SELECT * FROM psi_cat_oc)",
        *_RECORDS, "offer_features", "offer_rows", *_ON, *_OC,
    ),
)
def offer_drift_report(spark, sf):
    """Offers from the split day on, against the offers before it."""
    offers = P.offers(spark, sf)
    old = offers.where(F.col("CREATED_AT") < F.lit(SPLIT).cast("timestamp_ntz"))
    new = offers.where(F.col("CREATED_AT") >= F.lit(SPLIT).cast("timestamp_ntz"))
    roles = {m: Roles(tuple(n), tuple(c)) for m, (_, n, c) in _MODULES.items()}
    records = stored(O.module_records(old), "baseline_records")
    baselines = {
        module: O.module_table(records, module, [*roles[module].numerical, *roles[module].categorical])
        for _, module, _ in O.OFFER_MODULES
    }
    baselines["combination_module_xg"] = stored(O.combination_records(old), "baseline_scores")
    return rounded(offer_drift(new, baselines, roles))
