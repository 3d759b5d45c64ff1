"""Offers: rows with one nested JSON column that holds model input and output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions import iso_day, month_label
from loanlens.session import stored

OFFER_COLUMNS = [
    "ID", "EXPIRE_AT", "CREATED_AT", "UPDATED_AT", "LOAN_APPLICATION_ID", "UID", "USER_ID",
    "TYPE", "STATUS", "LOAN_TYPE", "LENDER",
]

# Output column, JSON path, type.
OFFER_PATHS = [
    ("MODEL_INPUT", "$.scoringServiceInput", "string"),
    ("MODEL_OUTPUT", "$.scoringServiceOutput", "string"),
    ("IS_RENEWAL", "$.reRenewalData.IS_RENEWAL", "boolean"),
    ("X_SELL_SCORE", "$.reVendorInsightsData.X_SELL_SCORE", "string"),
    ("FIS_SCORE", "$.reVendorInsightsData.FIS_SCORE", "string"),
    ("LENDER_RISK_BUCKET", "$.riskBucket", "string"),
    ("MODEL_VERSION", "$.scoringServiceOutput.model_config.model_version", "string"),
    ("COMBINATION_TYPE", "$.scoringServiceOutput.raw_output.COMBINATION_TYPE", "string"),
    ("MODEL_RISK_BUCKET", "$.scoringServiceOutput.raw_output.Risk_bands", "string"),
    ("USERID", "$.scoringServiceOutput.output.UserID", "string"),
    ("BR_PD", "$.scoringServiceOutput.raw_output.Br_PD", "double"),
    ("CALIB_PD", "$.scoringServiceOutput.raw_output.Calib_PD", "double"),
    ("COMBINED_PD", "$.scoringServiceOutput.raw_output.Combined_PD", "double"),
    ("COMBINED_LOGODDS", "$.scoringServiceOutput.raw_output.Combined_logodds", "double"),
    ("IS_BR_SUFF", "$.scoringServiceOutput.raw_output.IS_BR_SUFF", "string"),
    ("IS_SMS_SUFF", "$.scoringServiceOutput.raw_output.IS_SMS_SUFF", "string"),
    ("IS_TRX_SUFF", "$.scoringServiceOutput.raw_output.IS_TRX_SUFF", "string"),
    ("SMS_PD", "$.scoringServiceOutput.raw_output.SMS_PD", "double"),
    ("TRX_PD", "$.scoringServiceOutput.raw_output.Trx_PD", "double"),
    ("LOGODDS_BR", "$.scoringServiceOutput.raw_output.logodds_br", "double"),
    ("LOGODDS_TRX", "$.scoringServiceOutput.raw_output.logodds_trx", "double"),
    ("PRED_BR", "$.scoringServiceOutput.raw_output.pred_br", "double"),
    ("PRED_SMS", "$.scoringServiceOutput.raw_output.pred_sms", "double"),
    ("PRED_TRX", "$.scoringServiceOutput.raw_output.pred_trx", "double"),
]

# Module of the JSON, its name as a table, its own score.
OFFER_MODULES = [
    ("sms", "sms_module", "SMS_PD"),
    ("ledger", "transaction_module", "TRX_PD"),
    ("bureau", "bureau_module", "BR_PD"),
]

FEATURES = "$.scoringServiceInput.features"
MOST_FEATURES = 2_000  # that one module's table has as columns
SCORING_OUTPUT = "$.scoringServiceOutput"


def json_value(document: Column, path: str, type_name: str) -> Column:
    """One value of a parsed document; NULL where the path or the type does not fit."""
    return F.try_variant_get(document, path, type_name)


def has_path(document: Column, path: str) -> Column:
    """The path exists.  A JSON null counts as present, as it does in a variant column."""
    return F.try_variant_get(document, path, "variant").isNotNull()


def parsed_offers(offers: DataFrame) -> DataFrame:
    """Offers that carry a scoring output, with the parsed document as ``_doc``.

    The document passes through a one-element array that the condition may
    empty: a plain filter would be moved below the projection and parse every
    document a second time.
    """
    kept = F.filter(F.array(F.try_parse_json("METADATA")), lambda d: has_path(d, SCORING_OUTPUT))
    return offers.select(*OFFER_COLUMNS, F.explode(kept).alias("_doc"))


def document_counts(offers: DataFrame) -> DataFrame:
    """One row: offers, those without a document, with one that does not parse, and without a scoring output.

    The scans leave all three kinds out; a job reports these counts beside its result.
    """
    doc = F.try_parse_json("METADATA")
    given = F.col("METADATA").isNotNull()
    return offers.select(given.alias("_given"), doc.isNotNull().alias("_parsed"), has_path(doc, SCORING_OUTPUT).alias("_scored")).agg(
        F.count("*").alias("OFFERS"),
        F.count_if(~F.col("_given")).alias("WITHOUT_DOCUMENT"),
        F.count_if(F.col("_given") & ~F.col("_parsed")).alias("FAILED_DOCUMENTS"),
        F.count_if(F.col("_parsed") & ~F.col("_scored")).alias("NOT_SCORED"),
    )


def _paths(names: Sequence[str] | None = None) -> list[Column]:
    doc = F.col("_doc")
    return [
        json_value(doc, path, kind).alias(name)
        for name, path, kind in OFFER_PATHS
        if names is None or name in names
    ]


def offer_scan(offers: DataFrame, model_type: str = "XGBOOST") -> DataFrame:
    """Offers that carry a scoring output, with the listed paths as columns."""
    return parsed_offers(offers).select(
        *OFFER_COLUMNS, F.lit(model_type).alias("MODEL_TYPE"), *_paths()
    )


def _members(module: str) -> Column:
    """The features of one module as a map."""
    return json_value(F.col("_doc"), f"{FEATURES}['{module}']", "map<string, string>")


def _feature(module: str, key: str) -> Column:
    """One feature by its path; a name with a quote is looked up in the map."""
    if "'" in key:
        return F.element_at(_members(module), key)
    return json_value(F.col("_doc"), f"{FEATURES}['{module}']['{key}']", "string")


def _present(module: str) -> Column:
    """The module is in the document and not empty."""
    members = _members(module)
    return F.coalesce(F.size(members) > 0, F.lit(False))


_SCORES = ["CALIB_PD", *[pd for _, _, pd in OFFER_MODULES]]


def module_records(offers: DataFrame) -> DataFrame:
    """One record per scored offer and non-empty module, with ids and its own score."""
    score = F.lit(None).cast("double")
    name = F.col("_module")
    for source, table, pd_column in OFFER_MODULES:
        score = F.when(F.col("_module") == source, F.col(pd_column)).otherwise(score)
        name = F.when(F.col("_module") == source, F.lit(table)).otherwise(name)
    features = json_value(F.col("_doc"), FEATURES, "map<string, map<string, string>>")
    return (
        parsed_offers(offers)
        .select(
            "ID", "CREATED_AT", "USER_ID", "LOAN_APPLICATION_ID",
            *_paths(_SCORES),
            F.explode(features).alias("_module", "FEATURES"),
        )
        .where(F.size("FEATURES") > 0)
        .select(
            "ID",
            name.alias("MODULE"),
            iso_day("CREATED_AT").alias("CREATED_AT"),
            month_label("CREATED_AT").alias("MONTH_YEAR"),
            "USER_ID",
            "LOAN_APPLICATION_ID",
            score.alias("MODULE_PD"),
            "FEATURES",
        )
    )


def _gated_scores() -> list[Column]:
    """The score of each module, NULL where the module is empty."""
    return [F.when(_present(m), F.col(pd)).alias(pd) for m, _, pd in OFFER_MODULES]


def combination_records(offers: DataFrame) -> DataFrame:
    """One record per scored offer: the blended score and those of its non-empty modules."""
    return parsed_offers(offers).select(*OFFER_COLUMNS, "_doc", *_paths(_SCORES)).select(
        "ID",
        iso_day("CREATED_AT").alias("CREATED_AT"),
        month_label("CREATED_AT").alias("MONTH_YEAR"),
        "USER_ID",
        "LOAN_APPLICATION_ID",
        "CALIB_PD",
        *_gated_scores(),
    )


def module_columns(offers: DataFrame, features: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per scored offer: the listed features of each module table, and the scores.

    Columns are named ``{module table}_{feature}``; the module's own score is
    among them and is NULL where the module is empty.  Nothing is exploded, so
    all modules are read in one pass.
    """
    values = [
        _feature(source, key).alias(f"{table}_{key}")
        for source, table, _ in OFFER_MODULES
        for key in features.get(table, ())
    ]
    scored = parsed_offers(offers).select(
        "ID", "CREATED_AT", "_doc", *values, *_paths(_SCORES)
    )
    gated = scored.select(
        "ID",
        month_label("CREATED_AT").alias("MONTH_YEAR"),
        "CALIB_PD",
        *[f"{table}_{key}" for _, table, _ in OFFER_MODULES for key in features.get(table, ())],
        *_gated_scores(),
    )
    return gated.select("*", *[F.col(pd).alias(f"{table}_{pd}") for _, table, pd in OFFER_MODULES])


def module_long(records: DataFrame) -> DataFrame:
    """One row per record and feature: the form that holds any number of feature names."""
    return records.select(
        "ID", "MODULE", "CREATED_AT", "MONTH_YEAR", "USER_ID", "LOAN_APPLICATION_ID", "MODULE_PD",
        F.explode("FEATURES").alias("FEATURE", "VALUE"),
    )


def module_union(records: DataFrame, module: str, most: int = MOST_FEATURES) -> DataFrame:
    """Records of one module with a column for every feature name that any of them has.

    The names are the fields of one schema, which the tasks merge; the records
    are written once, as a stored frame, and read for the schema and for the
    table.  A module with more than ``most`` names raises: it has no use as
    columns, but ``module_long`` takes it.
    """
    kept = stored(records.where(F.col("MODULE") == module), "module_records")
    merged = kept.agg(F.schema_of_variant_agg(F.to_variant_object("FEATURES"))).first()[0] or ""
    fields = T.StructType.fromDDL("f STRUCT<" + merged.removeprefix("OBJECT<"))["f"].dataType if merged.startswith("OBJECT<") else []
    if len(fields) > most:
        raise ValueError(f"{module} has {len(fields)} features, more than {most}; module_long holds them as rows")
    return module_table(kept, module, sorted(f.name for f in fields))


def module_table(
    records: DataFrame, module: str, keys: Sequence[str], pd_column: str | None = None
) -> DataFrame:
    """Records of one module as columns, absent features NULL.

    Reads the map per row, so no pivot and no shuffle.
    """
    pds = {table: pd for _, table, pd in OFFER_MODULES}
    score = pd_column or pds.get(module, "MODULE_PD")
    return records.where(F.col("MODULE") == module).select(
        "ID", "CREATED_AT", "MONTH_YEAR", "USER_ID", "LOAN_APPLICATION_ID",
        *[F.element_at("FEATURES", key).alias(key) for key in keys],
        F.col("MODULE_PD").alias(score),
    )
