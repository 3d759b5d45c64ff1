import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loanlens.operators.scoring import Calibration
from loanlens.plans import monitoring as M
from loanlens.session import shared_folder, stored
from loanlens.sources import assets, offers, scans, sinks
from loanlens.sources import schemas as S
from loanlens.sources.assets import Roles

OFFER = "ID int, CREATED_AT timestamp, METADATA string"


def offer_frame(spark, documents):
    rows = [(i, dt.datetime(2022, 8 + i % 2, 3, 4, 5), d if d is None or isinstance(d, str) else json.dumps(d))
            for i, d in enumerate(documents)]
    df = spark.createDataFrame(rows, OFFER)
    for c in offers.OFFER_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(c.lower()))
    return df


def document(features, scores=None, output=True):
    d = {"scoringServiceInput": {"features": features}, "riskBucket": "A", "reRenewalData": {"IS_RENEWAL": True}}
    if output:
        d["scoringServiceOutput"] = None if scores is None else {"raw_output": scores}
    return d


DOCS = [
    document({"sms": {"amt": 5, "kind": "x"}, "ledger": {}, "bureau": {"score": 700.5}},
             {"SMS_PD": 0.1, "Trx_PD": 0.2, "Br_PD": 0.3, "Calib_PD": 0.4}),
    document({"sms": {"amt": None}}, None),
    document({"sms": {"amt": 1}}, {"SMS_PD": 0.9}, output=False),
    "not json", None,
    document({"ledger": {"n": 3, "odd key's": "v"}, "activity": {"a": 1}}, {"Trx_PD": "0.25", "Calib_PD": "bad"}),
]


def test_json_null_output_is_kept_and_missing_output_dropped(spark):
    scanned = offers.offer_scan(offer_frame(spark, DOCS)).orderBy("ID").collect()
    assert [r["ID"] for r in scanned] == [0, 1, 5]
    first, null_output, third = scanned
    assert (first["SMS_PD"], first["TRX_PD"], first["BR_PD"], first["CALIB_PD"]) == (0.1, 0.2, 0.3, 0.4)
    assert first["LENDER_RISK_BUCKET"] == "A" and first["IS_RENEWAL"] is True and first["MODEL_TYPE"] == "XGBOOST"
    assert json.loads(first["MODEL_INPUT"])["features"]["sms"] == {"amt": 5, "kind": "x"}
    assert null_output["SMS_PD"] is None and third["TRX_PD"] == 0.25 and third["CALIB_PD"] is None
    assert len(offers.offer_scan(offer_frame(spark, DOCS)).columns) == 36


def test_module_records(spark):
    records = offers.module_records(offer_frame(spark, DOCS))
    got = {(r["ID"], r["MODULE"]): (r["MODULE_PD"], r["FEATURES"], r["MONTH_YEAR"], r["CREATED_AT"]) for r in records.collect()}
    assert got[0, "sms_module"] == (0.1, {"amt": "5", "kind": "x"}, "Aug-2022", "2022-08-03")
    assert got[0, "bureau_module"][:2] == (0.3, {"score": "700.5"})
    assert got[5, "transaction_module"][0] == 0.25 and got[5, "transaction_module"][2] == "Sep-2022"
    assert got[5, "activity"][0] is None and got[1, "sms_module"][1] == {"amt": None}
    assert (0, "transaction_module") not in got and len(got) == 5
    union = offers.module_union(records, "transaction_module")
    assert [c for c in union.columns if c not in records.columns and c != "TRX_PD"] == ["n", "odd key's"]
    long = offers.module_long(records)
    assert {(r.FEATURE, r.VALUE) for r in long.where("MODULE = 'transaction_module'").collect()} == {
        (k, r[k]) for r in union.collect() for k in ("n", "odd key's") if r[k] is not None
    }
    with pytest.raises(ValueError, match="more than 1"):
        offers.module_union(records, "transaction_module", most=1)
    assert offers.module_union(records, "nowhere").count() == 0
    table = offers.module_table(records, "sms_module", ["amt", "kind"]).orderBy("ID").collect()
    assert [(r["amt"], r["kind"], r["SMS_PD"]) for r in table] == [("5", "x", 0.1), (None, None, None)]


def test_combination_records_and_wide_columns(spark):
    df = offer_frame(spark, DOCS)
    got = {r["ID"]: r for r in offers.combination_records(df).collect()}
    assert (got[0]["SMS_PD"], got[0]["TRX_PD"], got[0]["BR_PD"], got[0]["CALIB_PD"]) == (0.1, None, 0.3, 0.4)
    wide = {r["ID"]: r for r in offers.module_columns(df, {"sms_module": ["amt"], "transaction_module": ["odd key's"]}).collect()}
    assert wide[0]["sms_module_amt"] == "5" and wide[0]["sms_module_SMS_PD"] == 0.1
    assert wide[0]["transaction_module_TRX_PD"] is None
    assert wide[5]["transaction_module_odd key's"] == "v" and wide[5]["TRX_PD"] == 0.25


def test_offer_drift_counts_by_own_month(spark):
    docs = [document({"sms": {"amt": i % 5}, "ledger": {}, "bureau": {}}, {"SMS_PD": i / 100, "Calib_PD": i / 100}) for i in range(40)]
    df = offer_frame(spark, docs)
    old = offers.module_records(df)
    roles = {"sms_module": Roles(("amt",))}
    report = M.offer_drift(df, {"sms_module": offers.module_table(old, "sms_module", ["amt"])}, roles).collect()
    assert {r["PSI_MONTH"] for r in report} == {"OVERALL", "AUG-2022", "SEP-2022"}
    assert {(r["COL_MODULE"], r["PSI_VAR"]) for r in report} == {("SMS_MODULE", "amt"), ("SMS_MODULE", "SMS_PD")}
    assert all(abs(r["PSI"]) < 1e-12 for r in report if r["PSI_MONTH"] == "OVERALL")


def test_writing_upper_cases_widens_and_replaces(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.5, "a", True, dt.date(2022, 1, 1))], "i int, Trx_PD float, s string, b boolean, d date")
    path = sinks.overwrite_path(df, str(tmp_path), "final_result", "MODEL_X", partition_by=["s"])
    sinks.overwrite_path(df.unionAll(df), str(tmp_path), "final_result", "MODEL_X", partition_by=["s"])
    assert path.endswith("/final_result_model_x_dag_version_two")
    back = sinks.read_path(spark, path)
    assert back.count() == 2 and set(back.columns) == {"I", "TRX_PD", "S", "B", "D"}
    assert dict(back.dtypes)["I"] == "bigint" and dict(back.dtypes)["TRX_PD"] == "double"
    with pytest.raises(TypeError, match="m"):
        sinks.warehouse_types(spark.sql("select map('a', 1) as m"))


def test_snapshots_are_never_overwritten(spark, tmp_path):
    path = sinks.write_snapshot(spark.range(3), f"{tmp_path}/run=1")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        sinks.write_snapshot(spark.range(1), path)
    assert spark.read.parquet(path).count() == 3


def test_catalog_table_round_trip(spark, tmp_path):
    spark.conf.set("spark.sql.legacy.createHiveTableByDefault", "false")
    spark.sql(f"create database if not exists t_sinks location '{tmp_path}/db'")
    spark.catalog.setCurrentDatabase("t_sinks")
    try:
        name = sinks.overwrite_table(spark.range(2), "result", "SMS")
        name = sinks.overwrite_table(spark.range(5), "result", "SMS")
        assert name == "result_sms_dag_version_two" and scans.table_scan(spark, name).count() == 5
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("drop database t_sinks cascade")


def test_shared_folder_follows_the_session(spark):
    class Session:
        conf = {"spark.checkpoint.dir": "store:/shared/"}

    assert shared_folder(Session).startswith("store:/shared/loanlens-")
    assert shared_folder(Session) != shared_folder(Session)
    assert stored(spark.range(4), "x").count() == 4


def test_shared_folder_raises_when_unset():
    class Context:
        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        conf, sparkContext = {}, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_assets(spark, tmp_path):
    (tmp_path / "d.csv").write_text("variables,Type\na,Numerical\nb,Categorical\nc,Other\n")
    roles = assets.feature_roles(assets.read_csv(spark, str(tmp_path / "d.csv"), assets.FEATURE_DICTIONARY))
    assert roles == Roles(("a",), ("b",)) and roles.within(["b"]) == Roles((), ("b",))
    (tmp_path / "m.csv").write_text("Model_no,variable,coefficient\n0,const,1.5\n0,x_woe,-2\n1,y,3\n")
    model = assets.read_csv(spark, str(tmp_path / "m.csv"), assets.MODEL_VARIABLES)
    assert assets.model_variables(model, 0) == [("const", 1.5), ("x_woe", -2.0)]
    (tmp_path / "w.csv").write_text('variable,bin,woe\nn,"[-inf,1.0)",0.5\nn,missing,1\n')
    assert assets.woe_bins(assets.read_csv(spark, str(tmp_path / "w.csv"), assets.WOE_BINS)) == {"n": [("[-inf,1.0)", 0.5), ("missing", 1.0)]}


def test_column_lists_are_whole():
    assert len(S.TRANSACTION_FEATURES) == len(set(S.TRANSACTION_FEATURES)) == 196
    assert len(S.BUREAU_FEATURES) == len(set(S.BUREAU_FEATURES)) == 139
    assert len(S.SMS_FEATURES) == len(set(S.SMS_FEATURES)) == 102
    assert len(S.SMS_EVENT_COUNTS) == 30 and len(S.ACTIVITY_FEATURES) == 19
    assert len(S.MASTER_COLUMNS) == len(set(S.MASTER_COLUMNS)) == 58
    assert Calibration().slope == 1.0


def test_scan_reads_only_what_it_needs(spark, tmp_path):
    wide = {c: F.lit(1.0) for c in S.TRANSACTION_FEATURES}
    fact = spark.range(5).select(
        F.col("id").cast("string").alias("CUSTOMER_ID"), F.lit("r").alias("BRE_RUN_ID"),
        F.lit(dt.datetime(2022, 8, 2)).alias("BRE_RUN_DATE"), F.lit(True).alias(S.LEDGER_FLAG),
        *[v.alias(c) for c, v in wide.items()],
    )
    fact.write.parquet(f"{tmp_path}/fact")
    df = scans.module_scan(spark.read.parquet(f"{tmp_path}/fact"), "transaction_module", "2022-08-01", "2022-08-31", features=["KB_AGE"])
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "KB_AGE" in read and "TOTAL_KHATAS" not in read and "DAYS_SINCE_LAST_TXN" in read
    assert "GreaterThanOrEqual(BRE_RUN_DATE" in plan and "LessThanOrEqual(DAYS_SINCE_LAST_TXN" in plan
    assert "Exchange" not in plan and df.count() == 5
