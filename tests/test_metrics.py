import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators import gini as G
from loanlens.operators import ks as K
from loanlens.operators import psi as P
from loanlens.operators.kl import aligned_shares, kl_divergence
from loanlens.operators.quantiles import SKETCH_RANK_ERROR, exact_quantiles, sketched_quantiles
from loanlens.sources import schemas as S
from loanlens.sources.assets import Roles


def pairwise_gini(rows):
    bad = [s for s, y in rows if y == 1]
    good = [s for s, y in rows if y == 0]
    if not bad or not good:
        return None
    wins = sum((b > g) + 0.5 * (b == g) for b in bad for g in good)
    return 2 * wins / (len(bad) * len(good)) - 1


def scored(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        s = 0.5 if rnd.random() < 0.35 else round(rnd.random(), rnd.choice([1, 6]))  # one score holds a third
        rows.append(("a" if rnd.random() < 0.7 else "b", s, int(rnd.random() < s * 0.8)))
    return rows + [("a", None, 1), ("a", 0.4, None), ("one", 0.1, 1), ("one", 0.2, 1)]


@pytest.mark.parametrize("ranges", [1, 2, 7, 64, 300])
def test_gini_equals_pairwise_for_any_ranges(spark, ranges):
    rows = scored(3)
    df = spark.createDataFrame(rows, "g string, s double, y int")
    got = {r["g"]: r for r in G.gini(df, ["g"], "s", "y", ranges).collect()}
    for g in ("a", "b"):
        kept = [(s, y) for k, s, y in rows if k == g and s is not None and y is not None]
        assert got[g]["GINI"] == pytest.approx(pairwise_gini(kept), abs=1e-12)
        assert got[g]["BADS"] + got[g]["GOODS"] == len(kept)
    assert got["one"]["GINI"] is None


def test_gini_changes_sign_with_the_score(spark):
    df = spark.createDataFrame(scored(5), "g string, s double, y int").where("g <> 'one'")
    up = {r["g"]: r["GINI"] for r in G.gini(df, ["g"], "s", "y").collect()}
    down = {r["g"]: r["GINI"] for r in G.gini(df.withColumn("s", -F.col("s")), ["g"], "s", "y").collect()}
    assert all(down[g] == pytest.approx(-up[g]) for g in up)


def gini_rows(n=300):
    rnd = random.Random(11)

    def maybe(v):
        return None if rnd.random() < 0.2 else v

    return [
        (i, rnd.choice(["XGBOOST", "LR"]), maybe(dt.date(2022, 6 + rnd.randrange(4), 1 + rnd.randrange(28))),
         maybe(rnd.random()), maybe(rnd.random()), maybe(rnd.random()), maybe(rnd.random()), maybe(rnd.random()),
         maybe(rnd.random() < 0.6), maybe(rnd.random() < 0.6), maybe(rnd.random() < 0.6), rnd.randrange(2))
        for i in range(n)
    ]


COLUMNS = (f"id int, MODEL_TYPE string, DISBURSED_DATE date, CALIB_PD double, SMS_PD double, TRX_PD double, BR_PD double,"
           f" {S.EXTERNAL_SCORE} double, {S.SMS_FLAG} boolean, {S.LEDGER_FLAG} boolean, {S.BUREAU_FLAG} boolean,"
           f" {S.OUTCOME_LABEL} int")


def test_gini_columns_reach_exactly_the_rows_that_counted(spark):
    rows = gini_rows()
    df = spark.createDataFrame(rows, COLUMNS)
    got = G.with_gini_columns(df).collect()
    assert len(got) == len(rows)
    names = df.columns
    flags = dict(G.GINI_SCORES)
    data = [dict(zip(names, r)) for r in rows]
    by_id = {r["id"]: r for r in got}

    def check(metric, measured, counts, group):
        groups = {}
        for d in data:
            if counts(d):
                groups.setdefault(group(d), []).append((d[measured], d[S.OUTCOME_LABEL]))
        for d in data:
            value = by_id[d["id"]][metric]
            if counts(d):
                assert value == pytest.approx(pairwise_gini(groups[group(d)]), abs=1e-9), metric
            else:
                assert value is None, metric

    since = dt.date(2022, 8, 1)
    month = lambda d: (d["MODEL_TYPE"], d["DISBURSED_DATE"].strftime("%b-%Y"))
    for score, flag in flags.items():
        ok = lambda d, s=score, f=flag: d[s] is not None and (f is None or d[f] is True)
        check(f"{score}_GINI_OVERALL", score, lambda d: ok(d) and d["DISBURSED_DATE"] and d["DISBURSED_DATE"] >= since,
              lambda d: d["MODEL_TYPE"])
        check(f"{score}_GINI", score, lambda d: ok(d) and d["DISBURSED_DATE"], month)
        if score != S.EXTERNAL_SCORE:
            own = ok if score == "BR_PD" else (lambda d, s=score: d[s] is not None)
            check(f"{score}_AND_FB_SCORE_GINI", S.EXTERNAL_SCORE,
                  lambda d: own(d) and d[S.EXTERNAL_SCORE] is not None and d["DISBURSED_DATE"], month)


def brute_ks(rows, cuts):
    tb, tg = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    buckets = []
    for i in range(len(cuts) - 1):
        inside = [(s, y) for s, y in rows if s is not None and cuts[i] < s <= cuts[i + 1]]
        buckets.append((min((s for s, _ in inside), default=math.inf), i, sum(y for _, y in inside), sum(1 - y for _, y in inside)))
    out, cb, cg = [], 0.0, 0.0
    for low, i, b, g in sorted(buckets):
        cb, cg = cb + b / tb, cg + g / tg
        out.append((i + 1, b, g, np.round(cg - cb, 3) * 100))
    return out


def test_ks_with_an_empty_bucket_and_null_scores(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([0.01, 0.0162, 0.02, 0.03, 0.06, None]), rnd.randrange(2)) for _ in range(200)]  # none in (.0392, .0532]
    df = spark.createDataFrame([("X", s, y) for s, y in rows], "MODEL_TYPE string, CALIB_PD double, EVER_15DPD_IN_90DAYS int")
    got = K.ks_table(df, ["CALIB_PD"]).orderBy("DECILE").collect()
    expected = brute_ks(rows, [-math.inf, *K.KS_CUTS, math.inf])
    assert [(r["BUCKET"], r["BADS"], r["GOODS"]) for r in got] == [e[:3] for e in expected]
    assert [r["CUM_DIFFERENCE"] for r in got] == pytest.approx([e[3] for e in expected])
    assert got[4]["BUCKET"] == 4 and got[4]["MIN_PROB"] is None and got[4]["DECILE"] == 5
    top = K.ks_statistic(K.ks_table(df, ["CALIB_PD"])).first()
    best = max(e[3] for e in expected)
    assert top["KS"] == pytest.approx(best)
    assert top["DECILE"] == 1 + [e[3] for e in expected].index(best)
    assert -100 <= top["KS"] <= 100
    assert K.as_display(K.ks_table(df, ["CALIB_PD"])).first()["DISTRIBUTION_BADS"].endswith("%")


def test_equal_width_buckets(spark):
    rnd = random.Random(4)
    rows = [(m, rnd.random() * 0.9 + 0.05, rnd.randrange(2)) for m in "XY" for _ in range(150)]
    df = spark.createDataFrame(rows, "MODEL_TYPE string, P double, EVER_15DPD_IN_90DAYS int")
    got = K.ks_table(df, ["P"], buckets="equal_width").where("MODEL_TYPE = 'X'").orderBy("DECILE").collect()
    scores = [s for _, s, _ in rows]
    edges = np.linspace(min(scores), max(scores), 11)
    ids = [int(np.searchsorted(edges[1:-1], s, side="left")) + 1 for m, s, _ in rows if m == "X"]
    own = [y for m, _, y in rows if m == "X"]
    assert [r["BUCKET"] for r in got] == list(range(10, 0, -1))
    for r in got:
        assert r["BADS"] == sum(y for i, y in zip(ids, own) if i == r["BUCKET"])
    assert got[-1]["CUM_BADS"] == sum(own) and len(got) == 10


def test_equal_width_of_one_value(spark):
    df = spark.createDataFrame([("X", 0.5, 1), ("X", 0.5, 0)], "MODEL_TYPE string, P double, EVER_15DPD_IN_90DAYS int")
    assert K.ks_table(df, ["P"], buckets="equal_width").agg(F.sum("BADS"), F.sum("GOODS")).first()[:] == (1, 1)
    with pytest.raises(ValueError):
        K.ks_table(df, ["P"], buckets="other")


# --- PSI --------------------------------------------------------------------


def numpy_psi(base, new, kind="quantiles", buckets=10):
    b = np.array([v for v in base if v is not None], dtype=float)
    n = np.array([v for v in new if v is not None], dtype=float)
    steps = np.arange(0, buckets + 1) / buckets * 100
    if kind == "quantiles":
        edges = np.array([np.percentile(b, s) for s in steps])
    else:
        edges = steps / (100 / (b.max() - b.min())) + b.min()
    total = 0.0
    pairs = list(zip(np.histogram(b, edges)[0] / len(base), np.histogram(n, edges)[0] / len(new)))
    pairs.append(((len(base) - len(b)) / len(base), (len(new) - len(n)) / len(new)))
    for e, a in pairs:
        e, a = e or 1e-4, a or 1e-4
        total += (e - a) * math.log(e / a)
    return total


def sample(seed, n, ties):
    rnd = random.Random(seed)
    pick = (lambda: float(rnd.randrange(4))) if ties else (lambda: round(rnd.gauss(0, 3), 3))
    return [None if rnd.random() < 0.1 else (2.0 if ties and rnd.random() < 0.3 else pick()) for _ in range(n)]


@pytest.mark.parametrize("kind", ["quantiles", "bins"])
@pytest.mark.parametrize("ties", [False, True])
def test_numeric_psi_equals_numpy(spark, kind, ties):
    base, new = sample(1, 257, ties), sample(2, 130, ties) + [99.0, -99.0]
    months = ["Jan-2022" if i % 3 else "Feb-2022" for i in range(len(new))]
    months[0] = None
    bdf = spark.createDataFrame([(v, None) for v in base], "x double, empty double")
    ndf = spark.createDataFrame([(v, 1.0, m) for v, m in zip(new, months)], "x double, empty double, MONTH_YEAR string")
    got = {(r["PSI_MONTH"], r["PSI_VAR"]): r["PSI"] for r in P.numeric_psi(bdf, ndf, ["x", "empty"], buckettype=kind).collect()}
    assert set(m for m, _ in got) == {"JAN-2022", "FEB-2022", "OVERALL"}
    assert got["OVERALL", "x"] == pytest.approx(numpy_psi(base, new, kind))
    for m in ("Jan-2022", "Feb-2022"):
        own = [v for v, k in zip(new, months) if k == m]
        assert got[m.upper(), "x"] == pytest.approx(numpy_psi(base, own, kind))
    assert got["OVERALL", "empty"] is None


def test_psi_of_a_sample_with_itself_is_zero(spark):
    rows = [(v, "c%d" % (i % 4), "M-1") for i, v in enumerate(sample(7, 200, False))]
    df = spark.createDataFrame(rows, "x double, c string, MONTH_YEAR string")
    spec = P.DriftModule("m", None, Roles(("x",), ("c",)), df)
    assert all(abs(r["PSI"]) < 1e-12 for r in P.psi_report([spec], df).collect())


def test_categorical_psi_by_hand(spark):
    base = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("--",)], "c string")
    new = spark.createDataFrame([("a", "Jan-2022")] * 5 + [("z", "Jan-2022")] * 4 + [(None, "Feb-2022")], "c string, MONTH_YEAR string")
    got = {r["PSI_MONTH"]: r["PSI"] for r in P.categorical_psi(base, new, ["c"]).collect()}

    def term(e, a):
        a = a or 1e-4
        return (e - a) * math.log(e / a)

    assert got["OVERALL"] == pytest.approx(term(0.6, 0.5) + term(0.3, 0) + term(0.1, 0.1))
    assert got["JAN-2022"] == pytest.approx(term(0.6, 5 / 9) + term(0.3, 0) + term(0.1, 0))
    assert got["FEB-2022"] == pytest.approx(term(0.6, 0) + term(0.3, 0) + term(0.1, 1.0))
    shares = {r["CATEGORY"]: r["SHARE"] for r in P.category_shares(base, ["c"]).collect()}
    assert shares == {"a": 0.6, "b": 0.3, "MISSING": 0.1}


def test_report_counts_only_rows_with_score_and_flag(spark):
    base = spark.createDataFrame([(float(i), 0.1 * (i % 10), 1.0) for i in range(50)], "x double, PD double, only_old double")
    rows = [(float(i), 0.05 * (i % 10) if i % 4 else None, i % 3 == 0 or None, "M-1", 2.0) for i in range(60)]
    new = spark.createDataFrame(rows, "x double, PD double, ok boolean, MONTH_YEAR string, only_new double")
    spec = P.DriftModule("mod", "PD", Roles(("x", "only_old", "only_new", "nowhere")), base, flag="ok")
    got = {(r["PSI_MONTH"], r["PSI_VAR"]): r["PSI"] for r in P.psi_report([spec], new).collect()}
    kept = [r for r in rows if r[1] is not None and r[2]]
    assert got["OVERALL", "x"] == pytest.approx(numpy_psi([float(i) for i in range(50)], [r[0] for r in kept]))
    assert got["OVERALL", "PD"] == pytest.approx(numpy_psi([0.1 * (i % 10) for i in range(50)], [r[1] for r in kept]))
    assert got["OVERALL", "only_old"] is None and got["OVERALL", "only_new"] is None
    assert not any(v == "nowhere" for _, v in got)


def spread_values(seed, n):
    """Many magnitudes and signs, one value a third of all, and values that differ in the last digits alone."""
    rnd = random.Random(seed)
    close = 1.0 + 2.0**-50
    draws = [
        lambda: 7.25, lambda: rnd.lognormvariate(0, 30), lambda: -rnd.lognormvariate(0, 5), lambda: rnd.choice([1.0, close]),
        lambda: float(rnd.randrange(-5, 5)), lambda: 1e6 + rnd.random(), lambda: rnd.choice([5e-324, -0.0, 0.0, 1.7e308, -1.7e308]),
    ]
    return [draws[0]() if rnd.random() < 0.3 else rnd.choice(draws)() for _ in range(n)]


@pytest.mark.parametrize("few", [0, 3, 20_000])
def test_exact_quantiles_equal_numpy(spark, few):
    rnd = random.Random(9)
    groups = {"g": [rnd.choice([1.5, rnd.random()]) for _ in range(101)], "h": [3.0], "k": [float(rnd.randrange(3)) for _ in range(64)]}
    groups |= {f"s{seed}": spread_values(seed, 1500) for seed in range(4)}
    groups["equal"] = [0.1 * 3] * 50
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("n", None)], "g string, v double")
    probabilities = [i / 10 for i in range(11)] + [0.999]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probabilities, few).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        ordered = sorted(vs)
        for p, q in zip(probabilities, got[g]["QUANTILES"]):
            low, high = ordered[math.floor((len(vs) - 1) * p)], ordered[math.ceil((len(vs) - 1) * p)]
            if high - low < 1e300:  # beyond, the interpolation itself is not one number
                assert q == float(np.percentile(vs, p * 100)), (g, p)
        assert got[g]["N"] == len(vs)
    none = exact_quantiles(df.where("false"), ["g"], "v", probabilities)
    assert none.count() == 0 and none.columns == ["g", "QUANTILES", "N"]


def test_counts_that_are_shuffled_do_not_grow_with_the_values(spark):
    """A hundred thousand distinct values of a variable leave a few thousand counts."""
    from loanlens.operators import quantiles as Q

    rows = spark.range(100_000).select(F.lit("x").alias("g"), (F.col("id") / 7.0).alias("_v"))
    assert Q._counted(rows, ["g"], Q._log_bucket(F.col("_v"))).count() < 1000
    assert exact_quantiles(rows, ["g"], "_v", [0.5], few=10).first()["QUANTILES"] == [np.percentile(np.arange(100_000) / 7.0, 50)]


def test_sketched_quantiles_keep_their_rank_error(spark):
    groups = {f"s{seed}": spread_values(seed, 30_000) for seed in range(2)} | {"u": [random.Random(4).random() for _ in range(30_000)]}
    groups["small"] = [3.0, 1.0, 2.0]
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("n", None)], "g string, v double").repartition(7)
    probabilities = [i / 20 for i in range(21)]
    got = {r["g"]: r for r in sketched_quantiles(df, ["g"], "v", probabilities).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        ordered, n = np.sort(vs), len(vs)
        assert got[g]["N"] == n and got[g]["QUANTILES"][0] == ordered[0] and got[g]["QUANTILES"][-1] == ordered[-1]
        for p, q in zip(probabilities, got[g]["QUANTILES"]):
            below, until = np.searchsorted(ordered, q, "left") / n, np.searchsorted(ordered, q, "right") / n
            assert below - SKETCH_RANK_ERROR - 1 / n <= p <= until + SKETCH_RANK_ERROR + 1 / n, (g, p)


def test_psi_over_sketched_edges_is_near_the_exact_one(spark):
    """An edge off by one percent of the rows moves a share by two at most; the bound allows that for each bucket."""
    rnd = random.Random(2)
    rows = [(rnd.gauss(0, 1), rnd.expovariate(1.0)) for _ in range(8000)]
    base = spark.createDataFrame(rows, "a double, b double")
    new = base.selectExpr("a * 1.1 + 0.2 as a", "b * 0.8 as b", "'M-1' as MONTH_YEAR")
    exact, near = (
        {r["PSI_VAR"]: r["PSI"] for r in P.numeric_psi(base, new, ["a", "b"], buckettype=kind).collect() if r["PSI_MONTH"] == "OVERALL"}
        for kind in ("quantiles", "approx_quantiles")
    )
    for v in ("a", "b"):
        assert near[v] == pytest.approx(exact[v], abs=0.01) and near[v] > 0


def test_a_stored_baseline_is_not_read_again(spark):
    rows = [(float(i % 9), f"k{i % 4}", "M-1") for i in range(200)]
    base = spark.createDataFrame(rows, "x double, k string, MONTH_YEAR string")
    spec = P.DriftModule("m", None, Roles(("x",), ("k",)), base)
    new = base.where("x > 2")
    chosen, _ = P.compared([spec], new)
    fitted = P.fit_baseline(chosen)
    once = sorted(map(tuple, P.psi_report([spec], new).collect()))
    broken = base.withColumn("x", F.raise_error(F.lit("read")).cast("double"))
    again = P.psi_report([P.DriftModule("m", None, Roles(("x",), ("k",)), broken)], new, baseline=fitted)
    assert sorted(map(tuple, again.collect())) == once and len(once) == 4


def test_more_variables_than_a_block(spark):
    names = [f"x{i}" for i in range(P.BLOCK * 2 + 3)]
    rows = [tuple(float((i * (j + 3)) % 17) for j in range(len(names))) + ("M",) for i in range(120)]
    df = spark.createDataFrame(rows, [*names, "MONTH_YEAR"])
    base, new = df.where("x0 < 9"), df.where("x0 >= 9")
    got = {r["PSI_VAR"]: r["PSI"] for r in P.numeric_psi(base, new, names).collect() if r["PSI_MONTH"] == "OVERALL"}
    assert set(got) == set(names)
    for j in (0, P.BLOCK, len(names) - 1):
        b = [r[j] for r in rows if r[0] < 9]
        n = [r[j] for r in rows if r[0] >= 9]
        assert got[names[j]] == pytest.approx(numpy_psi(b, n))


def test_names_with_quotes(spark):
    df = spark.createDataFrame([(1.0, "it's", "M"), (2.0, "x", "M")], ["a'b", "c d", "MONTH_YEAR"])
    spec = P.DriftModule("m'1", None, Roles(("a'b",), ("c d",)), df)
    got = P.psi_report([spec], df).collect()
    assert {(r["COL_MODULE"], r["PSI_VAR"]) for r in got} == {("M'1", "a'b"), ("M'1", "c d")}


# --- KL ---------------------------------------------------------------------


def test_kl(spark):
    df = spark.createDataFrame([(0.5, 0.25), (0.5, 0.75), (0.0, 0.0)], "P double, Q double")
    assert kl_divergence(df).first()["KL"] == pytest.approx(0.5 * 1 + 0.5 * math.log2(0.5 / 0.75))
    assert kl_divergence(spark.createDataFrame([(0.5, 0.0), (0.5, 1.0)], "P double, Q double")).first()["KL"] is None
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "b string")
    b = spark.createDataFrame([("x",), ("z",)], "b string")
    shares = {r["BUCKET"]: (r["P"], r["Q"]) for r in aligned_shares(a, b, "b").collect()}
    assert shares == {"x": (pytest.approx(2 / 3), 0.5), "y": (pytest.approx(1 / 3), 0.0), "z": (0.0, 0.5)}


def test_divergence_report_equals_the_one_variable_form(spark):
    old = [(float(i % 7), "ab"[i % 2], "M1") for i in range(70)] + [(None, "--", None)]
    later = [(float(i % 5), "aabc"[i % 4], "M2" if i % 3 else None) for i in range(60)] + [(9.0, "a", "M2"), (None, None, "M2")]
    schema = "X double, C string, MONTH_YEAR string"
    baseline, new = spark.createDataFrame(old, schema), spark.createDataFrame(later, schema)
    spec = P.DriftModule("m", None, Roles(numerical=("X",), categorical=("C",)), baseline)
    got = {(r.KL_MONTH, r.KL_VAR): r.KL for r in P.divergence_report([spec], new).collect()}
    assert set(got) == {(m, v) for m in ("M2", "OVERALL") for v in ("X", "C")}
    clean = F.coalesce(F.nullif(F.col("C"), F.lit("--")), F.lit("MISSING")).alias("C")
    for month, rows in (("OVERALL", new), ("M2", new.where("MONTH_YEAR = 'M2'"))):
        one = kl_divergence(aligned_shares(baseline.select(clean), rows.select(clean), "C")).first()["KL"]
        assert got[month, "C"] == pytest.approx(one)
    assert got["OVERALL", "X"] is None  # the last bucket is empty on the new side
    nothing = P.divergence_report([spec], new.select("MONTH_YEAR"))
    assert nothing.columns == ["COL_MODULE", "KL_MONTH", "KL_VAR", "KL"] and nothing.count() == 0
