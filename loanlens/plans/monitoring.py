"""Outcomes and monitoring: labelled master, Gini, KS and drift."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions import in_day_window
from loanlens.operators.gini import with_gini_columns
from loanlens.operators.ks import ks_table
from loanlens.operators.outcomes import (
    LOAN_KEYS,
    RUN_KEYS,
    USER_KEYS,
    as_of_latest_run,
    features_for_master,
    labelled_master,
)
from loanlens.operators.psi import DriftModule, psi_report
from loanlens.operators.skew import Hot, hot_buckets, stored_with_hot
from loanlens.session import stored
from loanlens.sources import offers as O
from loanlens.sources import scans
from loanlens.sources.assets import Roles

# Scores the blend's drift report follows.
BLEND_MODULE = "combination_module_xg"
BLEND_ROLES = Roles(numerical=("TRX_PD", "SMS_PD", "BR_PD"))


def attach_outcomes(
    master: DataFrame,
    repayments: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    labelled_since: dt.date | str = "2022-08-01",
    with_keys: bool = False,
) -> DataFrame:
    """As-of join of loans with runs, then the labels on every master row.

    Loans paid out on other days label nothing and leave first: which of a
    loan's rows counts and which run answers it are settled within its day.
    The plan depends on the data: the users of the loans are counted when this
    is called.  Where none holds many of them, no run does either, and nothing
    is stored: rows and columns that the caller leaves out are not carried.
    ``master`` is read twice, so give a stored one.  ``with_keys`` is that of
    ``labelled_master``; where a user is hot there are no keys.
    """
    paid = repayments.where(in_day_window("DISBURSED_DATE", start, end))
    users = paid.select(F.expr(USER_KEYS[0]).alias("_user"))
    if not hot_buckets(users, ["_user"]):
        loans = as_of_latest_run(paid, master, {})
        return labelled_master(master, loans, start, end, labelled_since, {}, with_keys)
    loans, hot = stored_with_hot(as_of_latest_run(paid, master), "loans_with_runs", LOAN_KEYS)
    return labelled_master(master, loans, start, end, labelled_since, hot)


def features_with_outcomes(
    master: DataFrame,
    repayments: DataFrame,
    fact: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    labelled_since: dt.date | str = "2022-08-01",
) -> DataFrame:
    """The fact's columns beside the labelled master's others (``attach_outcomes``, then ``features_for_master``).

    Where no customer and run is hot in the master or the fact, the master moves
    once for both joins.  Their keys are counted when this is called.
    """
    keyed = [df.select(*[F.expr(k).alias(n) for k, n in zip(RUN_KEYS, ("c", "r"))]) for df in (master, fact)]
    hot = hot_buckets(keyed[1], ["c", "r"])
    once = not hot and not hot_buckets(keyed[0], ["c", "r"])
    rows = attach_outcomes(master, repayments, start, end, labelled_since, with_keys=once)
    return features_for_master(rows, fact, hot=hot)


def matured_outcomes(
    master: DataFrame,
    repayments: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str,
    labelled_since: dt.date | str = "2022-08-01",
) -> DataFrame:
    """The matured rows of ``attach_outcomes``; loans that are not matured leave before the joins."""
    rows = attach_outcomes(master, scans.matured(repayments, as_of), start, end, labelled_since)
    return scans.matured(rows, as_of)


def gini_table(labelled: DataFrame, as_of: dt.date | str, **options) -> DataFrame:
    """Matured rows with their Gini columns."""
    rows = stored(scans.matured(labelled, as_of), "matured_master")
    return with_gini_columns(scans.require_rows(rows, "matured master"), **options)


def ks_report(labelled: DataFrame, as_of: dt.date | str, **options) -> DataFrame:
    """KS tables of the module scores and the blend on matured rows."""
    rows = stored(scans.matured(labelled, as_of), "matured_master")
    return ks_table(scans.require_rows(rows, "matured master"), **options)


def drift_report(
    gini_rows: DataFrame,
    fact: DataFrame,
    specs: Sequence[DriftModule],
    model_type: str = "XGBOOST",
    hot: Hot | None = None,
) -> DataFrame:
    """PSI of every module's features and scores, overall and by month.

    ``hot`` are the hot buckets of the fact's keys (see ``features_for_master``).
    """
    full = scans.of_model(features_for_master(gini_rows, fact, hot=hot), model_type)
    asked = {c for s in specs for c in (*s.asked().numerical, *s.asked().categorical, s.score, s.flag)}
    needed = [c for c in full.columns if c in asked or c == "MONTH_YEAR"]
    return psi_report(specs, stored(full.select(*needed), "drift_rows"))


def offer_drift(
    offers: DataFrame,
    baselines: Mapping[str, DataFrame],
    roles: Mapping[str, Roles],
    missing_cat: str = "MISSING",
) -> DataFrame:
    """PSI of the features inside scored offers; the month is the offer's own.

    ``baselines`` and ``roles`` are keyed by module table name;
    ``combination_module_xg`` follows the scores themselves.  The offers are
    parsed once for all modules and stored as columns, which several counts read.
    """
    features = {m: [*r.numerical, *r.categorical] for m, r in roles.items()}
    rows = stored(O.module_columns(offers, features), "offer_columns")
    specs = [
        DriftModule(m, pd, roles[m], baselines[m], missing_cat=missing_cat, prefix=f"{m}_")
        for _, m, pd in O.OFFER_MODULES
        if m in baselines
    ]
    if BLEND_MODULE in baselines:
        specs.append(DriftModule(BLEND_MODULE, "CALIB_PD", BLEND_ROLES, baselines[BLEND_MODULE]))
    return psi_report(specs, rows)
