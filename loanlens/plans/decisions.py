"""Scoring the modules, blending the scores and deciding: scan to verdict as one plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.operators import blend as B
from loanlens.operators import rules as R
from loanlens.operators.cleaning import clean, require_numbers
from loanlens.operators.scoring import Calibration, ModuleModel, prepare
from loanlens.operators.woe import apply_woe, woe_score_rows
from loanlens.sources import scans, schemas as S
from loanlens.sources.assets import Roles


def score_module(
    fact: DataFrame,
    module: str,
    start: dt.date | str,
    end: dt.date | str,
    model: ModuleModel,
    scorer: Callable[[DataFrame, Calibration], DataFrame],
    columns: Sequence[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Scan, prepare and score one module.  No shuffle: one stage from scan to write.

    ``columns`` are the feature columns to read, by default those of the model.
    Text that is no number becomes NULL; with ``strict`` it raises instead, at
    the cost of reading the numeric columns once more beforehand.
    """
    chosen = list(model.features if columns is None else columns)
    rows = scans.module_scan(fact, module, start, end, features=chosen)
    if strict:
        rows = require_numbers(rows, [c for c in model.roles.numerical if c in rows.columns])
    return scorer(prepare(rows, model), model.calibration)


def activity_woe_score(
    fact: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    roles: Roles,
    bins: Mapping[str, Sequence[tuple[str, float]]],
    model: Sequence[tuple[str, float]],
    missing_num: float,
    missing_cat: str,
    strict: bool = False,
) -> DataFrame:
    """Activity rows cleaned, WOE-encoded and scored with a logistic regression.

    ``strict`` raises on text that is no number (see ``score_module``).
    """
    rows = scans.module_scan(fact, "activity_module", start, end)
    if strict:
        rows = require_numbers(rows, [c for c in roles.numerical if c in rows.columns])
    prepared = clean(rows, roles, missing_num, missing_cat)
    scored = woe_score_rows(apply_woe(prepared, bins, S.ID_COLUMNS), model)
    return scored.select(*S.ID_COLUMNS, *[name.upper() for name, _ in model[1:]], "PRED_TRAIN")


def blended_decisions(
    fact: DataFrame,
    bureau: DataFrame,
    transaction: DataFrame,
    sms: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    calibration: Calibration,
) -> DataFrame:
    """Decisions of a day window with flags, module scores, blend and band.

    The flags follow from the other columns, so they are made after the joins
    and do not move.
    """
    numbered = B.sufficiency_numbers(scans.decision_scan(fact, start, end))
    dated = numbered.withColumn("BRE_RUN_DATE", F.to_date("BRE_RUN_DATE"))
    joined = B.sufficiency_flags(B.join_module_scores(dated, bureau, transaction, sms))
    return B.blend(joined.withColumn("COMBINATION_TYPE", B.combination_type()), calibration)


def decided(blended: DataFrame, model_type: str = "XGBOOST") -> DataFrame:
    """Rules and verdicts, in the column order of the master.

    Raises when a column of the master is absent; only rule 15 and its inputs
    may be.
    """
    verdicts = R.with_verdicts(R.apply_rules(blended.withColumn("MODEL_TYPE", F.lit(model_type))))
    optional = {c for n in R.OPTIONAL_RULES for c in (R.build_rules()[n].output, *R.build_rules()[n].inputs)}
    if absent := [c for c in S.MASTER_COLUMNS if c not in verdicts.columns and c not in optional]:
        raise ValueError(f"columns of the master are absent: {absent}")
    return verdicts.select(*[c for c in S.MASTER_COLUMNS if c in verdicts.columns])


def lr_decided(
    blended: DataFrame,
    thresholds: Mapping[str, Sequence[float]],
    model_type: str = "LOGISTIC_REGRESSION",
) -> DataFrame:
    """Rules, verdicts and threshold verdicts for the logistic-regression blend."""
    verdicts = R.with_verdicts(R.apply_rules(blended.withColumn("MODEL_TYPE", F.lit(model_type))))
    return R.with_threshold_verdicts(verdicts, thresholds)
