"""Applying trained models: raw probability, log-odds, calibrated score."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import calibrate, logit, null_if_nan, share_of, sigmoid
from loanlens.operators.cleaning import clean, zero_fill
from loanlens.sources.assets import Roles
from loanlens.sources.schemas import CREDIT_BANDS


@dataclass(frozen=True)
class Calibration:
    """Logistic calibration of log-odds."""

    intercept: float = 0.0
    slope: float = 1.0

    def apply(self, logodds: Column | str) -> Column:
        return calibrate(logodds, self.intercept, self.slope)


@dataclass(frozen=True)
class ModuleModel:
    """What scoring one module needs, beside the model object."""

    features: Sequence[str]
    roles: Roles
    calibration: Calibration = field(default_factory=Calibration)
    zero_filled: Sequence[str] = ()
    missing_num: float | None = None
    missing_cat: str | None = None
    credit_shares: bool = False


def credit_band_shares(df: DataFrame) -> DataFrame:
    """Share of the smallest and the largest band in all credit transactions."""
    return df.withColumns(
        {
            "PROP_CREDIT_TXNS_LESSTHAN_100_LAST30D": share_of(CREDIT_BANDS[0], CREDIT_BANDS),
            "PROP_CREDIT_TXNS_GREATERTHAN_10000_LAST30D": share_of(CREDIT_BANDS[-1], CREDIT_BANDS),
        }
    )


def prepare(df: DataFrame, model: ModuleModel) -> DataFrame:
    """Feature rows as the module's model expects them.

    Missing numbers stay NULL unless the model was trained with a marker value.
    """
    if model.credit_shares:
        df = credit_band_shares(df)
    if model.zero_filled:
        df = zero_fill(df, model.zero_filled)
    return clean(
        df, model.roles, model.missing_num, model.missing_cat, fill_categories=False
    )


def with_scores(df: DataFrame, probability: Column, calibration: Calibration) -> DataFrame:
    """PRED_TRAIN, LOGODDS_SCORE and PRED_TRAIN_XGB from a raw probability."""
    return (
        df.withColumn("PRED_TRAIN", probability)
        .withColumn("LOGODDS_SCORE", logit("PRED_TRAIN"))
        .withColumn("PRED_TRAIN_XGB", calibration.apply("LOGODDS_SCORE"))
    )


def score_with_pipeline(
    df: DataFrame, fitted: PipelineModel, calibration: Calibration
) -> DataFrame:
    """Score with a fitted Spark ML classifier that reads the frame's columns."""
    scored = fitted.transform(df)
    helpers = [c for c in scored.columns if c not in df.columns and c != "probability"]
    return with_scores(
        scored.drop(*helpers), vector_to_array("probability")[1], calibration
    ).drop("probability")


def score_with_function(
    df: DataFrame,
    features: Sequence[str],
    predict: Callable[[pd.DataFrame], pd.Series],
    calibration: Calibration,
) -> DataFrame:
    """Score with a model object from outside Spark, in Arrow batches.

    ``predict`` gets a frame with the feature columns and returns P(class 1).
    Only the features travel to Python.
    """

    @F.pandas_udf("double")
    def probability(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(predict(batch[list(features)])).astype("float64")

    raw = probability(F.struct(*[F.col(c) for c in features]))
    return with_scores(df, null_if_nan(raw), calibration)


def linear_score(intercept: float, coefficients: Sequence[tuple[str, float]]) -> Column:
    """Probability of a logistic regression; NULL when any input is missing."""
    total = F.lit(float(intercept))
    for column, weight in coefficients:
        total = total + F.lit(float(weight)) * F.col(column)
    return sigmoid(total)
