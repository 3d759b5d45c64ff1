"""Weight-of-evidence encoding from a table of bins.

Numeric bins are labelled ``[low,high)`` with ``-inf`` and ``inf`` at the ends;
``missing`` takes NULL; categories sharing a bin are joined by ``%,%``; a
label that is neither is a special value, checked before the ranges.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.operators.scoring import linear_score

SEPARATOR = "%,%"
MISSING = "missing"
_RANGE = re.compile(r"^\[(?P<low>[^,]+),(?P<high>[^)]+)\)$")


def woe_column(name: str, bins: Sequence[tuple[str, float]], numeric: bool) -> Column:
    """``CASE`` chain over the few bins of one variable; NULL where no bin fits."""
    value = F.col(name)
    special = F.lit(None).cast("double")
    ranges = F.lit(None).cast("double")
    for label, woe in bins:
        for part in label.split(SEPARATOR):
            woe_value = F.lit(float(woe))
            found = _RANGE.match(part)
            if part == MISSING:
                special = F.when(value.isNull(), woe_value).otherwise(special)
            elif numeric and found:
                low, high = float(found["low"]), float(found["high"])
                inside = F.lit(True)
                if low != float("-inf"):
                    inside = inside & (value >= low)
                if high != float("inf"):
                    inside = inside & (value < high)
                ranges = F.when(value.isNotNull() & inside, woe_value).otherwise(ranges)
            elif numeric:
                special = F.when(value == float(part), woe_value).otherwise(special)
            else:
                special = F.when(value == part, woe_value).otherwise(special)
    return F.coalesce(special, ranges)


def apply_woe(
    df: DataFrame,
    bins: Mapping[str, Sequence[tuple[str, float]]],
    ids: Sequence[str],
    suffix: str = "_woe",
) -> DataFrame:
    """Id columns and one ``{variable}_woe`` column per binned variable."""
    types = dict(df.dtypes)
    return df.select(
        *ids,
        *[
            woe_column(name, rows, types[name] != "string").alias(f"{name}{suffix}")
            for name, rows in bins.items()
        ],
    )


def _upper(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def woe_score_rows(encoded: DataFrame, model: Sequence[tuple[str, float]]) -> DataFrame:
    """Logistic-regression score of the encoded rows themselves, beside their ids.

    ``model`` holds (variable, coefficient); its first row is the intercept.
    """
    (_, intercept), *terms = model
    terms = [(name.upper(), weight) for name, weight in terms]
    return _upper(encoded).withColumn("PRED_TRAIN", linear_score(intercept, terms))


def woe_score(
    ids: DataFrame,
    encoded: DataFrame,
    model: Sequence[tuple[str, float]],
    key: str = "BRE_RUN_ID",
) -> DataFrame:
    """The same for encoded features of another table, joined to all ids.

    ``model`` holds (variable, coefficient); its first row is the intercept.
    """
    (_, intercept), *terms = model
    terms = [(name.upper(), weight) for name, weight in terms]
    chosen = _upper(encoded).select(key, *[name for name, _ in terms])
    joined = ids.join(chosen, [key], "left")
    return joined.withColumn("PRED_TRAIN", linear_score(intercept, terms))
