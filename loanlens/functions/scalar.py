"""Scalar expressions.  All are built-in Spark expressions; none is a UDF.

NULL is the only marker for a missing value.  NaN is turned into NULL where a
value enters, because Spark orders NaN above every number, so ``NaN >= 5``
would be true where the rules expect "not decided".
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_if_nan(value: ColumnOrName) -> Column:
    value = _col(value)
    return F.when(~F.isnan(value), value)


def trimmed(value: ColumnOrName) -> Column:
    """Key as it is compared: as text, without leading and trailing spaces."""
    return F.trim(_col(value).cast("string"))


def same_text(value: ColumnOrName, text: str) -> Column:
    """Comparison that ignores case and outer spaces."""
    return F.lower(F.trim(_col(value).cast("string"))) == F.lit(text.strip().lower())


def number(value: ColumnOrName) -> Column:
    """Text or number to double; text that is no number becomes NULL.

    ``cleaning.failed_casts`` counts the values lost this way.
    """
    return null_if_nan(_col(value).try_cast("double"))


def logit(p: ColumnOrName) -> Column:
    """ln(p / (1 - p)); minus and plus infinity at 0 and 1, NULL outside [0, 1]."""
    p = _col(p)
    return (
        F.when(p == 0.0, F.lit(float("-inf")))
        .when(p == 1.0, F.lit(float("inf")))
        .when((p > 0.0) & (p < 1.0), F.ln(F.try_divide(p, 1.0 - p)))
    )


def sigmoid(x: ColumnOrName) -> Column:
    """1 / (1 + exp(-x)); NaN (infinity minus infinity) becomes NULL."""
    return null_if_nan(1.0 / (1.0 + F.exp(-_col(x))))


def calibrate(logodds: ColumnOrName, intercept: float, slope: float) -> Column:
    """Logistic calibration of a log-odds score; the intercept always applies."""
    return sigmoid(F.lit(float(intercept)) + F.lit(float(slope)) * _col(logodds))


def share_of(part: ColumnOrName, parts: Sequence[ColumnOrName]) -> Column:
    """part / sum(parts); NULL when the sum is zero or a part is missing."""
    total = _col(parts[0])
    for other in parts[1:]:
        total = total + _col(other)
    return F.try_divide(_col(part).cast("double"), total.cast("double"))


def round_half_even(x: ColumnOrName, digits: int) -> Column:
    """Scale, round half to even, scale back."""
    factor = float(10**digits)
    return F.rint(_col(x) * factor) / factor


def percent_text(x: ColumnOrName) -> Column:
    """Share as text with two decimals, for display only."""
    return F.format_string("%.2f%%", _col(x) * 100.0)


def month_label(day: ColumnOrName) -> Column:
    """Month as ``Aug-2022``."""
    return F.date_format(_col(day), "MMM-yyyy")


def iso_day(day: ColumnOrName) -> Column:
    return F.date_format(_col(day), "yyyy-MM-dd")


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Days from start to end."""
    return F.datediff(_col(end), _col(start))


def in_day_window(ts: ColumnOrName, start: dt.date | str, end: dt.date | str) -> Column:
    """Both days included, as a half-open range on the bare column.

    The column is not wrapped in a function, so the filter reaches the parquet
    scan and prunes date partitions.
    """
    first = dt.date.fromisoformat(str(start))
    after = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
    ts = _col(ts)
    return (ts >= F.lit(first)) & (ts < F.lit(after))
