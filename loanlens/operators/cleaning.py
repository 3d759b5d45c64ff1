"""Preparation of feature columns by their role in the feature dictionary.

Every function builds one ``select``, so any number of columns is one
projection in the plan.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import number
from loanlens.sources.assets import Roles


def _rewrite(df: DataFrame, change: Callable[[str], Column | None]) -> DataFrame:
    columns = []
    for name in df.columns:
        changed = change(name)
        columns.append(F.col(name) if changed is None else changed.alias(name))
    return df.select(*columns)


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double; what is no number becomes NULL (see ``failed_casts``)."""
    chosen = set(columns)
    return _rewrite(df, lambda c: number(c) if c in chosen else None)


def failed_casts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: per column, how many values were given but are no number."""
    return df.agg(
        *[F.count_if(F.col(c).isNotNull() & number(c).isNull()).alias(c) for c in columns]
    )


def require_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``to_numbers``, or ValueError naming the columns that hold other text."""
    counts = failed_casts(df, columns).first().asDict()
    bad = {name: n for name, n in counts.items() if n}
    if bad:
        raise ValueError(f"not numeric: {bad}")
    return to_numbers(df, columns)


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL to 0 in the listed columns."""
    return df.fillna(0, subset=list(columns))


def category(
    name: str, missing: str | None, placeholder: str | None = "--", fill: bool = True
) -> Column:
    """Category as text; the placeholder text and (with ``fill``) NULL become ``missing``."""
    value = F.col(name).cast("string")
    if missing is None:
        return value
    if placeholder is not None:
        value = F.when(value == placeholder, F.lit(missing)).otherwise(value)
    return F.coalesce(value, F.lit(missing)) if fill else value


def clean(
    df: DataFrame,
    roles: Roles,
    missing_num: float | None = None,
    missing_cat: str | None = None,
    placeholder: str | None = "--",
    fill_categories: bool = True,
) -> DataFrame:
    """Numbers from text, and the marker values for what is missing.

    ``missing_num`` None keeps NULL in numeric columns; with ``missing_cat``
    None categories are only taken as text.
    """

    def change(name: str) -> Column | None:
        role = roles.of(name)
        if role == "Numerical":
            value = number(name)
            return value if missing_num is None else F.coalesce(value, F.lit(float(missing_num)))
        if role == "Categorical":
            return category(name, missing_cat, placeholder, fill_categories)
        return None

    return _rewrite(df, change)


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any NULL."""
    return df.dropna("any")


def not_null(df: DataFrame, columns: Sequence[str], flag: str | None = None) -> DataFrame:
    """Rows where all columns are given, and the flag (if any) is true."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull()
    if flag is not None:
        keep = keep & F.col(flag)
    return df.where(keep)


def matching_columns(df: DataFrame, pattern: str, ids: Sequence[str] = ()) -> DataFrame:
    """The id columns and those whose name matches the pattern."""
    return df.select(*ids, *[c for c in df.columns if re.search(pattern, c) and c not in ids])
