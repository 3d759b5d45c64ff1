"""Checks on rows that the job that writes them counts on the way.

A check adds observed metrics to a frame: the counts come out of the same scan
that produces the result, and no job of their own reads the rows.  Its
``verify`` raises once the job has run.  ``versions.replace`` verifies after the
write and before the new version counts, so rows that fail never show.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loanlens.functions import number
from loanlens.operators.cleaning import to_numbers


@dataclass(frozen=True)
class Check:
    """What a job counts, and what is wrong with the counts (empty if nothing is)."""

    observation: Observation
    problem: Callable[[dict[str, int]], str]

    def counts(self) -> dict[str, int]:
        """The counts; waits for the job that makes them."""
        return dict(self.observation.get)

    def verify(self) -> None:
        """ValueError if the counts are wrong.

        Only whether a count is zero matters, so a task that ran twice, after a
        lost executor, does no harm.
        """
        if found := self.problem(self.counts()):
            raise ValueError(found)


def checked_numbers(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Check]:
    """``to_numbers``, and a check that no column held other text."""
    names = list(columns)
    failed = [F.count_if(F.col(f"`{c}`").isNotNull() & number(c).isNull()).alias(f"c{i}") for i, c in enumerate(names)]
    if not failed:
        return checked_rows(df, "", least=0)

    def problem(counts: dict[str, int]) -> str:
        bad = {c: counts[f"c{i}"] for i, c in enumerate(names) if counts[f"c{i}"]}
        return f"not numeric: {bad}" if bad else ""

    seen = Observation()
    return to_numbers(df.observe(seen, *failed), names), Check(seen, problem)


def checked_rows(df: DataFrame, what: str, least: int = 1) -> tuple[DataFrame, Check]:
    """The rows, and a check that there are at least so many."""
    seen = Observation()

    def problem(counts: dict[str, int]) -> str:
        return f"{what}: {counts['n']} rows, at least {least} expected" if counts["n"] < least else ""

    return df.observe(seen, F.count("*").alias("n")), Check(seen, problem)
