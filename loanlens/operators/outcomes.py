"""Attaching repayment outcomes to decisions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions import day_diff, in_day_window, trimmed
from loanlens.operators.skew import Hot, left_join
from loanlens.sources import schemas as S

_PAIR = ["_customer", "_run"]
# The keys of the two joins below as SQL, for counts that are kept with a table.
RUN_KEYS = ("trim(cast(CUSTOMER_ID as string))", "trim(cast(BRE_RUN_ID as string))")
LOAN_KEYS = ("trim(cast(USER_ID as string))", "trim(cast(BRE_RUN_ID as string))")
USER_KEYS = LOAN_KEYS[:1]


def one_per_loan(repayments: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """One row per user, loan and payout day; a bad outcome wins over a good one.

    All other columns settle what is left of a tie, so the input's order says
    nothing.  Spark keeps one row per key in each map task before the shuffle.
    Rows that are dealt by ``dealt_by`` already, columns that follow from the
    keys, as all whose names begin with _ do, stay where they are.
    """
    first = [S.OUTCOME_LABEL, "VENDOR", "STATUS"]
    rest = sorted(c for c in repayments.columns if c not in (*first, *S.REPAYMENT_KEYS) and not c.startswith("_"))
    order = Window.partitionBy(*dealt_by, *S.REPAYMENT_KEYS).orderBy(
        F.col(S.OUTCOME_LABEL).desc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in (*first[1:], *rest)],
    )
    return repayments.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def _runs_by_day(decisions: DataFrame) -> DataFrame:
    """For each user and day with runs, ``_seen``: the day and the greatest run id."""
    return (
        decisions.select(
            trimmed("CUSTOMER_ID").alias("_user"),
            F.to_date("BRE_RUN_DATE").alias("_day"),
            "BRE_RUN_ID",
        )
        .where("_user is not null and _day is not null")
        .groupBy("_user", "_day")
        .agg(F.max("BRE_RUN_ID").alias("_id"))
        .select("_user", "_day", F.struct(F.col("_day").alias("day"), "_id").alias("_seen"))
    )


def latest_run_per_day(repayments: DataFrame, decisions: DataFrame) -> DataFrame:
    """For each (user, day) asked for, the latest run on or before that day.

    Both sides first shrink to one row per user and day, so a user with any
    number of runs or loans has no more rows in the window than there are days.
    Of several runs on one day the greatest run id counts.
    """
    runs = _runs_by_day(decisions)
    asked = (
        repayments.select(
            trimmed("USER_ID").alias("_user"), F.to_date("DISBURSED_DATE").alias("_day")
        )
        .where("_user is not null and _day is not null")
        .distinct()
    )
    events = runs.withColumn("_asked", F.lit(0)).unionByName(
        asked.withColumn("_asked", F.lit(1)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy("_user")
        .orderBy("_day", "_asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        events.withColumn("_latest", F.last("_seen", ignorenulls=True).over(so_far))
        .where("_asked = 1")
        .select(
            "_user",
            "_day",
            F.col("_latest.day").alias("BRE_RUN_DATE"),
            F.col("_latest._id").alias("BRE_RUN_ID"),
        )
    )


def _as_of_by_user(repayments: DataFrame, decisions: DataFrame) -> DataFrame:
    """``as_of_latest_run`` where no user holds many of the loans: all is done where a user's rows lie.

    Loans and days with runs move once, by user.  Rows without a user or a day
    stand before every run, so they meet none.
    """
    loans = repayments.select(
        "*", trimmed("USER_ID").alias("_user"), F.to_date("DISBURSED_DATE").alias("_day"), F.lit(1).alias("_asked")
    )
    events = loans.unionByName(_runs_by_day(decisions).withColumn("_asked", F.lit(0)), allowMissingColumns=True)
    so_far = (
        Window.partitionBy("_user")
        .orderBy("_day", "_asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answered = events.withColumn("_latest", F.last("_seen", ignorenulls=True).over(so_far)).where("_asked = 1")
    return one_per_loan(answered.drop("_asked", "_seen"), ["_user"]).select(
        *repayments.columns,
        F.col("_latest.day").alias("BRE_RUN_DATE"),
        F.col("_latest._id").alias("BRE_RUN_ID"),
        day_diff("_latest.day", "_day").alias("DAYS_DIFF"),
    )


def as_of_latest_run(repayments: DataFrame, decisions: DataFrame, hot: Hot | None = None) -> DataFrame:
    """As-of join: each loan with the latest run on or before its payout day.

    Loans without an earlier run stay, with NULLs.  Days are compared, as the
    decision table stores them.  No pairs of loans and runs are formed.  ``hot``
    are the hot buckets of the loans' trimmed users (see ``USER_KEYS``): without
    any, loans move once, by user.  Otherwise, or where they are not known, users
    and days are answered first, and adaptive execution can split the join with
    the loans.
    """
    if hot is not None and not hot:
        return _as_of_by_user(repayments, decisions)
    loans = one_per_loan(repayments).select(
        "*", trimmed("USER_ID").alias("_user"), F.to_date("DISBURSED_DATE").alias("_day")
    )
    answers = latest_run_per_day(repayments, decisions)
    return (
        loans.join(answers, ["_user", "_day"], "left")
        .withColumn("DAYS_DIFF", day_diff("BRE_RUN_DATE", "_day"))
        .drop("_user", "_day")
    )


def labelled_master(
    master: DataFrame,
    loans: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    labelled_since: dt.date | str,
    hot: Hot | None = None,
    with_keys: bool = False,
) -> DataFrame:
    """Every master row with the loans paid out on its run, or NULLs.

    Loans count when paid out in the day window.  Rows decided before
    ``labelled_since`` stay and remain without a label: their run key is NULL
    for the join.  ``hot`` are the hot buckets of the loans' trimmed customer and
    run (see ``LOAN_KEYS``).  Without it, give stored loans: their keys are
    counted first, to see whether one run holds many of them.

    ``with_keys`` leaves the trimmed customer and run of every row beside it, by
    which the rows lie then: ``features_for_master`` does not move them again.
    Adaptive execution cannot split joins in a row, so this is for masters and
    loans without hot keys.
    """
    paid = loans.where(in_day_window("DISBURSED_DATE", start, end) & F.col("BRE_RUN_ID").isNotNull())
    many = paid.select(
        trimmed("USER_ID").alias("_customer"),
        trimmed("BRE_RUN_ID").alias("_run"),
        *S.OUTCOME_COLUMNS,
    )
    recent = F.col("BRE_RUN_DATE") >= F.lit(dt.date.fromisoformat(str(labelled_since)))
    if with_keys:
        kept = master.select(
            "*", trimmed("CUSTOMER_ID").alias("_customer"), trimmed("BRE_RUN_ID").alias("_run"), recent.alias("_recent")
        )
        many = many.withColumnsRenamed({"_customer": "_of_customer", "_run": "_of_run"})
        same = (F.col("_customer") == F.col("_of_customer")) & (F.col("_run") == F.col("_of_run"))
        return kept.join(many, same & F.col("_recent"), "left").drop("_recent", "_of_customer", "_of_run")
    kept = master.select(
        "*",
        trimmed("CUSTOMER_ID").alias("_customer"),
        F.when(recent, trimmed("BRE_RUN_ID")).alias("_run"),
    )
    return left_join(kept, many, _PAIR, hot=hot).drop(*_PAIR)


def features_for_master(
    master: DataFrame,
    fact: DataFrame,
    columns: Sequence[str] | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """All fact columns for every master row, beside the listed master columns.

    The tables meet on trimmed customer and run.  ``columns`` defaults to the
    master columns the fact does not have.  ``hot`` are the hot buckets of the
    fact's keys: a fact stored with ``key_counts`` of ``RUN_KEYS`` has them, and
    without them the keys of the whole fact are counted when this is called.
    A master from ``labelled_master`` with its keys stays where it lies.
    """
    fact_names = {c.upper() for c in fact.columns}
    if columns is None:
        columns = [c for c in master.columns if c.upper() not in fact_names and c not in _PAIR]
    given = set(_PAIR).issubset(master.columns)
    keys = _PAIR if given else [trimmed("CUSTOMER_ID").alias("_customer"), trimmed("BRE_RUN_ID").alias("_run")]
    big = master.select(*keys, *columns)
    lookup = fact.select(
        "*", trimmed("CUSTOMER_ID").alias("_customer"), trimmed("BRE_RUN_ID").alias("_run")
    )
    joined = left_join(big, lookup, _PAIR, hot=hot)
    return joined.select(*fact.columns, *columns)
