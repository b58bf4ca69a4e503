"""State tables kept by key: upserts, deletes and reports.

No row-level table format is needed: each operator returns the new table for
the caller to write to a new path, never over the one being read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.operators.groups import last_by

REVIEW_KEYS = ("repo_url", "pr_number")


def upsert(
    state: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = (), null_safe: bool = True
) -> DataFrame:
    """Put ``new`` rows in the place of ``state`` rows with the same keys.

    Rows of ``new`` beat rows of ``state``, which has one row per key; among new
    rows the last by ``order`` wins.  Only new rows are grouped: the state is
    filtered by their keys and, when these are few, does not move at all.  A
    state in buckets of its keys (:mod:`leafwright.sources.state_tables`) never
    moves, if keys are compared plainly, not ``null_safe``.
    """
    last = last_by(new.select(*state.columns), list(keys), list(order) or list(keys)).select(*state.columns)
    fresh = last.select(*[F.col(c).alias(f"_new_{c}") for c in keys])
    alike = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    same = reduce(and_, [alike(F.col(c), F.col(f"_new_{c}")) for c in keys])
    return state.join(fresh, same, "left_anti").unionByName(last)


def save_reviews(state: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert reviews: all fields of a change set's review are replaced."""
    return upsert(state, new, REVIEW_KEYS, ["reviewed_at"])


def clear_reviews(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Delete reviews, so that their change sets are reviewed again."""
    return state.join(keys.select(*REVIEW_KEYS), list(REVIEW_KEYS), "left_anti")


def reviews_since(state: DataFrame, since: Column) -> DataFrame:
    """Reviews made at or after a time."""
    return state.filter(F.col("reviewed_at") >= since)


def week_start(now: Column) -> Column:
    """Start of the weekly report: midnight six days ago."""
    return F.date_trunc("day", now) - F.expr("INTERVAL 6 DAYS")


def is_report_day(now: Column) -> Column:
    """True on the day of the weekly report (Friday)."""
    return F.dayofweek(now) == 6


def review_stats(state: DataFrame) -> DataFrame:
    """Reviews by decision in one row, zeros filled in; the total takes unknown decisions too."""
    count = lambda d: F.count_if(F.col("decision") == d)
    return state.agg(
        count("APPROVE").alias("approve"),
        count("REQUEST_CHANGES").alias("request_changes"),
        count("REJECT").alias("reject"),
        F.count("*").alias("total"),
    )


def mark_processed(ledger: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Put submitted URLs in the ledger with the current time."""
    done = outcomes.filter("ok").select("url", now.alias("processed_at"))
    return upsert(ledger, done, ["url"], ["processed_at"])
