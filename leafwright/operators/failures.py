"""What failed in a run, as a table beside its results.

A run goes on when a change set or a repository fails; the failure is counted and the set is taken again by the next run.
Calls to the outside are made elsewhere and landed as rows ``repo_url, pr_number, call, attempt, ok, error``; a call of a
whole repository has no ``pr_number``.  The last attempt counts.

* ``repository``: none of its change sets is known; one failure.
* ``files``: the files of the set are not known, so it is skipped; no failure.
* ``evaluate``, ``review``, ``state``: the set has failed.
* ``merge``: the set is reviewed, but not merged.
* others (labels): no matter.

Rows that are damaged fail too: a set without an update time, and one with a file without a path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("repo_url", "pr_number")
REPOSITORY, LISTING, MERGE = "repository", "files", "merge"
FATAL = ("evaluate", "review", "state")


def failed_calls(calls: DataFrame) -> DataFrame:
    """``repo_url, pr_number, call, error`` of the calls whose last attempt failed; those without an outcome count as failed."""
    last = F.max_by(F.struct(F.coalesce("ok", F.lit(False)).alias("ok"), "error"), F.col("attempt")).alias("last")
    rows = calls.groupBy(*KEYS, "call").agg(last).filter("NOT last.ok")
    return rows.select(*KEYS, "call", F.coalesce("last.error", F.lit("unknown")).alias("error"))


def reachable(change_sets: DataFrame, failed: DataFrame) -> DataFrame:
    """Change sets of the repositories that could be reached."""
    lost = failed.filter((F.col("call") == REPOSITORY) & F.col("pr_number").isNull()).select("repo_url").distinct()
    return change_sets.join(lost, "repo_url", "left_anti")


def without(files: DataFrame, failed: DataFrame, call: str) -> DataFrame:
    """Files of the change sets for which a call did not fail."""
    return files.join(failed.filter(F.col("call") == call).select(*KEYS).distinct(), list(KEYS), "left_anti")


def set_failures(sets: DataFrame, files: DataFrame, failed: DataFrame | None) -> DataFrame:
    """``repo_url, pr_number, call, error`` of the sets that cannot be reviewed: damaged rows and failed calls."""
    names = sets.select(*KEYS)
    fault = lambda call, error: (*KEYS, F.lit(call).alias("call"), F.lit(error).alias("error"))
    damaged = sets.filter("updated_at IS NULL").select(*fault("change_set", "no update time"))
    pathless = files.filter("path IS NULL").select(*KEYS).distinct().join(names, list(KEYS), "left_semi")
    found = damaged.unionByName(pathless.select(*fault("file", "no path")))
    if failed is not None:
        known = failed.filter(F.col("call").isin(*FATAL)).join(names, list(KEYS), "left_semi")
        found = found.unionByName(known.select(*KEYS, "call", "error"))
    return found


def repository_failures(failed: DataFrame) -> DataFrame:
    """The repositories that could not be reached."""
    return failed.filter((F.col("call") == REPOSITORY) & F.col("pr_number").isNull()).select(*KEYS, "call", "error")
