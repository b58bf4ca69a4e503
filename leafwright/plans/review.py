"""The review job: from change sets and changed files to decisions, comments, state and metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from leafwright.operators import change_sets as cs
from leafwright.operators import failures as fl
from leafwright.operators import metrics, scoring, state
from leafwright.operators.checks import DEFAULT_CHECKLIST, CheckDef, run_checks
from leafwright.operators.words import CheckRules
from leafwright.session import settle


@dataclass(frozen=True)
class ReviewSettings:
    """Settings of a review run; the defaults are the shipped ones."""

    reviewer: str = "Page Review"
    branch_prefix: str | None = "api-update-"
    labels: tuple[str, ...] = ()
    path_contains: str | None = None
    max_reviews: int | None = None
    auto_merge: bool = False
    approve: int = scoring.APPROVE_AT
    request_changes: int = scoring.REQUEST_CHANGES_AT
    model_weight: int = scoring.MODEL_WEIGHT
    ai_issue_when_disabled: bool = True
    label_prefix: str = ""
    checklist: tuple[CheckDef, ...] = field(default=DEFAULT_CHECKLIST)
    rules: CheckRules = field(default_factory=CheckRules)


@dataclass(frozen=True)
class ReviewRun:
    """Tables of a review run.

    ``failures`` has the rows that failed; ``stopped_at`` is the place in order of the last product that was looked at,
    if a limit stopped the run.
    """

    files: DataFrame
    reviews: DataFrame
    outcomes: DataFrame
    platforms: DataFrame
    failures: DataFrame
    stopped_at: int | None = None


def review_files(
    files: DataFrame, answers: DataFrame | None, answer_on: Sequence[str], settings: ReviewSettings
) -> DataFrame:
    """Checks, scores and issues of each readable file."""
    readable = files.filter(F.col("content").isNotNull())
    checked = run_checks(readable, settings.checklist, rules=settings.rules).drop("content", "patch")
    scored = scoring.with_model_answers(
        checked, answers, answer_on, settings.model_weight, settings.ai_issue_when_disabled
    )
    return scored.withColumn("issues", scoring.file_issues(F.col("check_results"), F.col("ai")))


def _reached(sets: DataFrame, last: Row) -> DataFrame:
    """What a run came to see before its limit stopped it.

    Later products are not looked at; later sets of the last product are known
    but wait.  The place where it stopped is one row.
    """
    order = ("product_ord", "created_at", "pr_number")
    stop = F.struct(*[F.lit(last[c]).cast(sets.schema[c].dataType).alias(c) for c in order])
    return sets.filter(F.col("product_ord") <= last["product_ord"]).withColumn("waiting", F.struct(*order) > stop)


def review(
    change_sets: DataFrame,
    changed_files: DataFrame,
    seen: DataFrame,
    answers: DataFrame | None = None,
    answer_on: Sequence[str] = ("doc_id",),
    settings: ReviewSettings = ReviewSettings(),
    calls: DataFrame | None = None,
) -> ReviewRun:
    """Review the open change sets that were not reviewed before.

    Narrow change-set rows are filtered first (branch, state, files), and only
    files of the chosen sets are checked.  The chosen keys are a written table,
    so Spark knows their size and sends them to the scan tasks below its
    broadcast threshold; beyond it, contents are shuffled by key once.  File
    results are written to the work folder, so contents are checked once for
    decisions, comments, state and metrics together.

    ``calls`` has what the calls to the outside came to (see
    :mod:`leafwright.operators.failures`).  A set that failed has no review and
    is not in the state, so the next run takes it again; a merge is one that
    was asked for and did not fail.
    """
    keys = list(scoring.CHANGE_SET_KEYS)
    if calls is not None:
        calls = settle(fl.failed_calls(calls), "failed-calls")
        change_sets = fl.reachable(change_sets, calls)
    selected = cs.select_change_sets(change_sets, settings.branch_prefix, settings.labels)
    # Files of a set that were not listed are not known.
    listed = changed_files if calls is None else fl.without(changed_files, calls, fl.LISTING)
    markdown = cs.select_markdown(listed, settings.path_contains)
    # Paths and flags of the files, written once; contents are read for the chosen sets only, unless a limit needs to
    # know whether there are any.
    readable = F.lit(True) if settings.max_reviews is None else F.col("content").isNotNull()
    narrow = settle(markdown.select(*keys, "file_ord", "path", readable.alias("readable")), "markdown")
    fresh = cs.not_reviewed(selected, seen)
    failures = settle(fl.set_failures(fresh, listed, calls), "failures")
    failed = failures.select(*keys).distinct()
    sound = fresh.join(failed, keys, "left_anti")
    offered = narrow.groupBy(*keys).agg(F.count("*").alias("files_found"))
    # Only sets that can be reviewed count towards the limit.
    candidates = sound if settings.max_reviews is None else sound.join(narrow.filter("readable").select(*keys).distinct(), keys, "left_semi")
    chosen = settle(cs.limit_reviews(candidates, settings.max_reviews), "chosen")
    stopped_at = None
    selected = selected.withColumn("waiting", F.lit(False))
    if settings.max_reviews is not None and chosen.count() == settings.max_reviews:
        last = chosen.orderBy(*[F.col(c).desc() for c in ("product_ord", "created_at", "pr_number")]).first()
        if last is not None:
            stopped_at = last["product_ord"]
            selected, fresh = _reached(selected, last), _reached(fresh, last).filter("NOT waiting")
    markdown_chosen = markdown.join(chosen.select(*keys), keys, "left_semi")
    files = settle(review_files(markdown_chosen, answers, answer_on, settings), "files")
    scores = scoring.change_set_scores(files, settings.checklist)
    decided = scoring.with_decision(scores, settings.approve, settings.request_changes, settings.label_prefix)
    reviews = chosen.join(decided, keys)
    merged = F.lit(settings.auto_merge) & (F.col("decision") == "APPROVE")
    if calls is not None:
        merged = merged & F.col("merge_failed").isNull()
    results = decided.select(*keys, "decision", "files")
    outcomes = (
        selected.join(fresh.select(*keys, F.lit(True).alias("fresh")), keys, "left")
        .join(offered, keys, "left")
        .join(results, keys, "left")
        .join(failed.withColumn("failed", F.lit(True)), keys, "left")
    )
    if calls is not None:
        not_merged = calls.filter(F.col("call") == fl.MERGE).select(*keys, F.lit(True).alias("merge_failed"))
        outcomes = outcomes.join(not_merged, keys, "left")
    outcomes = outcomes.select(
        *keys,
        "product",
        "product_ord",
        F.when(F.col("decision").isNotNull(), "reviewed")
        .when(F.col("waiting"), "waiting")
        .when(F.col("failed"), "error")
        .otherwise("skipped")
        .alias("outcome"),
        "decision",
        F.coalesce(merged, F.lit(False)).alias("merged"),
        F.when(F.col("fresh"), F.coalesce("files_found", F.lit(0))).otherwise(0).alias("files_found"),
        F.coalesce("files", F.lit(0)).alias("files_reviewed"),
    )
    seen_files = narrow.join(fresh.select(*keys, "product", "created_at"), keys)
    platforms = cs.change_set_platforms(seen_files, ["product"], ["created_at", "pr_number", "file_ord"])
    reached = failures.join(fresh.select(*keys), keys, "left_semi")
    if calls is not None:
        reached = reached.unionByName(fl.repository_failures(calls))
    return ReviewRun(files, reviews, outcomes, platforms, reached, stopped_at)


def review_records(reviews: DataFrame, now: Column) -> DataFrame:
    """Reviews as rows of the state table."""
    return reviews.select(
        *scoring.CHANGE_SET_KEYS,
        "product",
        "decision",
        F.col("total_score").alias("score"),
        now.alias("reviewed_at"),
        F.col("updated_at").alias("pr_updated_at"),
    )


def next_state(seen: DataFrame, run: ReviewRun, now: Column) -> DataFrame:
    """State table after a run."""
    return state.save_reviews(seen, review_records(run.reviews, now))


def run_report(
    run: ReviewRun,
    usage: DataFrame,
    product_dim: DataFrame,
    now: Column,
    agent_name: str,
    agent_owner: str,
    products: DataFrame | None = None,
    **names: str,
) -> DataFrame:
    """Metrics rows of a run, one per product that it looked at.

    ``usage`` has ``product, tokens, calls, duration_ms``.  Tokens and calls
    are those of the run so far, products in order.  ``product_dim`` has
    ``product, display, website`` with lower-case keys.  ``products`` has the
    configured products, ``product, product_ord, repo_url``: each gets its row, also
    without change sets or when its repository could not be reached.  Without it the
    products are those of the change sets.
    """
    looked_at = run.outcomes.select("product", "product_ord").distinct()
    repositories = None
    if products is not None:
        looked_at = products.select("product", "product_ord")
        if run.stopped_at is not None:
            looked_at = looked_at.filter(F.col("product_ord") <= run.stopped_at)
        repositories = run.failures.filter("pr_number IS NULL").join(products.select("product", "repo_url"), "repo_url")
        repositories = repositories.groupBy("product").agg(F.count("*").alias("unreachable"))
    so_far = metrics.running_usage(looked_at.join(usage, "product", "left").fillna(0, ["tokens", "calls", "duration_ms"]))
    counted = metrics.run_counters(run.outcomes).filter("NOT is_total").select("product", "files_found", "files_reviewed", "errors")
    counters = (
        so_far.join(counted, "product", "left")
        .fillna(0, ["files_found", "files_reviewed", "errors"])
        .withColumn("_key", F.lower("product"))
        .join(product_dim.select(F.col("product").alias("_key"), "display", "website"), "_key", "left")
        .join(run.platforms, "product", "left")
    )
    if repositories is not None:
        counters = counters.join(repositories, "product", "left").fillna(0, ["unreachable"])
        counters = counters.withColumn("errors", F.col("errors") + F.col("unreachable"))
    filled = counters.select(
        "product", "display", "website", "platforms", "files_found", "files_reviewed", "errors",
        F.col("duration_ms"), F.col("tokens_so_far").alias("tokens"), F.col("calls_so_far").alias("calls"),
    )
    return metrics.run_metrics(filled, now, agent_name, agent_owner, **names)
