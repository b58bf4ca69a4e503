"""Runs that go on when something fails: what is counted, what is kept, who gets a row."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leafwright.operators import failures as fl
from leafwright.operators.metrics import run_counters
from leafwright.plans.review import ReviewSettings, next_state, review, run_report
from leafwright.sources.readers import CHANGED_FILE_SCHEMA, REVIEW_STATE_SCHEMA

DAY = dt.datetime(2024, 1, 1)
SETS = "repo_url string, pr_number int, product string, product_ord int, title string, head_ref string, labels array<string>, created_at timestamp, updated_at timestamp"
CALLS = "repo_url string, pr_number int, call string, attempt int, ok boolean, error string"
GOOD = "---\ntitle: Convert pages\nlayout: reference-single\n---\nbody\n"


def sets(spark, *numbers, damaged=()):
    rows = [
        (f"r{p}", n, f"p{p}", p, "t", "api-update-x", [], DAY + dt.timedelta(hours=n), None if n in damaged else DAY)
        for p, n in numbers
    ]
    return spark.createDataFrame(rows, SETS)


def files(spark, *numbers, pathless=()):
    rows = [(f"r{p}", n, 0, f"en/{n}.md", "added", None, 1, 0, GOOD) for p, n in numbers]
    rows += [(f"r{p}", n, 1, None, "added", None, 1, 0, GOOD) for p, n in numbers if n in pathless]
    return spark.createDataFrame(rows, CHANGED_FILE_SCHEMA)


def seen(spark):
    return spark.createDataFrame([], REVIEW_STATE_SCHEMA)


def outcomes(run):
    return {r.pr_number: (r.outcome, r.merged, r.files_found, r.files_reviewed) for r in run.outcomes.collect()}


NUMBERS = [(0, 1), (0, 2), (0, 3), (1, 4), (1, 5), (2, 6)]


def test_failed_sets_are_errors_and_are_taken_again(spark):
    calls = [("r0", 1, "review", 1, False, "no"), ("r0", 2, "review", 1, False, "no"), ("r0", 2, "review", 2, True, None)]
    calls += [("r1", 4, "files", 1, False, "no"), ("r1", 5, "labels", 1, False, "no"), ("r2", 6, "state", 1, None, None)]
    run = review(
        sets(spark, *NUMBERS, damaged=[3]), files(spark, *NUMBERS), seen(spark), calls=spark.createDataFrame(calls, CALLS)
    )
    got = outcomes(run)
    assert {n: got[n][0] for n in got} == {1: "error", 2: "reviewed", 3: "error", 4: "skipped", 5: "reviewed", 6: "error"}
    # Files were found before the failure, but not those of a list that failed.
    assert {n: got[n][2:] for n in got} == {1: (1, 0), 2: (1, 1), 3: (1, 0), 4: (0, 0), 5: (1, 1), 6: (1, 0)}
    assert {(r.pr_number, r.call, r.error) for r in run.failures.collect()} == {
        (1, "review", "no"), (3, "change_set", "no update time"), (6, "state", "unknown")
    }
    kept = {r.pr_number for r in next_state(seen(spark), run, F.lit(DAY)).collect()}
    assert kept == {2, 5}
    total = run_counters(run.outcomes).filter("is_total").first()
    assert (total.found, total.reviewed, total.skipped, total.errors) == (6, 2, 1, 3)


def test_a_file_without_a_path_fails_its_set(spark):
    run = review(sets(spark, *NUMBERS), files(spark, *NUMBERS, pathless=[2]), seen(spark))
    assert {n for n, o in outcomes(run).items() if o[0] == "error"} == {2}
    assert [(r.pr_number, r.call) for r in run.failures.collect()] == [(2, "file")]


def test_merged_is_what_was_done(spark):
    settings = ReviewSettings(auto_merge=True, approve=0)
    calls = spark.createDataFrame([("r0", 1, "merge", 1, False, "conflict"), ("r0", 2, "merge", 1, True, None)], CALLS)
    run = review(sets(spark, *NUMBERS), files(spark, *NUMBERS), seen(spark), settings=settings, calls=calls)
    got = outcomes(run)
    assert all(o[0] == "reviewed" for o in got.values()) and {n for n, o in got.items() if not o[1]} == {1}


@pytest.mark.parametrize("limit", [None, 2])
def test_every_configured_product_has_a_row(spark, limit):
    """One cannot be reached, one has no change sets; after the limit no product is looked at."""
    calls = [("r1", None, "repository", 1, False, "gone"), ("r0", 1, "review", 1, False, "no")]
    run = review(
        sets(spark, *NUMBERS), files(spark, *NUMBERS), seen(spark),
        settings=ReviewSettings(max_reviews=limit), calls=spark.createDataFrame(calls, CALLS),
    )
    assert {r.product for r in run.outcomes.select("product").collect()} == ({"p0", "p2"} if limit is None else {"p0"})
    products = spark.createDataFrame([(f"p{i}", i, f"r{i}") for i in range(4)], "product string, product_ord int, repo_url string")
    usage = spark.createDataFrame([("p0", 10, 1, 5), ("p2", 7, 1, 5)], "product string, tokens long, calls long, duration_ms long")
    dim = spark.createDataFrame([], "product string, display string, website string")
    rows = run_report(run, usage, dim, F.lit(DAY), "a", "o", products).collect()
    got = {r.product: (r.status, r.items_discovered, r.items_succeeded, r.items_failed, r.token_usage) for r in rows}
    want = {
        "Acme.P0": ("partial_success", 3, 2, 1, 10), "Acme.P1": ("failure", 0, 0, 1, 10),
        "Acme.P2": ("success", 1, 1, 0, 17), "Acme.P3": ("failure", 0, 0, 0, 17),
    }
    assert got == (want if limit is None else {"Acme.P0": want["Acme.P0"]})


def test_failed_calls_take_the_last_attempt(spark):
    calls = [("r", 1, "review", 2, True, None), ("r", 1, "review", 1, False, "x"), ("r", 1, "merge", 1, True, None)]
    calls += [("r", 1, "merge", 2, False, "y"), ("r", None, "repository", 1, False, None)]
    got = {tuple(r) for r in fl.failed_calls(spark.createDataFrame(calls, CALLS)).collect()}
    assert got == {("r", 1, "merge", "y"), ("r", None, "repository", "unknown")}
