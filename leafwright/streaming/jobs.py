"""Streaming forms of the incremental jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafwright.operators.change_sets import KEYS
from leafwright.operators.keywords import drop_listing_pages, valid_query_rows
from leafwright.plans.review import ReviewSettings, review, review_records
from leafwright.sources.readers import REVIEW_STATE_SCHEMA
from leafwright.streaming.log import compact, read_state, run_to_log

# Groups of keys that share their state in streams: many enough that a group of tens of millions of keys stays small.
GROUPS = 4096

STATE_LOG_SCHEMA = REVIEW_STATE_SCHEMA.replace("pr_number int", "pr_number bigint")


def review_stream(
    files: DataFrame,
    change_sets: DataFrame,
    log_path: str,
    checkpoint: str,
    now: Column,
    answers: DataFrame | None = None,
    answer_on: Sequence[str] = ("doc_id",),
    settings: ReviewSettings = ReviewSettings(),
    trigger: dict | None = None,
    compact_every: int = 10,
) -> StreamingQuery:
    """Review changed files as they land.

    A landed file holds whole change sets.  Each micro-batch leaves out the
    sets that earlier batches reviewed and adds its own reviews to the log; the
    state table is the newest row per change set of that log.  Every
    ``compact_every`` batches it becomes the base of the log, so a batch reads
    the base and a few newer batches.  A batch that runs twice gives the same rows.
    """
    spark = files.sparkSession

    def each(batch: DataFrame, batch_id: int) -> DataFrame:
        seen = read_state(spark, log_path, STATE_LOG_SCHEMA, KEYS, before=batch_id)
        landed = batch.select(*KEYS).distinct()
        open_sets = change_sets.join(landed, KEYS, "left_semi")
        run = review(open_sets, batch, seen, answers, answer_on, settings)
        return review_records(run.reviews, now)

    def after(_: int) -> None:
        compact(spark, log_path, STATE_LOG_SCHEMA, KEYS, compact_every)

    return run_to_log(files, log_path, checkpoint, "append", each, trigger, after)


def _timed(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Put a watermark on a time column (one without a zone is read in the session's)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def first_notices(notices: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts", delay: str = "30 days") -> DataFrame:
    """Notices of change sets without the repeats that come within ``delay``."""
    return _timed(notices, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_pairs(rows: DataFrame, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """``day, page, query`` pairs seen, a row per day.

    Days are kept apart and put together when keywords are read: a sliding
    window of 28 days would hold every pair 28 times.  State is by pair, so a
    page with most of the rows is spread out.
    """
    pairs = _timed(drop_listing_pages(valid_query_rows(rows, [ts])), ts, delay)
    seen = pairs.groupBy(F.window(ts, "1 day"), "page", "query").agg(F.count("*").alias("n"))
    return seen.select(F.to_date("window.start").alias("day"), "page", "query", "n")


def sliding_pairs(rows: DataFrame, ts: str = "ts", days: int = 28, delay: str = "1 day", groups: int = GROUPS) -> DataFrame:
    """``page, query, first, last``: spans of days through which each pair was seen, no ``days`` apart.

    A pair is in the window of ``days`` days before a day if a span begins before that day and ended ``days`` before
    it or later, so one span of state per pair stands for all its windows.  A span is given anew when it is seen again,
    and dropped when no window can hold it any more.  Pairs share their state with others of their hash, one of ``groups``.
    """
    pairs = drop_listing_pages(valid_query_rows(rows, [ts]))
    daily = (
        pairs.select("page", "query", F.date_trunc("day", F.col(ts).cast("timestamp")).alias("day"))
        .withWatermark("day", delay)
        .dropDuplicatesWithinWatermark(["page", "query", "day"])
    )

    def span(held: dict, rows: list[tuple]) -> Iterator[tuple]:
        """Spans that hold a day of the rows, which are in order of days; ``held`` keeps the newest of each pair."""
        now: dict = {}
        for page, query, day in rows:
            pair = page, query
            first, last = held.get(pair, (day, day))
            if day > last + days or day < first - days:
                if pair in now:
                    yield (*pair, *now[pair])
                first, last = day, day
            held[pair] = now[pair] = min(first, day), max(last, day)
        for pair, seen in now.items():
            yield (*pair, *seen)

    schema = "page string, query string, first timestamp, last timestamp"
    return _by_hash(daily, ["page", "query"], span, ["first", "last"], schema, lambda seen: seen[1] + days + 1, groups)


def _by_hash(
    daily: DataFrame, keys: Sequence[str], step: Callable, values: Sequence[str], schema: str, end: Callable, groups: int
) -> DataFrame:
    """Rows (``keys``, then timestamps) that ``step`` gives for the daily rows (``keys``, day) and what is held of each key.

    A call of Python for each key would cost more than its rows, so keys meet by their hash in one of ``groups`` groups of
    state, which holds a tuple of ``values``, days since 1970, for each key.  ``end`` gives the day on which a key is dropped.
    """
    group = F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("group")
    columns = [*keys, *values]

    def run(_: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        arrays = state.get if state.exists else [[] for _ in columns]
        n = len(keys)
        held = dict(zip(zip(*arrays[:n]), zip(*arrays[n:])))
        if not state.hasTimedOut:
            days = lambda c: c.to_numpy("M8[D]").astype(int).tolist()
            rows = [r for chunk in chunks for r in zip(*(chunk[k] for k in keys), days(chunk["day"]))]
            out = list(step(held, sorted(rows, key=lambda r: r[-1])))
            if out:
                given = dict(zip(names, zip(*out)))
                yield pd.DataFrame({c: v if c in keys else np.array(v, "M8[D]").astype("M8[ns]") for c, v in given.items()})
        ms, passed = 86_400_000, state.getCurrentWatermarkMs()
        held = {key: seen for key, seen in held.items() if end(seen) * ms > passed}
        if held:
            state.update(tuple([list(c) for c in zip(*(key + seen for key, seen in held.items()))]))
            state.setTimeoutTimestamp(min(end(seen) for seen in held.values()) * ms)
        elif state.exists:
            state.remove()

    names = [c.split()[0] for c in schema.split(", ")]
    held_schema = ", ".join([*(f"{c} array<string>" for c in keys), *(f"{c} array<int>" for c in values)])
    kept = daily.filter("day IS NOT NULL").select(group, *keys, "day")
    return kept.groupBy("group").applyInPandasWithState(run, schema, held_schema, "append", "EventTimeTimeout")


def pairs_before(spans: DataFrame, end: Column, days: int = 28) -> DataFrame:
    """``page, query`` of the spans that the window of ``days`` days before ``end`` holds."""
    held = (F.col("first") < end) & (F.date_add(F.to_date("last"), days) >= F.to_date(end))
    return spans.filter(held).select("page", "query").distinct()


def grant_submissions(requests: DataFrame, days: int = 30, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """``url, day`` of requests that may be submitted: none within ``days`` of the last one granted.

    Requests are cut to one per URL and day before they meet the state, so a
    URL with most of the rows is no load for its task.  State that is older
    than ``days`` is dropped.
    """
    daily = (
        requests.select("url", F.date_trunc("day", F.col(ts).cast("timestamp")).alias("day"))
        .withWatermark("day", delay)
        .dropDuplicatesWithinWatermark(["url", "day"])
    )

    def grant(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        wanted = sorted(set().union(*[set(chunk["day"]) for chunk in chunks]))
        last = pd.Timestamp(state.get[0]) if state.exists else None
        granted = []
        for day in wanted:
            if last is None or (day - last).days > days:
                granted.append(day)
                last = day
        if last is not None:
            state.update((last.to_pydatetime(),))
            end_ms = int((last + pd.Timedelta(days=days + 1)).timestamp() * 1000)
            state.setTimeoutTimestamp(max(end_ms, state.getCurrentWatermarkMs() + 1))
        if granted:
            yield pd.DataFrame({"url": [key[0]] * len(granted), "day": granted})

    return daily.groupBy("url").applyInPandasWithState(
        grant, "url string, day timestamp", "last timestamp", "append", "EventTimeTimeout"
    )


def windowed_metrics(outcomes: DataFrame, ts: str = "ts", length: str = "4 hours", delay: str = "4 hours") -> DataFrame:
    """Counters per time window: ``start, items, succeeded, failed``."""
    counts = (
        _timed(outcomes, ts, delay)
        .groupBy(F.window(ts, length))
        .agg(
            F.count("*").alias("items"),
            F.count_if("ok").alias("succeeded"),
            F.count_if(F.col("outcome") == "failed").alias("failed"),
        )
    )
    return counts.select(F.col("window.start").alias("start"), "items", "succeeded", "failed")
