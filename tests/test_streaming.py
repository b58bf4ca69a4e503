"""Streams over several files against the batch answer on the same rows."""

from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from leafwright.plans.review import ReviewSettings
from leafwright.streaming import jobs
from leafwright.streaming.log import compact, folders, latest, read_log, read_state, run_to_log, write_batch
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import change_sets, fixture

SF = "/root/testdata/sf0.001"


def in_files(df, path, key, n=3):
    for i in range(n):
        df.filter(F.pmod(F.col(key), F.lit(n)) == i).coalesce(1).write.mode("append").parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_review_stream_in_batches(spark, tmp_path):
    state = fixture(spark, SF, "review_state").select(
        "repo_url", "pr_number", "product", "decision", "score", "reviewed_at", "pr_updated_at"
    )
    log = str(tmp_path / "log")
    write_batch(state, log, -1)
    stream = in_files(fixture(spark, SF, "changed_file"), str(tmp_path / "files"), "pr_number", 4)
    args = (stream, change_sets(spark, SF), log, str(tmp_path / "ckpt"), F.lit(fx.NOW).cast("timestamp"))
    jobs.review_stream(*args, settings=ReviewSettings()).awaitTermination()
    rows = read_log(spark, log, jobs.STATE_LOG_SCHEMA)
    assert rows.filter("batch >= 0").select("batch").distinct().count() == 4
    keys = ["repo_url", "pr_number"]
    assert rows.groupBy(*keys).count().filter("count > 1").count() == 0  # nothing is reviewed twice
    expected = change_sets(spark, SF).filter("pr_number % 6 <> 0 AND pr_number % 3 <> 0").count()
    assert rows.filter("batch >= 0").count() == expected
    # The same files again, as after a lost checkpoint: nothing is left to review.
    again = (stream, change_sets(spark, SF), log, str(tmp_path / "ckpt2"), F.lit(fx.NOW).cast("timestamp"))
    before = latest(rows, keys).count()
    jobs.review_stream(*again, settings=ReviewSettings()).awaitTermination()
    assert latest(read_log(spark, log, jobs.STATE_LOG_SCHEMA), keys).count() <= before


def test_update_log_keeps_the_newest(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=7 * i), i % 3 == 0, "done" if i % 3 == 0 else "failed") for i in range(300)]
    df = spark.createDataFrame(rows, "i int, ts timestamp, ok boolean, outcome string")
    stream = in_files(df, str(tmp_path / "in"), "i")
    log = str(tmp_path / "log")
    counts = jobs.windowed_metrics(stream, delay="10 days")
    run_to_log(counts, log, str(tmp_path / "ckpt")).awaitTermination()
    got = latest(read_log(spark, log, "start timestamp, items bigint, succeeded bigint, failed bigint"), ["start"])
    want = df.groupBy(F.window("ts", "4 hours")).agg(F.count("*").alias("items"), F.count_if("ok").alias("ok"))
    assert {(r.start, r.items, r.succeeded) for r in got.collect()} == {(r.window.start, r["items"], r.ok) for r in want.collect()}


def test_grants(spark, tmp_path):
    days = {"hot": [0, 0, 1, 5, 8, 9, 16, 17, 40], "b": [3, 10, 11], "c": [2]}
    rows = [(u, datetime(2024, 1, 1, h) + timedelta(days=d)) for u, ds in days.items() for d in ds for h in range(4)]
    df = spark.createDataFrame(rows, "url string, ts timestamp").orderBy("ts")
    path = str(tmp_path / "in")
    cuts = [datetime(2024, 1, 1), datetime(2024, 1, 7), datetime(2024, 1, 15), datetime(2025, 1, 1)]
    for lo, hi in zip(cuts, cuts[1:]):
        df.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    log = str(tmp_path / "log")
    run_to_log(jobs.grant_submissions(stream, days=7), log, str(tmp_path / "ckpt"), "append").awaitTermination()

    def greedy(ds):
        out = []
        for d in sorted(set(ds)):
            if not out or d - out[-1] > 7:
                out.append(d)
        return out

    got = read_log(spark, log, "url string, day timestamp").toPandas()
    want = {(u, pd.Timestamp("2024-01-01") + pd.Timedelta(days=d)) for u, ds in days.items() for d in greedy(ds)}
    assert {(r.url, r.day) for r in got.itertuples()} == want and len(got) == len(want)


def test_first_notices_in_append_mode(spark, tmp_path):
    rows = [(i % 5, datetime(2024, 1, 1) + timedelta(hours=i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, ts timestamp").withColumn("i", F.monotonically_increasing_id())
    stream = in_files(df, str(tmp_path / "in"), "k", 2)
    log = str(tmp_path / "log")
    run_to_log(jobs.first_notices(stream, ["k"]), log, str(tmp_path / "ckpt"), "append").awaitTermination()
    assert sorted(r.k for r in read_log(spark, log, "k int, ts timestamp").collect()) == [0, 1, 2, 3, 4]


def test_pairs(spark, tmp_path):
    rows = [(["https://h/p", f"q{i % 4}"], datetime(2024, 1, 1) + timedelta(days=i % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "keys array<string>, ts timestamp").withColumn("i", F.lit(0))
    stream = in_files(df, str(tmp_path / "in"), "i", 1)
    log = str(tmp_path / "log")
    run_to_log(jobs.daily_pairs(stream), log, str(tmp_path / "ckpt")).awaitTermination()
    got = read_log(spark, log, "day date, page string, query string, n bigint")
    assert got.count() == 12 and got.agg(F.sum("n")).first()[0] == 40


def test_sliding_pairs_hold_one_state_row_per_pair(spark, tmp_path):
    """Spans of a pair stand for all windows that hold it; state is by pair and goes when it is old."""
    days = {"a": [0, 1, 5, 9, 30, 31], "b": [2], "c": [0, 12, 24], "z": [60]}
    rows = [(["https://h/p", q], datetime(2024, 1, 1, h) + timedelta(days=d)) for q, ds in days.items() for d in ds for h in range(3)]
    df = spark.createDataFrame(rows, "keys array<string>, ts timestamp")
    path, start = str(tmp_path / "in"), datetime(2024, 1, 1)
    cuts = [0, 2, 6, 20, 40, 61]
    for lo, hi in zip(cuts, cuts[1:]):
        part = df.filter((F.col("ts") >= start + timedelta(days=lo)) & (F.col("ts") < start + timedelta(days=hi)))
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    log = str(tmp_path / "log")
    query = run_to_log(jobs.sliding_pairs(stream, days=7), log, str(tmp_path / "ckpt"), "append")
    query.awaitTermination()
    spans = read_log(spark, log, "page string, query string, first timestamp, last timestamp").cache()
    for end in range(0, 75):
        got = {r.query for r in jobs.pairs_before(spans, F.lit(start + timedelta(days=end)), 7).collect()}
        assert got == {q for q, ds in days.items() if any(d < end <= d + 7 for d in ds)}
    held = [max(s["numRowsTotal"] for s in p["stateOperators"] if s["operatorName"] == "applyInPandasWithState" or "FlatMap" in s["operatorName"]) for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= len(days) and held[-1] < len(days)


def test_pairs_share_groups_of_state(spark, tmp_path):
    """A group of state, and a call of Python, is for many pairs; late days and pairs that go out leave the others right."""
    seen = [(f"q{i % 300}", (i * 7) % 45) for i in range(900)] + [("late", 40), ("late", 2), ("new", 44)]
    df = spark.createDataFrame([(["https://h/p", q], datetime(2024, 1, 1) + timedelta(days=d), d) for q, d in seen], "keys array<string>, ts timestamp, d int")
    path, log, start = str(tmp_path / "in"), str(tmp_path / "log"), datetime(2024, 1, 1)
    for lo, hi in ((0, 20), (20, 41), (41, 60)):
        df.filter((F.col("d") >= lo) & (F.col("d") < hi)).drop("d").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.drop("d").schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = run_to_log(jobs.sliding_pairs(stream, days=7, groups=8), log, str(tmp_path / "ckpt"), "append")
    query.awaitTermination()
    spans = read_log(spark, log, "page string, query string, first timestamp, last timestamp").cache()
    for end in range(0, 60, 6):
        got = {r.query for r in jobs.pairs_before(spans, F.lit(start + timedelta(days=end)), 7).collect()}
        assert got == {q for q, d in seen if d < end <= d + 7}
    held = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"] if s["operatorName"] == "applyInPandasWithState" or "FlatMap" in s["operatorName"]]
    assert max(held) == 8


def test_compacted_log_is_read_in_bounded_parts(spark, tmp_path):
    """Files that a batch reads do not grow with the number of batches; a batch that runs again reads the same."""
    log, schema, keys = str(tmp_path / "log"), "k int, v int", ["k"]
    newest, read, again = {}, [], {}
    for batch in range(50):
        rows = [(batch % 7, batch), (100 + batch % 3, -batch)]
        state = read_state(spark, log, schema, keys, before=batch)
        read.append(len(state.inputFiles()))
        again[batch] = sorted(map(tuple, state.collect()))
        assert dict(again[batch]) == newest
        newest.update(rows)
        write_batch(spark.createDataFrame(rows, schema).coalesce(1), log, batch)
        compact(spark, log, schema, keys, every=5)
        # As if this batch had failed after its log was written.
        assert sorted(map(tuple, read_state(spark, log, schema, keys, before=batch).collect())) == again[batch]
    assert dict(map(tuple, read_state(spark, log, schema, keys).collect())) == newest
    assert max(read) <= 5 + spark.sparkContext.defaultParallelism and max(read[25:]) <= max(read[:25])
    assert len(folders(spark, log, "base")) <= 2 and len(folders(spark, log, "batch")) <= 10


def test_a_base_that_was_not_finished_does_not_count(spark, tmp_path):
    log, schema = str(tmp_path / "log"), "k int, v int"
    for batch in range(3):
        write_batch(spark.createDataFrame([(1, batch)], schema), log, batch)
    assert not compact(spark, log, schema, ["k"], every=4)
    assert compact(spark, log, schema, ["k"], every=3)
    (tmp_path / "log" / "base=2" / "_SUCCESS").unlink()
    write_batch(spark.createDataFrame([(2, 9)], schema), log, 3)
    assert sorted(map(tuple, read_state(spark, log, schema, ["k"]).collect())) == [(1, 2), (2, 9)]
    assert read_state(spark, str(tmp_path / "none"), schema, ["k"]).count() == 0
