"""Streaming queries: a stream takes the table in, its log is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators.frontier import classify_outcome
from leafwright.operators.keywords import in_range, keywords_by_page
from leafwright.session import work_path
from leafwright.streaming import jobs
from leafwright.streaming.log import latest, read_log, read_state, run_to_log, write_batch
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import change_sets, fixture, tables
from leafwright.suite.review_queries import QUERIES as REVIEW_QUERIES
from leafwright.suite.review_queries import SETTINGS, _state_text
from leafwright.suite.site_queries import QUERIES as SITE_QUERIES


def now():
    """The fixed time of all queries."""
    return F.to_timestamp(F.lit(fx.NOW))


def _stream(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    """A fixture over a table that is read as a stream."""
    tables(spark, sf_dir)
    # A pattern, since a stream takes a folder or a pattern but not the name of one file.
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parque[t]").createOrReplaceTempView(f"{table}_stream")
    return spark.sql(sql.replace(f"FROM {table}", f"FROM {table}_stream"))


def _finish(spark: SparkSession, stream: DataFrame, schema: str, mode: str = "update") -> DataFrame:
    log = work_path(spark, "log")
    run_to_log(stream, log, work_path(spark, "checkpoint"), mode).awaitTermination()
    return read_log(spark, log, schema)


def stream_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State table after the files were reviewed as a stream."""
    log = work_path(spark, "reviews")
    seen = fixture(spark, sf_dir, "review_state").select(
        "repo_url", "pr_number", "product", "decision", "score", "reviewed_at", "pr_updated_at"
    )
    write_batch(seen, log, -1)
    files = _stream(spark, sf_dir, "documents", fx.CHANGED_FILE)
    answers = fixture(spark, sf_dir, "ai_response").select("doc_id", "body")
    query = jobs.review_stream(
        files, change_sets(spark, sf_dir), log, work_path(spark, "checkpoint"), now(), answers, settings=SETTINGS
    )
    query.awaitTermination()
    return _state_text(read_state(spark, log, jobs.STATE_LOG_SCHEMA, ["repo_url", "pr_number"]))


def stream_first_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices without repeats."""
    notices = _stream(spark, sf_dir, "events", "SELECT user_id, event_type, ts FROM events")
    log = _finish(
        spark,
        jobs.first_notices(notices, ["user_id", "event_type"], delay="3650 days").select("user_id", "event_type"),
        "user_id bigint, event_type string",
        "append",
    )
    return log.select("user_id", "event_type")


def stream_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of the last 28 days from daily pairs."""
    rows = _stream(spark, sf_dir, "events", fx.QUERY_ROW)
    rows = rows.select("ts", F.array_compact(F.array("k1", "k2")).alias("keys"))
    log = _finish(spark, jobs.daily_pairs(rows), "day date, page string, query string, n bigint")
    recent = in_range(log, F.to_date(now()), 28, "day").select(F.array("page", "query").alias("keys"))
    return _keywords(recent)


def stream_keywords_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the spans of each pair, for the window that ends at the fixed date."""
    rows = _stream(spark, sf_dir, "events", fx.QUERY_ROW)
    rows = rows.select("ts", F.array_compact(F.array("k1", "k2")).alias("keys"))
    log = _finish(spark, jobs.sliding_pairs(rows), "page string, query string, first timestamp, last timestamp", "append")
    return _keywords(jobs.pairs_before(log, now()).select(F.array("page", "query").alias("keys")))


def _keywords(rows: DataFrame) -> DataFrame:
    out = keywords_by_page(rows, F.to_date(now()))
    return out.select(
        "url", "part", F.array_join("keywords", "|").alias("keywords"), "lang",
        F.date_format("last_updated", "yyyy-MM-dd").alias("last_updated"),
    )


def stream_resubmission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions granted, none within seven days of the last."""
    requests = _stream(
        spark, sf_dir, "events", "SELECT 'https://h.example/' || CAST(user_id AS STRING) || '/' AS url, ts FROM events"
    )
    log = _finish(spark, jobs.grant_submissions(requests, days=7), "url string, day timestamp", "append")
    return log.select("url", F.date_format("day", "yyyy-MM-dd").alias("day"))


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission counters of every four hours."""
    sql = fx.OUTCOME.replace("SELECT 'h'", "SELECT e.ts, 'h'", 1)
    outcomes = classify_outcome(_stream(spark, sf_dir, "events", sql))
    log = _finish(
        spark, jobs.windowed_metrics(outcomes), "start timestamp, items bigint, succeeded bigint, failed bigint"
    )
    return latest(log, ["start"]).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


_DAYS = "SELECT DISTINCT 'https://h.example/' || CAST(user_id AS STRING) || '/' AS url, CAST(ts AS DATE) AS d FROM events"

QUERIES = {
    "stream_review": (stream_review, REVIEW_QUERIES["review_upsert"][1]),
    "stream_first_notices": (stream_first_notices, "SELECT DISTINCT user_id, event_type FROM events"),
    "stream_keywords": (stream_keywords, SITE_QUERIES["keywords_28d"][1]),
    "stream_keywords_sliding": (stream_keywords_sliding, SITE_QUERIES["keywords_28d"][1]),
    "stream_resubmission": (
        stream_resubmission,
        f"""WITH RECURSIVE e AS ({_DAYS}), g AS (SELECT url, min(d) AS d FROM e GROUP BY url UNION ALL
        SELECT e.url, min(e.d) AS d FROM g JOIN e ON e.url = g.url AND e.d > g.d + 7 GROUP BY e.url)
        SELECT url, strftime(d, '%Y-%m-%d') AS day FROM g""",
    ),
    "stream_metrics": (
        stream_metrics,
        f"""WITH o AS (SELECT *, CASE WHEN attempt > 5 THEN 'failed' WHEN status = 200 THEN 'done'
          WHEN status IN (401, 429) AND attempt < 5 THEN 'retry' ELSE 'failed' END AS outcome
          FROM ({fx.OUTCOME.replace("SELECT 'h'", "SELECT e.ts, 'h'", 1)}) x)
        SELECT strftime(time_bucket(interval '4 hours', ts, timestamp '2000-01-01'), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS items,
          count(*) FILTER (outcome = 'done') AS succeeded, count(*) FILTER (outcome = 'failed') AS failed FROM o GROUP BY 1""",
    ),
}
