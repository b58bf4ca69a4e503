"""Queries over change sets: decisions, comments, state and metrics."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators import change_sets as cs
from leafwright.operators import metrics, scoring, state
from leafwright.operators.checks import DEFAULT_CHECKLIST
from leafwright.plans.review import ReviewSettings, next_state, review, run_report
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import change_sets, fixture
from leafwright.suite.page_queries import decision_sql, scored

REVIEWER = "Page Review"
SETTINGS = ReviewSettings(reviewer=REVIEWER, labels=("docs",), label_prefix="review:")


def now():
    """The fixed time of all queries."""
    return F.to_timestamp(F.lit(fx.NOW))


def _text(ts: str):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias(ts)


def _run(spark: SparkSession, sf_dir: str, settings: ReviewSettings = SETTINGS, calls: DataFrame | None = None):
    answers = fixture(spark, sf_dir, "ai_response").select("doc_id", "body")
    return review(
        change_sets(spark, sf_dir),
        fixture(spark, sf_dir, "changed_file"),
        fixture(spark, sf_dir, "review_state"),
        answers,
        settings=settings,
        calls=calls,
    )


def _run_with_calls(spark: SparkSession, sf_dir: str):
    """A run that merges, of whose calls some fail."""
    return _run(spark, sf_dir, replace(SETTINGS, auto_merge=True), fixture(spark, sf_dir, "call"))


def change_set_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, decision, label and event of each change set reviewed."""
    passed = F.array_join(F.transform(F.filter("check_results", lambda r: r["passed"]), lambda r: r["id"]), ",")
    return _run(spark, sf_dir).reviews.select(
        "repo_url",
        "pr_number",
        F.col("files").cast("bigint").alias("files"),
        "required_failed",
        *[F.col(c).cast("bigint").alias(c) for c in ("static_score", "ai_score", "ai_contribution", "total_score")],
        "decision",
        "label",
        "event",
        passed.alias("passed_checks"),
    )


def change_set_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct issues of each change set."""
    issues = scoring.merge_issues(_run(spark, sf_dir).files)
    return issues.select("repo_url", "pr_number", "part", F.array_join("issues", "|").alias("issues"))


def change_set_issues_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with so small a part that groups are split; one row per issue."""
    issues = scoring.merge_issues(_run(spark, sf_dir).files, size=4)
    return issues.select("repo_url", "pr_number", F.explode("issues").alias("issue"))


def change_set_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review text of each change set."""
    run = _run(spark, sf_dir)
    return scoring.review_comments(run.reviews, run.files, REVIEWER).select(
        "repo_url", "pr_number", "part", "comment"
    )


def short_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short review text and merge commit text."""
    reviews = _run(spark, sf_dir).reviews
    merges = scoring.merge_candidates(reviews, "review").select("repo_url", "pr_number", "commit_message")
    return reviews.join(merges, ["repo_url", "pr_number"], "left").select(
        "repo_url",
        "pr_number",
        scoring.short_comment(F.col("decision"), F.col("total_score"), REVIEWER).alias("comment"),
        "commit_message",
    )


def model_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions without a model."""
    run = review(
        change_sets(spark, sf_dir), fixture(spark, sf_dir, "changed_file"), fixture(spark, sf_dir, "review_state"),
        settings=SETTINGS,
    )
    return run.reviews.select(
        "repo_url", "pr_number", F.col("total_score").cast("bigint").alias("total_score"), "decision"
    )


def selected_change_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change sets by branch prefix or label, from a list that names each twice."""
    sets = change_sets(spark, sf_dir)
    twice = sets.unionByName(
        sets.withColumn("title", F.lit("again")).withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY"))
    )
    return cs.select_change_sets(twice, "api-update-", ("docs",)).select(
        "repo_url", "pr_number", "title", _text("created_at")
    )


def not_reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change sets without a saved review."""
    return cs.not_reviewed(change_sets(spark, sf_dir), fixture(spark, sf_dir, "review_state")).select(
        "repo_url", "pr_number"
    )


def needs_re_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change sets updated since their review."""
    return cs.needs_re_review(change_sets(spark, sf_dir), fixture(spark, sf_dir, "review_state")).select(
        "repo_url", "pr_number", _text("updated_at")
    )


def skipped_change_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change sets without a Markdown file to review."""
    files = cs.select_markdown(fixture(spark, sf_dir, "changed_file"), "docs/net")
    return cs.has_files(change_sets(spark, sf_dir), files)[1].select("repo_url", "pr_number")


def limited_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty change sets of a run."""
    fresh = cs.not_reviewed(change_sets(spark, sf_dir), fixture(spark, sf_dir, "review_state"))
    return cs.limit_reviews(fresh, 20).select("repo_url", "pr_number", F.col("product_ord").cast("bigint").alias("product_ord"))


def one_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change sets of one product."""
    return cs.filter_product(change_sets(spark, sf_dir), "viewer", ["words", "viewer", "other-tools2"]).select(
        "repo_url", "pr_number"
    )


def change_set_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platforms of each change set."""
    files = cs.select_markdown(fixture(spark, sf_dir, "changed_file"))
    return cs.change_set_platforms(files).select("repo_url", "pr_number", "platforms")


def _state_text(df: DataFrame) -> DataFrame:
    return df.select(
        "repo_url", "pr_number", "product", "decision", F.col("score").cast("bigint").alias("score"),
        _text("reviewed_at"), _text("pr_updated_at"),
    )


def review_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State table after a run."""
    seen = fixture(spark, sf_dir, "review_state").select(
        "repo_url", "pr_number", "product", "decision", "score", "reviewed_at", "pr_updated_at"
    )
    return _state_text(next_state(seen, _run(spark, sf_dir), now()))


def review_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved reviews replaced by two generations of new ones, the later wins."""
    seen = fixture(spark, sf_dir, "review_state")
    again = seen.filter("score >= 40").withColumn("decision", F.lit("APPROVE")).withColumn("reviewed_at", now())
    last = again.filter("score >= 80").withColumn("decision", F.lit("REJECT")).withColumn(
        "reviewed_at", now() + F.expr("INTERVAL 1 HOUR")
    )
    return _state_text(state.save_reviews(seen, last.unionByName(again)))


def review_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State table without the reviews that were cleared."""
    seen = fixture(spark, sf_dir, "review_state")
    return _state_text(state.clear_reviews(seen, seen.filter("decision = 'REJECT'")))


def reviews_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of the last week."""
    return _state_text(state.reviews_since(fixture(spark, sf_dir, "review_state"), state.week_start(now())))


def review_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved reviews by decision."""
    return state.review_stats(fixture(spark, sf_dir, "review_state"))


def _usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = fixture(spark, sf_dir, "ai_response").select("doc_id", "total_tokens")
    files = fixture(spark, sf_dir, "changed_file").select("doc_id", F.element_at(F.split("repo_url", "/"), -1).alias("product"))
    return metrics.ai_usage(answers.join(files, "doc_id"))


def ai_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and calls per product, and of the run so far."""
    order = change_sets(spark, sf_dir).select("product", "product_ord").distinct()
    out = metrics.running_usage(_usage(spark, sf_dir).join(order, "product"))
    return out.select("product", *[F.col(c).cast("bigint").alias(c) for c in ("tokens", "calls", "tokens_so_far", "calls_so_far")])


def run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What failed in a run, and why."""
    name = F.coalesce(F.col("pr_number").cast("string"), F.lit("")).alias("pr_number")
    return _run_with_calls(spark, sf_dir).failures.select("repo_url", name, "call", "error")


def run_counters_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run of which some calls fail: errors are counted, merges are those done."""
    return _counters(metrics.run_counters(_run_with_calls(spark, sf_dir).outcomes))


def review_state_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State table after a run of which some calls fail: these sets are not in it."""
    seen = fixture(spark, sf_dir, "review_state").select(
        "repo_url", "pr_number", "product", "decision", "score", "reviewed_at", "pr_updated_at"
    )
    return _state_text(next_state(seen, _run_with_calls(spark, sf_dir), now()))


def run_metrics_all_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics rows of a run of which some calls fail, one for each configured product."""
    usage = _usage(spark, sf_dir).withColumn("duration_ms", F.lit(1500))
    dim, products = fixture(spark, sf_dir, "product_dim"), fixture(spark, sf_dir, "product")
    rows = run_report(_run_with_calls(spark, sf_dir), usage, dim, now(), "page reviewer", "docs team", products)
    return _metric_rows(rows)


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per product and of the whole run."""
    return _counters(metrics.run_counters(_run(spark, sf_dir).outcomes))


def _counters(out: DataFrame) -> DataFrame:
    names = [c for c in out.columns if c not in ("product", "is_total")]
    return out.select(
        F.coalesce("product", F.lit("(run)")).alias("product"), *[F.col(c).cast("bigint").alias(c) for c in names]
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics rows of the run."""
    usage = _usage(spark, sf_dir).withColumn("duration_ms", F.lit(1500))
    dim = fixture(spark, sf_dir, "product_dim")
    return _metric_rows(run_report(_run(spark, sf_dir), usage, dim, now(), "page reviewer", "docs team"))


def _metric_rows(rows: DataFrame) -> DataFrame:
    ints = ("items_discovered", "items_succeeded", "items_failed", "run_duration_ms", "token_usage", "api_calls_count")
    return rows.select(*[F.col(c).cast("bigint").alias(c) if c in ints else c for c in metrics.METRIC_FIELDS])


# --- the same in SQL ---------------------------------------------------------

_KEYS = "repo_url, pr_number"
_SELECTED = f"SELECT * FROM ({fx.CHANGE_SET}) c WHERE pr_number % 6 <> 0 OR pr_number % 4 = 0"
_MARKDOWN = f"SELECT * FROM ({fx.CHANGED_FILE}) f WHERE ends_with(path, '.md') AND status IN ('added', 'modified')"
_AI = f"""SELECT doc_id, doc_id % 13 = 0 AS ai_failed,
       CASE WHEN doc_id % 13 = 0 THEN 0 ELSE true_score END AS ai_score,
       CASE WHEN doc_id % 13 = 0 THEN ['AI evaluation could not be completed.']
            ELSE ['i' || CAST(doc_id % 4 AS VARCHAR), 'i' || CAST(doc_id % 7 AS VARCHAR)] END AS ai_issues
FROM ({fx.AI_RESPONSE}) a"""


def _esc(text: str) -> str:
    return text.replace("'", "''")


def _reviewed(model: bool = True, also: str = "") -> str:
    """CTEs up to ``dec``: decisions of the change sets of a run, of those that ``also`` fit a condition."""
    md = f"""SELECT f.* FROM ({_MARKDOWN}) f JOIN (
        SELECT {_KEYS} FROM ({_SELECTED}) s WHERE pr_number % 3 <> 0{also}) s USING ({_KEYS}) WHERE content IS NOT NULL"""
    issues = ", ".join(f"CASE WHEN NOT c_{c.id} THEN '{_esc(c.description)}' END" for c in DEFAULT_CHECKLIST)
    every = ", ".join(f"bool_and(c_{c.id}) AS p_{c.id}" for c in DEFAULT_CHECKLIST)
    points = "CASE WHEN ai_failed THEN 0 ELSE round_even(greatest(0, least(100, ai_score)) / CAST(100 AS DOUBLE) * 20, 0) END"
    if not model:
        points = "0"
    return f"""{scored(md)},
ai AS ({_AI}),
fr AS (SELECT sc.*, ai_score, {points} AS points, list_concat([x for x in [{issues}] if x IS NOT NULL], ai_issues) AS issues
       FROM sc JOIN ai USING (doc_id)),
ag AS (SELECT {_KEYS}, count(*) AS files, bool_or(required_failed) AS required_failed,
       round_even(sum(static_score) / CAST(count(*) AS DOUBLE), 0) AS raw_static,
       CAST(round_even(sum(points) / CAST(count(*) AS DOUBLE), 0) AS BIGINT) AS ai_contribution,
       CAST(round_even(sum(ai_score) / CAST(count(*) AS DOUBLE), 0) AS BIGINT) AS ai_score, {every}
       FROM fr GROUP BY {_KEYS}),
cp AS (SELECT *, CAST(CASE WHEN required_failed THEN least(raw_static, 49) ELSE raw_static END AS BIGINT) AS static_score FROM ag),
tt AS (SELECT *, least(100, static_score + ai_contribution) AS total_score FROM cp),
dec AS (SELECT *, {decision_sql('total_score')} AS decision FROM tt)"""


_PASSED = ", ".join(f"CASE WHEN p_{c.id} THEN '{c.id}' END" for c in DEFAULT_CHECKLIST)

DECISIONS = f"""
WITH {_reviewed()}
SELECT {_KEYS}, files, required_failed, static_score, ai_score, ai_contribution, total_score, decision,
       CASE decision WHEN 'APPROVE' THEN 'review:approved' WHEN 'REQUEST_CHANGES' THEN 'review:needs-changes'
                     ELSE 'review:rejected' END AS label,
       CASE decision WHEN 'APPROVE' THEN 'APPROVE' ELSE 'REQUEST_CHANGES' END AS event,
       concat_ws(',', {_PASSED}) AS passed_checks
FROM dec
"""

ISSUES = f"""
WITH {_reviewed()}
SELECT {_KEYS}, CAST(0 AS BIGINT) AS part, string_agg(issue, '|' ORDER BY issue) AS issues
FROM (SELECT DISTINCT {_KEYS}, unnest(issues) AS issue FROM fr) d GROUP BY {_KEYS}
"""

ISSUE_ROWS = f"WITH {_reviewed()} SELECT DISTINCT {_KEYS}, unnest(issues) AS issue FROM fr"

NL = "chr(10)"
_CHECK_ROWS = ", ".join(
    f"'| {i} | {_esc(c.description)} | {c.type.title()} | ' || CASE WHEN p_{c.id} THEN '✅' ELSE "
    f"'{'❌' if c.type == 'required' else '⚠️'}' END || ' |'"
    for i, c in enumerate(DEFAULT_CHECKLIST, 1)
)

COMMENT = f"""
WITH {_reviewed()},
iss AS (SELECT {_KEYS}, string_agg({NL} || '- ' || issue, '' ORDER BY issue) AS issue_lines
        FROM (SELECT DISTINCT {_KEYS}, unnest(issues) AS issue FROM fr) d GROUP BY {_KEYS}),
fil AS (SELECT {_KEYS}, string_agg({NL} || '**`' || path || '`**' || CASE WHEN len(issues) = 0
          THEN {NL} || '  - No issues found' ELSE array_to_string([{NL} || '  - ' || x for x in issues], '') END,
          {NL} ORDER BY file_ord) AS file_lines FROM fr GROUP BY {_KEYS})
SELECT {_KEYS}, CAST(0 AS BIGINT) AS part,
  '## ' || CASE decision WHEN 'APPROVE' THEN '✅' WHEN 'REQUEST_CHANGES' THEN '⚠️' ELSE '❌' END ||
  ' {REVIEWER} Review — Score: **' || total_score || '/100**' || {NL} || {NL} ||
  CASE decision WHEN 'APPROVE' THEN '{scoring.VERDICTS['APPROVE'][1]}'
    WHEN 'REQUEST_CHANGES' THEN '{scoring.VERDICTS['REQUEST_CHANGES'][1]}' ELSE '{scoring.VERDICTS['REJECT'][1]}' END ||
  {NL} || {NL} || '| Threshold | Score |' || {NL} || '|-----------|-------|' || {NL} ||
  '| Auto-approve (≥ 70) | ' || CASE WHEN total_score >= 70 THEN '✅ Met' ELSE '❌ Not met' END || ' |' || {NL} ||
  '| Request changes (≥ 40) | ' || CASE WHEN total_score >= 40 THEN '✅ Met' ELSE '❌ Not met' END || ' |' || {NL} || {NL} ||
  CASE WHEN required_failed THEN '{scoring.CAP_NOTICE}' || {NL} || {NL} ELSE '' END ||
  '### Score Breakdown' || {NL} || {NL} || '| Component | Points |' || {NL} || '|-----------|--------|' || {NL} ||
  '| Static checklist (max 80) | ' || static_score || ' |' || {NL} || '| AI evaluation (max 20) | ' || ai_contribution || ' |' || {NL} ||
  '| **Total** | **' || (static_score + ai_contribution) || '** |' || {NL} || {NL} ||
  '### Checklist Results' || {NL} || {NL} || '| # | Check | Type | Result |' || {NL} || '|---|-------|------|--------|' || {NL} ||
  array_to_string([{_CHECK_ROWS}], {NL}) || {NL} || {NL} ||
  '### AI Content Evaluation' || {NL} || {NL} || '**Summary:** Averaged over ' || files || ' English Markdown file(s).' || {NL} || {NL} ||
  '| Criterion | Score |' || {NL} || '|-----------|-------|' || {NL} || '| Technical accuracy (max 25) | 0 |' || {NL} ||
  '| Clarity & readability (max 20) | 0 |' || {NL} || '| SEO quality (max 20) | 0 |' || {NL} ||
  '| Actionability (max 20) | 0 |' || {NL} || '| Content uniqueness (max 15) | 0 |' ||
  CASE WHEN issue_lines IS NULL THEN '' ELSE {NL} || {NL} || '**Issues:**' || issue_lines END || {NL} || {NL} ||
  '### Files Reviewed' || {NL} || file_lines || {NL} || {NL} ||
  '---' || {NL} || '{scoring.FOOTER.replace('{reviewer}', REVIEWER).split(chr(10))[1]}' AS comment
FROM dec LEFT JOIN iss USING ({_KEYS}) LEFT JOIN fil USING ({_KEYS})
"""

SHORT = f"""
WITH {_reviewed()}
SELECT {_KEYS}, '{REVIEWER} decision: **' || decision || '** (score: ' || total_score || '/100)' AS comment,
       CASE WHEN decision = 'APPROVE' THEN 'Auto-merge: Update ' || pr_number || ' (review score ' || total_score || '/100)' END
       AS commit_message
FROM dec
"""


def _ts(name: str, expr: str | None = None) -> str:
    return f"strftime({expr or name}, '%Y-%m-%d %H:%M:%S') AS {name}"


_STATE_COLS = f"{_KEYS}, product, decision, CAST(score AS BIGINT) AS score, {_ts('reviewed_at')}, {_ts('pr_updated_at')}"

_OUTCOMES = f"""{_reviewed()},
off AS (SELECT {_KEYS}, count(*) AS files_found FROM ({_MARKDOWN}) m GROUP BY {_KEYS}),
oc AS (SELECT s.*, d.decision, d.files, CASE WHEN s.pr_number % 3 <> 0 THEN coalesce(files_found, 0) ELSE 0 END AS files_found
       FROM ({_SELECTED}) s LEFT JOIN off USING ({_KEYS}) LEFT JOIN dec d USING ({_KEYS}))"""

_COUNTS = """count(*) AS found, count(*) FILTER (decision IS NULL) AS skipped, count(decision) AS reviewed,
 count(*) FILTER (decision = 'APPROVE') AS approved, count(*) FILTER (decision = 'REQUEST_CHANGES') AS request_changes,
 count(*) FILTER (decision = 'REJECT') AS rejected, CAST(0 AS BIGINT) AS merged, CAST(0 AS BIGINT) AS errors,
 CAST(sum(files_found) AS BIGINT) AS files_found, CAST(coalesce(sum(files), 0) AS BIGINT) AS files_reviewed"""

COUNTERS = f"""
WITH {_OUTCOMES}
SELECT product, {_COUNTS} FROM oc GROUP BY product
UNION ALL SELECT '(run)', {_COUNTS} FROM oc
"""

_USAGE = f"""SELECT product, product_ord, tokens, calls,
  CAST(sum(tokens) OVER (ORDER BY product_ord) AS BIGINT) AS tokens_so_far,
  CAST(sum(calls) OVER (ORDER BY product_ord) AS BIGINT) AS calls_so_far
FROM (SELECT product, product_ord, CAST(sum(total_tokens) AS BIGINT) AS tokens, count(*) AS calls
  FROM ({fx.AI_RESPONSE}) a JOIN ({fx.CHANGED_FILE}) f USING (doc_id) JOIN ({fx.CHANGE_SET}) c USING ({_KEYS})
  GROUP BY product, product_ord) u"""

_LABELS = """SELECT *, [x for x in ['Docs/net/', 'docs/java/', 'docs/net/python/'] if starts_with(path, x)] AS hit"""


def _platforms(keys: str, source: str, order: str) -> str:
    return f"""SELECT {keys}, coalesce(string_agg(label, ', ' ORDER BY first_at), 'All') AS platforms FROM (
  SELECT {keys}, label, min({order}) AS first_at FROM (
    SELECT *, unnest(CASE WHEN starts_with(path, 'Docs/net/') THEN [['1', '.NET']]
                          WHEN starts_with(path, 'docs/java/') THEN [['1', 'Java']]
                          WHEN starts_with(path, 'docs/net/python/') THEN [['1', '.NET'], ['2', 'Python']]
                          ELSE [['1', NULL]] END) AS lb FROM ({source}) s) e,
    LATERAL (SELECT lb[1] AS pos, lb[2] AS label) l GROUP BY {keys}, label) g
  GROUP BY {keys}"""


_FRESH_FILES = f"SELECT f.*, s.product, s.created_at FROM ({_MARKDOWN}) f JOIN ({_SELECTED}) s USING ({_KEYS}) WHERE pr_number % 3 <> 0"

METRICS = f"""
WITH {_OUTCOMES},
pf AS ({_platforms('product', _FRESH_FILES, "struct_pack(a := created_at, b := pr_number, c := file_ord, d := pos)")}),
us AS ({_USAGE}),
ct AS (SELECT product, {_COUNTS} FROM oc GROUP BY product)
SELECT '2024-02-15T00:00:00' AS timestamp, 'page reviewer' AS agent_name, 'docs team' AS agent_owner, 'pr_review' AS job_type,
  'page_review_' || product || '_20240215_000000' AS run_id,
  CASE WHEN files_reviewed = 0 THEN 'failure' ELSE 'success' END AS status, 'Pull Requests' AS item_name,
  CASE product WHEN 'words' THEN 'Acme.Words' WHEN 'viewer' THEN 'AcmeView.Viewer' ELSE 'Acme.Other-Tools2' END AS product,
  coalesce(platforms, 'All') AS platform,
  CASE product WHEN 'viewer' THEN 'acmeview.example' ELSE 'acme.example' END AS website, 'API Reference' AS website_section,
  files_found AS items_discovered, files_reviewed AS items_succeeded, errors AS items_failed,
  CAST(1500 AS BIGINT) AS run_duration_ms, tokens_so_far AS token_usage, calls_so_far AS api_calls_count
FROM ct JOIN us USING (product) LEFT JOIN pf USING (product)
"""

# Of the last calls, reviews fail where pr_number % 20 = 13, file lists where pr_number % 25 = 1, merges where pr_number % 8 = 4.
_SOUND = " AND pr_number % 20 <> 13 AND pr_number % 25 <> 1"

_OUTCOMES_WITH_ERRORS = f"""{_reviewed(also=_SOUND)},
off AS (SELECT {_KEYS}, count(*) AS files_found FROM ({_MARKDOWN}) m WHERE pr_number % 25 <> 1 GROUP BY {_KEYS}),
oc AS (SELECT s.*, d.decision, d.files, s.pr_number % 3 <> 0 AND s.pr_number % 20 = 13 AS failed,
         CASE WHEN s.pr_number % 3 <> 0 THEN coalesce(files_found, 0) ELSE 0 END AS files_found
       FROM ({_SELECTED}) s LEFT JOIN off USING ({_KEYS}) LEFT JOIN dec d USING ({_KEYS}))"""

_COUNTS_WITH_ERRORS = (
    _COUNTS.replace("decision IS NULL)", "decision IS NULL AND NOT failed)")
    .replace("CAST(0 AS BIGINT) AS merged", "count(*) FILTER (decision = 'APPROVE' AND pr_number % 8 <> 4) AS merged")
    .replace("CAST(0 AS BIGINT) AS errors", "count(*) FILTER (failed) AS errors")
)

COUNTERS_WITH_ERRORS = f"""
WITH {_OUTCOMES_WITH_ERRORS}
SELECT product, {_COUNTS_WITH_ERRORS} FROM oc GROUP BY product
UNION ALL SELECT '(run)', {_COUNTS_WITH_ERRORS} FROM oc
"""

FAILURES = f"""
SELECT repo_url, CAST(pr_number AS VARCHAR) AS pr_number, 'review' AS call, 'review refused' AS error FROM ({_SELECTED}) s WHERE pr_number % 3 <> 0 AND pr_number % 20 = 13
UNION ALL SELECT 'https://host.example/acme/cells', '', 'repository', 'no such repository'
"""

METRICS_ALL_PRODUCTS = f"""
WITH {_OUTCOMES_WITH_ERRORS},
pf AS ({_platforms('product', f"SELECT * FROM ({_FRESH_FILES}) x WHERE pr_number % 25 <> 1", "struct_pack(a := created_at, b := pr_number, c := file_ord, d := pos)")}),
us AS ({_USAGE}),
ct AS (SELECT product, {_COUNTS_WITH_ERRORS} FROM oc GROUP BY product),
pr AS (SELECT product, product_ord, CASE WHEN product = 'cells' THEN 1 ELSE 0 END AS lost FROM ({fx.PRODUCT}) x),
al AS (SELECT pr.product, coalesce(files_found, 0) AS files_found, coalesce(files_reviewed, 0) AS files_reviewed,
         coalesce(errors, 0) + lost AS errors, calls, platforms,
         CAST(sum(coalesce(tokens, 0)) OVER (ORDER BY pr.product_ord) AS BIGINT) AS tokens_so_far,
         CAST(sum(coalesce(calls, 0)) OVER (ORDER BY pr.product_ord) AS BIGINT) AS calls_so_far
       FROM pr LEFT JOIN ct USING (product) LEFT JOIN us USING (product) LEFT JOIN pf USING (product))
SELECT '2024-02-15T00:00:00' AS timestamp, 'page reviewer' AS agent_name, 'docs team' AS agent_owner, 'pr_review' AS job_type,
  'page_review_' || product || '_20240215_000000' AS run_id,
  CASE WHEN files_reviewed = 0 THEN 'failure' WHEN errors = 0 THEN 'success' ELSE 'partial_success' END AS status,
  'Pull Requests' AS item_name,
  CASE product WHEN 'words' THEN 'Acme.Words' WHEN 'viewer' THEN 'AcmeView.Viewer' WHEN 'cells' THEN 'Acme.Cells'
    WHEN 'slides' THEN 'Acme.Slides' ELSE 'Acme.Other-Tools2' END AS product,
  coalesce(platforms, 'All') AS platform,
  CASE product WHEN 'viewer' THEN 'acmeview.example' ELSE 'acme.example' END AS website, 'API Reference' AS website_section,
  CAST(files_found AS BIGINT) AS items_discovered, CAST(files_reviewed AS BIGINT) AS items_succeeded, CAST(errors AS BIGINT) AS items_failed,
  CAST(CASE WHEN calls IS NULL THEN 0 ELSE 1500 END AS BIGINT) AS run_duration_ms, tokens_so_far AS token_usage, calls_so_far AS api_calls_count
FROM al
"""

QUERIES = {
    "change_set_decisions": (change_set_decisions, DECISIONS),
    "change_set_issues": (change_set_issues, ISSUES),
    "change_set_issues_in_parts": (change_set_issues_in_parts, ISSUE_ROWS),
    "change_set_comment": (change_set_comment, COMMENT),
    "short_comments": (short_comments, SHORT),
    "change_set_decisions_model_off": (
        model_off,
        f"WITH {_reviewed(False)} SELECT {_KEYS}, total_score, decision FROM dec",
    ),
    "selected_change_sets": (
        selected_change_sets,
        f"SELECT {_KEYS}, title, {_ts('created_at')} FROM ({_SELECTED}) s",
    ),
    "not_reviewed": (not_reviewed, f"SELECT {_KEYS} FROM ({fx.CHANGE_SET}) c WHERE pr_number % 3 <> 0"),
    "needs_re_review": (
        needs_re_review,
        f"SELECT {_KEYS}, {_ts('updated_at')} FROM ({fx.CHANGE_SET}) c WHERE pr_number % 6 = 0",
    ),
    "skipped_change_sets": (
        skipped_change_sets,
        f"SELECT {_KEYS} FROM ({fx.CHANGE_SET}) c WHERE NOT EXISTS (SELECT 1 FROM ({_MARKDOWN}) m "
        "WHERE m.repo_url = c.repo_url AND m.pr_number = c.pr_number AND contains(m.path, 'docs/net'))",
    ),
    "limited_reviews": (
        limited_reviews,
        f"SELECT {_KEYS}, CAST(product_ord AS BIGINT) AS product_ord FROM ({fx.CHANGE_SET}) c WHERE pr_number % 3 <> 0 "
        "ORDER BY product_ord, created_at, pr_number LIMIT 20",
    ),
    "one_product": (one_product, f"SELECT {_KEYS} FROM ({fx.CHANGE_SET}) c WHERE product = 'viewer'"),
    "change_set_platforms": (
        change_set_platforms,
        _platforms(_KEYS, _MARKDOWN, "struct_pack(a := file_ord, b := pos)"),
    ),
    "review_upsert": (
        review_upsert,
        f"WITH {_reviewed()} SELECT {_STATE_COLS} FROM ({fx.REVIEW_STATE}) st UNION ALL "
        f"SELECT {_KEYS}, c.product, d.decision, CAST(d.total_score AS BIGINT), '{fx.NOW}', "
        f"strftime(c.updated_at, '%Y-%m-%d %H:%M:%S') FROM dec d JOIN ({fx.CHANGE_SET}) c USING ({_KEYS})",
    ),
    "review_overwrite": (
        review_overwrite,
        f"""SELECT {_KEYS}, product, CASE WHEN score >= 80 THEN 'REJECT' WHEN score >= 40 THEN 'APPROVE' ELSE decision END AS decision,
        CAST(score AS BIGINT) AS score, CASE WHEN score >= 80 THEN '2024-02-15 01:00:00' WHEN score >= 40 THEN '{fx.NOW}'
        ELSE strftime(reviewed_at, '%Y-%m-%d %H:%M:%S') END AS reviewed_at, {_ts('pr_updated_at')} FROM ({fx.REVIEW_STATE}) st""",
    ),
    "review_clear": (review_clear, f"SELECT {_STATE_COLS} FROM ({fx.REVIEW_STATE}) st WHERE decision <> 'REJECT'"),
    "reviews_since": (
        reviews_since,
        f"SELECT {_STATE_COLS} FROM (SELECT * FROM ({fx.REVIEW_STATE}) st WHERE reviewed_at >= timestamp '2024-02-09 00:00:00') r",
    ),
    "review_stats": (
        review_stats,
        f"""SELECT count(*) FILTER (decision = 'APPROVE') AS approve, count(*) FILTER (decision = 'REQUEST_CHANGES') AS request_changes,
        count(*) FILTER (decision = 'REJECT') AS reject, count(*) AS total FROM ({fx.REVIEW_STATE}) st""",
    ),
    "ai_usage": (
        ai_usage,
        f"SELECT product, tokens, calls, tokens_so_far, calls_so_far FROM ({_USAGE}) u",
    ),
    "run_counters": (run_counters, COUNTERS),
    "run_metrics": (run_metrics, METRICS),
    "run_failures": (run_failures, FAILURES),
    "run_counters_with_errors": (run_counters_with_errors, COUNTERS_WITH_ERRORS),
    "run_metrics_all_products": (run_metrics_all_products, METRICS_ALL_PRODUCTS),
    "review_state_with_errors": (
        review_state_with_errors,
        f"WITH {_reviewed(also=_SOUND)} SELECT {_STATE_COLS} FROM ({fx.REVIEW_STATE}) st UNION ALL "
        f"SELECT {_KEYS}, c.product, d.decision, CAST(d.total_score AS BIGINT), '{fx.NOW}', "
        f"strftime(c.updated_at, '%Y-%m-%d %H:%M:%S') FROM dec d JOIN ({fx.CHANGE_SET}) c USING ({_KEYS})",
    ),
}
