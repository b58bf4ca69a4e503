"""Scores and decisions: from check results to a verdict per change set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.text import let, title_case
from leafwright.operators.checks import CheckDef
from leafwright.operators.groups import split_in_order

CHANGE_SET_KEYS = ("repo_url", "pr_number")

# Caps, thresholds and weights as shipped.
REQUIRED_CAP = 49
TOTAL_CAP = 100
APPROVE_AT = 70
REQUEST_CHANGES_AT = 40
MODEL_WEIGHT = 20

# The issue text of a file that got no model answer.
NO_MODEL_ISSUE = "AI evaluation could not be completed."

# Label of each decision, without its prefix.
DECISION_LABELS = {"APPROVE": "approved", "REQUEST_CHANGES": "needs-changes", "REJECT": "rejected"}

# Whole-number fields of a model answer.
MODEL_SCORES = ("score", "technical_accuracy", "clarity", "seo_quality", "actionability", "uniqueness")

MODEL_TYPE = (
    "struct<score int, technical_accuracy int, clarity int, seo_quality int, actionability int,"
    " uniqueness int, summary string, strengths array<string>, issues array<string>,"
    " recommendation string>"
)


# --- one file ----------------------------------------------------------------


def score_columns(
    checklist: Sequence[CheckDef], cap: int = REQUIRED_CAP, prefix: str = "passed_"
) -> tuple[Column, Column]:
    """``(required_failed, static_score)`` from check columns."""
    weights = [F.when(F.col(prefix + c.id), c.weight).otherwise(0) for c in checklist]
    failed = [~F.col(prefix + c.id) for c in checklist if c.type == "required"]
    raw = reduce(lambda a, b: a + b, weights, F.lit(0))
    required_failed = reduce(lambda a, b: a | b, failed, F.lit(False))
    return required_failed, F.when(required_failed, F.least(raw, F.lit(cap))).otherwise(raw)


def static_score(results: Column, cap: int = REQUIRED_CAP) -> Column:
    """Score from a result array: weights of passed checks, capped on a required failure."""
    raw = F.aggregate(results, F.lit(0), lambda acc, r: acc + F.when(r["passed"], r["weight"]).otherwise(0))
    return F.when(required_failure(results), F.least(raw, F.lit(cap))).otherwise(raw)


def required_failure(results: Column) -> Column:
    """True when a required check of a result array failed."""
    return F.exists(results, lambda r: (r["type"] == "required") & ~r["passed"])


def decide_total(static: Column, model: Column | None = None, cap: int = TOTAL_CAP) -> Column:
    """Total score of static and model points."""
    return F.least(F.lit(cap), static + (F.lit(0) if model is None else model))


def decide(total: Column, approve: int = APPROVE_AT, request_changes: int = REQUEST_CHANGES_AT) -> Column:
    """Decision for a total score."""
    return (
        F.when(total >= approve, "APPROVE")
        .when(total >= request_changes, "REQUEST_CHANGES")
        .otherwise("REJECT")
    )


def parse_model_answer(body: Column) -> Column:
    """Read a model answer: whole numbers with default 0, lists, a known recommendation.

    NULL when the text is not a JSON object.
    """
    none = F.array().cast("array<string>")

    def read(v: Column) -> Column:
        def texts(name: str) -> Column:
            return F.coalesce(F.try_variant_get(v, f"$.{name}", "array<string>"), none).alias(name)

        def score(name: str) -> Column:
            # Points are clamped later, so a number beyond the range of int may be cut to it.
            n = F.coalesce(F.try_variant_get(v, f"$.{name}", "bigint"), F.lit(0))
            return F.greatest(F.least(n, F.lit((1 << 31) - 1)), F.lit(-(1 << 31))).cast("int")

        known = F.try_variant_get(v, "$.recommendation", "string")
        fields = [
            *[score(n).alias(n) for n in MODEL_SCORES],
            F.coalesce(F.try_variant_get(v, "$.summary", "string"), F.lit("")).alias("summary"),
            texts("strengths"),
            texts("issues"),
            F.when(known.isin(*DECISION_LABELS), known).otherwise("REQUEST_CHANGES").alias("recommendation"),
        ]
        # A text with another JSON value at the top has no fields.
        return F.when(F.schema_of_variant(v).startswith("OBJECT"), F.struct(*fields))

    return let(F.try_parse_json(body), read).cast(MODEL_TYPE)


def fallback_answer(issue: str | None = NO_MODEL_ISSUE) -> Column:
    """The answer of a model that is off or failed."""
    none = F.array().cast("array<string>")
    return F.struct(
        *[F.lit(0).alias(n) for n in MODEL_SCORES],
        F.lit("").alias("summary"),
        none.alias("strengths"),
        (F.array(F.lit(issue)) if issue else none).alias("issues"),
        F.lit("REQUEST_CHANGES").alias("recommendation"),
    ).cast(MODEL_TYPE)


def model_points(score: Column, weight: int = MODEL_WEIGHT) -> Column:
    """Points of a model score: clamped to 0..100, weighted, half-even rounding."""
    clamped = F.greatest(F.lit(0), F.least(F.lit(100), score))
    return F.bround(clamped / 100 * weight).cast("int")


def with_model_answers(
    files: DataFrame,
    answers: DataFrame | None,
    on: Sequence[str],
    weight: int = MODEL_WEIGHT,
    ai_issue_when_disabled: bool = True,
) -> DataFrame:
    """Add ``ai``, ``ai_score`` and ``ai_contribution`` to files.

    ``answers`` holds ``on`` and ``body``; None means the model is off.  A file
    without a readable answer gets the fallback, with no points.
    """
    if answers is None:
        issue = NO_MODEL_ISSUE if ai_issue_when_disabled else None
        with_ai = files.withColumn("ai", fallback_answer(issue)).withColumn("_points", F.lit(0))
    else:
        # The answer is read before the join, on its own narrow rows.
        read = answers.select(*on, parse_model_answer(F.col("body")).alias("_read"))
        with_ai = (
            files.join(read, list(on), "left")
            .withColumn("ai", F.coalesce("_read", fallback_answer()))
            .withColumn("_points", F.when(F.col("_read").isNull(), 0).otherwise(model_points(F.col("_read.score"), weight)))
            .drop("_read")
        )
    return with_ai.select(
        *files.columns,
        "ai",
        F.col("ai.score").alias("ai_score"),
        F.col("_points").alias("ai_contribution"),
    )


def file_issues(results: Column, ai: Column) -> Column:
    """Descriptions of failed checks, then the issues of the model."""
    failed = F.transform(F.filter(results, lambda r: ~r["passed"]), lambda r: r["description"])
    return F.concat(failed, ai["issues"])


# --- one change set ----------------------------------------------------------


def change_set_scores(
    files: DataFrame,
    checklist: Sequence[CheckDef],
    keys: Sequence[str] = CHANGE_SET_KEYS,
    cap: int = REQUIRED_CAP,
) -> DataFrame:
    """Scores and merged checks of each change set.

    ``files`` needs ``check_results``, ``required_failed``, ``static_score``,
    ``ai_score`` and ``ai_contribution``.  A check holds for the set when it
    holds for all files.  All buffers have a fixed size, so one aggregate with
    map-side combine does it, however many files one set has.
    """
    passed = [
        F.bool_and(F.get("check_results", F.lit(i))["passed"]).alias(f"_p{i}") for i in range(len(checklist))
    ]
    sums = files.groupBy(*keys).agg(
        F.count("*").alias("files"),
        F.sum("static_score").alias("_static"),
        F.sum("ai_contribution").alias("_points"),
        F.sum("ai_score").alias("_ai"),
        F.bool_or("required_failed").alias("required_failed"),
        *passed,
    )

    def mean(col: str) -> Column:
        return F.bround(F.col(col) / F.col("files")).cast("int")

    merged = F.array(
        *[
            F.struct(
                F.lit(c.id).alias("id"),
                F.lit(c.description).alias("description"),
                F.col(f"_p{i}").alias("passed"),
                F.lit(c.weight).alias("weight"),
                F.lit(c.type).alias("type"),
            )
            for i, c in enumerate(checklist)
        ]
    )
    capped = F.when(F.col("required_failed"), F.least(mean("_static"), F.lit(cap))).otherwise(mean("_static"))
    return sums.select(
        *keys,
        "files",
        "required_failed",
        capped.alias("static_score"),
        mean("_points").alias("ai_contribution"),
        mean("_ai").alias("ai_score"),
        merged.alias("check_results"),
    )


def with_decision(
    scores: DataFrame, approve: int = APPROVE_AT, request_changes: int = REQUEST_CHANGES_AT, label_prefix: str = ""
) -> DataFrame:
    """Add ``total_score``, ``decision``, ``label`` and ``event``."""
    return (
        scores.withColumn("total_score", decide_total(F.col("static_score"), F.col("ai_contribution")))
        .withColumn("decision", decide(F.col("total_score"), approve, request_changes))
        .withColumn("label", decision_label(F.col("decision"), label_prefix))
        .withColumn("event", review_event(F.col("decision")))
    )


def decision_label(decision: Column, prefix: str = "") -> Column:
    """Label that a decision puts on its change set."""
    out = None
    for name, label in DECISION_LABELS.items():
        test = decision == name
        out = F.when(test, prefix + label) if out is None else out.when(test, prefix + label)
    return out


def review_event(decision: Column) -> Column:
    """Review event of a decision."""
    return F.when(decision == "APPROVE", "APPROVE").otherwise("REQUEST_CHANGES")


def merge_candidates(reviews: DataFrame, reviewer: str, auto_merge: bool = True) -> DataFrame:
    """Approved change sets with the text of their merge commit; none when merging is off."""
    text = F.format_string("Auto-merge: %s (%s score %d/100)", F.col("title"), F.lit(reviewer), F.col("total_score"))
    return reviews.filter(F.lit(auto_merge) & (F.col("decision") == "APPROVE")).withColumn("commit_message", text)


def merge_issues(
    files: DataFrame, keys: Sequence[str] = CHANGE_SET_KEYS, issues: str = "issues", size: int = 5000
) -> DataFrame:
    """Distinct issues of each change set, sorted, ``size`` to a part."""
    rows = files.select(*keys, F.explode(issues).alias("issue")).distinct()
    parts = split_in_order(rows, keys, ["issue"], size)
    return parts.groupBy(*keys, "part").agg(F.sort_array(F.collect_list("issue")).alias("issues"))


# --- review text -------------------------------------------------------------

# The wording of a review.
VERDICTS = {
    "APPROVE": ("✅", "This PR meets quality standards and is approved for merge."),
    "REQUEST_CHANGES": (
        "⚠️",
        "This PR needs some improvements before it can be merged. "
        "Please address the issues listed below and push an update.",
    ),
    "REJECT": (
        "❌",
        "This PR has significant quality issues that must be resolved. "
        "Please review the checklist failures and AI feedback carefully.",
    ),
}
MET, NOT_MET = "✅ Met", "❌ Not met"
PASSED, FAILED, WARNED = "✅", "❌", "⚠️"
CAP_NOTICE = (
    "> ⚠️ **Required check failed in one or more files** — static score capped at 49 "
    "regardless of other passing files. Resolve all ❌ required checks below to lift the cap."
)
CRITERIA = (
    ("Technical accuracy (max 25)", "technical_accuracy"),
    ("Clarity & readability (max 20)", "clarity"),
    ("SEO quality (max 20)", "seo_quality"),
    ("Actionability (max 20)", "actionability"),
    ("Content uniqueness (max 15)", "uniqueness"),
)
FOOTER = (
    "---\n*This review was generated automatically by the **{reviewer}**. "
    "Static checks evaluate frontmatter, structure, and content completeness. "
    "The AI evaluation assesses overall quality and SEO effectiveness.*"
)


def _text(*parts: Column | str | int) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def review_header(
    decision: Column, total: Column, reviewer: str, approve: int = APPROVE_AT, request_changes: int = REQUEST_CHANGES_AT
) -> Column:
    """Headline, verdict and thresholds."""

    def choose(i: int) -> Column:
        col = F.when(decision == "APPROVE", VERDICTS["APPROVE"][i])
        return col.when(decision == "REQUEST_CHANGES", VERDICTS["REQUEST_CHANGES"][i]).otherwise(VERDICTS["REJECT"][i])

    def met(limit: int) -> Column:
        return F.when(total >= limit, MET).otherwise(NOT_MET)

    return _text(
        "## ", choose(0), f" {reviewer} Review — Score: **", total, "/100**\n\n", choose(1),
        "\n\n| Threshold | Score |\n|-----------|-------|\n",
        f"| Auto-approve (≥ {approve}) | ", met(approve), " |\n",
        f"| Request changes (≥ {request_changes}) | ", met(request_changes), " |",
    )


def score_breakdown(static: Column, points: Column) -> Column:
    """Score table; its total is not cut to 100."""
    return _text(
        "### Score Breakdown\n\n| Component | Points |\n|-----------|--------|\n",
        "| Static checklist (max 80) | ", static, " |\n| AI evaluation (max 20) | ", points,
        " |\n| **Total** | **", static + points, "** |",
    )


def checklist_table(results: Column) -> Column:
    """One table row per check."""
    icon = lambda r: (
        F.when(r["passed"], PASSED).when(r["type"] == "required", FAILED).otherwise(WARNED)
    )
    rows = F.transform(
        results,
        lambda r, i: _text("| ", i + 1, " | ", r["description"], " | ", title_case(r["type"]), " | ", icon(r), " |"),
    )
    head = "### Checklist Results\n\n| # | Check | Type | Result |\n|---|-------|------|--------|\n"
    return F.when(F.size(results) > 0, _text(head, F.array_join(rows, "\n"))).otherwise("")


def model_section(ai: Column) -> Column:
    """Model answer as text; empty without a summary."""
    bullets = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat(F.lit("\n- "), x)), "")
    listed = lambda title, xs: F.when(
        F.size(xs) > 0, _text(f"\n\n**{title}:**", bullets(xs))
    ).otherwise("")
    rows = [part for name, field in CRITERIA for part in (f"\n| {name} | ", ai[field], " |")]
    text = _text(
        "### AI Content Evaluation\n\n**Summary:** ", ai["summary"],
        "\n\n| Criterion | Score |\n|-----------|-------|", *rows,
        listed("Strengths", ai["strengths"]), listed("Issues", ai["issues"]),
    )
    return F.when(F.coalesce(ai["summary"], F.lit("")) == "", "").otherwise(text)


def file_text(path: Column, issues: Column) -> Column:
    """Issues of one file."""
    lines = F.array_join(F.transform(issues, lambda x: F.concat(F.lit("\n  - "), x)), "")
    return _text("\n**`", path, "`**", F.when(F.size(issues) > 0, lines).otherwise("\n  - No issues found"))


FILES_HEADING = "### Files Reviewed"
ISSUES_HEADING = "### AI Content Evaluation"


def short_comment(decision: Column, total: Column, reviewer: str) -> Column:
    """Review text when the long one is off."""
    return F.format_string(reviewer.replace("%", "%%") + " decision: **%s** (score: %d/100)", decision, total)


def review_comments(
    reviews: DataFrame,
    files: DataFrame,
    reviewer: str,
    keys: Sequence[str] = CHANGE_SET_KEYS,
    approve: int = APPROVE_AT,
    request_changes: int = REQUEST_CHANGES_AT,
    files_per_part: int = 500,
    issues_per_part: int = 5000,
) -> DataFrame:
    """Review text of each change set: ``keys, part, comment``.

    ``reviews`` is :func:`with_decision` output; ``files`` has ``file_ord``,
    ``path`` and ``issues``.  Part 0 is the review.  A set with more files or
    issues than one part takes goes on in further parts, so no text grows with
    the data and none is cut.
    """
    keys = list(keys)
    issue_parts = merge_issues(files, keys, size=issues_per_part).withColumnRenamed("issues", "part_issues")
    # Files are numbered inside their set, so a range of numbers is one part.
    numbered = files.withColumn("part", F.floor(F.col("file_ord") / files_per_part))
    file_parts = numbered.groupBy(*keys, "part").agg(
        F.array_sort(
            F.collect_list(F.struct("file_ord", file_text(F.col("path"), F.col("issues")).alias("text")))
        ).alias("_files")
    )
    parts = file_parts.join(issue_parts, [*keys, "part"], "full").withColumn(
        "_files_text",
        F.when(
            F.col("_files").isNotNull(),
            _text(FILES_HEADING, "\n", F.array_join(F.transform("_files", lambda f: f["text"]), "\n")),
        ).otherwise(""),
    )
    head = parts.filter("part = 0").withColumnsRenamed({"part_issues": "_issues"})
    none = F.array().cast("array<string>")
    ai = F.struct(
        _text("Averaged over ", F.col("files"), " English Markdown file(s).").alias("summary"),
        *[F.lit(0).alias(f) for _, f in CRITERIA],
        none.alias("strengths"),
        F.coalesce("_issues", none).alias("issues"),
    )
    first = (
        reviews.join(head, keys, "left")
        .withColumn("_ai_text", ai)
        .select(
            *keys,
            F.lit(0).cast("bigint").alias("part"),
            _join_parts(
                review_header(F.col("decision"), F.col("total_score"), reviewer, approve, request_changes),
                F.when(F.col("required_failed"), CAP_NOTICE).otherwise(""),
                score_breakdown(F.col("static_score"), F.col("ai_contribution")),
                checklist_table(F.col("check_results")),
                model_section(F.col("_ai_text")),
                F.coalesce("_files_text", F.lit("")),
                F.lit(FOOTER.replace("{reviewer}", reviewer)),
            ).alias("comment"),
        )
    )
    more_issues = F.when(
        F.col("part_issues").isNotNull(),
        _text(
            ISSUES_HEADING,
            "\n\n**Issues:**",
            F.array_join(F.transform("part_issues", lambda x: F.concat(F.lit("\n- "), x)), ""),
        ),
    ).otherwise("")
    further = parts.filter("part > 0").select(
        *keys, "part", _join_parts(more_issues, F.col("_files_text")).alias("comment")
    )
    return first.unionByName(further)


def _join_parts(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), "\n\n")
