"""Queries over pages: checks, review, text of markup."""

from __future__ import annotations

from functools import partial, reduce
from html.entities import name2codepoint

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.functions.pages import lang_from_url, review_prompt
from leafwright.functions.text import html_to_text
from leafwright.operators.checks import (
    CHECKS,
    DEFAULT_CHECKLIST,
    CheckDef,
    add_check_columns,
    check_pass_rates,
    run_checks,
)
from leafwright.operators.scoring import decide, fallback_answer, model_points, parse_model_answer
from leafwright.operators.words import CheckRules
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import fixture, pages, tables

ALL_CHECKS = tuple(CheckDef(i, i, 1) for i in CHECKS)
PROMPT = "Rate this page.\n\n{content}\n\nAnswer as {{\"score\": <0-100>}}."


def page_static_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipped checklist, score and decision of every page."""
    return static_review(spark, sf_dir, DEFAULT_CHECKLIST)


def static_review(spark: SparkSession, sf_dir: str, checklist) -> DataFrame:
    """Score and decision of every page by a checklist."""
    reviewed = run_checks(pages(spark, sf_dir).select("doc_id", "path", "content"), checklist)
    failed = F.transform(F.filter("check_results", lambda r: ~r["passed"]), lambda r: r["id"])
    return reviewed.select(
        "doc_id",
        "path",
        "required_failed",
        F.col("static_score").cast("bigint").alias("static_score"),
        decide(F.col("static_score")).alias("decision"),
        F.array_join(failed, ",").alias("failed_checks"),
    )


def one_check(check_id: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check on every page."""
    df = fixture(spark, sf_dir, "changed_file" if check_id == "body_unchanged" else "page")
    cols = [c for c in ("doc_id", "content", "patch") if c in df.columns]
    if check_id == "body_unchanged":
        df = df.filter("content IS NOT NULL")
    flags = add_check_columns(df.select(*cols), [CheckDef(check_id, check_id, 1)])
    return flags.select("doc_id", F.col(f"passed_{check_id}").alias("passed"))


def all_check_pass_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass counts of all checks by language, good pages told apart."""
    tables(spark, sf_dir, "labels")
    plain = [c for c in ALL_CHECKS if c.id != "body_unchanged"]
    # Checks first: contents end where they are read, only flags are joined.
    flags = add_check_columns(pages(spark, sf_dir).select("doc_id", "lang", "content"), plain).drop("content")
    flags = flags.join(spark.table("labels").select("doc_id", "quality"), "doc_id", "left")
    flags = flags.withColumn("quality", F.coalesce("quality", F.lit(-1)).cast("bigint"))
    return check_pass_rates(flags, plain, ["lang", "quality"])


def table_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table check with each table on its own."""
    flags = add_check_columns(
        pages(spark, sf_dir).select("doc_id", "content"),
        [CheckDef("tables_well_formed", "", 1)],
        rules=CheckRules(tables_per_block=True),
    )
    return flags.select("doc_id", F.col("passed_tables_well_formed").alias("passed"))


def user_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A check that a user registered, and an id nobody registered."""
    from leafwright.operators.checks import register_check

    rules = register_check(CheckRules(), "has_section", lambda content, fm, body: body.contains("## Section"))
    flags = add_check_columns(
        pages(spark, sf_dir).select("doc_id", "content"),
        [CheckDef("has_section", "", 1), CheckDef("nobody_knows", "", 1)],
        rules=rules,
    )
    return flags.select("doc_id", "passed_has_section", "passed_nobody_knows")


def html_unclosed_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unclosed paragraphs of raw web pages."""
    tables(spark, sf_dir, "pages")
    flags = add_check_columns(
        spark.table("pages").select("page_id", F.col("html").alias("content")),
        [CheckDef("no_broken_html_tags", "", 1)],
        rules=CheckRules(closed_tags=("p",)),
    )
    return flags.select("page_id", F.col("passed_no_broken_html_tags").alias("passed"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text of raw web pages."""
    tables(spark, sf_dir, "pages")
    return spark.table("pages").select("page_id", html_to_text(F.col("html")).alias("text"))


def language_of_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the language in their address."""
    tables(spark, sf_dir, "pages")
    return spark.table("pages").groupBy(lang_from_url(F.col("url")).alias("lang")).agg(F.count("*").alias("n"))


def ai_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers read, repaired and weighted."""
    read = fixture(spark, sf_dir, "ai_response").select("doc_id", parse_model_answer(F.col("body")).alias("_read"))
    ai = read.withColumn("ai", F.coalesce("_read", fallback_answer()))
    return ai.select(
        "doc_id",
        F.col("_read").isNull().alias("failed"),
        F.col("ai.score").cast("bigint").alias("score"),
        F.col("ai.clarity").cast("bigint").alias("clarity"),
        F.col("ai.summary").alias("summary"),
        F.array_join("ai.strengths", ",").alias("strengths"),
        F.array_join("ai.issues", ",").alias("issues"),
        F.col("ai.recommendation").alias("recommendation"),
        F.when(F.col("_read").isNull(), 0).otherwise(model_points(F.col("ai.score"))).cast("bigint").alias("points"),
    )


def review_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt text of every page."""
    return pages(spark, sf_dir).select("doc_id", review_prompt(F.col("content"), PROMPT).alias("prompt"))


# --- the same in SQL ---------------------------------------------------------

HEAD = r"(?s)^---\s*\n(.*?)\n---\s*\n?"


def parted(source: str) -> str:
    """CTEs ``pg`` and ``fb``: pages, and pages with ``fm`` and ``body``."""
    return f"""pg AS ({source}),
sp AS (SELECT *, regexp_extract(content, '{HEAD}', 0) AS head FROM pg),
fb AS (SELECT *, CASE WHEN head <> '' THEN regexp_extract(content, '{HEAD}', 1) END AS fm,
              substr(content, length(head) + 1) AS body FROM sp)"""


def _field(key: str) -> str:
    return rf"nullif(regexp_extract(fm, '(?m)^\s*{key}\s*:\s*(.+)', 1), '')"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def _unquoted(text: str) -> str:
    return f"trim({_strip(text)}, chr(34) || chr(39))"


def _has(key: str, value: str = r"\s*.+") -> str:
    return rf"regexp_matches(fm, '(?m)^\s*{key}\s*:{value}')"


def _words(words: tuple[str, ...]) -> str:
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(words) + r")([^\p{L}\p{N}_]|$)"


_R = CheckRules()
_LINKS = r"[x for x in regexp_extract_all(body, '\[[^\n]*?\]\(([^)]+)\)', 1) if not starts_with(x, 'http')]"
_ROWS = r"regexp_extract_all(body, '(?m)^\|.+\|$')"
_TAGS_BAD_YAML = "(doc_id % 29 = 0 AND doc_id % 13 <> 0 AND doc_id % 31 <> 0)"
_VISIBLE = (
    r"regexp_replace(regexp_replace(regexp_replace(body, '(?s)```.*?```', '', 'g'), "
    r"'\{\{<.*?>\}\}', '', 'g'), '\s+', '', 'g')"
)
_STUFFED = (
    "lower(concat_ws(' ', " + _unquoted(_field("seoTitle")) + ", " + _unquoted(_field("description")) + "))"
)


def _tags_closed(names: tuple[str, ...]) -> str:
    count = lambda p: f"len(regexp_extract_all(body, '(?i){p}'))"
    return " AND ".join(f"{count(f'<{n}[' + chr(92) + 's>]')} <= {count(f'</{n}' + chr(92) + 's*>')}" for n in names)


CHECK_SQL = {
    "frontmatter_present": "fm IS NOT NULL",
    "frontmatter_has_title": _has("title"),
    "frontmatter_has_description": f"length({_unquoted(_field('description'))}) >= 50",
    "no_placeholder_text": r"NOT regexp_matches(content, '(?i)\bTODO\b|\bFIXME\b|\[PLACEHOLDER\]|Lorem ipsum|\[INSERT\b')",
    "content_not_empty": f"length({_strip('body')}) >= 100",
    "hugo_shortcodes_closed": (
        r"NOT regexp_matches(body, '(?i)\{\{<\s*/blocks/products/pf/main-wrap-class\s*>\}\}') OR "
        r"regexp_matches(body, '(?is)\{\{<\s*/blocks/products/pf/main-wrap-class\s*>\}\}\s*"
        r"(?:\{\{<\s*blocks/products/products-backtop-button\s*>\}\}\s*)*$')"
    ),
    "no_translation_artifacts": (
        r"NOT regexp_matches(body, '(?i)\{\{<\s*blocks/products/pf/main-wrap-class\s*>\}\}') OR "
        r"regexp_matches(body, '(?is)^\s*\{\{<\s*blocks/products/pf/main-wrap-class\s*>\}\}')"
    ),
    "headings_translated": (
        rf"CASE WHEN {_VISIBLE} = '' THEN true "
        rf"WHEN length(regexp_replace({_VISIBLE}, '[\x00-\x7F]', '', 'g')) / CAST(length({_VISIBLE}) AS DOUBLE) < 0.05 THEN true "
        r"WHEN len(regexp_extract_all(body, '(?m)^#{1,6}\s+(.+)', 1)) = 0 THEN true "
        r"ELSE regexp_matches(array_to_string(regexp_extract_all(body, '(?m)^#{1,6}\s+(.+)', 1), ' '), '[^\x00-\x7F]') END"
    ),
    "frontmatter_values_safe": (
        "fm IS NULL OR len([v for v in [trim(regexp_extract(line, '^\\s*\\w[\\w-]*\\s*:\\s*(.+)$', 1)) "
        "for line in string_split(fm, chr(10))] if contains(v, ':') "
        "and not (starts_with(v, chr(34)) and ends_with(v, chr(34)))]) = 0"
    ),
    "frontmatter_has_url": _has("(url|linktitle)"),
    "adequate_word_count": (
        r"len([w for w in string_split(regexp_replace(regexp_replace(body, '[#*`\[\]()>_~]', ' ', 'g'), '\s+', ' ', 'g'), ' ') "
        r"if w <> '']) >= 200"
    ),
    "proper_heading_structure": r"regexp_matches(body, '(?m)^##\s+')",
    "seo_keywords_in_title": f"regexp_matches(lower({_field('title')}), '{_words(_R.title_verbs)}')",
    "seo_keywords_in_description": (
        f"regexp_matches(lower({_field('description')}), '{_words(_R.brands + _R.format_words + ('java', 'python'))}')"
    ),
    "code_examples_present": "contains(body, '```')",
    "internal_links_valid_format": (
        rf"len({_LINKS}) = 0 OR regexp_matches(body, '\{{\{{<\s*relref\s+') OR "
        f"len([y for y in {_LINKS} if not (starts_with(y, '/') or starts_with(y, '../') or ends_with(y, '.md'))]) = 0"
    ),
    "frontmatter_has_layout": _has("layout"),
    "frontmatter_has_categories": _has("categories", ""),
    "no_broken_html_tags": _tags_closed(_R.closed_tags),
    "tables_well_formed": f"len(list_distinct([length(r) - length(replace(r, '|', '')) for r in {_ROWS}])) <= 1",
    "no_raw_docfx_artifacts": r"NOT contains(body, '<xref:') AND NOT regexp_matches(body, '(?m)^\s*uid\s*:')",
    "frontmatter_has_summary": f"{_strip(_field('summary'))} <> ''",
    "assembly_version_present": r"regexp_matches(body, '(?i)Assembly\s*:.*\.dll')",
    "internal_links_format": f"len([y for y in {_LINKS} if ends_with(y, '.md')]) = 0",
    "seo_title_length": f"length({_unquoted(_field('seoTitle'))}) BETWEEN 30 AND 60",
    "description_length": f"length({_unquoted(_field('description'))}) BETWEEN 50 AND 160",
    "no_keyword_stuffing": (
        "fm IS NULL OR coalesce(list_max([len([v for v in ws if v = w]) for w in ws]), 0) <= 2"
    ),
    "seo_title_has_brand": f"regexp_matches(lower({_field('seoTitle')}), 'acme')",
    "description_has_call_to_action": f"regexp_matches(lower({_field('description')}), '{_words(_R.description_verbs)}')",
    "frontmatter_yaml_valid": f"doc_id % 11 <> 0 AND NOT {_TAGS_BAD_YAML}",
    "tags_format_valid": (
        f"CASE WHEN doc_id % 11 = 0 THEN true WHEN {_TAGS_BAD_YAML} THEN false WHEN doc_id % 12 = 0 THEN true "
        "ELSE doc_id % 12 BETWEEN 3 AND 10 AND doc_id % 17 <> 0 END"
    ),
    "tags_relevance": (
        f"CASE WHEN doc_id % 11 = 0 OR {_TAGS_BAD_YAML} OR doc_id % 12 = 0 THEN true ELSE doc_id % 12 >= 3 END"
    ),
}

_STUFF_WORDS = (
    "[x for x in string_split(regexp_replace(" + _STUFFED + r", '[^\p{L}\p{N}_]+', ' ', 'g'), ' ') "
    "if regexp_full_match(x, '[a-z]{4,}')]"
)


def check_query(check_id: str) -> str:
    test = CHECK_SQL[check_id]
    extra = f", {_STUFF_WORDS} AS ws" if check_id == "no_keyword_stuffing" else ""
    return (
        f"WITH {parted(fx.PAGE)}, w AS (SELECT *{extra} FROM fb) "
        f"SELECT doc_id, coalesce({test}, false) AS passed FROM w"
    )


BODY_UNCHANGED = f"""
WITH pg AS (SELECT * FROM ({fx.CHANGED_FILE}) cf WHERE content IS NOT NULL),
ln AS (SELECT doc_id, patch, [trim(x) for x in string_split(content, chr(10))] AS lines FROM pg),
fe AS (SELECT doc_id, patch, CASE WHEN lines[1] = '---' THEN nullif(list_position(lines[2:], '---'), 0) + 1 END AS fm_end FROM ln),
hk AS (SELECT *, regexp_extract_all(patch, '(?m)^@@ -\\d+(?:,\\d+)? \\+(\\d+)(?:,(\\d+))? @@', 1) AS st,
              regexp_extract_all(patch, '(?m)^@@ -\\d+(?:,\\d+)? \\+(\\d+)(?:,(\\d+))? @@', 2) AS ct FROM fe),
en AS (SELECT doc_id, patch, fm_end, list_max([CAST(st[i] AS BIGINT) + coalesce(try_cast(ct[i] AS BIGINT), 1) - 1
              for i in range(1, len(st) + 1)]) AS last_line FROM hk)
SELECT doc_id, CASE WHEN coalesce(patch, '') = '' THEN true WHEN fm_end IS NULL THEN false
               ELSE coalesce(last_line <= fm_end, true) END AS passed FROM en
"""

_ACTIVE = [(c.id, c.weight, c.type) for c in DEFAULT_CHECKLIST]


def scored(source: str) -> str:
    """CTEs up to ``sc``: active checks ``c_<id>``, ``required_failed``, ``static_score``."""
    flags = ", ".join(f"coalesce({CHECK_SQL[i]}, false) AS c_{i}" for i, _, _ in _ACTIVE)
    raw = " + ".join(f"CASE WHEN c_{i} THEN {w} ELSE 0 END" for i, w, _ in _ACTIVE)
    bad = " OR ".join(f"NOT c_{i}" for i, _, t in _ACTIVE if t == "required")
    return f"""{parted(source)},
fl AS (SELECT *, {flags} FROM fb),
rw AS (SELECT *, {raw} AS raw_score, ({bad}) AS required_failed FROM fl),
sc AS (SELECT *, CAST(CASE WHEN required_failed THEN least(raw_score, 49) ELSE raw_score END AS BIGINT) AS static_score FROM rw)"""


def decision_sql(score: str) -> str:
    return f"CASE WHEN {score} >= 70 THEN 'APPROVE' WHEN {score} >= 40 THEN 'REQUEST_CHANGES' ELSE 'REJECT' END"


STATIC_REVIEW = f"""
WITH {scored(fx.PAGE)}
SELECT doc_id, path, required_failed, static_score, {decision_sql('static_score')} AS decision,
       concat_ws(',', {', '.join(f"CASE WHEN NOT c_{i} THEN '{i}' END" for i, _, _ in _ACTIVE)}) AS failed_checks
FROM sc
"""


def _pass_rates() -> str:
    ids = [c.id for c in ALL_CHECKS if c.id != "body_unchanged"]
    flags = ", ".join(f"coalesce({CHECK_SQL[i]}, false) AS c_{i}" for i in ids)
    rows = " UNION ALL ".join(
        f"SELECT lang, quality, count(*) AS pages, '{i}' AS check_id, count(*) FILTER (c_{i}) AS passed "
        "FROM fl GROUP BY lang, quality"
        for i in ids
    )
    return (
        f"WITH {parted(fx.PAGE)}, w AS (SELECT fb.*, CAST(coalesce(quality, -1) AS BIGINT) AS quality, {_STUFF_WORDS} AS ws FROM fb LEFT JOIN labels l ON l.doc_id = fb.doc_id), "
        f"fl AS (SELECT lang, quality, {flags.replace('doc_id %', 'w.doc_id %')} FROM w) {rows}"
    )


TABLE_BLOCKS = f"""
WITH {parted(fx.PAGE)},
ln AS (SELECT doc_id, string_split(body, chr(10)) AS lines FROM fb),
wd AS (SELECT doc_id, [CASE WHEN regexp_full_match(s, '\\|.+\\|') THEN length(s) - length(replace(s, '|', '')) END for s in lines] AS ws FROM ln)
SELECT doc_id, coalesce(list_bool_and([coalesce(ws[i] = ws[i + 1], true) for i in range(1, len(ws))]), true) AS passed FROM wd
"""

# The named entities of HTML 4, the ampersand last, with or without its semicolon.
_ENTITIES = reduce(
    lambda sql, name: f"replace({sql}, '&{name};', chr({name2codepoint[name]}))",
    [name for name in name2codepoint if name != "amp"],
    "replace(replace(t, '&#39;', ''''), '&apos;', '''')",
)

HTML_TEXT = r"""
WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g') AS t FROM pages),
b AS (SELECT page_id, regexp_replace(t, '<[A-Za-z/!?][^>]*>', '', 'g') AS t FROM a)
SELECT page_id, {ENTITIES} AS text FROM b
""".replace("{ENTITIES}", f"regexp_replace({_ENTITIES}, '&amp;?', '&', 'g')")

AI_NORMALISED = f"""
WITH a AS ({fx.AI_RESPONSE}),
n AS (SELECT doc_id, doc_id % 13 = 0 AS failed, CASE WHEN doc_id % 13 = 0 THEN 0 ELSE true_score END AS score FROM a)
SELECT doc_id, failed, CAST(score AS BIGINT) AS score,
       CAST(CASE WHEN failed THEN 0 ELSE doc_id % 21 END AS BIGINT) AS clarity,
       CASE WHEN failed THEN '' ELSE 'fine' END AS summary,
       CASE WHEN failed THEN '' ELSE 's' || CAST(doc_id % 3 AS VARCHAR) END AS strengths,
       CASE WHEN failed THEN 'AI evaluation could not be completed.'
            ELSE 'i' || CAST(doc_id % 4 AS VARCHAR) || ',i' || CAST(doc_id % 7 AS VARCHAR) END AS issues,
       CASE WHEN failed OR doc_id % 3 = 0 THEN 'REQUEST_CHANGES' ELSE 'APPROVE' END AS recommendation,
       CAST(CASE WHEN failed THEN 0 ELSE round_even(greatest(0, least(100, score)) / CAST(100 AS DOUBLE) * 20, 0) END AS BIGINT) AS points
FROM n
"""

QUERIES = {
    "page_static_review": (page_static_review, STATIC_REVIEW),
    **{
        f"check_{i}": (partial(one_check, i), BODY_UNCHANGED if i == "body_unchanged" else check_query(i))
        for i in CHECKS
    },
    "check_pass_rates": (all_check_pass_rates, _pass_rates()),
    "check_table_blocks": (table_blocks, TABLE_BLOCKS),
    "check_registered_by_user": (
        user_check,
        f"WITH {parted(fx.PAGE)} SELECT doc_id, contains(body, '## Section') AS passed_has_section, "
        "true AS passed_nobody_knows FROM fb",
    ),
    "html_unclosed_tags": (
        html_unclosed_tags,
        f"SELECT page_id, {_tags_closed(('p',)).replace('body', 'html')} AS passed FROM pages",
    ),
    "html_text": (html_text, HTML_TEXT),
    "lang_from_url": (
        language_of_urls,
        "SELECT coalesce(nullif(lower(regexp_extract(url, 'https?://[^/]+(?:/[^/]+)?/([a-zA-Z]{2})/', 1)), ''), 'en') AS lang, "
        "count(*) AS n FROM pages GROUP BY 1",
    ),
    "ai_normalised": (ai_normalised, AI_NORMALISED),
    "review_prompts": (
        review_prompts,
        f"""SELECT doc_id, 'Rate this page.' || chr(10) || chr(10) ||
        CASE WHEN length(content) > 4000 THEN substr(content, 1, 4000) || chr(10) || '...[truncated]' ELSE content END ||
        chr(10) || chr(10) || 'Answer as {{"score": <0-100>}}.' AS prompt FROM ({fx.PAGE}) pg""",
    ),
}
