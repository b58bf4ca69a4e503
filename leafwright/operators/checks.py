"""Page checks: one boolean column each, run together by :func:`run_checks`.

Every check reads the same few columns (``content``, ``fm``, ``body``,
``patch`` and, for the YAML checks, ``yaml``), so a page is taken apart once.
No check raises; a NULL result counts as failed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.frontmatter import fm_field, fm_has, parse_yaml, with_frontmatter
from leafwright.functions.pages import headings, hunks, internal_links
from leafwright.functions.text import LINE_BREAK, LINE_BREAK_CHAR, WHITESPACE, let, pattern, pytrim, split_lines, unquote_value
from leafwright.operators.words import CheckRules


@dataclass(frozen=True)
class PageColumns:
    """The columns a check may read."""

    content: Column
    fm: Column
    body: Column
    patch: Column
    yaml: Column
    rules: CheckRules


@dataclass(frozen=True)
class CheckDef:
    """One line of a checklist."""

    id: str
    description: str
    weight: int
    type: str = "recommended"


# The shipped checklist, in order.
DEFAULT_CHECKLIST = (
    CheckDef("frontmatter_present", "YAML frontmatter block (--- ... ---) is present", 10, "required"),
    CheckDef("frontmatter_has_title", "Frontmatter contains a non-empty 'title' field", 10, "required"),
    CheckDef(
        "frontmatter_has_layout",
        "Frontmatter contains a 'layout' field (reference-single or reference-home)",
        10,
        "required",
    ),
    CheckDef("frontmatter_has_categories", "Frontmatter contains a 'categories' field", 5, "required"),
    CheckDef(
        "no_broken_html_tags", "No unclosed HTML tags (<xref>, <pre>, <code>) in body", 15, "required"
    ),
    CheckDef(
        "tables_well_formed", "Markdown tables have consistent column counts across rows", 10, "required"
    ),
    CheckDef(
        "no_raw_docfx_artifacts", "No raw DocFX artifacts (<xref:...> or uid: references) in body", 10, "required"
    ),
    CheckDef("frontmatter_has_description", "Frontmatter 'description' field is at least 30 characters", 5),
    CheckDef("frontmatter_has_summary", "Frontmatter contains a non-empty 'summary' field", 5),
    CheckDef("code_examples_present", "At least one fenced code block is present", 5),
    CheckDef("assembly_version_present", "Body references an assembly version (Assembly: *.dll)", 5),
    CheckDef("internal_links_format", "Internal links use path format, not .md extensions", 5),
    CheckDef("content_not_empty", "Body content is at least 50 characters", 5),
)

CHECKS: dict[str, Callable[[PageColumns], Column]] = {}
YAML_CHECKS = frozenset({"frontmatter_yaml_valid", "tags_format_valid", "tags_relevance"})


def check(check_id: str):
    """Put a check in the registry."""

    def add(fn: Callable[[PageColumns], Column]):
        CHECKS[check_id] = fn
        return fn

    return add


def register_check(rules: CheckRules, check_id: str, fn: Callable[[Column, Column, Column], Column]) -> CheckRules:
    """Rules with a user check: ``fn(content, fm, body)`` gives a boolean column.

    The check belongs to these rules alone: whoever does not pass them on does not see it.  A user check goes before a
    shipped one of the same id.
    """
    return replace(rules, user_checks=(*rules.user_checks, (check_id, fn)))


def _any_word(words: Sequence[str], bounded: bool = True) -> str:
    joined = "|".join(words)
    return pattern(rf"\b({joined})\b" if bounded else joined)


def _blank(fm: Column) -> Column:
    return fm.isNull() | (fm == "")


# --- presence and length of frontmatter fields -------------------------------


@check("frontmatter_present")
def _(p: PageColumns) -> Column:
    return p.fm.isNotNull()


@check("frontmatter_has_title")
def _(p: PageColumns) -> Column:
    return fm_has(p.fm, "title")


@check("frontmatter_has_description")
def _(p: PageColumns) -> Column:
    return F.length(unquote_value(fm_field(p.fm, "description"))) >= p.rules.min_description


@check("frontmatter_has_url")
def _(p: PageColumns) -> Column:
    return fm_has(p.fm, "(?:url|linktitle)")


@check("frontmatter_has_layout")
def _(p: PageColumns) -> Column:
    return fm_has(p.fm, "layout")


@check("frontmatter_has_categories")
def _(p: PageColumns) -> Column:
    return fm_has(p.fm, "categories", "")


@check("frontmatter_has_summary")
def _(p: PageColumns) -> Column:
    return pytrim(fm_field(p.fm, "summary")) != ""


@check("frontmatter_values_safe")
def _(p: PageColumns) -> Column:
    key_value = pattern(r"^\s*\w[\w-]*\s*:\s*(.+)$")
    values = F.transform(split_lines(p.fm), lambda line: pytrim(F.regexp_extract(line, key_value, 1)))

    def quoted(v: Column, q: str) -> Column:
        return v.startswith(q) & v.endswith(q)

    unsafe = F.exists(values, lambda v: v.contains(":") & ~quoted(v, '"') & ~quoted(v, "'"))
    return _blank(p.fm) | ~unsafe


@check("seo_title_length")
def _(p: PageColumns) -> Column:
    size = F.length(unquote_value(fm_field(p.fm, "seoTitle")))
    return size.between(p.rules.min_seo_title, p.rules.max_seo_title)


@check("description_length")
def _(p: PageColumns) -> Column:
    size = F.length(unquote_value(fm_field(p.fm, "description")))
    return size.between(p.rules.min_description, p.rules.max_description)


# --- words in frontmatter fields ---------------------------------------------


@check("seo_keywords_in_title")
def _(p: PageColumns) -> Column:
    return F.lower(fm_field(p.fm, "title")).rlike(_any_word(p.rules.title_verbs))


@check("seo_keywords_in_description")
def _(p: PageColumns) -> Column:
    text = F.lower(fm_field(p.fm, "description"))
    lists = (p.rules.brands, p.rules.format_words, p.rules.language_words)
    return reduce(lambda a, b: a | b, [text.rlike(_any_word(words)) for words in lists if words])


@check("description_has_call_to_action")
def _(p: PageColumns) -> Column:
    return F.lower(fm_field(p.fm, "description")).rlike(_any_word(p.rules.description_verbs))


@check("seo_title_has_brand")
def _(p: PageColumns) -> Column:
    return F.lower(fm_field(p.fm, "seoTitle")).rlike(_any_word(p.rules.brands, bounded=False))


@check("no_keyword_stuffing")
def _(p: PageColumns) -> Column:
    fields = [F.lower(unquote_value(fm_field(p.fm, key))) for key in ("seoTitle", "description")]
    words = F.regexp_extract_all(
        F.concat_ws(" ", *fields), F.lit(pattern(r"\b[a-z]{4,}\b")), F.lit(0)
    )
    # In sorted order a word that comes too often equals the one n places on.
    n = p.rules.word_repeats
    often = let(
        F.array_sort(words),
        lambda o: F.exists(
            F.zip_with(o, F.slice(o, F.lit(n + 1), F.size(o)), lambda a, b: a.eqNullSafe(b)), lambda same: same
        ),
    )
    return _blank(p.fm) | ~often


# --- YAML --------------------------------------------------------------------


@check("frontmatter_yaml_valid")
def _(p: PageColumns) -> Column:
    return p.yaml["valid"]


@check("tags_format_valid")
def _(p: PageColumns) -> Column:
    tags = p.yaml["tags"]
    well_formed = (
        (p.yaml["tags_kind"] == "list")
        & F.size(tags).between(p.rules.min_tags, p.rules.max_tags)
        & p.yaml["tags_all_text"]
        & F.forall(tags, lambda t: t.rlike(r"^[a-z0-9][a-z0-9-]*\n?\z"))
    )
    return (
        F.when(_blank(p.fm), True)
        .when(~p.yaml["valid"], False)
        .when(p.yaml["tags_kind"].isNull(), True)
        .otherwise(well_formed)
    )


@check("tags_relevance")
def _(p: PageColumns) -> Column:
    tags = p.yaml["tags"]
    joined = F.lower(F.array_join(tags, " "))
    both = joined.rlike(_any_word(p.rules.brands, bounded=False)) & joined.rlike(
        _any_word(p.rules.tag_words, bounded=False)
    )
    return F.when(_blank(p.fm) | tags.isNull() | (F.size(tags) == 0), True).otherwise(both)


# --- body --------------------------------------------------------------------


@check("no_placeholder_text")
def _(p: PageColumns) -> Column:
    return ~p.content.rlike(pattern("|".join(p.rules.placeholders), "i"))


@check("content_not_empty")
def _(p: PageColumns) -> Column:
    return F.length(pytrim(p.body)) >= p.rules.min_body


@check("adequate_word_count")
def _(p: PageColumns) -> Column:
    word = pattern(r"[^\s\x1C-\x1F#*`\[\]()>_~]+")
    return F.regexp_count(p.body, F.lit(word)) >= p.rules.min_words


@check("proper_heading_structure")
def _(p: PageColumns) -> Column:
    return p.body.rlike(pattern(r"^##\s+", "m"))


@check("code_examples_present")
def _(p: PageColumns) -> Column:
    return p.body.contains("```")


@check("hugo_shortcodes_closed")
def _(p: PageColumns) -> Column:
    close = pattern(p.rules.wrapper_close, "i")
    after = F.element_at(F.split(p.body, close, -1), -1)
    rest = F.regexp_replace(after, pattern(p.rules.back_to_top), "")
    return ~p.body.rlike(close) | (pytrim(rest) == "")


@check("no_translation_artifacts")
def _(p: PageColumns) -> Column:
    opening = pattern(p.rules.wrapper_open, "i")
    before = F.get(F.split(p.body, opening, 2), 0)
    return ~p.body.rlike(opening) | (pytrim(before) == "")


@check("headings_translated")
def _(p: PageColumns) -> Column:
    found = headings(p.body)
    no_code = F.regexp_replace(p.body, pattern(r"```.*?```", "s"), "")
    no_shortcodes = F.regexp_replace(no_code, pattern(r"\{\{<.*?>\}\}"), "")
    visible = F.translate(no_shortcodes, WHITESPACE, "")
    foreign = F.length(F.regexp_replace(visible, r"[\x00-\x7F]+", ""))
    # The cheap tests come first; the share is only worked out when it matters.
    return (
        (F.size(found) == 0)
        | F.exists(found, lambda h: h.rlike(r"[^\x00-\x7F]"))
        | (visible == "")
        | (foreign < F.length(visible) * p.rules.translated_share)
    )


@check("internal_links_valid_format")
def _(p: PageColumns) -> Column:
    def local(link: Column) -> Column:
        return link.startswith("/") | link.startswith("../") | link.endswith(".md")

    return (
        ~p.body.contains("](")
        | F.forall(internal_links(p.body), local)
        | p.body.rlike(pattern(p.rules.relref))
    )


@check("internal_links_format")
def _(p: PageColumns) -> Column:
    return ~(p.body.contains("](") & F.exists(internal_links(p.body), lambda x: x.endswith(".md")))


@check("no_broken_html_tags")
def _(p: PageColumns) -> Column:
    names = "|".join(p.rules.closed_tags)
    tags = F.transform(
        F.regexp_extract_all(
            p.body, F.lit(pattern(rf"<(?:{names})[\s>]|</(?:{names})\s*>", "i")), F.lit(0)
        ),
        F.lower,
    )

    def count(start: str) -> Column:
        return F.size(F.filter(tags, lambda t: t.startswith(start)))

    closed = [count(f"<{name}") <= count(f"</{name}") for name in p.rules.closed_tags]
    return ~p.body.contains("<") | reduce(lambda a, b: a & b, closed)


@check("tables_well_formed")
def _(p: PageColumns) -> Column:
    def pipes(row: Column) -> Column:
        return F.length(row) - F.length(F.replace(row, F.lit("|"), F.lit("")))

    row = pattern(r"^\|.+\|$", "m")
    if not p.rules.tables_per_block:
        rows = F.regexp_extract_all(p.body, F.lit(row), F.lit(0))
        return ~p.body.contains("|") | (F.size(F.array_distinct(F.transform(rows, pipes))) <= 1)
    # Neighbouring rows must agree; any other line parts two tables.
    widths = F.transform(F.split(p.body, "\n", -1), lambda s: F.when(s.rlike(row), pipes(s)))
    broken = let(
        widths,
        lambda w: F.exists(
            F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.coalesce(a != b, F.lit(False))), lambda x: x
        ),
    )
    return ~p.body.contains("|") | ~broken


@check("no_raw_docfx_artifacts")
def _(p: PageColumns) -> Column:
    uid_line = p.body.contains("uid") & p.body.rlike(pattern(r"^\s*uid\s*:", "m"))
    return ~p.body.contains("<xref:") & ~uid_line


@check("assembly_version_present")
def _(p: PageColumns) -> Column:
    return p.body.rlike(pattern(r"Assembly\s*:.*\.dll", "i"))


# Whitespace inside a line, and the page up to its second fence line.
_INLINE = r"[ \t\x1F\xA0\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]*"
_TO_FENCE = rf"(?s)^{_INLINE}---{_INLINE}(?:{LINE_BREAK}).*?(?<={LINE_BREAK_CHAR}){_INLINE}---{_INLINE}(?={LINE_BREAK_CHAR}|\z)"


@check("body_unchanged")
def _(p: PageColumns) -> Column:
    # Lines are counted in front of the closing fence only; the body is not cut to lines.
    to_fence = F.regexp_extract(p.content, _TO_FENCE, 0)
    fm_end = F.when(to_fence != "", F.regexp_count(to_fence, F.lit(LINE_BREAK)) + 1)
    inside = F.forall(hunks(p.patch), lambda h: h["start"] + h["count"] - 1 <= fm_end)
    return F.when(p.patch.isNull() | (p.patch == ""), True).otherwise(fm_end.isNotNull() & inside)


# --- the checklist as a whole ------------------------------------------------


def needs_yaml(checklist: Sequence[CheckDef]) -> bool:
    """True when some check of the list reads YAML (costs a Python worker)."""
    return any(c.id in YAML_CHECKS for c in checklist)


def _page_columns(df: DataFrame, content: str, rules: CheckRules) -> PageColumns:
    patch = F.col("patch") if "patch" in df.columns else F.lit(None).cast("string")
    yaml = F.col("_yaml") if "_yaml" in df.columns else F.lit(None)
    return PageColumns(F.col(content), F.col("fm"), F.col("body"), patch, yaml, rules)


def add_check_columns(
    df: DataFrame,
    checklist: Sequence[CheckDef] = DEFAULT_CHECKLIST,
    content: str = "content",
    rules: CheckRules = CheckRules(),
    prefix: str = "passed_",
) -> DataFrame:
    """Add one boolean column per check.

    An id without a check passes.  Frontmatter checks and body checks go to two
    selects, which keeps the generated code of each small.
    """
    kept = df.columns
    df = with_frontmatter(df, content)
    if needs_yaml(checklist):
        df = df.withColumn("_yaml", parse_yaml(F.col("fm")))
    page = _page_columns(df, content, rules)

    own = {check_id: fn for check_id, fn in rules.user_checks}

    def column(c: CheckDef) -> Column:
        rule = CHECKS.get(c.id)
        if c.id in own:
            rule = lambda p: own[c.id](p.content, p.fm, p.body)
        passed = F.lit(True) if rule is None else F.coalesce(rule(page), F.lit(False))
        return passed.alias(prefix + c.id)

    def on_fm(c: CheckDef) -> bool:
        return c.id.startswith(("frontmatter_", "seo_", "description_", "tags_")) or c.id == "no_keyword_stuffing"

    df = df.select("*", *[column(c) for c in checklist if on_fm(c)])
    df = df.select("*", *[column(c) for c in checklist if not on_fm(c)])
    return df.select(*kept, *[prefix + c.id for c in checklist])


def check_results(checklist: Sequence[CheckDef], prefix: str = "passed_") -> Column:
    """Check columns as one ordered array of results."""
    return F.array(
        *[
            F.struct(
                F.lit(c.id).alias("id"),
                F.lit(c.description).alias("description"),
                F.col(prefix + c.id).alias("passed"),
                F.lit(c.weight).alias("weight"),
                F.lit(c.type).alias("type"),
            )
            for c in checklist
        ]
    )


def run_checks(
    df: DataFrame,
    checklist: Sequence[CheckDef] = DEFAULT_CHECKLIST,
    content: str = "content",
    rules: CheckRules = CheckRules(),
    required_cap: int = 49,
) -> DataFrame:
    """Add ``check_results``, ``required_failed`` and ``static_score`` to pages."""
    from leafwright.operators.scoring import score_columns

    kept = df.columns
    flags = add_check_columns(df, checklist, content, rules)
    required_failed, static_score = score_columns(checklist, required_cap)
    return flags.select(
        *kept,
        check_results(checklist).alias("check_results"),
        required_failed.alias("required_failed"),
        static_score.alias("static_score"),
    )


def check_pass_rates(
    df: DataFrame, checklist: Sequence[CheckDef], group: Sequence[str] = (), prefix: str = "passed_"
) -> DataFrame:
    """Passed and seen pages of each check, from check columns: one aggregate, no explode of pages."""
    counts = df.groupBy(*group).agg(
        F.count("*").alias("pages"),
        *[F.count_if(prefix + c.id).alias(c.id) for c in checklist],
    )
    return counts.unpivot(
        [*group, "pages"], [c.id for c in checklist], "check_id", "passed"
    )
