"""Projections of page text, page names and page addresses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafwright.functions.text import (
    html_to_text,
    pattern,
    pytrim,
    single_line,
    truncate_text,
)

# Path segment and the platform it stands for.
PLATFORMS = {
    "net": ".NET",
    "java": "Java",
    "python": "Python",
    "cpp": "C++",
    "nodejs": "Node.js",
    "android": "Android",
    "ios": "iOS",
    "php": "PHP",
    "ruby": "Ruby",
    "go": "Go",
    "javascript": "JavaScript",
    "rust": "Rust",
}


def page_title(content: Column) -> Column:
    """Text of the first ``# <a ..>`` heading, tags dropped; ``''`` when none."""
    found = pytrim(F.regexp_extract(content, pattern(r"^#\s+<a.*?>\s*(.+)", "m"), 1))
    return pytrim(F.regexp_replace(found, pattern(r"<.*?>"), ""))


def raw_description(content: Column) -> Column:
    """Text after the assembly line up to a fence or the end, examples dropped."""
    no_examples = F.regexp_replace(content, pattern(r"<example>.*?</example>", "s"), "")
    found = F.regexp_extract(
        no_examples, pattern(r"Assembly:.*?\.dll\s*\n\n\s*(.*?)(?=\n```|\z)", "ms"), 1
    )
    return pytrim(found)


def description_line(raw: Column) -> Column:
    """A raw description on one line, markup kept."""
    return pytrim(single_line(raw))


def summary_line(raw: Column) -> Column:
    """A raw description on one line as plain text."""
    return pytrim(single_line(html_to_text(raw)))


def page_description(content: Column) -> Column:
    """The description of a page on one line, markup kept."""
    return description_line(raw_description(content))


def page_summary(content: Column) -> Column:
    """The description of a page on one line as plain text."""
    return summary_line(raw_description(content))


def page_category(title: Column) -> Column:
    """First word of the title, ``other`` when there is none."""
    first = F.get(F.split(pytrim(title), pattern(r"\s+"), 2), 0)
    return F.coalesce(F.nullif(first, F.lit("")), F.lit("other"))


def lang_from_url(url: Column, default: str = "en") -> Column:
    """Two-letter segment in first or second place of the path."""
    code = F.lower(F.regexp_extract(url, r"https?://[^/]+(?:/[^/]+)?/([a-zA-Z]{2})/", 1))
    return F.coalesce(F.nullif(code, F.lit("")), F.lit(default))


def platform_labels(path: Column, platforms: Mapping[str, str] | None = None) -> Column:
    """Platform labels of one path, in path order, as an array."""
    pairs = (platforms or PLATFORMS).items()
    table = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    parts = F.split(F.lower(F.replace(path, F.lit("\\"), F.lit("/"))), "/", -1)
    labels = F.transform(parts, lambda s: F.try_element_at(table, s))
    return F.array_distinct(F.filter(labels, lambda x: x.isNotNull()))


def platforms(paths: Column, labels: Mapping[str, str] | None = None) -> Column:
    """Distinct platform labels of many paths, first seen first; ``All`` when none."""
    found = F.array_distinct(F.flatten(F.transform(paths, lambda p: platform_labels(p, labels))))
    return F.coalesce(F.nullif(F.array_join(found, ", "), F.lit("")), F.lit("All"))


def family_slug(name: Column, prefix: str = "Acme.") -> Column:
    """Short lower-case family name."""
    return F.lower(F.replace(name, F.lit(prefix), F.lit("")))


def repo_name(url: Column) -> Column:
    """``owner/name`` of a repository address."""
    parts = F.split(F.rtrim(url, F.lit("/")), "/", -1)
    return F.array_join(F.slice(parts, -2, 2), "/")


def headings(body: Column) -> Column:
    """Markdown heading texts."""
    return F.regexp_extract_all(body, F.lit(pattern(r"^#{1,6}\s+(.+)", "m")), F.lit(1))


def internal_links(body: Column) -> Column:
    """Targets of Markdown links that do not start with ``http``.

    Only the target is taken, so a match may start at the last bracket in
    front of it.  Each bracket is then looked at up to the next one and not to
    the end of its line, which may be a megabyte of data.
    """
    return F.regexp_extract_all(body, F.lit(pattern(r"\[[^\[\n]*?\]\(((?!http)[^)]+)\)")), F.lit(1))


def hunks(patch: Column) -> Column:
    """New-side line ranges of a unified patch; the count is 1 when not given."""
    hunk = F.lit(pattern(r"^@@ -\d+(?:,\d+)? \+(\d+)(?:,(\d+))? @@", "m"))
    starts = F.regexp_extract_all(patch, hunk, F.lit(1))
    counts = F.regexp_extract_all(patch, hunk, F.lit(2))
    return F.zip_with(
        starts,
        counts,
        lambda s, c: F.struct(
            s.cast("bigint").alias("start"),
            F.coalesce(F.nullif(c, F.lit("")).cast("bigint"), F.lit(1)).alias("count"),
        ),
    )


def is_home_page(name: Column, family_name: Column, special: Mapping[str, str] | None = None) -> Column:
    """True for the page named after its family (``special`` gives odd file stems)."""
    stem = family_name
    for family, other in (special or {}).items():
        stem = F.when(family_name == family, F.lit(other)).otherwise(stem)
    return name == F.concat(stem, F.lit(".md"))


def output_name(name: Column, family_name: Column, special: Mapping[str, str] | None = None) -> Column:
    """File name of the clean page: the home page of a family is ``_index.md``."""
    return F.when(is_home_page(name, family_name, special), F.lit("_index.md")).otherwise(name)


def run_id(product: Column, ts: Column, prefix: str = "page_review") -> Column:
    """``{prefix}_{product or all}_{time}``."""
    name = F.coalesce(F.nullif(product, F.lit("")), F.lit("all"))
    return F.concat_ws("_", F.lit(prefix), name, F.date_format(ts, "yyyyMMdd_HHmmss"))


def review_prompt(content: Column, template: str, limit: int = 4000) -> Column:
    """Fill a prompt template: ``{content}`` once cut, doubled braces made single."""
    shown = truncate_text(content, limit)
    before, _, after = template.partition("{content}")
    plain = [t.replace("{{", "{").replace("}}", "}") for t in (before, after)]
    return F.concat(F.lit(plain[0]), shown, F.lit(plain[1]))

