"""Clean-up of generated Markdown pages: links, tables, examples, frontmatter.

All steps are columns over one page row; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.pages import (
    description_line,
    family_slug,
    is_home_page,
    output_name,
    page_category,
    page_title,
    raw_description,
    summary_line,
)
from leafwright.functions.text import (
    drop_first_line,
    html_to_text,
    let,
    pattern,
    percent_decode,
    pytrim,
    quote_regex,
    replace_matches,
)

# List sections, in the order they are turned to tables, with the name of one item.
SECTIONS = {
    "Structs": "Struct",
    "Delegates": "Delegate",
    "Classes": "Class",
    "Interfaces": "Interface",
    "Enums": "Enum",
    "Namespaces": "Namespace",
}

# Patterns of one item of a list section.
ITEM_LINK = r"\[(.*?)\]\((.*?)\)"
ITEM_PLAIN = ITEM_LINK + r"(?:\s*\n\s*(.*?))?(?=\n\s*\[|\n###|\z)"
ITEM_DELEGATE = ITEM_LINK + r"(?:\s*\n(?!\s*\[)(.*?))?(?=\n\s*\[|\n###|\z)"

# Markup around code in generated pages.
CODE_OPEN, CODE_CLOSE = '<pre><code class="lang-csharp">', "</code></pre>"

LAYOUT_HOME, LAYOUT_SINGLE = "reference-home", "reference-single"


def replace_xref(content: Column) -> Column:
    """Put the decoded target in the place of each ``<xref href="..">`` and all it holds.

    The element ends before the next ``<xref`` if it is not closed till then; then only its tag goes.
    """
    tag = pattern(r"<xref\b[^>]*>(?:[^<]*+(?:<(?!/?xref\b)[^<]*+)*+</xref\s*>)?", "i")
    href = pattern(r"""^<xref\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", "i")
    return replace_matches(
        content, tag, lambda m: percent_decode(F.concat(*[F.regexp_extract(m, href, i) for i in (1, 2, 3)]))
    )


def rewrite_links(content: Column, family_name: Column, family: Column) -> Column:
    """Internal links to ``/family/page`` form; the link of the own namespace goes to the family home."""
    own = F.concat(
        F.lit(r"(?U)Namespace: \["), quote_regex(family_name), F.lit(r"\]\(\s*"), quote_regex(family_name), F.lit(r"\.md\s*\)")
    )
    home = F.concat(F.lit("Namespace: ["), family_name, F.lit("](/"), family, F.lit("/)"))
    # A name is a regular expression of its own in each row, so it is made once; in the new text ``\\`` and ``$`` stand for
    # themselves.  Without a name the text stays.
    literal = F.replace(F.replace(home, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    content = let(content, lambda text: F.coalesce(F.regexp_replace(text, own, F.coalesce(literal, F.lit(""))), text))
    # From the last bracket before the target: earlier ones that never close cost nothing and stay as they are.
    link = pattern(r"\[([^\[\]]+)\]\((?!https?://)([^)]+\.md)\)")

    def moved(m: Column) -> Column:
        text, target = F.regexp_extract(m, link, 1), F.lower(F.regexp_extract(m, link, 2))
        page = F.ltrim(F.replace(target, F.lit(".md"), F.lit("")), F.lit("/"))
        start = F.when(target.startswith(family), "/").otherwise(F.concat(F.lit("/"), family, F.lit("/")))
        return F.concat(F.lit("["), text, F.lit("]("), start, page, F.lit(")"))

    return replace_matches(content, link, moved)


def add_version(content: Column, family_name: Column, version: Column, idempotent: bool = False) -> Column:
    """Put the version behind ``Assembly: {family}.dll``."""
    name = F.concat(F.lit("Assembly: "), family_name, F.lit(".dll"))
    marked = F.concat(name, F.lit(" ("), version, F.lit(")"))
    if idempotent:
        content = F.replace(content, marked, name)
    return F.replace(content, name, marked)


def section_to_table(content: Column, section: str, family: Column, anchored: bool = False) -> Column:
    """Turn a list section to a two-column table.

    ``anchored`` looks for the heading at the start of a line; as shipped it
    may also sit inside a deeper heading.
    """
    level = "###" if section == "Namespaces" else "##"
    start = r"(?<![^\n])" if anchored else ""
    heading = f"{level} {section}\n\n"
    block = pattern(rf"{start}{level} {section}\n\n(.*?)(?=\n###|\n##|\z)", "s")
    if section == "Namespaces":
        item = F.lit(pattern(ITEM_LINK))
    else:
        item = F.lit(pattern(ITEM_DELEGATE if section == "Delegates" else ITEM_PLAIN, "s"))
    head = f"## {section}\n\n| {SECTIONS[section]} Name | Description |\n| --- | --- |\n"

    def row(name: Column, link: Column, note: Column) -> Column:
        target = F.replace(F.lower(link), F.lit(".md"), F.lit(""))
        return F.concat(
            F.lit("| ["), name, F.lit("](/"), family, F.lit("/"), target, F.lit("/) | "), note, F.lit(" |\n")
        )

    def table(inside: Column) -> Column:
        group = lambda i: F.regexp_extract_all(inside, item, F.lit(i))
        named = F.zip_with(group(1), group(2), lambda n, t: F.struct(n.alias("name"), t.alias("link")))
        if section == "Namespaces":
            rows = F.transform(named, lambda r: row(r["name"], r["link"], F.lit("")))
        else:
            note = lambda n: F.replace(pytrim(n), F.lit("\n"), F.lit(" "))
            rows = F.zip_with(named, group(3), lambda r, n: row(r["name"], r["link"], note(n)))
        return F.concat(F.lit(head), F.array_join(rows, ""))

    def changed(text: Column) -> Column:
        swap = lambda found: F.when(found == "", text).otherwise(
            F.replace(text, found, let(replace_xref(F.regexp_extract(found, block, 1)), table))
        )
        return F.when(text.contains(heading), let(F.regexp_extract(text, block, 0), swap)).otherwise(text)

    return let(content, changed)


def format_examples(content: Column, example_text_first: bool = False) -> Column:
    """Code blocks in markup to Markdown code.

    The rule for examples with text finds nothing when it runs last, as
    shipped; ``example_text_first`` runs it before the rule that would take its
    code.
    """
    fence = lambda lang, code: f"```{lang}\n{code}\n```"
    both = pattern(rf"{CODE_OPEN}\[C#\]\s*(.*?)\s*\[Visual Basic\]\s*(.*?)\s*{CODE_CLOSE}", "s")
    content = F.regexp_replace(content, both, "\n" + fence("csharp", "$1") + "\n" + fence("vb", "$2"))
    example = pattern(rf"<example>{CODE_OPEN}\s*(.*?)\s*{CODE_CLOSE}</example>", "s")
    content = F.regexp_replace(content, example, "\n" + fence("csharp", "$1"))
    with_text = pattern(rf"<example>\s*(.*?)\s*{CODE_OPEN}\s*(.*?)\s*{CODE_CLOSE}\s*</example>", "s")
    text_to_fence = lambda c: F.regexp_replace(c, with_text, "$1\n\n" + fence("csharp", "$2"))
    if example_text_first:
        content = text_to_fence(content)
    block = pattern(rf"{CODE_OPEN}(.*?){CODE_CLOSE}", "s")

    def code_block(m: Column) -> Column:
        code = pytrim(F.regexp_extract(m, block, 1))
        code = F.when(code.startswith("[C#]"), pytrim(F.substring(code, 5, 1 << 30))).otherwise(code)
        fenced = F.concat(F.lit("\n```csharp\n"), code, F.lit("\n```"))
        return F.when(code.contains("\n"), fenced).otherwise(F.concat(F.lit("`"), code, F.lit("`")))

    content = replace_matches(content, block, code_block)
    if not example_text_first:
        content = text_to_fence(content)
    content = replace_matches(
        content, pattern(r"<pre>.*?</pre>", "s"), lambda m: F.replace(m, F.lit("</attachedfile>"), F.lit(""))
    )
    return F.regexp_replace(content, pattern(r"\[(?:Visual Basic|VB\.NET)\]\s*"), "")


def clean_yaml(col: Column, escape_single: bool = True) -> Column:
    """Text that can stand between double quotes in YAML.

    A single quote is escaped too as shipped, though YAML does not allow it
    there; ``escape_single=False`` leaves it.
    """
    plain = lambda t: F.when(
        t.contains("<") & t.contains(">"), html_to_text(t)
    ).otherwise(t)
    text = let(percent_decode(F.coalesce(col, F.lit(""))), plain)
    text = pytrim(F.regexp_replace(text, pattern(r"^```[a-zA-Z0-9]+\s*"), ""))
    text = pytrim(F.replace(text, F.lit("\n"), F.lit(" ")))
    for char in ("\\", '"', "'") if escape_single else ("\\", '"'):
        text = F.replace(text, F.lit(char), F.lit("\\" + char))
    return text


def frontmatter_block(
    title: Column, description: Column, summary: Column, category: Column, layout: Column, escape_single: bool = True
) -> Column:
    """The frontmatter of a clean page."""

    def quoted(key: str, value: Column) -> list[Column]:
        return [F.lit(f'{key}: "'), value, F.lit('"\n')]

    names = let(
        clean_yaml(title, escape_single),
        lambda name: F.concat(*quoted("linkTitle", name), *quoted("title", name)),
    )
    return F.concat(
        F.lit("---\n"),
        names,
        *quoted("description", clean_yaml(description, escape_single)),
        *quoted("summary", clean_yaml(summary, escape_single)),
        F.lit("categories:\n  - "),
        category,
        F.lit("\n"),
        *quoted("layout", layout),
        F.lit("---"),
    )


def set_layout(content: Column, layout: str) -> Column:
    """Set ``layout`` in the frontmatter, adding block or line where missing.

    A block that is not closed is left as it is.
    """
    line = f'layout: "{layout}"'
    end = F.locate("\n---", content, 4)
    block = F.substring(content, F.lit(1), end + 3)
    rest = pytrim(F.substring(content, end + 4, F.length(content)))
    newer = F.when(
        block.contains("layout:"),
        F.regexp_replace(block, pattern(r'layout:\s*".*?"'), line.replace("\\", "\\\\").replace("$", "\\$")),
    ).otherwise(F.concat(F.rtrim(block, F.lit(" \t\n\r\x0b\x0c")), F.lit(f"\n{line}\n")))
    return (
        F.when(~content.startswith("---"), F.concat(F.lit(f"---\n{line}\n---\n\n"), content))
        .when(end == 0, content)
        .otherwise(F.concat(newer, F.lit("\n\n"), rest))
    )


def page_meta(df: DataFrame, content: str = "content") -> DataFrame:
    """Add ``title``, ``description``, ``summary`` and ``category`` of raw pages."""
    read = df.select(
        "*", page_title(F.col(content)).alias("title"), raw_description(F.col(content)).alias("_raw")
    )
    return read.select(
        *df.columns,
        "title",
        description_line(F.col("_raw")).alias("description"),
        summary_line(F.col("_raw")).alias("summary"),
        page_category(F.col("title")).alias("category"),
    )


def clean_pages(
    df: DataFrame,
    prefix: str = "Acme.",
    home_names: Mapping[str, str] | None = None,
    escape_single: bool = True,
    example_text_first: bool = False,
    idempotent_version: bool = False,
) -> DataFrame:
    """Clean raw pages: ``family_name, version, name, content`` to ``family, name, content``.

    Titles and summaries come from the raw text.  Sections become tables on
    namespace pages only.  No step is worked out twice.
    """
    family_name, version, name = F.col("family_name"), F.col("version"), F.col("name")
    family = F.col("_family")
    out = page_meta(df, "content").withColumn("_family", family_slug(family_name, prefix))

    def with_tables(text: Column) -> Column:
        tables = text
        for section in SECTIONS:
            tables = section_to_table(tables, section, family)
        return F.when(F.col("category") == "Namespace", tables).otherwise(text)

    body = let(drop_first_line(F.col("content")), with_tables)
    body = format_examples(replace_xref(body), example_text_first)
    body = add_version(rewrite_links(body, family_name, family), family_name, version, idempotent_version)
    layout = F.when(is_home_page(name, family_name, home_names), LAYOUT_HOME).otherwise(LAYOUT_SINGLE)
    block = frontmatter_block(
        F.col("title"), F.col("description"), F.col("summary"), F.col("category"), layout, escape_single
    )
    kept = [c for c in df.columns if c not in ("family_name", "version", "name", "content")]
    return out.select(
        *kept,
        family.alias("family"),
        output_name(name, family_name, home_names).alias("name"),
        F.concat(block, F.lit("\n"), body).alias("content"),
    )
