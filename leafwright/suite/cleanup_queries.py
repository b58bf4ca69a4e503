"""Queries over raw generated pages: each clean-up step, and all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.functions.pages import family_slug, output_name
from leafwright.functions.text import drop_first_line
from leafwright.operators import cleanup as cl
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import fixture, pages


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "raw_page").withColumn("family", family_slug(F.col("family_name")))


def _step(spark: SparkSession, sf_dir: str, column: F.Column) -> DataFrame:
    return _raw(spark, sf_dir).select("p_partkey", column.alias("content"))


def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, description, summary and category."""
    return cl.page_meta(_raw(spark, sf_dir)).select("p_partkey", "title", "description", "summary", "category")


def page_xref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross references put in as text."""
    return _step(spark, sf_dir, cl.replace_xref(F.col("content")))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Internal links rewritten."""
    return _step(spark, sf_dir, cl.rewrite_links(F.col("content"), F.col("family_name"), F.col("family")))


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of structs, delegates, classes, interfaces and enums as tables."""
    content = F.col("content")
    for section in [s for s in cl.SECTIONS if s != "Namespaces"]:
        content = cl.section_to_table(content, section, F.col("family"))
    return _step(spark, sf_dir, content)


def page_namespace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of namespaces as a table."""
    return _step(spark, sf_dir, cl.section_to_table(F.col("content"), "Namespaces", F.col("family")))


def page_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code blocks as Markdown."""
    return _step(spark, sf_dir, cl.format_examples(F.col("content")))


def page_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version behind the assembly line, added twice as the step is not idempotent."""
    once = cl.add_version(F.col("content"), F.col("family_name"), F.col("version"))
    return _step(spark, sf_dir, cl.add_version(once, F.col("family_name"), F.col("version")))


def page_version_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the idempotent variant."""
    once = cl.add_version(F.col("content"), F.col("family_name"), F.col("version"), idempotent=True)
    return _step(spark, sf_dir, cl.add_version(once, F.col("family_name"), F.col("version"), idempotent=True))


def page_first_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without their first line."""
    return _step(spark, sf_dir, drop_first_line(F.col("content")))


def page_output_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of clean pages."""
    special = {"Acme.Brand7": "Acme.BRAND7"}
    return _raw(spark, sf_dir).select(
        "p_partkey", output_name(F.col("name"), F.col("family_name"), special).alias("name")
    )


def page_frontmatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frontmatter made from page texts full of quotes and line ends."""
    text = F.col("content")
    return pages(spark, sf_dir).select(
        "doc_id",
        cl.frontmatter_block(text, text, text, F.lit("Class"), F.lit("reference-single")).alias("block"),
    )


def page_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout set in existing frontmatter."""
    return pages(spark, sf_dir).select("doc_id", cl.set_layout(F.col("content"), "reference-home").alias("content"))


def page_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps together."""
    raw = _raw(spark, sf_dir).select("p_partkey", "family_name", "version", "name", "content")
    return cl.clean_pages(raw).select("p_partkey", "family", "name", "content")


# --- the same in SQL ---------------------------------------------------------

NL = "chr(10)"
_B = "replace(p_brand, '#', '')"
_F = f"lower({_B})"
_RAW = f"(SELECT r.*, p_name, p_size, p_brand, {_F} AS fam FROM ({fx.RAW_PAGE}) r JOIN part USING (p_partkey)) x"


def _lines(*parts: str) -> str:
    return f" || {NL} || ".join(parts)


_CODE_ONE = "'<pre><code class=\"lang-csharp\">[C#] one(' || CAST(p_size AS VARCHAR) || ');</code></pre>'"
_CODE_TWO = f"'<pre><code class=\"lang-csharp\">a' || {NL} || 'b</code></pre>'"
_OPEN = '<pre><code class="lang-csharp">'
# Examples, code in two languages, stray markers: as shipped, text in an example keeps its tags.
_MARKERS = (
    f"replace(replace(replace(replace(replace({{c}}, '<example>{_OPEN}e1</code></pre></example>', "
    f"{NL} || '```csharp' || {NL} || 'e1' || {NL} || '```'), "
    f"'{_OPEN}[C#] c1' || {NL} || '[Visual Basic] v1</code></pre>', "
    f"{NL} || '```csharp' || {NL} || 'c1' || {NL} || '```' || {NL} || '```vb' || {NL} || 'v1' || {NL} || '```'), "
    f"'<pre>a</attachedfile>b</pre>', '<pre>ab</pre>'), 'x [VB.NET] y', 'x y'), '{_OPEN}t1</code></pre>', '`t1`')"
)
_EXAMPLES = (
    "replace(replace(" + _MARKERS + ", " + _CODE_ONE + ", '`one(' || CAST(p_size AS VARCHAR) || ');`'), " + _CODE_TWO + ", "
    f"{NL} || '```csharp' || {NL} || 'a' || {NL} || 'b' || {NL} || '```')"
)
_XREF = "replace({c}, '<xref href=\"Sys.T%601\"><b>t</b> &copy;</xref>', 'Sys.T`1')"
_OWN = "replace({c}, '[Acme.' || " + _B + " || '](Acme.' || " + _B + " || '.md)', '[Acme.' || " + _B + " || '](/' || fam || '/)')"
_DEEP = "replace({c}, '](X/' || p_brand || '.md)', '](/' || fam || '/x/' || lower(p_brand) || ')')"
_PLAIN = (
    "replace(replace(replace({c}, '](Acme.A.md)', '](/' || fam || '/acme.a)'), '](B.md)', '](/' || "
    "CASE WHEN starts_with('b.md', fam) THEN '' ELSE fam || '/' END || 'b)'), '](Acme.N.md)', '](/' || fam || '/acme.n)')"
)
_VERSION = "replace({c}, 'Assembly: Acme.' || " + _B + " || '.dll', 'Assembly: Acme.' || " + _B + " || '.dll (' || version || ')')"


def _on(template: str, inner: str) -> str:
    return template.replace("{c}", inner)


_SECTION = "CASE p_partkey % 5 WHEN 1 THEN 'Structs' WHEN 2 THEN 'Delegates' WHEN 3 THEN 'Interfaces' WHEN 4 THEN 'Enums' ELSE 'Classes' END"
_ITEM = "CASE p_partkey % 5 WHEN 1 THEN 'Struct' WHEN 2 THEN 'Delegate' WHEN 3 THEN 'Interface' WHEN 4 THEN 'Enum' ELSE 'Class' END"
_CLASS_LIST = _lines(
    f"'## ' || {_SECTION}", "''", "'[A](Acme.A.md)'", "''", "'First thing.'", "''", "'[B' || CAST(p_partkey AS VARCHAR) || '](B.md)'"
) + f" || {NL}"
_CLASS_TABLE = _lines(
    f"'## ' || {_SECTION}", "''", f"'| ' || {_ITEM} || ' Name | Description |'", "'| --- | --- |'",
    "'| [A](/' || fam || '/acme.a/) | First thing. |'",
    "'| [B' || CAST(p_partkey AS VARCHAR) || '](/' || fam || '/b/) |  |'", "''",
)
_SPACE_LIST = _lines("'### Namespaces'", "''", "'[N](Acme.N.md)'") + f" || {NL}"
_SPACE_TABLE = _lines(
    "'## Namespaces'", "''", "'| Namespace Name | Description |'", "'| --- | --- |'", "'| [N](/' || fam || '/acme.n/) |  |'", "''"
)
_FIRST = f"substr(content, strpos(content, {NL}) + 1)"
_NO_LAST = f"regexp_replace({_FIRST}, '\\n$', '')"
_TITLE = "CASE WHEN p_partkey % 4 = 0 THEN 'Namespace N' ELSE 'Class N' END || CAST(p_partkey AS VARCHAR)"
_CATEGORY = "CASE WHEN p_partkey % 4 = 0 THEN 'Namespace' ELSE 'Class' END"
_TABLES = (
    f"CASE WHEN p_partkey % 4 = 0 THEN replace(replace({_NO_LAST}, {_CLASS_LIST}, {_CLASS_TABLE}), "
    f"{_lines(chr(39) + '### Namespaces' + chr(39), chr(39) * 2, chr(39) + '[N](Acme.N.md)' + chr(39))}, {_SPACE_TABLE}) ELSE {_NO_LAST} END"
)
_BODY = _on(_VERSION, _on(_PLAIN, _on(_DEEP, _on(_OWN, _on(_EXAMPLES, _on(_XREF, _TABLES))))))
_HOME = "p_partkey % 7 = 0"
_CLEAN = _lines(
    "'---'", f"'linkTitle: \"' || {_TITLE} || '\"'", f"'title: \"' || {_TITLE} || '\"'",
    "'description: \"A ' || p_name || ' kind of part.\"'", "'summary: \"A ' || p_name || ' kind of part.\"'",
    "'categories:'", f"'  - ' || {_CATEGORY}",
    f"'layout: \"' || CASE WHEN {_HOME} THEN 'reference-home' ELSE 'reference-single' END || '\"'", "'---'", _BODY,
)

_TEXT = (
    "CASE WHEN contains(t, '<') AND contains(t, '>') THEN replace(replace(replace(replace(replace(replace(replace("
    "regexp_replace(t, '<[A-Za-z/!?][^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), "
    "'&apos;', chr(39)), '&nbsp;', chr(160)), '&amp;', '&') ELSE t END"
)
_YAML = (
    rf"replace(replace(replace(trim(regexp_replace({_TEXT}, '^```[a-zA-Z0-9]+\s*', ''), ' ' || chr(10)), chr(10), ' '), "
    "chr(34), chr(92) || chr(34)), chr(39), chr(92) || chr(39))"
)


def _of_raw(expr: str) -> str:
    return f"SELECT p_partkey, {expr} AS content FROM {_RAW}"


QUERIES = {
    "page_meta": (
        page_meta,
        f"""SELECT p_partkey, {_TITLE} AS title, 'A ' || p_name || ' <b>kind</b> of part.' AS description,
        'A ' || p_name || ' kind of part.' AS summary, {_CATEGORY} AS category FROM {_RAW}""",
    ),
    "page_xref": (page_xref, _of_raw(_on(_XREF, "content"))),
    "page_links": (page_links, _of_raw(_on(_PLAIN, _on(_DEEP, _on(_OWN, "content"))))),
    "page_table": (page_table, _of_raw(f"replace(content, {_CLASS_LIST}, {_CLASS_TABLE})")),
    "page_namespace_table": (
        page_namespace_table,
        _of_raw(f"replace(content, {_SPACE_LIST}, {_SPACE_TABLE})"),
    ),
    "page_examples": (page_examples, _of_raw(_on(_EXAMPLES, "content"))),
    "page_version": (page_version, _of_raw(_on(_VERSION, _on(_VERSION, "content")))),
    "page_version_once": (page_version_once, _of_raw(_on(_VERSION, "content"))),
    "page_first_line": (page_first_line, _of_raw(_NO_LAST)),
    "page_output_name": (
        page_output_name,
        f"SELECT p_partkey, CASE WHEN {_HOME} AND p_brand <> 'Brand#7' THEN '_index.md' ELSE name END AS name FROM {_RAW}",
    ),
    "page_frontmatter": (
        page_frontmatter,
        f"""WITH s AS (SELECT doc_id, content AS t FROM ({fx.PAGE}) p), y AS (SELECT doc_id, {_YAML} AS v FROM s)
        SELECT doc_id, {_lines("'---'", "'linkTitle: ' || chr(34) || v || chr(34)", "'title: ' || chr(34) || v || chr(34)",
        "'description: ' || chr(34) || v || chr(34)", "'summary: ' || chr(34) || v || chr(34)", "'categories:'", "'  - Class'",
        "'layout: ' || chr(34) || 'reference-single' || chr(34)", "'---'")} AS block FROM y""",
    ),
    "page_layout": (
        page_layout,
        f"""WITH p AS ({fx.PAGE}), e AS (SELECT doc_id, content, strpos(substr(content, 4), {NL} || '---') + 3 AS n FROM p),
        b AS (SELECT doc_id, content, substr(content, 1, n + 3) AS fm, regexp_replace(substr(content, n + 4), '^\\s+|\\s+$', '', 'g') AS rest FROM e)
        SELECT doc_id, CASE WHEN NOT starts_with(content, '---') THEN {_lines("'---'", "'layout: ' || chr(34) || 'reference-home' || chr(34)", "'---'", "''", "content")}
        WHEN contains(fm, 'layout:') THEN {_lines("replace(fm, 'reference-single', 'reference-home')", "''", "rest")}
        ELSE {_lines("fm", "'layout: ' || chr(34) || 'reference-home' || chr(34)", "''", "''", "rest")} END AS content FROM b""",
    ),
    "page_clean": (
        page_clean,
        f"""SELECT p_partkey, fam AS family, CASE WHEN {_HOME} THEN '_index.md' ELSE name END AS name, {_CLEAN} AS content FROM {_RAW}""",
    ),
}
