"""Queries over single projections: parts of pages, names, labels, damaged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.functions.frontmatter import fm_field, with_frontmatter
from leafwright.functions.pages import headings, hunks, internal_links, repo_name, run_id
from leafwright.functions.text import single_line, truncate_text, unquote_value
from leafwright.operators import change_sets as cs
from leafwright.operators import frontier as fr
from leafwright.operators.catalog import parse_products
from leafwright.operators.metrics import product_display, product_website, run_status
from leafwright.operators.scoring import parse_model_answer
from leafwright.session import settle
from leafwright.sources.readers import permissive
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import change_sets, fixture, pages, sitemap_docs
from leafwright.suite.page_queries import parted


def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frontmatter and body of each page."""
    return with_frontmatter(pages(spark, sf_dir).select("doc_id", "content")).select("doc_id", "fm", "body")


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frontmatter values, raw and without quotes."""
    parts = with_frontmatter(pages(spark, sf_dir).select("doc_id", "content"))
    fm = F.col("fm")
    return parts.select(
        "doc_id",
        fm_field(fm, "title").alias("title"),
        unquote_value(fm_field(fm, "title")).alias("plain_title"),
        unquote_value(fm_field(fm, "description")).alias("description"),
        fm_field(fm, "url").alias("url"),
    )


def page_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings and internal links of each page."""
    parts = with_frontmatter(pages(spark, sf_dir).select("doc_id", "content"))
    return parts.select(
        "doc_id",
        F.array_join(headings(F.col("body")), "|").alias("headings"),
        F.array_join(internal_links(F.col("body")), "|").alias("links"),
    )


def page_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages cut to 500 characters, on one line."""
    return pages(spark, sf_dir).select("doc_id", single_line(truncate_text(F.col("content"), 500)).alias("text"))


def patch_hunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line ranges of each patch."""
    files = fixture(spark, sf_dir, "changed_file").select("doc_id", F.explode(hunks(F.col("patch"))).alias("h"))
    return files.select("doc_id", F.col("h.start").alias("start"), F.col("h.count").alias("n"))


def change_set_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repository name, product label, website and run id of each change set."""
    now = F.to_timestamp(F.lit(fx.NOW))
    sets = change_sets(spark, sf_dir).select("repo_url", "pr_number", "product")
    dim = fixture(spark, sf_dir, "product_dim")
    named = cs.with_label(cs.with_label(sets, dim, "product", "display"), dim, "product", "website")
    return named.select(
        "pr_number",
        repo_name(F.col("repo_url")).alias("repo"),
        product_display(F.col("product"), F.col("display")).alias("display"),
        product_website(F.col("website")).alias("website"),
        run_id(F.col("product"), now).alias("run_id"),
    )


def product_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run status for each part by what was sent and what failed of it."""
    rows = fr.classify_outcome(fixture(spark, sf_dir, "outcome")).groupBy("url").agg(
        F.count_if("ok").alias("ok"), F.count_if(F.col("outcome") == "failed").alias("bad")
    )
    return rows.select("url", run_status(F.col("ok"), F.col("bad")).alias("status"))


def product_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in each request list."""
    asked = fixture(spark, sf_dir, "requested")
    return asked.select("request_ord", F.array_join(parse_products(F.col("products")), "|").alias("names"))


def readable_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers that could be read, with the number of damaged ones."""
    read = fixture(spark, sf_dir, "ai_response").select("doc_id", parse_model_answer(F.col("body")).alias("answer"))
    good, bad = permissive(read, "answer")
    return good.agg(F.count("*").alias("good")).select(F.lit("good").alias("kind"), F.col("good").alias("n")).unionByName(
        bad.select(F.lit("bad").alias("kind"), F.col("errors").alias("n"))
    )


def sitemap_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which payloads are sitemaps, and which of them are an index."""
    docs = settle(sitemap_docs(spark, sf_dir), "sitemaps")
    return docs.select(
        "sitemap_url",
        (F.col("status") == 200).alias("found"),
        fr.starts_as_xml(F.col("body")).alias("is_xml"),
        fr.is_sitemap_index(F.col("body")).alias("is_index"),
    )


_FIELD = r"nullif(regexp_extract(fm, '(?m)^\s*{}\s*:\s*(.+)', 1), '')".format
_QUOTES = "chr(34) || chr(39)"
_HUNK = r"'(?m)^@@ -\d+(?:,\d+)? \+(\d+)(?:,(\d+))? @@'"

QUERIES = {
    "page_parts": (page_parts, f"WITH {parted(fx.PAGE)} SELECT doc_id, fm, body FROM fb"),
    "page_fields": (
        page_fields,
        f"""WITH {parted(fx.PAGE)} SELECT doc_id, {_FIELD('title')} AS title, trim(trim({_FIELD('title')}), {_QUOTES}) AS plain_title,
        trim(trim({_FIELD('description')}), {_QUOTES}) AS description, {_FIELD('url')} AS url FROM fb""",
    ),
    "page_structure": (
        page_structure,
        f"""WITH {parted(fx.PAGE)} SELECT doc_id,
        array_to_string(regexp_extract_all(body, '(?m)^#{{1,6}}\\s+(.+)', 1), '|') AS headings,
        array_to_string([x for x in regexp_extract_all(body, '\\[[^\\n]*?\\]\\(([^)]+)\\)', 1) if not starts_with(x, 'http')], '|') AS links
        FROM fb""",
    ),
    "page_excerpts": (
        page_excerpts,
        f"""SELECT doc_id, replace(regexp_replace(CASE WHEN length(content) > 500 THEN substr(content, 1, 500) || chr(10) || '...[truncated]'
        ELSE content END, '\\n$', ''), chr(10), ' ') AS text FROM ({fx.PAGE}) p""",
    ),
    "patch_hunks": (
        patch_hunks,
        f"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(patch, {_HUNK}, 1)) AS s, unnest(regexp_extract_all(patch, {_HUNK}, 2)) AS c
        FROM ({fx.CHANGED_FILE}) f) SELECT doc_id, CAST(s AS BIGINT) AS start, coalesce(try_cast(c AS BIGINT), 1) AS n FROM h""",
    ),
    "change_set_names": (
        change_set_names,
        f"""SELECT pr_number, 'acme/' || product AS repo, CASE product WHEN 'words' THEN 'Acme.Words' WHEN 'viewer' THEN 'AcmeView.Viewer'
        ELSE 'Acme.Other-Tools2' END AS display, CASE product WHEN 'viewer' THEN 'acmeview.example' ELSE 'acme.example' END AS website,
        'page_review_' || product || '_20240215_000000' AS run_id FROM ({fx.CHANGE_SET}) c""",
    ),
    "product_status": (
        product_status,
        f"""WITH o AS (SELECT url, status = 200 AND attempt <= 5 AS ok,
        NOT (status = 200 AND attempt <= 5) AND NOT (status IN (401, 429) AND attempt < 5) AS bad FROM ({fx.OUTCOME}) x)
        SELECT url, CASE WHEN NOT bool_or(ok) THEN 'failure' WHEN NOT bool_or(bad) THEN 'success' ELSE 'partial_success' END AS status
        FROM o GROUP BY url""",
    ),
    "product_lists": (
        product_lists,
        f"""SELECT request_ord, first_name || '|nobody' || CAST(request_ord AS VARCHAR) || '|' || first_name || '|' || second_name AS names
        FROM ({fx.REQUESTED}) r""",
    ),
    "readable_answers": (
        readable_answers,
        "SELECT CASE WHEN doc_id % 13 = 0 THEN 'bad' ELSE 'good' END AS kind, count(*) AS n FROM documents GROUP BY 1",
    ),
    "sitemap_roots": (
        sitemap_roots,
        f"""WITH sp AS ({fx.SITEMAP_PAGE})
        SELECT DISTINCT sitemap_url, status = 200 AS found, (NOT bad_xml OR host % 3 <> 0) AS is_xml, false AS is_index FROM sp
        UNION SELECT DISTINCT 'https://' || subdomain || '/sitemap.xml', true, true, true FROM sp WHERE sm < 2""",
    ),
}
