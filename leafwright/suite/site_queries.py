"""Queries over addresses: keywords, sitemaps, frontier, search index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators import frontier as fr
from leafwright.operators.keywords import in_range, keywords_by_page
from leafwright.operators.search_index import merge_entries, merge_search
from leafwright.operators.state import mark_processed
from leafwright.plans import site
from leafwright.session import settle
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import fixture, hosts, query_rows, search_docs, sitemap_docs

FAMILIES = ("words", "pdf")
BATCH = 20


def now():
    """The fixed time of all queries."""
    return F.to_timestamp(F.lit(fx.NOW))


def _keywords(rows: DataFrame, size: int = 25000) -> DataFrame:
    out = keywords_by_page(rows, F.to_date(now()), size)
    return out.select(
        "url", "part", F.array_join("keywords", "|").alias("keywords"), "lang",
        F.date_format("last_updated", "yyyy-MM-dd").alias("last_updated"),
    )


def all_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of each page over all rows."""
    return _keywords(query_rows(spark, sf_dir))


def keywords_28d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of each page in the 28 days before the fixed date."""
    rows = query_rows(spark, sf_dir).withColumn("date", F.to_date("ts"))
    return _keywords(in_range(rows, F.to_date(now()), 28))


def keywords_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords with so small a part that pages are split; one row per keyword."""
    out = keywords_by_page(query_rows(spark, sf_dir), F.to_date(now()), size=5)
    return out.select("url", F.explode("keywords").alias("keyword"), "lang")


def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of all sitemaps."""
    return fr.sitemap_urls(fr.locations(sitemap_docs(spark, sf_dir))).select(
        "sitemap_url", F.col("pos").cast("bigint").alias("pos"), "url", "lastmod",
        F.date_format(fr.parse_lastmod(F.col("lastmod")), "yyyy-MM-dd").alias("lastmod_date"),
    )


def _visits(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    docs = settle(sitemap_docs(spark, sf_dir), "sitemaps")
    return fr.expand_sitemaps(docs, hosts(spark, sf_dir), FAMILIES, **options)


def _visit_columns(df: DataFrame) -> DataFrame:
    return df.select("subdomain", F.col("step").cast("bigint").alias("step"), "p1", "p2", "sitemap_url")


def sitemap_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sitemap visits, two levels down."""
    return _visit_columns(_visits(spark, sf_dir))


def sitemap_expand_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, each sitemap once."""
    return _visit_columns(_visits(spark, sf_dir, dedupe=True))


def sitemap_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of site and sitemap to submit."""
    pairs = fr.sitemap_inventory(settle(sitemap_docs(spark, sf_dir), "sitemaps"), hosts(spark, sf_dir), FAMILIES)
    return pairs.select("site_url", "sitemap_url", F.col("step").cast("bigint").alias("step"))


def _site(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, F.Column]:
    # Payloads are landed once, as a fetch job would leave them.
    docs = settle(sitemap_docs(spark, sf_dir), "sitemaps")
    return docs, hosts(spark, sf_dir), fixture(spark, sf_dir, "ledger"), now()


def url_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs never processed."""
    urls = site.due_urls(*_site(spark, sf_dir), families=FAMILIES)
    return urls.groupBy("subdomain", "url").agg(F.count("*").alias("times"))


def url_frontier_lastmod(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs never processed, or due again by their change date."""
    urls = site.due_urls(*_site(spark, sf_dir), families=FAMILIES, use_lastmod=True)
    return urls.groupBy("subdomain", "url").agg(F.count("*").alias("times"))


def url_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of the URLs to be submitted."""
    batches = site.url_batches(*_site(spark, sf_dir), size=BATCH, families=FAMILIES)
    return batches.select("subdomain", "batch_no", F.array_join("urls", " ").alias("urls"))


def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches taken apart again."""
    rows = fr.explode_batches(site.url_batches(*_site(spark, sf_dir), size=BATCH, families=FAMILIES))
    return rows.select("subdomain", "batch_no", F.col("pos").cast("bigint").alias("pos"), "url")


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.classify_outcome(fixture(spark, sf_dir, "outcome"))


def submission_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came of each submission."""
    return _outcomes(spark, sf_dir).select(
        "event_id", "outcome", "ok", F.coalesce("retry_after", F.lit(0)).alias("retry_after")
    )


def submission_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted URLs of each batch."""
    return fr.submission_counts(_outcomes(spark, sf_dir))


def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger after the submissions."""
    ledger = fixture(spark, sf_dir, "ledger").select("url", "processed_at")
    return mark_processed(ledger, _outcomes(spark, sf_dir), now()).select(
        "url", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at")
    )


def search_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged search entries, a row per key."""
    return merge_entries(search_docs(spark, sf_dir))


def search_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged search index, a row per page."""
    return merged_text(merge_search(search_docs(spark, sf_dir)))


def merged_text(out: DataFrame) -> DataFrame:
    """A merged index with its maps as texts."""
    text = lambda m: F.array_join(
        F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"
    )
    return out.select("lang", "page_path", "part", text("data").alias("data"), text("other").alias("other"))


# --- the same in SQL ---------------------------------------------------------

_LANG = "coalesce(nullif(lower(regexp_extract(k1, 'https?://[^/]+(?:/[^/]+)?/([a-zA-Z]{2})/', 1)), ''), 'en')"
_LISTING = "NOT (contains(k1, '/tag/') OR contains(k1, '/categories/') OR contains(k1, '/archives/'))"


def _keywords_sql(where: str = "true") -> str:
    return f"""SELECT k1 AS url, CAST(0 AS BIGINT) AS part, string_agg(k2, '|' ORDER BY k2) AS keywords, {_LANG} AS lang,
    '2024-02-15' AS last_updated FROM (SELECT DISTINCT k1, k2 FROM ({fx.QUERY_ROW}) q
    WHERE k2 IS NOT NULL AND {_LISTING} AND {where}) d GROUP BY k1"""


# Sitemap documents as rows: pages of readable sitemaps, and which sitemap names which.
_SITE = f"""
sp AS ({fx.SITEMAP_PAGE}),
doc AS (SELECT DISTINCT subdomain, host, sm, sitemap_url, status = 200 AND NOT bad_xml AS readable, status FROM sp),
nst AS (SELECT 'https://' || subdomain || '/sitemap.xml' AS parent, sm AS pos, sitemap_url AS loc FROM doc WHERE sm < 2
        UNION ALL
        SELECT sitemap_url, (SELECT count(*) FROM sp p WHERE p.sitemap_url = doc.sitemap_url), 'https://' || subdomain || '/sm-2.xml'
        FROM doc WHERE sm = 1 AND readable),
v0 AS (SELECT DISTINCT subdomain, host, 0 AS step, 0 AS p1, 0 AS p2, 'https://' || subdomain || '/sitemap.xml' AS sitemap_url FROM doc WHERE sm < 2),
v1 AS (SELECT subdomain, host, 1 AS step, pos AS p1, 0 AS p2, loc AS sitemap_url FROM v0 JOIN nst ON parent = sitemap_url),
v2 AS (SELECT subdomain, host, 2 AS step, src AS p1, pos AS p2, loc AS sitemap_url
       FROM (SELECT *, 0 AS src FROM v0 UNION ALL SELECT *, p1 + 1 FROM v1) s JOIN nst ON parent = sitemap_url),
v3 AS (SELECT v0.subdomain, v0.host, 3 AS step, 0 AS p1, 0 AS p2, doc.sitemap_url FROM v0 JOIN doc USING (subdomain)
       WHERE doc.sm = 3 AND status = 200 AND v0.host % 2 = 0),
vis AS (SELECT * FROM v0 UNION ALL SELECT * FROM v1 UNION ALL SELECT * FROM v2 UNION ALL SELECT * FROM v3),
url AS (SELECT sp.* FROM sp JOIN doc USING (sitemap_url) WHERE readable),
cand AS (SELECT v.subdomain, v.step, v.p1, v.p2, u.pos, u.url, u.lastmod FROM vis v JOIN url u USING (sitemap_url)),
new AS (SELECT * FROM cand WHERE url NOT IN (SELECT url FROM ({fx.LEDGER}) l)),
num AS (SELECT *, row_number() OVER (PARTITION BY subdomain ORDER BY step, p1, p2, pos) AS rn FROM new)"""

_VISIT = "subdomain, CAST(step AS BIGINT) AS step, CAST(p1 AS BIGINT) AS p1, CAST(p2 AS BIGINT) AS p2, sitemap_url"

_OUTCOME_SQL = f"""SELECT *, CASE WHEN attempt > 5 THEN 'failed' WHEN status = 200 THEN 'done'
   WHEN status IN (401, 429) AND attempt < 5 THEN 'retry' ELSE 'failed' END AS outcome FROM ({fx.OUTCOME}) o"""

_ENTRIES = f"""SELECT lang, page_path, section, key, arg_max(value, family_ord) AS value FROM (
  SELECT lang, page_path, family_ord, 'data' AS section, key1 AS key, value1 AS value FROM ({fx.SEARCH_DOC}) a WHERE has_data
  UNION ALL SELECT lang, page_path, family_ord, 'data', key2, value2 FROM ({fx.SEARCH_DOC}) b WHERE has_data
  UNION ALL SELECT lang, page_path, family_ord, 'other', 'title', title FROM ({fx.SEARCH_DOC}) c) e
GROUP BY lang, page_path, section, key"""

QUERIES = {
    "keywords_by_page": (all_keywords, _keywords_sql()),
    "keywords_28d": (
        keywords_28d,
        _keywords_sql("CAST(ts AS DATE) BETWEEN DATE '2024-01-18' AND DATE '2024-02-15'"),
    ),
    "keywords_in_parts": (
        keywords_in_parts,
        f"SELECT DISTINCT k1 AS url, k2 AS keyword, {_LANG} AS lang FROM ({fx.QUERY_ROW}) q WHERE k2 IS NOT NULL AND {_LISTING}",
    ),
    "sitemap_urls": (
        sitemap_urls,
        f"WITH {_SITE} SELECT sitemap_url, pos, url, lastmod, CASE WHEN length(lastmod) = 10 THEN lastmod END AS lastmod_date FROM url",
    ),
    "sitemap_expand": (sitemap_expand, f"WITH {_SITE} SELECT {_VISIT} FROM vis"),
    "sitemap_expand_once": (
        sitemap_expand_once,
        f"WITH {_SITE} SELECT {_VISIT} FROM (SELECT *, row_number() OVER (PARTITION BY subdomain, sitemap_url ORDER BY step, p1, p2) AS n "
        "FROM vis) x WHERE n = 1",
    ),
    "sitemap_inventory": (
        sitemap_inventory,
        f"WITH {_SITE} SELECT 'https://' || subdomain AS site_url, sitemap_url, CAST(step AS BIGINT) AS step FROM vis WHERE step <> 2",
    ),
    "url_frontier": (url_frontier, f"WITH {_SITE} SELECT subdomain, url, count(*) AS times FROM new GROUP BY subdomain, url"),
    "url_frontier_lastmod": (
        url_frontier_lastmod,
        f"WITH {_SITE} SELECT subdomain, url, count(*) AS times FROM cand LEFT JOIN ({fx.LEDGER}) l USING (url) "
        "WHERE processed_at IS NULL OR (length(lastmod) = 10 AND processed_at < timestamp '2024-01-16 00:00:00') GROUP BY subdomain, url",
    ),
    "url_batches": (
        url_batches,
        f"WITH {_SITE} SELECT subdomain, CAST(FLOOR((rn - 1) / {BATCH}.0) AS BIGINT) AS batch_no, "
        "string_agg(url, ' ' ORDER BY rn) AS urls FROM num GROUP BY 1, 2",
    ),
    "batch_rows": (
        batch_rows,
        f"WITH {_SITE} SELECT subdomain, CAST(FLOOR((rn - 1) / {BATCH}.0) AS BIGINT) AS batch_no, (rn - 1) % {BATCH} AS pos, url FROM num",
    ),
    "submission_outcomes": (
        submission_outcomes,
        f"SELECT event_id, outcome, outcome = 'done' AS ok, CASE WHEN status = 429 AND attempt <= 5 "
        f"THEN CAST(pow(2, attempt) AS BIGINT) ELSE 0 END AS retry_after FROM ({_OUTCOME_SQL}) o",
    ),
    "submission_counts": (
        submission_counts,
        f"SELECT subdomain, batch_no, count(*) FILTER (outcome = 'done') AS submitted FROM ({_OUTCOME_SQL}) o GROUP BY subdomain, batch_no",
    ),
    "ledger_upsert": (
        ledger_upsert,
        f"""WITH d AS (SELECT DISTINCT url FROM ({_OUTCOME_SQL}) o WHERE outcome = 'done')
        SELECT url, '{fx.NOW}' AS processed_at FROM d UNION ALL
        SELECT url, strftime(processed_at, '%Y-%m-%d %H:%M:%S') FROM ({fx.LEDGER}) l WHERE url NOT IN (SELECT url FROM d)""",
    ),
    "search_entries": (search_entries, _ENTRIES),
    "search_merge": (
        search_merge,
        f"""SELECT lang, page_path, CAST(0 AS BIGINT) AS part,
        coalesce(string_agg(key || '=' || value, ';' ORDER BY key) FILTER (section = 'data'), '') AS data,
        coalesce(string_agg(key || '=' || value, ';' ORDER BY key) FILTER (section = 'other'), '') AS other
        FROM ({_ENTRIES}) e GROUP BY lang, page_path""",
    ),
}
