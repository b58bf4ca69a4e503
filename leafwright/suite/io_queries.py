"""Queries that go through a writer and a reader: the rows that come back must be the rows of the plain query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.functions.pages import family_slug
from leafwright.operators import cleanup as cl
from leafwright.operators import frontier as fr
from leafwright.operators.catalog import apply_filter_rules, apply_updates, version_updates
from leafwright.operators.checks import DEFAULT_CHECKLIST
from leafwright.operators.keywords import keywords_by_page
from leafwright.operators.manifest import write_manifest
from leafwright.operators.search_index import merge_search
from leafwright.operators.state import mark_processed
from leafwright.plans import catalog
from leafwright.session import work_path
from leafwright.sources import readers as rd
from leafwright.sources import sinks as sk
from leafwright.sources.page_files import write_files
from leafwright.sources.state_tables import read_state, upsert_state, write_state
from leafwright.suite import catalog_queries, cleanup_queries, page_queries, review_queries, site_queries
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import feeds, fixture, query_rows, search_docs, sitemap_docs


def now():
    """The fixed time of all queries."""
    return F.to_timestamp(F.lit(fx.NOW))


def source_query_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-query rows landed as JSON, the last 28 days, no limit: pages per language."""
    path = work_path(spark, "query_rows")
    query_rows(spark, sf_dir).select("keys", F.date_format("ts", "yyyy-MM-dd").alias("date")).write.json(path)
    rows = rd.read_query_rows(spark, path, F.to_date(now()), row_limit=None)
    return rows.groupBy("date").agg(F.count("*").alias("n")).select(F.date_format("date", "yyyy-MM-dd").alias("date"), "n")


def source_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap payloads landed as JSON, parsed after they were read."""
    path = work_path(spark, "sitemaps")
    sitemap_docs(spark, sf_dir).write.json(path)
    return fr.sitemap_urls(fr.locations(rd.read_sitemaps(spark, path))).select(
        "sitemap_url", F.col("pos").cast("bigint").alias("pos"), "url", "lastmod",
        F.date_format(fr.parse_lastmod(F.col("lastmod")), "yyyy-MM-dd").alias("lastmod_date"),
    )


def source_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed files landed as JSON: what there is of each status."""
    path = work_path(spark, "changed_files")
    fixture(spark, sf_dir, "changed_file").drop("doc_id").write.json(path)
    return rd.read_changed_files(spark, path, "json").groupBy("status").agg(
        F.count("*").alias("files"), F.count("content").alias("readable"), F.sum(F.length("content")).alias("characters")
    )


def sink_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords written by host and read back."""
    path = work_path(spark, "keywords")
    sk.write_keywords(keywords_by_page(query_rows(spark, sf_dir), F.to_date(now())), path)
    schema = "url string, part bigint, keywords array<string>, lang string, last_updated string"
    return spark.read.schema(schema).json(path).withColumn("keywords", F.array_join("keywords", "|")).select(
        "url", "part", "keywords", "lang", "last_updated"
    )


def sink_search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search index written by language and read back."""
    path = work_path(spark, "search")
    sk.write_search_index(merge_search(search_docs(spark, sf_dir)), path)
    text = lambda m: F.array_join(
        F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"
    )
    back = rd.read_search_table(spark, path)
    return back.select("lang", "page_path", "part", text("data").alias("data"), text("other").alias("other"))


def sink_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL batches written and read back."""
    path = work_path(spark, "batches")
    docs, sites, ledger, time = site_queries._site(spark, sf_dir)
    batches = site_queries.site.url_batches(docs, sites, ledger, time, size=site_queries.BATCH, families=site_queries.FAMILIES)
    sk.write_batches(batches, path)
    back = spark.read.schema("subdomain string, batch_no bigint, urls array<string>").json(path)
    return back.withColumn("urls", F.array_join("urls", " "))


def source_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of written batches, in order."""
    path = work_path(spark, "batches")
    docs, sites, ledger, time = site_queries._site(spark, sf_dir)
    sk.write_batches(
        site_queries.site.url_batches(docs, sites, ledger, time, size=site_queries.BATCH, families=site_queries.FAMILIES), path
    )
    rows = rd.read_batch_table(spark, path)
    whole = rows.groupBy("subdomain", "batch_no").agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("u"))
    return whole.select("subdomain", "batch_no", F.array_join(F.col("u.url"), " ").alias("urls"))


def sink_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed URLs written, read as the ledger of the next run, and written again after it."""
    first, second = work_path(spark, "ledger"), work_path(spark, "ledger")
    sk.write_ledger(fixture(spark, sf_dir, "ledger"), first)
    ledger = rd.read_ledger_table(spark, first)
    sk.write_ledger(mark_processed(ledger, site_queries._outcomes(spark, sf_dir), now()), second)
    return rd.read_ledger_table(spark, second).select(
        "url", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at")
    )


def sink_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status table written after an update and read back."""
    path = work_path(spark, "status")
    status = fixture(spark, sf_dir, "package_status")
    sk.write_status(apply_updates(status, version_updates(status, feeds(spark, sf_dir))), path)
    return catalog_queries._text(rd.read_status_table(spark, path))


def source_version_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version feeds landed as a JSON file per package."""
    path = work_path(spark, "feeds")
    sk.write_version_feeds(feeds(spark, sf_dir), path)
    rows = rd.read_version_feed(spark, path, encoded=True)
    return rows.select("nuget", F.array_join("versions", " ").alias("versions"))


def sink_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean pages written by family and read back."""
    path = work_path(spark, "pages")
    raw = fixture(spark, sf_dir, "raw_page").select("p_partkey", "family_name", "version", "name", "content")
    sk.write_pages(cl.clean_pages(raw), path)
    back = spark.read.schema("p_partkey bigint, name string, content string, family string").parquet(path)
    return back.select("p_partkey", "family", "name", "content")


def sink_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update list written as JSON arrays and read back as rows."""
    path = work_path(spark, "updates")
    status = fixture(spark, sf_dir, "package_status")
    sk.write_updates(version_updates(status, feeds(spark, sf_dir)), path)
    row = "array<struct<family:string, nuget:string, version:string>>"
    return spark.read.text(path).select(F.explode(F.from_json("value", row)).alias("u")).select("u.*")


def sink_review_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State table written and read back."""
    path = work_path(spark, "state")
    seen = fixture(spark, sf_dir, "review_state").withColumn("pr_number", F.col("pr_number").cast("int"))
    sk.write_review_state(seen.select("repo_url", "pr_number", "product", "decision", "score", "reviewed_at", "pr_updated_at"), path)
    back = rd.read_review_state(spark, path).withColumn("pr_number", F.col("pr_number").cast("bigint"))
    return review_queries._state_text(back)


def sink_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics rows added to a table twice and read back."""
    path = work_path(spark, "metrics")
    for _ in range(2):
        sk.append_metrics(review_queries.run_metrics(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("run_id", "status", "items_succeeded").agg(F.count("*").alias("n"))


def sink_export_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean pages, home pages too, exported as Markdown files, a folder per family, and read back from them; pages of one name
    count once, the last of them."""
    path = work_path(spark, "export")
    raw = fixture(spark, sf_dir, "raw_page").select("p_partkey", "family_name", "version", "name", "content")
    sk.export_pages(cl.clean_pages(raw), path, order=["p_partkey"])
    return rd.read_pages(spark, path, exported=True).select("family", "name", "content")


def source_search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search data landed as one JSON file per family and language, merged after it was read."""
    path = work_path(spark, "search-files")
    docs = search_docs(spark, sf_dir)
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    fields = lambda m: F.array_join(
        F.transform(F.map_entries(m), lambda e: F.concat(quoted(e["key"]), F.lit(":"), quoted(e["value"]))), ","
    )
    data = F.when(F.col("data").isNotNull(), F.concat(F.lit('"data":{'), fields("data"), F.lit("},"))).otherwise("")
    entry = F.concat(quoted(F.col("page_path")), F.lit(":{"), data, fields("other"), F.lit("}"))
    files = docs.groupBy("family", "lang").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    content = F.concat(F.lit("{"), F.array_join("e", ","), F.lit("}")).alias("content")
    write_files(files.select(F.col("family").alias("folder"), F.concat("lang", F.lit(".search-data.json")).alias("name"), content), path)
    families = [f"f{i}" for i in range(8)]
    return site_queries.merged_text(merge_search(rd.read_search_index(spark, path, families)))


def source_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of packages, landed in their folders: sizes and places."""
    path = work_path(spark, "artifacts")
    files = fixture(spark, sf_dir, "artifact")
    folder = F.concat_ws("/", "nuget", "family", F.concat(F.lit("lib"), F.col("walk_ord")))
    name = F.element_at(F.split("path", "/"), -1)
    write_files(files.select(folder.alias("folder"), name.alias("name"), F.expr("repeat('x', int(length))").alias("content")), path)
    back = rd.read_artifacts(spark, path)
    below = F.expr("regexp_extract(path, '/(lib[^/]+/[^/]+)$', 1)")
    return back.select("nuget", "family", below.alias("path"), "length")


def source_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checklist written as YAML and read back drives the review of every page."""
    path = work_path(spark, "checklist")
    row = "  - id: {0.id}\n    description: \"{0.description}\"\n    weight: {0.weight}\n    type: {0.type}\n"
    lines = [row.format(c).replace("\\", "\\\\") for c in DEFAULT_CHECKLIST]
    text = "checks:\n" + "".join(lines) + "ai_evaluation:\n  weight: 20\n"
    write_files(spark.createDataFrame([(".", "checklist.yaml", text)], "folder string, name string, content string"), path)
    checks, _ = rd.read_checklist(f"{path}/checklist.yaml")
    return page_queries.static_review(spark, sf_dir, checks)


def source_filter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules written as YAML and read back: the API ids that they keep."""
    path = work_path(spark, "rules")
    text = "apiRules:\n" + "".join(f"  - {action}:\n      uidRegex: '{regex}'\n" for action, regex in catalog_queries.RULES)
    write_files(spark.createDataFrame([(".", "filter.yml", text)], "folder string, name string, content string"), path)
    return apply_filter_rules(fixture(spark, sf_dir, "api_id"), rd.read_filter_rules(f"{path}/filter.yml"))


def _landed_map(rows: DataFrame, path: str) -> str:
    """One JSON object of rows (key, value), the value a JSON text, as a file over several lines."""
    entry = F.concat(F.lit(" "), F.regexp_replace(F.to_json(F.array("key")), r"^\[|\]$", ""), F.lit(": "), "value")
    whole = rows.groupBy().agg(F.array_sort(F.collect_list(entry)).alias("e"))
    text = F.concat(F.lit("{\n"), F.array_join("e", ",\n"), F.lit("\n}\n")).alias("content")
    write_files(whole.select(F.lit(".").alias("folder"), F.lit("map.json").alias("name"), text), path)
    return f"{path}/map.json"


def source_status_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status file of the original form, one JSON object, read by ranges."""
    status = fixture(spark, sf_dir, "package_status")
    value = F.to_json(F.struct("nuget", "version", F.date_format("processed", "yyyy-MM-dd").alias("processed")))
    path = _landed_map(status.select(F.col("family").alias("key"), value.alias("value")), work_path(spark, "status-json"))
    return catalog_queries._text(rd.read_status(spark, path))


def source_ledger_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of processed URLs of the original form, one JSON object, read by ranges."""
    time = F.concat(F.lit('"'), F.date_format("processed_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z"'))
    ledger = fixture(spark, sf_dir, "ledger").select(F.col("url").alias("key"), time.alias("value"))
    rows = rd.read_ledger(spark, _landed_map(ledger, work_path(spark, "ledger-json")))
    return rows.select("url", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"))


def source_batches_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of URL batches of the original form, a list of batches for each host, read by ranges."""
    docs, sites, ledger, time = site_queries._site(spark, sf_dir)
    batches = site_queries.site.url_batches(docs, sites, ledger, time, size=site_queries.BATCH, families=site_queries.FAMILIES)
    hosts = batches.groupBy("subdomain").agg(F.array_sort(F.collect_list(F.struct("batch_no", "urls"))).alias("b"))
    value = F.to_json(F.col("b.urls"))
    path = _landed_map(hosts.select(F.col("subdomain").alias("key"), value.alias("value")), work_path(spark, "batches-json"))
    whole = rd.read_batches(spark, path).groupBy("subdomain", "batch_no").agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("u"))
    return whole.select("subdomain", F.col("batch_no").cast("bigint").alias("batch_no"), F.array_join(F.col("u.url"), " ").alias("urls"))


def ledger_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed URLs kept in buckets: written, read, upserted, written and read again."""
    paths = [work_path(spark, "ledger-buckets") for _ in range(2)]
    first = fixture(spark, sf_dir, "ledger").select("url", "processed_at")
    write_state(first, paths[0], ["url"], 16)
    ledger = read_state(spark, paths[0], rd.LEDGER_SCHEMA, ["url"], 16)
    done = site_queries._outcomes(spark, sf_dir).filter("ok").select("url", now().alias("processed_at"))
    write_state(upsert_state(ledger, done, ["url"], ["processed_at"]), paths[1], ["url"], 16)
    after = read_state(spark, paths[1], rd.LEDGER_SCHEMA, ["url"], 16)
    return after.select("url", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"))


def _published_and_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw pages, and clean ones as they were published: some are missing, some were others; whole families are as they are now."""
    raw = fixture(spark, sf_dir, "raw_page").filter("name NOT LIKE 'Acme%'").select("p_partkey", "family_name", "version", "name", "content")
    clean = cl.clean_pages(raw).withColumn("path", F.concat_ws("/", "family", "name"))
    settled = F.col("family").rlike("[0-4]$")
    old = clean.filter(settled | (F.col("p_partkey") % 3 != 0)).withColumn(
        "content", F.when(~settled & (F.col("p_partkey") % 4 == 0), F.concat("content", F.lit("old"))).otherwise(F.col("content"))
    )
    return raw, old.select("path", "content")


def pages_to_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are new or changed, found by a manifest of hashes."""
    raw, old = _published_and_raw(spark, sf_dir)
    path = work_path(spark, "manifest")
    write_manifest(old, path)
    return catalog.pages_to_publish(raw, path).select("path", "change")


def family_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short names of families."""
    raw = fixture(spark, sf_dir, "raw_page")
    return raw.groupBy(family_slug(F.col("family_name")).alias("family")).agg(F.count("*").alias("pages"))


_METRICS = review_queries.QUERIES["run_metrics"][1]

QUERIES = {
    "source_query_rows": (
        source_query_rows,
        f"""SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS n FROM ({fx.QUERY_ROW}) q
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-18' AND DATE '2024-02-15' GROUP BY 1""",
    ),
    "source_sitemaps": (source_sitemaps, site_queries.QUERIES["sitemap_urls"][1]),
    "source_changed_files": (
        source_changed_files,
        f"""SELECT status, count(*) AS files, count(content) AS readable, CAST(sum(length(content)) AS BIGINT) AS characters
        FROM ({fx.CHANGED_FILE}) f GROUP BY status""",
    ),
    "sink_keywords": (sink_keywords, site_queries.QUERIES["keywords_by_page"][1]),
    "sink_search_index": (sink_search_index, site_queries.QUERIES["search_merge"][1]),
    "sink_batches": (sink_batches, site_queries.QUERIES["url_batches"][1]),
    "source_batches": (source_batches, site_queries.QUERIES["url_batches"][1]),
    "sink_ledger": (sink_ledger, site_queries.QUERIES["ledger_upsert"][1]),
    "sink_status": (sink_status, catalog_queries.QUERIES["status_after_updates"][1]),
    "source_version_feed": (
        source_version_feed,
        f"SELECT lower(nuget) AS nuget, concat_ws(' ', v1, v2) AS versions FROM ({fx.VERSION_FEED}) f",
    ),
    "sink_pages": (sink_pages, cleanup_queries.QUERIES["page_clean"][1]),
    "sink_updates": (sink_updates, catalog_queries.QUERIES["version_updates"][1]),
    "sink_review_state": (
        sink_review_state,
        f"SELECT {review_queries._STATE_COLS} FROM ({fx.REVIEW_STATE}) st",
    ),
    "sink_metrics": (
        sink_metrics,
        f"SELECT run_id, status, items_succeeded, CAST(2 AS BIGINT) AS n FROM ({_METRICS}) m",
    ),
    "sink_export_pages": (
        sink_export_pages,
        f"""SELECT family, name, content FROM ({cleanup_queries.QUERIES['page_clean'][1]}) c
        QUALIFY row_number() OVER (PARTITION BY family, name ORDER BY content IS NULL, p_partkey DESC NULLS LAST, content DESC) = 1""",
    ),
    "source_search_index": (source_search_index, site_queries.QUERIES["search_merge"][1]),
    "source_artifacts": (
        source_artifacts,
        f"""SELECT nuget, family, 'lib' || CAST(walk_ord AS VARCHAR) || '/' || regexp_extract(path, '[^/]+$') AS path, length
        FROM ({fx.ARTIFACT}) a""",
    ),
    "source_checklist": (source_checklist, page_queries.QUERIES["page_static_review"][1]),
    "source_filter_rules": (source_filter_rules, catalog_queries.QUERIES["api_filter"][1]),
    "source_status_json": (
        source_status_json,
        f"SELECT family, nuget, version, strftime(processed, '%Y-%m-%d') AS processed FROM ({fx.PACKAGE_STATUS}) s",
    ),
    "source_ledger_json": (
        source_ledger_json,
        f"SELECT url, strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at FROM ({fx.LEDGER}) l",
    ),
    "source_batches_json": (source_batches_json, site_queries.QUERIES["url_batches"][1]),
    "ledger_upsert_bucketed": (ledger_upsert_bucketed, site_queries.QUERIES["ledger_upsert"][1]),
    "pages_to_publish": (
        pages_to_publish,
        f"""SELECT fam || '/' || name AS path, CASE WHEN p_partkey % 3 = 0 THEN 'added' ELSE 'modified' END AS change
        FROM (SELECT lower(replace(p_brand, '#', '')) AS fam, name, p_partkey FROM ({fx.RAW_PAGE}) r JOIN part USING (p_partkey)
          WHERE name NOT LIKE 'Acme%') x
        WHERE NOT regexp_matches(fam, '[0-4]$') AND (p_partkey % 3 = 0 OR p_partkey % 4 = 0)""",
    ),
    "family_slugs": (
        family_slugs,
        "SELECT lower(replace(p_brand, '#', '')) AS family, count(*) AS pages FROM part GROUP BY 1",
    ),
}
