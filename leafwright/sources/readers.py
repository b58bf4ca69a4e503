"""Readers of landed site data.  All schemas are given, none is inferred.

Nothing is fetched: payloads of feeds, sitemaps and reviews are landed as files
or tables by whatever calls the outside services.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators.checks import CheckDef
from leafwright.operators.frontier import explode_batches
from leafwright.sources.json_map import read_json_map
from leafwright.sources.page_files import file_system
from leafwright.sources.whole_files import hidden_from_exports, hidden_from_pages, whole_files

REVIEW_STATE_SCHEMA = (
    "repo_url string, pr_number int, product string, decision string, score int,"
    " reviewed_at timestamp, pr_updated_at timestamp"
)
CHANGED_FILE_SCHEMA = (
    "repo_url string, pr_number int, file_ord int, path string, status string, patch string,"
    " additions int, deletions int, content string"
)
STATUS_SCHEMA = "family string, nuget string, version string, processed date"
LEDGER_SCHEMA = "url string, processed_at timestamp"
BATCH_SCHEMA = "subdomain string, batch_no bigint, urls array<string>"
SEARCH_SCHEMA = "page_path string, part bigint, data map<string,string>, other map<string,string>, lang string"
STATUS_VALUE = "struct<nuget:string, version:string, processed:string>"
QUERY_ROW_SCHEMA = "keys array<string>, date date"
SITEMAP_SCHEMA = "subdomain string, sitemap_url string, status int, body string"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_pages(spark: SparkSession, path: str, family: str | None = None, exported: bool = False) -> DataFrame:
    """Markdown pages of a folder tree: ``family, path, name, content``.

    The family is the folder of a page unless it is given.  Files whose names begin with ``_``, as home pages, are pages too.
    With ``exported`` the tree is one that ``export_pages`` wrote: no name is hidden, and names are not percent-encoded.
    """
    files = whole_files(spark, path, "*" if exported else "*.md", hidden_from_exports if exported else hidden_from_pages, empty=True)
    # Decoding takes a plus for a blank.
    plain = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))) if exported else c
    folder = F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1)
    return files.select(
        (F.lit(family) if family else plain(folder)).alias("family"),
        F.col("file_path").alias("path"),
        plain(F.col("name")).alias("name"),
        F.col("value").alias("content"),
    )


def read_status(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Package status: ``family, nuget, version, processed``.

    A missing or damaged file gives an empty table; ``strict`` makes it an error.
    """
    if not _exists(spark, path):
        if strict:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], STATUS_SCHEMA)
    rows = read_json_map(spark, path, STATUS_VALUE)
    if strict and rows.isEmpty() and not spark.read.text(path).filter("value RLIKE '[^{} \\t\\r]'").isEmpty():
        raise ValueError(f"damaged status file: {path}")
    return rows.select(
        F.col("key").alias("family"), "value.nuget", "value.version", F.try_to_date("value.processed", "yyyy-MM-dd").alias("processed")
    )


def read_version_feed(
    spark: SparkSession, path: str, glob: str = "*.json", by_folder: bool = False, encoded: bool = False
) -> DataFrame:
    """Version feeds, one JSON file per package named after it: ``nuget, versions``.

    With ``by_folder`` the folder ``nuget=..`` names the package, as in files that Spark wrote; with ``encoded`` the
    file's name does so, percent-encoded, as ``write_version_feeds`` leaves it.
    """
    folder = F.try_url_decode(F.regexp_extract("file_path", r"/nuget=([^/]+)/[^/]+$", 1))
    named = F.try_url_decode(folder) if by_folder else F.regexp_replace("name", r"\.json$", "")
    if encoded:
        # Spark gives the names of files percent-encoded once more.
        named = F.try_url_decode(F.try_url_decode(F.regexp_replace("name", r"^nuget=|\.json$", "")))
    parsed = F.from_json("value", "versions array<string>")
    return whole_files(spark, path, glob).select(
        F.lower(named).alias("nuget"),
        F.coalesce(parsed["versions"], F.array().cast("array<string>")).alias("versions"),
    )


def read_search_index(spark: SparkSession, path: str, families: Sequence[str]) -> DataFrame:
    """Search documents in ``{family}/{lang}.search-data.json`` files.

    Gives ``lang, family, family_ord, page_path, data, other``; damaged files
    are left out.
    """
    order = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    files = whole_files(spark, path, "*.search-data.json").select(
        F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1).alias("family"),
        F.regexp_extract("name", r"^([^.]+)\.", 1).alias("lang"),
        F.from_json("value", "map<string, map<string, string>>").alias("docs"),
    )
    pages = files.filter("docs IS NOT NULL").select(
        "lang", "family", order.cast("int").alias("family_ord"), F.explode("docs").alias("page_path", "c")
    )
    return pages.filter("family_ord >= 0").select(
        "lang",
        "family",
        "family_ord",
        "page_path",
        F.from_json(F.try_element_at("c", F.lit("data")), "map<string, string>").alias("data"),
        F.map_filter("c", lambda k, v: k != "data").alias("other"),
    )


def read_query_rows(
    spark: SparkSession, path: str, end_date: Column, days: int = 28, row_limit: int | None = None
) -> DataFrame:
    """Search-query rows of the days before ``end_date``; ``row_limit`` is how many one call of the service gives."""
    rows = spark.read.schema(QUERY_ROW_SCHEMA).json(path)
    rows = rows.filter(F.col("date").between(F.date_sub(end_date, days), end_date))
    return rows if row_limit is None else rows.limit(row_limit)


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """Landed sitemap payloads: ``subdomain, sitemap_url, status, body``."""
    return spark.read.schema(SITEMAP_SCHEMA).json(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Processed URLs: ``url, processed_at``; a missing file gives an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = read_json_map(spark, path, "string")
    return rows.select(F.col("key").alias("url"), F.try_to_timestamp("value").alias("processed_at"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """URL batches: ``subdomain, batch_no, pos, url`` from a map of lists."""
    hosts = read_json_map(spark, path, "array<array<string>>").withColumnRenamed("key", "subdomain")
    batches = hosts.select("subdomain", F.posexplode("value").alias("batch_no", "urls"))
    return batches.select("subdomain", "batch_no", F.posexplode("urls").alias("pos", "url"))


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Files of extracted packages in ``{nuget}/{family}/..``: ``nuget, family, path, length``.

    Contents are not read.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    )
    base = path.rstrip("/").rsplit("/", 1)[-1]
    below = F.element_at(F.split("path", f"/{base}/"), -1)
    parts = F.split(below, "/")
    return listing.select(
        F.get(parts, F.lit(0)).alias("nuget"), F.get(parts, F.lit(1)).alias("family"), "path", "length"
    )


def _yaml_file(path: str) -> dict:
    import yaml

    system, name = file_system(path)
    with system.open_input_stream(name) as f:
        return yaml.safe_load(f.read().decode()) or {}


def read_checklist(path: str) -> tuple[list[CheckDef], dict]:
    """Checks of a YAML checklist in order, and its settings for the model (a small file, read on the driver)."""
    data = _yaml_file(path)
    checks = [
        CheckDef(c["id"], c.get("description", c["id"]), int(c.get("weight", 0)), c.get("type", "recommended"))
        for c in data.get("checks", [])
    ]
    return checks, data.get("ai_evaluation", {})


def read_filter_rules(path: str) -> list[tuple[str, str]]:
    """Ordered ``(action, pattern)`` rules of a YAML filter file (a small file, read on the driver)."""
    data = _yaml_file(path)
    return [(action, rule["uidRegex"]) for item in data.get("apiRules", []) for action, rule in item.items()]


def _table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A written table; a missing one is an empty one."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_status_table(spark: SparkSession, path: str) -> DataFrame:
    """Package status as ``write_status`` leaves it."""
    return _table(spark, path, STATUS_SCHEMA)


def read_ledger_table(spark: SparkSession, path: str) -> DataFrame:
    """Processed URLs as ``write_ledger`` leaves them."""
    return _table(spark, path, LEDGER_SCHEMA)


def read_batch_table(spark: SparkSession, path: str) -> DataFrame:
    """URL batches as ``write_batches`` leaves them: ``subdomain, batch_no, pos, url``."""
    return explode_batches(_table(spark, path, BATCH_SCHEMA, "json"))


def read_search_table(spark: SparkSession, path: str) -> DataFrame:
    """Search index as ``write_search_index`` leaves it: ``lang, page_path, part, data, other``."""
    return _table(spark, path, SEARCH_SCHEMA, "json").select("lang", "page_path", "part", "data", "other")


def read_review_state(spark: SparkSession, path: str) -> DataFrame:
    """Saved reviews; a missing table is an empty one."""
    return _table(spark, path, REVIEW_STATE_SCHEMA)


def read_changed_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed changed files with patch and content."""
    return spark.read.format(fmt).schema(CHANGED_FILE_SCHEMA).load(path)


def permissive(df: DataFrame, parsed: str) -> tuple[DataFrame, DataFrame]:
    """``(good rows, number of bad rows)`` of a table with a parsed column that is NULL when damaged."""
    bad = df.agg(F.count_if(F.col(parsed).isNull()).alias("errors"))
    return df.filter(F.col(parsed).isNotNull()), bad
