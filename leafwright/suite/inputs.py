"""Fixtures as DataFrames, with arrays, maps, XML and JSON put on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators.groups import spread
from leafwright.suite import fixtures as fx

# Pages that a task cleans: some seconds of work.
ROWS_PER_TASK = 20_000


def tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Make the driver tables known by name; times are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name in names or fx.TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture by name."""
    sql = getattr(fx, name.upper())
    tables(spark, sf_dir, *[t for t in fx.TABLES if f" {t}" in sql])
    if name == "raw_page":
        # Its texts are made and cleaned row by row, so a table of a single row group would be one task.
        spread(spark.table("part"), ROWS_PER_TASK).createOrReplaceTempView("part")
    return spark.sql(sql)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "page")


def change_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.when(F.col("has_docs_label"), F.array(F.lit("docs"), F.lit("auto"))).otherwise(F.array(F.lit("auto")))
    return fixture(spark, sf_dir, "change_set").withColumn("labels", labels)


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "version_feed")
    return df.select("nuget", F.array_compact(F.array("v1", "v2")).alias("versions"))


def search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.create_map("key1", "value1", "key2", "value2")
    return fixture(spark, sf_dir, "search_doc").select(
        "lang",
        "family",
        "family_ord",
        "page_path",
        F.when(F.col("has_data"), data).alias("data"),
        F.create_map(F.lit("title"), "title").alias("other"),
    )


def query_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "query_row")
    return df.select("event_id", "ts", F.array_compact(F.array("k1", "k2")).alias("keys"))


def sitemap_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap XML: the page sitemaps, and an index per host."""
    rows = fixture(spark, sf_dir, "sitemap_page")

    def xml(root: str, entries) -> F.Column:
        ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
        head = f'<?xml version="1.0" encoding="UTF-8"?>\n<{root} {ns}>'
        return F.concat(F.lit(head), F.array_join(F.transform(entries, lambda e: e["x"]), "\n"), F.lit(f"</{root}>"))

    mod = F.when(
        F.col("lastmod").isNotNull(), F.concat(F.lit("<lastmod>"), "lastmod", F.lit("</lastmod>"))
    ).otherwise("")
    entry = F.concat(F.lit("<url><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc>"), mod, F.lit("</url>"))
    # The second sitemap of a host also names the third.
    below = F.when(
        F.col("sm") == 1,
        F.concat(F.lit("<url><loc>https://"), "subdomain", F.lit("/sm-2.xml</loc></url>")),
    ).otherwise("")
    packed = rows.groupBy("subdomain", "host", "sm", "sitemap_url", "status", "bad_xml").agg(
        F.array_sort(F.collect_list(F.struct("pos", entry.alias("x")))).alias("_e")
    )
    whole = F.replace(xml("urlset", F.col("_e")), F.lit("</urlset>"), F.concat(below, F.lit("</urlset>")))
    leaf = packed.select(
        "subdomain",
        "sitemap_url",
        "status",
        F.when(~F.col("bad_xml"), whole)
        # What is no XML, has a bare & in a text, or was cut off names nothing.
        .when(F.col("host") % 3 == 0, "not found")
        .when(F.col("host") % 3 == 1, F.replace(whole, F.lit("</loc>"), F.lit("?a=1&b=2</loc>")))
        .otherwise(F.substr(whole, F.lit(1), F.length(whole) - 20))
        .alias("body"),
    )
    named = rows.filter("sm < 2").select("subdomain", "sm", "sitemap_url").distinct()
    index = named.groupBy("subdomain").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "sm", F.concat(F.lit("<sitemap><loc>"), "sitemap_url", F.lit("</loc></sitemap>")).alias("x")
                )
            )
        ).alias("_e")
    )
    return leaf.unionByName(
        index.select(
            "subdomain",
            F.concat(F.lit("https://"), "subdomain", F.lit("/sitemap.xml")).alias("sitemap_url"),
            F.lit(200).alias("status"),
            xml("sitemapindex", F.col("_e")).alias("body"),
        )
    )


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "sitemap_page")
    return df.select("subdomain", (F.col("host") % 2 == 0).alias("has_families")).distinct()
