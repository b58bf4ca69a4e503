"""What is published, as hashes: so that finding out what changed reads no published page.

A manifest has two tables: the hash of each page, a partition per folder, and a digest per folder.  New pages are hashed
as they are made; folders whose digest is the published one are settled by that, and of the pages' table only
the partitions of the others are read.  A digest is a sum over the hashes of a folder's pages, so a folder of any size is
summed up in its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.session import settle

PAGES, FOLDERS = "pages", "folders"
PAGE_SCHEMA = "path string, hash string, folder string"
FOLDER_SCHEMA = "folder string, digest string, n bigint"


def page_hashes(pages: DataFrame) -> DataFrame:
    """``path, hash, folder`` of pages (path, content)."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return pages.select("path", F.coalesce(F.sha2("content", 256), F.lit("")).alias("hash"), F.when(folder == "", ".").otherwise(folder).alias("folder"))


def folder_digests(hashes: DataFrame) -> DataFrame:
    """``folder, digest, n``: sums over four parts of the hash of each page's path and content."""
    both = F.sha2(F.concat_ws("\n", "path", "hash"), 256)
    part = lambda i: F.sum(F.conv(F.substr(both, F.lit(1 + 15 * i), F.lit(15)), 16, 10).cast("decimal(38,0)"))
    return hashes.groupBy("folder").agg(F.concat_ws("-", *[part(i).cast("string") for i in range(4)]).alias("digest"), F.count("*").alias("n"))


def write_manifest(pages: DataFrame, path: str) -> None:
    """Write the manifest of published pages (path, content) to a new path."""
    hashes = settle(page_hashes(pages), "page-hashes")
    hashes.write.mode("errorifexists").partitionBy("folder").parquet(f"{path}/{PAGES}")
    folder_digests(hashes).write.mode("errorifexists").parquet(f"{path}/{FOLDERS}")


def published_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).parquet(f"{path}/{PAGES}")


def changed_by_manifest(pages: DataFrame, path: str) -> DataFrame:
    """``path, change`` of the new pages (path, content) that are added or modified against a manifest."""
    spark = pages.sparkSession
    hashes = settle(page_hashes(pages), "page-hashes")
    there = spark.read.schema(FOLDER_SCHEMA).parquet(f"{path}/{FOLDERS}")
    equal = folder_digests(hashes).join(there, ["folder", "digest", "n"], "left_semi").select("folder")
    equal = settle(equal, "equal-folders")
    rest = hashes.join(equal, "folder", "left_anti")
    # A row per folder.  Below its broadcast threshold Spark leaves the partitions of other folders unread; it does so for
    # tables that are filtered, as this one is by its counts.
    wanted = settle(rest.groupBy("folder").agg(F.count("*").alias("pages")), "changed-folders").filter("pages > 0")
    old = published_hashes(spark, path).join(wanted, "folder", "left_semi").select("path", F.col("hash").alias("old"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("old") != F.col("hash"), "modified")
    return rest.join(old, "path", "left").select("path", change.alias("change")).filter("change IS NOT NULL")
