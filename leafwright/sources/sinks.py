"""Writers.  Tables go out partitioned; single files only where the data is small by nature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.operators.groups import split_in_order
from leafwright.sources.page_files import write_files


def write_pages(df: DataFrame, path: str, by: tuple[str, ...] = ("family",), mode: str = "overwrite") -> None:
    """Clean pages as a table with a folder per family."""
    df.write.mode(mode).partitionBy(*by).parquet(path)


def export_pages(df: DataFrame, folder: str, order: Sequence[str] = ()) -> int:
    """Clean pages (family, name, content) as ``.md`` files in a folder per family; gives their number.

    Of pages with the same family and name, as two home pages of a family, the last by ``order``, then by content, is there.
    A page whose content is NULL is none.
    """
    last = F.max(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], "content")).alias("_page")
    pages = df.filter("content IS NOT NULL").groupBy(F.col("family").alias("folder"), "name").agg(last)
    return write_files(pages.select("folder", "name", "_page.content"), folder)


def write_version_feeds(df: DataFrame, folder: str, rows: int = 1000) -> int:
    """Version feeds (nuget, versions) as one JSON file per package, named after it; gives their number.

    Tasks of about ``rows`` packages put them side by side into one folder, so neither a commit nor a listing goes
    through a folder for each.  A file is named as Spark names a partition, ``nuget=..``, percent-encoded; so is one without a name.
    Of feeds of one name the first is there.
    """
    named = df.withColumn("nuget", F.coalesce(F.nullif("nuget", F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")))
    files = named.repartition(-(-df.count() // rows) or 1, "nuget").dropDuplicates(["nuget"])
    name = F.concat(F.lit("nuget="), F.url_encode("nuget"), F.lit(".json"))
    return write_files(files.select(F.lit(".").alias("folder"), name.alias("name"), F.to_json(F.struct("versions")).alias("content")), folder)


def updates_json(df: DataFrame, size: int = 10000) -> DataFrame:
    """Update list as a JSON array: ``part, value``.

    Each row holds ``size`` updates, in order of ``pos`` if there is one, else of
    ``family``; there is one row, ``[]``, when nothing is to be updated.
    """
    order = "pos" if "pos" in df.columns else "family"
    updates = split_in_order(df, [], [order], size)
    entry = F.struct(F.col(order).alias("at"), F.struct("family", "nuget", "version").alias("u"))
    arrays = updates.groupBy("part").agg(F.array_sort(F.collect_list(entry)).alias("_u"))
    listed = arrays.select("part", F.to_json(F.transform("_u", lambda x: x["u"])).alias("value"))
    none = updates.agg(F.count("*").alias("_n")).filter("_n = 0")
    return listed.unionByName(none.select(F.lit(0).cast("bigint").alias("part"), F.lit("[]").alias("value")))


def write_updates(df: DataFrame, path: str) -> None:
    """Update list as text lines, each a JSON array."""
    updates_json(df).select("value").write.mode("overwrite").text(path)


def write_search_index(df: DataFrame, path: str) -> None:
    """Merged index with a folder per language; a language without pages gets none."""
    df.write.mode("overwrite").partitionBy("lang").json(path)


def write_keywords(df: DataFrame, path: str) -> None:
    """Keywords of pages with a folder per host."""
    host = F.regexp_extract("url", r"https?://([^/]+)", 1)
    df.withColumn("subdomain", host).write.mode("overwrite").partitionBy("subdomain").json(path)


def write_batches(df: DataFrame, path: str) -> None:
    """URL batches, one JSON row each."""
    df.write.mode("overwrite").json(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Add metrics rows to their table."""
    df.write.mode("append").parquet(path)


def write_review_state(df: DataFrame, path: str) -> None:
    """Write the new state table; an existing path is an error, so the table being read is never lost."""
    df.write.mode("errorifexists").parquet(path)


def write_status(df: DataFrame, path: str) -> None:
    """Write the new status table; as with the review state, to a path of its own."""
    df.select("family", "nuget", "version", "processed").write.mode("errorifexists").parquet(path)


def write_ledger(df: DataFrame, path: str) -> None:
    """Write the new table of processed URLs; as with the review state, to a path of its own."""
    df.select("url", "processed_at").write.mode("errorifexists").parquet(path)
