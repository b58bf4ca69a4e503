"""Search-query keywords of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.pages import lang_from_url
from leafwright.operators.groups import split_in_order

# Path parts of listing pages.
LISTING_PARTS = ("/tag/", "/categories/", "/archives/")


def valid_query_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``page, query`` of rows that have both keys."""
    return df.filter(F.size("keys") >= 2).select(
        F.get("keys", F.lit(0)).alias("page"), F.get("keys", F.lit(1)).alias("query"), *keep
    )


def drop_listing_pages(df: DataFrame, page: str = "page", parts: Sequence[str] = LISTING_PARTS) -> DataFrame:
    """Rows of pages that are not tag, category or archive listings."""
    for part in parts:
        df = df.filter(~F.col(page).contains(part))
    return df


def in_range(df: DataFrame, end: Column, days: int = 28, date: str = "date") -> DataFrame:
    """Rows of the ``days`` before ``end``, both ends included."""
    return df.filter(F.col(date).between(F.date_sub(end, days), end))


def keywords_by_page(rows: DataFrame, updated: Column, size: int = 25000, default_lang: str = "en") -> DataFrame:
    """``url, part, keywords, lang, last_updated``: distinct keywords of each page, sorted.

    A page has a row for each ``size`` keywords: ``part`` 0 holds the first ones
    in sorted order, and so on.  Repeats are dropped before the pairs are shuffled.
    """
    pairs = drop_listing_pages(valid_query_rows(rows)).distinct()
    parts = split_in_order(pairs, ["page"], ["query"], size)
    return parts.groupBy("page", "part").agg(F.sort_array(F.collect_list("query")).alias("keywords")).select(
        F.col("page").alias("url"),
        "part",
        "keywords",
        lang_from_url(F.col("page"), default_lang).alias("lang"),
        updated.alias("last_updated"),
    )
