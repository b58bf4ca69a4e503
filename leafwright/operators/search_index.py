"""Merge of per-family search documents to one index per language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.operators.groups import split_in_order

# Families of the search index, in merge order.
SEARCH_FAMILIES = tuple(
    """words pdf cells email slides imaging barcode diagram tasks ocr omr note cad 3d html gis zip
    page psd pub svg finance drawing font tex medical""".split()
)

# Languages of the search index.
SEARCH_LANGUAGES = tuple("ar cs de el es fa fr id it ja ko pl pt ru sv th tr uk vi zh".split())


def merge_entries(docs: DataFrame) -> DataFrame:
    """Merged entries in long form: ``lang, page_path, section, key, value``.

    ``docs`` has ``lang, family_ord, page_path`` and the maps ``data`` and
    ``other``.  ``data`` is merged key by key and other keys are replaced; the
    last family wins.  One value per key and map task reaches the shuffle.
    """
    return _entries(docs).filter("key IS NOT NULL")


def _entries(docs: DataFrame) -> DataFrame:
    # One scan: both maps become entries of one array.  A page without any
    # entry keeps a row with a NULL key, so that it stays in the index.
    def entries(name: str):
        found = F.coalesce(F.map_entries(name), F.array().cast("array<struct<key:string,value:string>>"))
        return F.transform(found, lambda e: F.struct(F.lit(name).alias("section"), e["key"].alias("key"), e["value"].alias("value")))

    rows = docs.select(
        "lang", "page_path", "family_ord", F.explode_outer(F.concat(entries("data"), entries("other"))).alias("_e")
    ).select("lang", "page_path", "family_ord", "_e.section", "_e.key", "_e.value")
    group = ["lang", "page_path", "section", "key"]
    return rows.groupBy(*group).agg(F.max_by("value", "family_ord").alias("value"))


def merge_search(docs: DataFrame, size: int = 10000) -> DataFrame:
    """``lang, page_path, part, data, other``: the merged index, a row per page.

    A page has a row for each ``size`` keys, in order of section and key.
    """
    rows = split_in_order(_entries(docs), ["lang", "page_path"], ["section", "key"], size)
    entry = F.struct("key", "value")

    def section(name: str):
        found = F.collect_list(F.when(F.col("section") == name, entry))
        return F.map_from_entries(F.array_sort(found)).alias(name)

    return rows.groupBy("lang", "page_path", "part").agg(section("data"), section("other"))
