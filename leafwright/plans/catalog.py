"""The catalog job: new versions, pages to publish, and the status table after it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.operators import catalog as cat
from leafwright.operators.cleanup import clean_pages
from leafwright.operators.manifest import changed_by_manifest
from leafwright.session import settle


@dataclass(frozen=True)
class VersionRun:
    """Updates found and the status table with them."""

    updates: DataFrame
    status: DataFrame


def check_versions(status: DataFrame, feed: DataFrame) -> VersionRun:
    """Compare the status table with the version feeds."""
    updates = cat.version_updates(status, feed)
    return VersionRun(updates, cat.apply_updates(status, updates))


def pages_to_publish(
    raw: DataFrame,
    published: DataFrame | str,
    prefix: str = "Acme.",
    home_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Clean pages with ``path`` and ``change``; unchanged ones are left out.

    ``published`` is a table of published pages, or the path of their manifest: then none of them is read.
    """
    # Cleaned once; then only hashes meet the published pages, and the paths that changed meet the written pages.
    clean = settle(clean_pages(raw, prefix, home_names).withColumn("path", F.concat_ws("/", "family", "name")), "clean")
    if isinstance(published, str):
        change = settle(changed_by_manifest(clean.select("path", "content"), published), "changed")
    else:
        change = settle(cat.changed_pages(clean, published).filter("change <> 'unchanged'"), "changed")
    return clean.join(change, "path")
