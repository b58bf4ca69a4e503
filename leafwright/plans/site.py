"""The frontier job: from sitemap payloads and the ledger to batches, and back to the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from leafwright.operators import frontier as fr
from leafwright.operators.state import mark_processed
from leafwright.session import settle


def due_urls(
    docs: DataFrame,
    hosts: DataFrame,
    ledger: DataFrame,
    now: Column,
    families: Sequence[str] = fr.SITEMAP_FAMILIES,
    use_lastmod: bool = False,
    dedupe: bool = False,
) -> DataFrame:
    """URLs to be submitted, in visit order.

    XML is parsed once: the locations go to the work folder, where the
    expansion and the URLs each take the columns they need.  The visits, a row
    per sitemap, go there too, so their joins are not planned again with each
    use of the URLs.
    """
    locs = settle(fr.locations(docs), "locations")
    visits = settle(fr.expand_sitemaps(docs, hosts, families, dedupe=dedupe, locs=locs), "visits")
    return fr.frontier(fr.candidate_urls(locs, visits), ledger, now, use_lastmod=use_lastmod)


def url_batches(docs: DataFrame, hosts: DataFrame, ledger: DataFrame, now: Column, size: int = fr.BATCH_SIZE, **options) -> DataFrame:
    """Batches of the URLs to be submitted (numbering reads them twice, so they are written once)."""
    return fr.to_batches(settle(due_urls(docs, hosts, ledger, now, **options), "due"), size)


def submitted(ledger: DataFrame, outcomes: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """``(new ledger, submitted per batch)`` of a table of outcomes."""
    judged = fr.classify_outcome(outcomes)
    return mark_processed(ledger, judged, now), fr.submission_counts(judged)
