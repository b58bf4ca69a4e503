"""Registered queries, their fixtures and their SQL oracles."""

from leafwright.suite import (
    catalog_queries,
    cleanup_queries,
    field_queries,
    io_queries,
    page_queries,
    review_queries,
    site_queries,
    stream_queries,
)

REGISTRY = {
    **page_queries.QUERIES,
    **review_queries.QUERIES,
    **site_queries.QUERIES,
    **catalog_queries.QUERIES,
    **cleanup_queries.QUERIES,
    **field_queries.QUERIES,
    **io_queries.QUERIES,
    **stream_queries.QUERIES,
}
