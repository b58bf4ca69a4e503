"""Counters and metric rows of review runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwright.functions.pages import run_id
from leafwright.functions.text import title_case

# Fields of a metrics row, in order.
METRIC_FIELDS = (
    "timestamp",
    "agent_name",
    "agent_owner",
    "job_type",
    "run_id",
    "status",
    "item_name",
    "product",
    "platform",
    "website",
    "website_section",
    "items_discovered",
    "items_succeeded",
    "items_failed",
    "run_duration_ms",
    "token_usage",
    "api_calls_count",
)


def product_display(key: Column, display: Column, brand: str = "Acme") -> Column:
    """Display name: the known one, else brand and title-cased key; ``All Products`` without a key."""
    named = F.coalesce(display, F.concat(F.lit(f"{brand}."), title_case(key)))
    return F.when(key.isNull() | (key == ""), "All Products").otherwise(named)


def product_website(website: Column, default: str = "acme.example") -> Column:
    """Website of a product group, else the main one."""
    return F.coalesce(website, F.lit(default))


def run_status(succeeded: Column, failed: Column) -> Column:
    """``failure``, ``success`` or ``partial_success``."""
    return F.when(succeeded == 0, "failure").when(failed == 0, "success").otherwise("partial_success")


def run_counters(outcomes: DataFrame, by: str = "product") -> DataFrame:
    """Counters per product, and for the run in the row with ``by`` NULL and ``is_total``.

    ``outcomes`` has one row per change set: ``outcome`` (``reviewed``,
    ``skipped`` or ``error``), ``decision``, ``merged``, ``files_found`` and
    ``files_reviewed``.  Products are summed first; the total comes from those
    few rows, so the input is not doubled as a rollup would do.
    """
    reviewed = F.col("outcome") == "reviewed"

    def decided(name: str) -> Column:
        return F.count_if(reviewed & (F.col("decision") == name))

    other = ~F.col("decision").isin("APPROVE", "REQUEST_CHANGES")
    per_product = outcomes.groupBy(by).agg(
        F.count("*").alias("found"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(reviewed).alias("reviewed"),
        decided("APPROVE").alias("approved"),
        decided("REQUEST_CHANGES").alias("request_changes"),
        F.count_if(reviewed & other).alias("rejected"),
        F.count_if(reviewed & F.col("merged")).alias("merged"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
        F.sum("files_found").alias("files_found"),
        F.sum("files_reviewed").alias("files_reviewed"),
    )
    names = [c for c in per_product.columns if c != by]
    total = per_product.agg(*[F.sum(c).alias(c) for c in names]).select(
        F.lit(None).cast(per_product.schema[by].dataType).alias(by), *names, F.lit(True).alias("is_total")
    )
    return per_product.withColumn("is_total", F.lit(False)).unionByName(total)


def ai_usage(answers: DataFrame, by: str = "product") -> DataFrame:
    """Tokens and calls of each product."""
    return answers.groupBy(by).agg(
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("tokens"), F.count("*").alias("calls")
    )


def running_usage(usage: DataFrame, order: str = "product_ord") -> DataFrame:
    """Totals of the run so far, products in order (a few rows: one per product)."""
    so_far = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return usage.withColumn("tokens_so_far", F.sum("tokens").over(so_far)).withColumn(
        "calls_so_far", F.sum("calls").over(so_far)
    )


def run_metrics(
    counters: DataFrame,
    now: Column,
    agent_name: str,
    agent_owner: str,
    brand: str = "Acme",
    main_website: str = "acme.example",
    website_section: str = "API Reference",
    job_type: str = "pr_review",
    item_name: str = "Pull Requests",
    run_prefix: str = "page_review",
) -> DataFrame:
    """One 17-field row per product.

    ``counters`` needs ``product``, ``display``, ``website``, ``platforms``,
    ``files_found``, ``files_reviewed``, ``errors``, ``duration_ms``, ``tokens``
    and ``calls``.  Only errors count as failed items, not rejections.
    """
    values = {
        "timestamp": F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss"),
        "agent_name": F.lit(agent_name),
        "agent_owner": F.lit(agent_owner),
        "job_type": F.lit(job_type),
        "run_id": run_id(F.col("product"), now, run_prefix),
        "status": run_status(F.col("files_reviewed"), F.col("errors")),
        "item_name": F.lit(item_name),
        "product": product_display(F.col("product"), F.col("display"), brand),
        "platform": F.coalesce(F.nullif("platforms", F.lit("")), F.lit("All")),
        "website": product_website(F.col("website"), main_website),
        "website_section": F.lit(website_section),
        "items_discovered": F.col("files_found"),
        "items_succeeded": F.col("files_reviewed"),
        "items_failed": F.col("errors"),
        "run_duration_ms": F.col("duration_ms"),
        "token_usage": F.col("tokens"),
        "api_calls_count": F.col("calls"),
    }
    return counters.select(*[values[f].alias(f) for f in METRIC_FIELDS])
