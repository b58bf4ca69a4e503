"""Change sets and their files: what is to be reviewed in a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.pages import platform_labels
from leafwright.operators.groups import first_by

KEYS = ["repo_url", "pr_number"]


def select_change_sets(
    df: DataFrame,
    prefix: str | None = None,
    labels: Sequence[str] = (),
    order: Sequence[str] = ("created_at",),
) -> DataFrame:
    """Change sets whose branch has ``prefix`` or which carry all ``labels``.

    With neither given nothing is selected.  One row per number, the first by ``order``.
    """
    wanted = F.lit(False)
    if prefix:
        wanted = wanted | F.col("head_ref").startswith(prefix)
    if labels:
        required = F.array(*[F.lit(x) for x in labels])
        carried = F.coalesce("labels", F.array().cast("array<string>"))
        wanted = wanted | (F.size(F.array_except(required, carried)) == 0)
    return first_by(df.filter(wanted), KEYS, order)


def select_markdown(df: DataFrame, path_contains: str | None = None) -> DataFrame:
    """Added or modified ``.md`` files, of one part of the tree when asked."""
    keep = F.col("path").endswith(".md") & F.col("status").isin("added", "modified")
    if path_contains:
        keep = keep & F.col("path").contains(path_contains)
    return df.filter(keep)


def filter_product(df: DataFrame, key: str, known: Sequence[str]) -> DataFrame:
    """Rows of one product; an unknown key is an error."""
    if key not in known:
        raise ValueError(f"unknown product: {key!r}")
    return df.filter(F.col("product") == key)


def has_files(change_sets: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(with files, skipped)``: change sets with and without a file to review."""
    found = files.select(*KEYS).distinct()
    return change_sets.join(found, KEYS, "left_semi"), change_sets.join(found, KEYS, "left_anti")


def not_reviewed(change_sets: DataFrame, state: DataFrame) -> DataFrame:
    """Change sets without a saved review."""
    return change_sets.join(state.select(*KEYS), KEYS, "left_anti")


def needs_re_review(change_sets: DataFrame, state: DataFrame) -> DataFrame:
    """Reviewed change sets whose update time is not the one that was reviewed."""
    seen = state.select(*KEYS, "pr_updated_at")
    return change_sets.join(seen, KEYS).filter(~F.col("updated_at").eqNullSafe(F.col("pr_updated_at")))


def limit_reviews(
    change_sets: DataFrame, n: int | None, order: Sequence[str] = ("product_ord", "created_at", "pr_number")
) -> DataFrame:
    """At most ``n`` change sets of a run, products in order and oldest first."""
    return change_sets if n is None else change_sets.orderBy(*order).limit(n)


def change_set_platforms(
    files: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ("file_ord",)
) -> DataFrame:
    """``keys, platforms``: distinct labels of all paths, first seen first, ``All`` when none.

    Each label is cut down to its first place before labels are put together,
    so a group holds a dozen rows however many files it has.
    """
    seen = files.select(
        *keys,
        *order,
        F.posexplode_outer(platform_labels(F.col("path"))).alias("_pos", "_label"),
    )
    first = seen.groupBy(*keys, "_label").agg(F.min(F.struct(*order, "_pos")).alias("_at"))
    listed = first.groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(F.when(F.col("_label").isNotNull(), F.struct("_at", "_label")))
        ).alias("_labels")
    )
    names = F.array_join(F.transform("_labels", lambda x: x["_label"]), ", ")
    return listed.select(*keys, F.coalesce(F.nullif(names, F.lit("")), F.lit("All")).alias("platforms"))


def with_label(df: DataFrame, dim: DataFrame, on: str, value: str, default: Column | None = None) -> DataFrame:
    """Look up ``value`` of key ``on`` in a dimension; ``default`` when there is none.

    No broadcast is forced: Spark sees the size of the dimension and picks.
    """
    out = df.join(dim.select(on, value), on, "left")
    return out if default is None else out.withColumn(value, F.coalesce(F.col(value), default))
