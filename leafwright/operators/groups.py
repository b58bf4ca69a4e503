"""Grouping helpers that stay spread out when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafwright.session import settle


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``.

    ``min_by`` keeps one row per key and map task, so nothing is sorted and a
    hot key costs one row per task, unlike a row number over the key.
    """
    return _pick(df, keys, order, F.min_by)


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``."""
    return _pick(df, keys, order, F.max_by)


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # A struct is never NULL, so rows without an order value count as first.
    rank = F.struct(*order)
    if not rest:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The same rows dealt out anew, about ``rows`` to a task: for narrow rows ahead of much work on each."""
    dealt = df.repartition(-(-df.count() // rows) or 1)
    # Later filters on what is worked out of these rows would be moved ahead of the shuffle; none passes this one.
    return dealt.filter(F.spark_partition_id() >= 0)


def split_in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, part: str = "part"
) -> DataFrame:
    """Add ``part``: the rows of each key in ``order``, ``size`` to a part, from 0.

    Grouping by ``keys`` and ``part`` afterwards gives every row of every key,
    yet no task gets a group above ``size``.  Rows are laid out by range of key
    and order, so a hot key covers several tasks; each range tells how many
    rows of its keys it holds, and running sums over these give the positions.
    The layout is written once, so ranges cannot move between its two readers.
    Parts are ranges of positions at every size; an empty ``keys`` is one key.
    """
    rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    laid = settle(rows.withColumn("_id", F.monotonically_increasing_id()), "in-order")
    # The upper bits of the id name the range.
    laid = laid.withColumn("_range", F.shiftright("_id", 33))
    ranges = laid.groupBy(*keys, "_range").agg(F.min("_id").alias("_low"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")
    named = {c: f"_of_{c}" for c in [*keys, "_range"]}
    starts = ranges.select(*[F.col(c).alias(n) for c, n in named.items()], shift.alias("_shift"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in named.items()])
    at = F.floor((F.col("_id") + F.col("_shift")) / size).cast("bigint")
    return laid.join(starts, same).select(*df.columns, at.alias(part))


def number_in_order(
    df: DataFrame,
    keys: Sequence[str],
    block: Sequence[str],
    order: Sequence[str],
    number: str = "rn",
) -> DataFrame:
    """Number the rows of each key from 1, in ``block`` then ``order`` sequence.

    A plain row number sorts a whole key in one task.  Here ``block`` columns
    cut a key to ordered blocks (a sitemap, a range of positions): rows are
    numbered inside their block, and blocks get their start from a running sum
    over block counts.
    """
    all_keys = [*keys, *block]
    counts = df.groupBy(*all_keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*all_keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = df.withColumn("_pos", F.row_number().over(Window.partitionBy(*all_keys).orderBy(*order)))
    return (
        inside.join(starts, all_keys)
        .withColumn(number, F.col("_start") + F.col("_pos"))
        .drop("_start", "_pos")
    )
