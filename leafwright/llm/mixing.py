"""Mixing sources to target weights: documents are counted by exact length and a subset of lengths fills the budget.

Each source gets a share of all words by weight, at most ``most`` times its own; what it cannot take is shared again.
Whole rounds of a source are taken first.  The rest is a bounded knapsack over the counts of each length: an equal
share of each length, then the longest that fit while much is left, then an exact dynamic programme over the last
few thousand words.  Which documents of a length are taken is a matter of their seeded hash.

Null texts have size 0; documents of size 0 are in every whole round and add nothing.  A null source is a source of
its own, the last.  Repeated rows are rows of their own; equal ids are told apart by their text, and rows equal in both by
their order only, which makes no difference.  Of documents of a length those of the least hash are taken.  Texts of any
length are counted whole, and an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwright.llm.texts import packed, read
from leafwright.session import settle

SEED = 11
MOST = 3


def size_of(text: Column) -> Column:
    """Number of runs of other signs than space and \\t \\n \\v \\f \\r."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` of rows (source, source_size): one row per source.

    Sources in order of their code points, null last, weigh 1, 2, 3, 1, ...  Sharing again until no source is above
    its cap is one water level: sources whose cap lies below ``level * weight`` get their cap, the others that product.
    """
    # UTF-8 bytes sort as code points do.  One row per source from here on.
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary")))
    rows = sources.withColumn("weight", ((place - 1) % 3 + 1).cast("double"))
    rows = rows.withColumn("cap", (F.col("source_size") * most).cast("double"))
    rows = rows.withColumn("_ratio", F.col("cap") / F.col("weight")).withColumn("_place", place)
    order = Window.orderBy("_ratio", "_place")
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(
        F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    free = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("_level", left / free)
    first = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_place", "_level"))
    rows = rows.withColumn("_level", F.min(first).over(whole)["_level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", target.alias("target"))


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int, exact: int = 1 << 14) -> np.ndarray:
    """How many of each length to take so that their words come as near ``budget`` as can be.

    ``lengths`` are distinct and above 0.  All but ``exact`` words (or twice the longest) are taken as an equal share
    of each length, and what rounding leaves as the longest that fit; for the last words, which sums can be reached
    is worked out length by length, each length at most as often as it is there.
    """
    order = np.argsort(-lengths, kind="stable")
    lengths, counts = lengths[order].astype(object), counts[order].astype(object)
    total = int((lengths * counts).sum())
    took = np.zeros(len(lengths), object)
    if total:
        bulk = budget - max(exact, 2 * int(lengths[0]))
        took = counts * max(0, min(bulk, total)) // total
    left = budget - int((lengths * took).sum())
    for i, length in enumerate(lengths):
        room = left - max(exact, 2 * int(length))
        if room >= length:
            more = min(counts[i] - took[i], room // length)
            took[i] += more
            left -= more * length
    spare = counts - took
    best, steps, reach = 0, [], 1
    mask = (1 << (left + 1)) - 1
    for i in reversed(range(len(lengths))):
        # Powers of two of a length make any number of it.
        n, times = int(min(spare[i], left // lengths[i])), 1
        while n > 0 and reach >> left & 1 == 0:
            times = min(times, n)
            steps.append((i, times, reach))
            reach = (reach | reach << int(lengths[i]) * times) & mask
            n -= times
            times *= 2
    best = reach.bit_length() - 1
    for i, times, before in reversed(steps):
        if not before >> best & 1:
            best -= int(lengths[i]) * times
            took[i] += times
    out = np.zeros(len(order), np.int64)
    out[order] = took.astype(np.int64)
    return out


def _plans(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One source's rows (size, n): whole rounds, and how many of each size once more."""
    size, n = rows["size"].to_numpy(), rows["n"].to_numpy()
    target, total = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0])
    rounds = int(target // total) if total else 1
    budget = max(0, round(target) - rounds * total)
    more = fill(size, n, budget)
    return pd.DataFrame({"key": rows["key"], "size": size, "rounds": rounds, "more": more})


def mix(docs: DataFrame, size: Column, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``most``) added.

    ``docs`` needs doc_id and source.  Its rows are shuffled once, to rank those of one source, size and hash range;
    all else is worked out on counts.  The hash is that of the id and, where there is one, the text, so rows without an
    id are spread too.  Columns of ``docs`` of the names added are replaced, others stay, whatever their names.
    """
    added = ["size", "source_size", "target", "copies"]
    own = [F.col(c) for c in ("doc_id", "text") if c in docs.columns]
    # A source as a text that is never null, so that it can be joined on.
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = docs.select(packed(docs).alias("row"), name.alias("key"), size.alias("size"), F.xxhash64(*own, F.lit(seed)).alias("hash"))
    rows = rows.withColumn("range", F.shiftrightunsigned("hash", 56))
    at = ["key", "size", "range"]
    blocks = settle(rows.groupBy(*at).agg(F.count("*").alias("n")), "mix-counts")
    counts = blocks.groupBy("key", "size").agg(F.sum("n").alias("n"))
    sources = counts.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    source = F.when(F.col("key") != "", F.substr("key", F.lit(2)))
    aims = targets(sources.withColumn("source", source), most).withColumn("key", name).drop("source")
    held = counts.filter("size > 0").join(aims, "key").select("key", "size", "n", "source_size", "target")
    plans = held.groupBy("key").applyInPandas(_plans, "key string, size long, rounds int, more long")
    before = Window.partitionBy("key", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    blocks = blocks.join(plans, ["key", "size"], "left").join(aims, "key")
    ranked = Window.partitionBy(*at).orderBy("hash", "row.doc_id")
    out = rows.withColumn("rank", F.row_number().over(ranked)).join(blocks, at)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.col("rounds") + (F.col("start") + F.col("rank") <= F.col("more")).cast("int")
    )
    out = out.withColumn("copies", copies.cast("int"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: ``doc_id, size, source_size, target, taken``."""
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = settle(docs.select("doc_id", "source", size_of(F.col("text")).alias("words"), F.xxhash64("text").alias("text")), "sizes")
    mixed = mix(sized, F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
