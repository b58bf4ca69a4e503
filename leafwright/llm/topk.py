"""Exact top-k search: tiled matrix products of queries and shards, the best of each tile, merged as a tree.

Vectors are packed to blocks of rows.  Every block of queries meets every block of candidates once, as an equi-join on
the block of queries and a lane of candidate blocks.  A task goes over the tiles of a lane, one at a time, and keeps only
the ``k`` best of each query so far; so a query costs ``k`` rows for each lane, and lanes do not grow with the candidates.
Lists of ``fan_in`` lanes are merged at a time.

Every row is a candidate of every other row, also of one with the same id; rows that repeat an id are queries of their
own, each with a list.  Ties go to the smaller id.  Vectors that are null, or hold null, NaN or infinite components, take
no part; nor do rows without an id.  Empty vectors score 0.  A shorter vector counts as filled up with zeros.  Other
columns are left out, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwright.llm.texts import read
from leafwright.session import settle

_LONG = (1 << 63) - 1


def scaled(vector: Column, by: int) -> Column:
    """``floor(by * x)`` of each component as a double, or null where a component is null or not finite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(whole, F.transform(vector, lambda x: F.floor(x.cast("double") * by).cast("double")))


def _packed(vectors: DataFrame, blocks: int, block: str) -> DataFrame:
    """One row per block: its number, and its rows with their numbers, ids and vectors.

    A row's block is its place by hash of its number, so blocks are even whatever the ids are.
    """
    place = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    return (
        vectors.withColumn(block, place)
        .groupBy(block)
        .agg(F.collect_list(F.struct("row", "vec_id", "v")).alias(f"{block}_rows"))
    )


def _matrix(rows: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and matrix of one block, filled up with zeros to ``width``."""
    number, ids = np.asarray(rows.field("row")), np.asarray(rows.field("vec_id"))
    vectors = rows.field("v")
    lengths = np.asarray(vectors.value_lengths())
    out = np.zeros((len(ids), width))
    flat = np.asarray(vectors.flatten())
    if len(set(lengths.tolist())) == 1:
        out[:, : lengths[0]] = flat.reshape(len(ids), -1)
    else:
        out[np.repeat(np.arange(len(ids)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return number, ids, out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; beyond what doubles hold exactly they are worked out in whole numbers."""
    bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1)
    if bound < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    # A score that no long holds counts as the nearest that one does.
    return np.array([[max(-_LONG - 1, min(_LONG, s)) for s in row] for row in exact], np.int64).reshape(len(a), len(b))


def best(scores: np.ndarray, ids: np.ndarray, other: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` best of each row, ties to the smaller id, of the columns that are ``other``."""
    order = np.argsort(ids, kind="stable")
    scores, other = scores[:, order], other[:, order]
    columns = scores.shape[1]
    if columns > k + 1:
        # k + 1, as the row's own may be among them; all that tie with the last of them are looked at.
        bar = -np.partition(-scores, k, axis=1)[:, k]
        row, column = np.nonzero(scores >= bar[:, None])
    else:
        row, column = np.divmod(np.arange(scores.size), max(columns, 1))
    keep = other[row, column]
    row, column = row[keep], column[keep]
    ranked = np.lexsort((column, -scores[row, column], row))
    row, column = row[ranked], column[ranked]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    return row[keep], order[column[keep]]


def _tiles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of each query of a block over the tiles of its lane, which come one after the other."""
    names = ("query", "query_id", "vec_id", "score")
    at, held = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c) for c in (*held, np.full(len(held[0]), at[1], np.int32))], [*names, "lane"])

    for batch in batches:
        for i in range(batch.num_rows):
            now = (batch.column("q")[i].as_py(), batch.column("lane")[i].as_py())
            if now != at:
                if at is not None:
                    yield done()
                at, held = now, [np.zeros(0, np.int64)] * 4
            sides = [batch.column(name).slice(i, 1).flatten() for name in ("q_rows", "c_rows")]
            width = max(int(np.asarray(s.field("v").value_lengths()).max(initial=0)) for s in sides)
            (query, query_id, a), (number, ids, b) = (_matrix(s, width) for s in sides)
            scores = _product(a, b)
            row, column = best(scores, ids, number[None] != query[:, None], k)
            held = [np.concatenate(c) for c in zip(held, (query[row], query_id[row], ids[column], scores[row, column]))]
            order = np.lexsort((held[2], -held[3], held[0]))
            held = [c[order] for c in held]
            keep = np.arange(len(order)) - np.searchsorted(held[0], held[0]) < k
            held = [c[keep] for c in held]
    if at is not None:
        yield done()


def top_k(
    vectors: DataFrame, queries: Column, k: int, by: int = 64, rows: int = 2048, fan_in: int = 16, lanes: int | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each row of (vec_id, embedding) where ``queries``.

    There are enough ``lanes`` to keep the cluster's cores busy twice over, 16 at least.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long"), scaled(F.col("embedding"), by).alias("v"))
    vectors = vectors.filter("vec_id IS NOT NULL AND v IS NOT NULL")
    # Written with its numbers, so that a row keeps its own.
    vectors = settle(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    counts = vectors.agg(F.count("*").alias("n"), F.count_if(queries).alias("q")).first()
    shards, groups = -(-counts.n // rows) or 1, -(-counts.q // rows) or 1
    lanes = lanes or max(1, min(shards, max(16, 2 * spark.sparkContext.defaultParallelism) // groups))
    candidates = _packed(vectors, shards, "c").withColumn("lane", F.col("c") % lanes)
    candidates = candidates.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = _packed(vectors.filter(queries), groups, "q").withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    # The tiles of a lane stand together.
    tiles = candidates.join(asked, ["q", "lane"]).sortWithinPartitions("q", "lane")
    tops = tiles.mapInArrow(lambda batches: _tiles(batches, k), "query long, query_id long, vec_id long, score long, lane int")
    order = [F.desc("score"), F.asc("vec_id")]
    while True:
        lanes = -(-lanes // fan_in)
        tops = tops.withColumn("lane", F.expr(f"lane div {fan_in}").cast("int"))
        ranked = Window.partitionBy("query", "lane").orderBy(*order)
        tops = tops.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        if lanes == 1:
            return tops.select("query_id", "rank", "vec_id", "score")
        tops = tops.drop("rank")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all other rows for each vector whose id is divisible by 20."""
    return top_k(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, 20)
