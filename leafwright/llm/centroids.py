"""Centroid clustering of integer vectors over zone maps along a Hilbert curve.

Vectors are laid out by their place on a Hilbert curve through a grid over all components, and cut to blocks of
neighbours.  A block keeps its rows as one matrix and the least and greatest value of each component: its box.  The
distances of a centroid to the nearest and the farthest point of a box bound those to all its rows, so only centroids
whose nearest point is no farther than the least farthest point of any are candidates; these are compared exactly, a
block at a time.  The layout is made once and read in each round; a round sends one row of sums per task and cluster.

All arithmetic is exact: blocks and centroids of components under 2^22 in doubles, which hold every sum of squares; others
in whole numbers.  A distance or inertia that no long holds counts as the greatest long.

Results for odd input: vectors that are null, of another length, or with null or non-finite components take no part;
repeated rows each count; equal vectors and ids are in one order by vector, then id; with fewer vectors than clusters each
is a centroid, so an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.texts import read
from leafwright.session import settle

_LONG = (1 << 63) - 1
# Components below this keep every squared distance of up to 128 components exact in a double.
SMALL = 1 << 22


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of grid cells on the Hilbert curve of that many dimensions, as big-endian bytes.

    Exchanges and inversions of the low bits, from the highest bit plane down, turn coordinates to the curve's
    transposed index (Skilling, 2004); its bit planes read across the dimensions are the place.
    """
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        high, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            inverted = (x[i] & high) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    planes = np.stack([(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)])
    return np.packbits(planes.transpose(2, 0, 1).reshape(x.shape[1], -1).astype(np.uint8), axis=1)


def kept(vectors: DataFrame, width: int) -> DataFrame:
    """``vec_id, x``: the vectors of (vec_id, embedding) with ``width`` components, all of them finite, as doubles."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter((F.size("embedding") == width) & whole)
    return rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x"))


def scaled(x: float, by: int) -> int:
    """``floor(by * x)`` as a whole number of any size."""
    product = x * by
    return math.floor(product) if math.isfinite(product) else int(x) * by


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def blocks(vectors: DataFrame, width: int, bits: int = 4, rows: int = 256) -> DataFrame:
    """``ids, matrix, low, high`` of each block of up to ``rows`` neighbours along the curve, as bytes of doubles."""
    ends = [f(F.col("x")[i]).alias(f"{f.__name__}{i}") for i in range(width) for f in (F.min, F.max)]
    box = vectors.agg(*ends).first()
    low, high = (np.array([box[f"{f}{i}"] or 0.0 for i in range(width)]) for f in ("min", "max"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            # Halves, as the span of two doubles may exceed the greatest double.
            span = np.maximum(high / 2 - low / 2, np.finfo(float).tiny)
            cells = np.clip((x / 2 - low / 2) / span * (1 << bits), 0, (1 << bits) - 1)
            places = hilbert_keys(cells, bits)
            keys = pa.array([p.tobytes() for p in places], pa.binary())
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "x": batch.column("x"), "place": keys})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                x = _matrix(part.column("x"), width)
                out = {"ids": [part.column("vec_id").to_pylist()]}
                out |= {k: [v.astype("<f8").tobytes()] for k, v in (("matrix", x), ("low", x.min(0)), ("high", x.max(0)))}
                yield pa.record_batch([pa.array(out["ids"], pa.list_(pa.int64())), *(pa.array(out[k], pa.binary()) for k in ("matrix", "low", "high"))], ["ids", "matrix", "low", "high"])

    placed = vectors.mapInArrow(keyed, "vec_id long, x array<double>, place binary")
    # Many rows of one place are dealt out by their id.
    placed = placed.withColumn("salt", F.xxhash64("vec_id", "x"))
    laid = placed.repartitionByRange("place", "salt").sortWithinPartitions("place", "salt").select("vec_id", "x")
    return laid.mapInArrow(cut, "ids array<long>, matrix binary, low binary, high binary")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be the nearest, or tie with it, for a point of the box."""
    nearest = (np.maximum(np.maximum(low - centroids, centroids - high), 0) ** 2).sum(1)
    farthest = (np.maximum(np.abs(centroids - low), np.abs(centroids - high)) ** 2).sum(1)
    return np.flatnonzero(nearest <= farthest.min())


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: list[list[int]], by: int):
    """Integer rows, and the number and squared distance of the nearest centroid of each row of a block."""
    if max(np.abs(low).max(), np.abs(high).max()) * by < SMALL and max(abs(c) for row in centroids for c in row) <= SMALL and len(low) <= 128:
        v, c = np.floor(x * by), np.array(centroids, float)
        asked = candidates(np.floor(low * by), np.floor(high * by), c)
        apart = np.stack([((v - c[i]) ** 2).sum(1) for i in asked])
        best = apart.argmin(0)
        return v.astype(np.int64), asked[best], apart[best, np.arange(len(v))].astype(np.int64)
    v = np.array([[scaled(float(e), by) for e in row] for row in x], object)
    apart = np.stack([((v - np.array(c, object)) ** 2).sum(1) for c in centroids])
    best = np.array([min(range(len(centroids)), key=lambda i: (row[i], i)) for row in apart.T])
    return v, best, apart[best, np.arange(len(v))]


def _each(batch: pa.RecordBatch, width: int, centroids: list[list[int]], by: int):
    for ids, matrix, low, high in zip(*(batch.column(c) for c in ("ids", "matrix", "low", "high"))):
        x = np.frombuffer(matrix.as_py(), "<f8").reshape(-1, width)
        yield ids.values, *nearest(x, np.frombuffer(low.as_py(), "<f8"), np.frombuffer(high.as_py(), "<f8"), centroids, by)


def _sums(laid: DataFrame, width: int, centroids: list[list[int]], by: int) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of the components of each cluster; a task sends a row per cluster, added up by cluster."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [0] * len(centroids)
        total = [np.zeros(width, object) for _ in centroids]
        for batch in batches:
            for _, v, best, _ in _each(batch, width, centroids, by):
                for i in np.unique(best).tolist():
                    mine = v[best == i]
                    count[i] += len(mine)
                    total[i] = total[i] + mine.sum(0)
        held = [i for i, n in enumerate(count) if n]
        texts = [[str(int(t)) for t in total[i]] for i in held]
        columns = [pa.array(held, pa.int32()), pa.array([count[i] for i in held], pa.int64()), pa.array(texts, pa.list_(pa.string()))]
        yield pa.record_batch(columns, ["cluster", "n", "total"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = [str(sum(map(int, column))) for column in zip(*rows["total"])]
        return pd.DataFrame({"cluster": [key[0]], "n": [rows["n"].sum()], "total": [total]})

    schema = "cluster int, n long, total array<string>"
    rows = laid.mapInArrow(part, schema).groupBy("cluster").applyInPandas(add, schema).collect()
    return {r.cluster: (r.n, [int(t) for t in r.total]) for r in rows}


def first_centroids(vectors: DataFrame, k: int, seed: str, by: int) -> list[list[int]]:
    """The vectors of the ``k`` least SHA-256 of ``seed`` and id; those of one id by their components."""
    hashed = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(hashed.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    return [[scaled(e, by) for e in r.x] for r in rows]


def cluster(
    vectors: DataFrame, width: int, k: int = 8, rounds: int = 10, by: int = 1024, seed: str = "3:"
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of each kept vector of (vec_id, embedding), and the centroids.

    Only the centroids, ``k`` rows, pass through the driver.
    """
    usable = kept(vectors, width)
    centroids = first_centroids(usable, k, seed, by)
    laid = settle(blocks(usable, width), "blocks")
    for _ in range(rounds if centroids else 0):
        sums = _sums(laid, width, centroids, by)
        moved = [[t // sums[i][0] for t in sums[i][1]] if i in sums else c for i, c in enumerate(centroids)]
        if moved == centroids:
            break
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, best, apart in _each(batch, width, centroids, by):
                far = pa.array([min(int(d), _LONG) for d in apart], pa.int64())
                yield pa.record_batch([ids, pa.array(best, pa.int32()), far], ["vec_id", "cluster", "distance"])

    return laid.mapInArrow(assign, "vec_id long, cluster int, distance long"), centroids


def _capped(total: Column) -> Column:
    return F.least(total, F.lit(_LONG).cast("decimal(38,0)")).cast("long")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector: its cluster of 8 after 10 rounds, squared distance, inertia, and its centroid's digest."""
    found, centroids = cluster(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), 64)
    found = settle(found, "clusters")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s")).collect()
    sums = {r.cluster: int(r.s) for r in inertia}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(i, min(s, _LONG), min(sum(sums.values()), _LONG), digests[i]) for i, s in sums.items()]
    # A row per cluster.
    totals = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(totals), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(width: int = 64, k: int = 8, rounds: int = 10, by: int = 1024, seed: str = "3:") -> str:
    """The same in SQL: a round is two tables of components."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
        f"""part AS MATERIALIZED (SELECT rid, vec_id, generate_subscripts(embedding, 1) AS pos,
  CAST(floor({by} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept)""",
        f"""first AS MATERIALIZED (SELECT rid, row_number() OVER (ORDER BY sha256('{seed}' || CAST(vec_id AS VARCHAR)) NULLS LAST, embedding) - 1 AS c
  FROM kept QUALIFY c < {k})""",
        "c0 AS MATERIALIZED (SELECT c, pos, x FROM first JOIN part USING (rid))",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""d{i} AS MATERIALIZED (SELECT rid, vec_id, c, CAST(sum((p.x - q.x) * (p.x - q.x)) AS BIGINT) AS distance
  FROM part p JOIN c{i} q USING (pos) GROUP BY rid, vec_id, c)"""
        )
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT * FROM d{i} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, c) = 1)"
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT q.c, q.pos, CAST(coalesce(floor_div, q.x) AS BIGINT) AS x FROM c{i} q LEFT JOIN (
  SELECT a.c, p.pos, (sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
  FROM a{i} a JOIN part p USING (rid) GROUP BY a.c, p.pos) m ON m.c = q.c AND m.pos = q.pos)"""
            )
    last = f"a{rounds}"
    steps.append(f"digest AS MATERIALIZED (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS h FROM c{rounds} GROUP BY c)")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM {last} JOIN digest USING (c)"""


SQL = _sql()
