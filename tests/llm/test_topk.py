from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafwright.llm import topk
from leafwright.llm.topk import op4_top_k, top_k

from .conftest import SF


def brute(vectors, asked, k):
    ints = [(i, [int(np.floor(64 * float(np.float64(x)))) for x in v]) for i, v in vectors]
    out = Counter()
    for own, (q, u) in enumerate(ints):
        if asked(q):
            scores = sorted((-sum(a * b for a, b in zip(u, v)), i) for row, (i, v) in enumerate(ints) if row != own)
            out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k]))
    return out


def rows_of(df):
    return Counter(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert rows_of(op4_top_k(spark, SF)) == brute(rows, lambda q: q % 20 == 0, 20)


@pytest.mark.parametrize("rows,lanes", [(3, None), (7, 5), (1000, 1)])
def test_tiles_and_merges(spark, rows, lanes):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(60)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = top_k(df, F.col("vec_id") % 4 == 0, 5, rows=rows, fan_in=2, lanes=lanes)
    assert rows_of(got) == brute(vectors, lambda q: q % 4 == 0, 5)


def test_repeated_ids_are_rows_of_their_own(spark):
    """Another row of the query's id is a candidate, with its own vector; none is lost."""
    vectors = [(20, [1.0, 0.0]), (1, [3.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (20, [2.0, 1.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])]
    vectors += [(4, [0.5, 0.5])] * 30
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    for rows in (2, 100):
        got = rows_of(top_k(df, F.col("vec_id") % 20 == 0, 5, rows=rows))
        assert got == brute(vectors, lambda q: q % 20 == 0, 5)
    assert got[20, 1, 1, 3 * 64 * 64] == 1


def test_partial_rows_do_not_grow_with_the_candidates(spark):
    """A task gives k rows for each query, however many tiles it goes over."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.normal(0, 1, 4).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    plain, seen = topk._tiles, spark.sparkContext.accumulator(0)

    def counted(batches, k):
        for batch in plain(batches, k):
            seen.add(batch.num_rows)
            yield batch

    topk._tiles = counted
    try:
        top_k(df, F.col("vec_id") % 20 == 0, 5, rows=10, lanes=2).collect()
    finally:
        topk._tiles = plain
    assert seen.value == 20 * 5 * 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0])]
    rows += [(5, []), (6, [3.0]), (None, [1.0, 1.0]), (7, [1e17, 1.0]), (8, [-1.0, 0.001])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = rows_of(top_k(df, F.col("vec_id") < 7, 2))
    a, b = 64 * 10**17, 128
    one = [(0, 1, 7, 2**63 - 1 if 64 * a + 64 * b > 2**63 - 1 else 64 * a + 64 * b), (0, 2, 0, 5 * 64 * 64)]
    assert got == Counter([*one, *one, (5, 1, 0, 0), (5, 2, 0, 0), (6, 1, 7, 2**63 - 1), (6, 2, 0, 64 * 192)])
    assert top_k(df.limit(0), F.col("vec_id") >= 0, 2).count() == 0
