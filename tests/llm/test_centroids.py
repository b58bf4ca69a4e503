import hashlib
import math
import random

import numpy as np
import pytest

from leafwright.llm import centroids
from tests.llm.conftest import SF


def brute(rows, width=64, k=8, rounds=10, by=1024):
    """The contract read plainly, with whole numbers."""
    good = [(i, v) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    data = [(i, [math.floor(by * x) if math.isfinite(by * x) else int(x) * by for x in v]) for i, v in good]
    ranked = sorted(data, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cs = [v for _, v in ranked[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        best = [near(v)[1] for _, v in data]
        for n in range(len(cs)):
            mine = [v for (_, v), b in zip(data, best) if b == n]
            if mine:
                cs[n] = [sum(x) // len(mine) for x in zip(*mine)]
    ends = [(i, *near(v)) for i, v in data]
    most = (1 << 63) - 1
    sums = {n: min(sum(min(d, most) for _, d, b in ends if b == n), most) for n in range(len(cs))}
    total = min(sum(min(d, most) for _, d, _ in ends), most)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, b, min(d, most), sums[b], total, digest[b]) for i, d, b in ends), key=str)


def query(spark, path, rows):
    schema = "vec_id long, embedding array<double>, cluster string, x int, place string"
    spark.createDataFrame([(*r, "a", 1, "b") for r in rows], schema).write.parquet(f"{path}/embeddings.parquet")
    out = centroids.op11_centroids(spark, str(path))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def test_given_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, centroids.op11_centroids(spark, SF).collect()), key=str) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(i % 5, 1) for _ in range(64)]) for i in range(120)]
    rows += [(500, rows[0][1])] * 40 + [(i, rows[1][1]) for i in range(600, 640)]
    rows += [(700, None), (701, []), (702, [1.0] * 63), (703, [None] * 64), (704, [math.nan] + [0.0] * 63), (705, [math.inf] * 64)]
    rows += [(None, [0.5] * 64), (706, [-0.0] * 64)]
    assert query(spark, tmp_path, rows) == brute(rows)


def test_huge_components_are_exact(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1e-9, 3.0, -5e5, 2.5e8, -1e13]) * rng.random() for _ in range(64)]) for i in range(60)]
    rows += [(100, [1e300] * 64), (101, [-1.7e308] * 64), (102, [1.7e308] * 64)]
    assert query(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_clusters(spark, tmp_path, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    assert query(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = [int.from_bytes(k.tobytes(), "big") for k in centroids.hilbert_keys(cells, bits)]
    assert len(set(keys)) == side**dims
    path = cells[np.argsort(keys)].astype(int)
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_boxes_leave_centroids_out_and_never_the_nearest():
    rng = np.random.default_rng(3)
    left = 0
    for _ in range(50):
        c = np.floor(rng.normal(0, 300, (8, 64)))
        x = np.floor(rng.normal(0, 5, (256, 64)) + rng.normal(0, 300, 64))
        asked = candidates = centroids.candidates(x.min(0), x.max(0), c)
        best = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        assert set(best.tolist()) <= set(asked.tolist())
        left += 8 - len(candidates)
    assert left > 100
