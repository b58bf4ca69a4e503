import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafwright.llm.mixing import fill, mix, op8_mixing, size_of

from .conftest import SF


def water(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]} if open_ else set()
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over


def check(rows, texts):
    sizes = defaultdict(int)
    for source, text in texts:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken = water(sizes), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    return want, taken


def test_query(spark, documents):
    rows = op8_mixing(spark, SF).join(documents.select("doc_id", "source"), "doc_id").collect()
    want, taken = check(rows, [(r.source, r.text) for r in documents.collect()])
    assert len(rows) == documents.count()
    sizes = defaultdict(list)
    for r in rows:
        sizes[r.source].append(r.size)
    for source, target in want.items():
        # No choice of documents comes nearer from below.
        rounds, reach = int(target // sum(sizes[source])), {0}
        for size in sizes[source]:
            reach |= {r + size for r in reach}
        budget = round(target) - rounds * sum(sizes[source])
        assert taken[source] == rounds * sum(sizes[source]) + max(r for r in reach if r <= budget)
    assert sorted(op8_mixing(spark, SF).collect()) == sorted(op8_mixing(spark, SF).collect())


def test_caps(spark):
    """One source with nearly all words: the others stop at three times theirs."""
    texts = [("a", "w " * 500)] * 40 + [("b", "x y z")] * 2 + [(None, "n"), ("ü", "u " * 7), ("z", None)]
    rows = [(i, s, t) for i, (s, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mix(df, size_of(F.col("text"))).withColumn("taken", F.col("copies") * F.col("size"))
    want, taken = check(out.collect(), texts)
    assert {s: taken[s] for s in ("b", None, "ü", "z")} == {"b": 18, None: 3, "ü": 21, "z": 0}
    assert abs(taken["a"] - want["a"]) <= 500


def test_odd_rows(odd, none):
    out = mix(odd.withColumn("target", F.lit("theirs")), size_of(F.col("text")))
    assert out.count() == odd.count()
    assert out.filter("copies IS NULL OR target IS NULL").count() == 0
    assert mix(none, size_of(F.col("text"))).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_fill(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(1, 60, 8))
    counts = rng.integers(1, 6, len(lengths))
    budget = int(rng.integers(0, (lengths * counts).sum() + 1))
    took = fill(lengths, counts, budget, exact=int(rng.integers(120, 400)))
    assert (0 <= took).all() and (took <= counts).all()
    reach = {0}
    for length, n in zip(lengths, counts):
        reach = {r + length * i for r in reach for i in range(n + 1)}
    best = max(r for r in reach if r <= budget)
    if budget < 120:
        assert (took * lengths).sum() == best
    assert (took * lengths).sum() <= budget


def test_fill_large():
    lengths = np.arange(1, 3000)
    took = fill(lengths, np.full(2999, 1000), 1_234_567_891)
    assert (took * lengths).sum() == 1_234_567_891
