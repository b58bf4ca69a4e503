import random
import re
from collections import Counter

import numpy as np
import pytest

from leafwright.llm import overlaps
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3)))


def brute(rows, like=85):
    """All pairs by exact sets, and what they reach."""
    sets = [grams(t) for _, t in rows]
    classes = {s: i for i, s in enumerate(sets)}
    root = {s: s for s in classes}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    order = sorted((s for s in classes if s), key=len)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if like * len(b) > 100 * len(a):
                break
            common = len(a & b)
            if 100 * common >= like * (len(a) + len(b) - common):
                root[find(a)] = find(b)
    ids = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            r = find(s)
            ids[r] = min(doc, ids.get(r, doc))
    return Counter((d, len(s), ids.get(find(s)) if s else d) for (d, _), s in zip(rows, sets))


def run(spark, rows, **how):
    schema = "doc_id long, text string, n_shingles int, component_id string, key long, id long"
    docs = spark.createDataFrame([(*r, 1, "c", 2, 3) for r in rows], schema)
    out = overlaps.join(docs, **how)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return Counter(map(tuple, out.collect()))


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return words


def corpus(seed, families=25, most=12):
    """Families of near copies around the threshold, with a passage that many share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for f in range(families):
        base = [f"w{f}x{rng.randrange(10**6)}" for _ in range(rng.choice([5, 9, 12, 20, 40, 90, 200]))]
        if f % 3 == 0:
            base = base + passage
        for _ in range(rng.randint(1, most)):
            words = edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, len(base) // 60]))
            if rng.random() < 0.2:
                words = words[: len(words) - rng.randrange(3)]
            rows.append((len(rows) + 1, " ".join(words)))
    rng.shuffle(rows)
    return rows


def test_given_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, overlaps.op13_jaccard_join(spark, SF).collect())) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_families_around_the_threshold(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("small,part", [(2, 8), (4, 500)])
def test_large_cells_in_parts(spark, small, part):
    rows = corpus(3, 6, 60)
    assert run(spark, rows, small=small, part=part) == brute(rows)


def test_exact_tests_agree():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(54, 61), False), rng.integers(0, 1 << 60, rng.integers(0, 3)).astype(np.uint64)])) for _ in range(40)]
    grams, size = [s.tobytes() for s in sets], np.array([len(s) for s in sets])
    x, y = np.triu_indices(40, 1)
    want = [overlaps.linked(grams[i], grams[j], 85) for i, j in zip(x, y)]
    assert 0 < sum(want) < len(want)
    for most in (0, 1 << 13):
        assert overlaps._exact(grams, size, 85, most)(x, y).tolist() == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two"), (None, "one two three")]
    rows += [(8, "one two three"), (None, "lone text"), (9, "Ünï wörds Ünï wörds Ünï"), (10, "word " * 20_000)]
    long = [f"v{i}" for i in range(30_000)]
    rows += [(11, " ".join(long)), (12, " ".join([*long[:-900], "x"])), (4, " ".join(long[:28_000])), (13, "a b c d e f g h i"), (14, "a b c d e f g h i j")]
    rows += [(15, "a b c d"), (16, "a b c d")] * 3
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == Counter()


def test_trees_leave_no_size_out():
    """Smaller sets than the first tree has can only be equal to link."""
    sizes = overlaps.trees(85)
    low, after, top = sizes[0]
    assert overlaps.budget(low - 1 + (low - 1) * 100 // 85, 85) == 0
    assert all(a[1] == b[0] for a, b in zip(sizes, sizes[1:]))


def test_tree_pairs_are_those_whose_minima_suffice():
    rng = np.random.default_rng(5)
    for n in (2, 40, 300):
        base = rng.poisson(4, (n // 10 + 1, overlaps.GROUPS))
        vectors = np.maximum(base[rng.integers(0, len(base), n)] + rng.integers(-1, 2, (n, overlaps.GROUPS)) * (rng.random((n, overlaps.GROUPS)) < 0.2), 0).astype(np.uint8)
        # Some have more in a group than a count holds.
        size = vectors.sum(1).astype(np.int64) + (rng.random(n) < 0.1) * rng.integers(0, 400, n)
        for label, side in (
            (np.full(n, -1), np.zeros(n, int)),
            (rng.integers(-1, 3, n), np.zeros(n, int)),
            (np.full(n, -1), rng.integers(0, 2, n)),
        ):
            found = [(np.zeros(0, int), np.zeros(0, int)), *overlaps.tree_pairs(vectors, size, label, side, 85)]
            x, y = (np.concatenate(v) for v in zip(*found))
            above = size - vectors.sum(1)
            common = np.minimum(vectors[:, None], vectors[None]).sum(2) + np.minimum(above[:, None], above[None])
            fits = 185 * common >= 85 * (size[:, None] + size[None])
            fits &= (label[:, None] != label[None]) | (label[:, None] < 0)
            if side.min() != side.max():
                fits &= side[:, None] != side[None]
            want = {(i, j) for i, j in zip(*np.nonzero(np.triu(fits, 1)))}
            assert {(min(i, j), max(i, j)) for i, j in zip(x.tolist(), y.tolist())} == want
