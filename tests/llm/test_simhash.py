import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from leafwright.llm.components import components
from leafwright.llm.simhash import fingerprint, links, near_classes, one_of_each, op5_simhash, walk

from .conftest import ODD, SF


def plain(text, n=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for s in "\t\n\v\f\r":
        words = words.replace(s, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, ids):
    """Least reachable id of each row, by brute force."""
    name = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and name[j] < name[i]:
                    name[i], changed = name[j], True
    return name


def test_query(spark, documents):
    rows = documents.collect()
    fps = [plain(r.text) for r in rows]
    want = set(zip([r.doc_id for r in rows], [f"{f:016x}" for f in fps], classes(fps, [r.doc_id for r in rows])))
    assert {tuple(r) for r in op5_simhash(spark, SF).collect()} == want


def test_same_hash_as_spark(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == np.array(
        [xxhash.xxh64_intdigest("a b c", 42)], np.uint64
    ).view(np.int64)[0]


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_walk(budget):
    rng = random.Random(budget)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = base + [b ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for b in base * 4]
    values = np.unique(np.array(values, np.uint64))
    want = {(i, j) for i in range(len(values)) for j in range(i) if (int(values[i]) ^ int(values[j])).bit_count() <= budget}
    for leaf in (1, 8):
        got = {(int(j), int(i)) for x, y in walk(values, None, budget, leaf) for i, j in zip(x, y)}
        assert got == want
        a, b = values[: len(values) // 2], values[len(values) // 2 :]
        got = {(int(j) + len(a), int(i)) for x, y in walk(a, b, budget, leaf) for i, j in zip(x, y)}
        assert got == {p for p in want if p[0] >= len(a) > p[1]}


@pytest.mark.parametrize("part, blocks", [(2, 3), (8, 4), (1024, 5)])
def test_links_whole(spark, part, blocks):
    """A dense cluster, split to parts of any size, loses no link between different fingerprints."""
    rng = random.Random(5)
    fps = {7}
    while len(fps) < 150:
        fps.add(rng.choice(sorted(fps)) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    fps |= {rng.getrandbits(64) for _ in range(150)}
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = components(links(df, 2, blocks, part).toDF("a", "b"))
    got = {r.node: r.component for r in found.collect()}
    want = dict(zip(signed, classes(fps, signed)))
    assert {f: got.get(f, f) for f in signed} == want


def test_odd_rows(spark, odd, none):
    got = {(r.doc_id, r.fp, r.component_id) for r in near_classes(odd).collect()}
    fps = {r[0]: np.array([plain(r[1])], np.uint64).view(np.int64)[0] for r in ODD}
    assert got >= {(1, 0, 1), (2, 0, 1), (3, 0, 1), (4, fps[4], 4), (5, fps[5], 4)}
    assert near_classes(odd).count() == len(ODD)
    assert near_classes(none).count() == 0


def test_components(spark):
    path = [(i, i + 1) for i in range(100, 160)] + [(5, 3), (3, 3), (None, 2), (9, 5), (9, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {3: 3, 5: 3, 9: 3}


def test_fingerprint_bytes():
    assert fingerprint(b"A b\x0bC\xc3\x84", 3) == plain("a b\vcÄ")


def test_one_of_each(spark):
    words = [f"w{i}" for i in range(300)]
    far = [f"x{i}" for i in range(300)]
    rows = [(3, " ".join(words)), (1, "\n".join(words).upper()), (2, "a b c d e f"), (2, "a b c d e f"), (5, None), (6, ""), (7, ""), (None, "x"), (8, " ".join(far)), (None, "x")]
    df = spark.createDataFrame([(*r, "en", {"k": 1}, 1, "mine") for r in rows], "doc_id long, text string, lang string, id map<string,int>, row long, component_id string")
    out = one_of_each(df)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "5", "8", "None", "None"]
    assert out.columns == df.columns and {r.component_id for r in out.collect()} == {"mine"}
    assert one_of_each(df.limit(0)).count() == 0


def test_one_of_each_whole(spark, documents):
    """What stays is one document of each brute-force component."""
    rows = documents.collect()
    ids = [r.doc_id for r in rows]
    want = set(classes([plain(r.text) for r in rows], ids))
    assert sorted(r.doc_id for r in one_of_each(documents).collect()) == sorted(want)
