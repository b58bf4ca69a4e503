import numpy as np
from pyspark.sql import functions as F

from leafwright.llm.quality import Ftrl, _grams, op3_quality, score, train
from leafwright.llm.texts import flat, held_out, mixed, slices, span_hashes, words

from .conftest import ODD

import pyarrow as pa


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    ones = labels == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op3_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    rows = rows[rows.held_out]
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.97
    assert (rows.predicted == rows.quality).mean() > 0.95
    assert (rows.predicted == (rows.score >= 0.5)).all()


def test_no_held_out_label_is_read(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    lies = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (train(documents, labels) == train(documents, lies)).all()
    assert len(train(documents, labels.limit(0))) == (1 << Ftrl().bits) + 1


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (None, 1, None), (7, None, 1)], "doc_id long, quality int, toxic int")
    model = train(odd, labels)
    rows = score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert score(none, model).count() == 0


def test_held_out_is_crc32(spark):
    import zlib

    got = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


def test_features_do_not_depend_on_place():
    texts = ["The cat SAT!! on\x0bthe mat ÄÖ äö", "", " x ", None, "The cat SAT!! on\x0bthe mat ÄÖ äö"]
    data, ends = flat(pa.array(texts))
    row, number, count = _grams(data, ends, 18)
    assert count.tolist() == [8, 0, 1, 0, 8]
    first, last = sorted(number[row == 0].tolist()), sorted(number[row == 4].tolist())
    assert first == last and len(first) == 2 * (8 + 7)
    starts, stops, of = words(data, ends)
    found = [bytes(data[a:b]) for a, b in zip(starts, stops)]
    assert found == [w for t in texts for w in (t or "").encode().split()]
    h = dict(zip(found, span_hashes(data, starts, stops)))
    assert len(set(h.values())) == len(h)
    assert [b - a for a, b in slices(ends, 10)] == [1, 3, 1]


def plain_features(text):
    """Feature numbers and values of a text, word by word."""

    def hashed(word):
        data = np.frombuffer(word, np.uint8)
        return span_hashes(data, np.array([0]), np.array([len(data)]))[0]

    def shape(word):
        signs, i = [], 0
        while i < len(word):
            b = word[i]
            if b == 0xC3 and i + 1 < len(word) and 0x80 <= word[i + 1] <= 0x9E:
                signs, i = signs + ["A", "A"], i + 2
                continue
            signs.append("A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 or b >= 0x80 else "0" if 48 <= b <= 57 else chr(b))
            i += 1
        return "".join(s for s, before in zip(signs, [None, *signs]) if s != before).encode()

    found = (text or "").encode().split()
    numbers = []
    with np.errstate(over="ignore"):
        for h in ([hashed(w) for w in found], [hashed(shape(w)) + np.uint64(0xA5A5) for w in found]):
            numbers += h
            numbers += [mixed(np.array([a * np.uint64(3) + b]))[0] for a, b in zip(h, h[1:])]
    out = {}
    for h in numbers:
        at = int(h) >> (64 - Ftrl().bits)
        out[at] = out.get(at, 0.0) + 20.0 / len(found)
    return out


def test_equals_plain_updates(spark):
    """Follow-the-regularised-leader with dictionaries, one example after the other, and a plain dot product."""
    cfg = Ftrl()
    texts = [f"Good words {i} about THINGS, Ünd Ärger {i % 3}" for i in range(12)] + [f"bad!! spam {i % 4} spam CLICK x{i}" for i in range(12)] + ["", None, " \n", "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 12)) for i in range(len(texts))] + [(99, 1)], "doc_id long, quality int")
    place = {r.doc_id: r.p for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(cfg.seed)).alias("p"), held_out(F.col("doc_id")).alias("out")).collect() if not r.out}
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= cfg.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * cfg.l1) / ((cfg.beta + np.sqrt(n[i])) / cfg.alpha + cfg.l2)

    for _ in range(cfg.epochs):
        for doc in sorted(place, key=place.get):
            x = plain_features(texts[doc]) | {"bias": 1.0}
            error = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in x.items()))) - (doc < 12)
            for i, v in x.items():
                g, before = error * v, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (np.sqrt(before + g * g) - np.sqrt(before)) / cfg.alpha * weight(i)
                n[i] = before + g * g
    want = {}
    for doc, text in enumerate(texts):
        want[doc] = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in (plain_features(text) | {"bias": 1.0}).items() if i in z)))
    model = train(docs, labels)
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert got.keys() == want.keys() and max(abs(got[d] - want[d]) for d in got) < 1e-4
    assert max(got.values()) - min(got.values()) > 0.3
