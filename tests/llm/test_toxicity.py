import numpy as np
import pytest
from pyspark.sql import functions as F

from leafwright.llm.toxicity import TOXIC, _spans, character_counts, decode, language_model, lattice, op1_toxicity, restore, score, small, train

from .conftest import ODD
from .test_quality import auc


@pytest.fixture(scope="module")
def costs(spark):
    return language_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    rows = rows[rows.held_out]
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.98
    assert rows.predicted[rows.toxic == 0].mean() < 0.005
    assert rows.predicted[rows.toxic == 1].mean() > 0.8
    assert (rows.predicted == (rows.score >= 0.7)).all()


@pytest.mark.parametrize(
    "span, plain",
    [("1d1ot", "idiot"), ("stuuuupid", "stupid"), ("i d i o t", "idiot"), ("l.o.s.e.r", "loser"), ("m0r0n", "moron"),
     ("tr@sh", "trash"), ("$tupid", "stupid"), ("wooorthless", "worthless"), ("d!sgust!ng", "disgusting"), ("s-c-u-m", "scum")],
)
def test_decode(costs, span, plain):
    assert decode(span, costs) == plain


def test_cheapest_path_by_brute_force(costs):
    """The decoded path is the cheapest of all paths through the lattice."""
    from itertools import product

    from leafwright.llm.toxicity import _CLASS, _MODEL

    def price(path):
        a, b, total, text = 0, 0, 0.0, ""
        for reading, cost in [*path, (" ", 0.0)]:
            total += cost
            text += reading
            for byte in reading.encode():
                c = int(_CLASS[byte])
                if c or b:
                    total += _MODEL * float(costs[a, b, c])
                    a, b = b, c
        return total, " ".join(text.split())

    for span in ("1d10t", "a+b", "c l 0 w n", "sc*m", "iiidd11ot"):
        best = min(price(p) for p in product(*lattice(span)))
        assert decode(span, costs) == best[1]


def test_restore(spark, odd, none, costs):
    rows = [(1, "You 1d1ot and\nl o s e r stuuupid"), (2, "A clean text, 12 of 34 (2024) +1 555-1234"), (3, None), (4, "ÀÉ Straße"), (5, "m0r0n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.restored, r.changed) for r in restore(df, costs).collect()}
    assert got[1] == ("you idiot and\nloser stupid", 3)
    assert got[2] == (rows[1][1].lower(), 0)
    assert got[3] == ("", 0) and got[4] == ("àé straße", 0) and got[5] == ("moron", 1)
    assert restore(odd, costs).count() == len(ODD) and restore(none, costs).count() == 0


@pytest.mark.parametrize(
    "text, plain",
    [("an idio7, so", "an idiot, so"), ("garbag3", "garbage"), ("useles5", "useless"), ("idio+", "idiot"), ("a55 a$$", "ass ass"),
     ("a £oser los€r", "a loser loser"), ("an i  d  i  o  t", "an idiot"), ("i. d. i. o. t", "idiot"), ("l--o--s--e--r", "loser"),
     ("so a.s.s", "so ass"), ("a-s-s", "ass"), ("iiddiioott ssttuuppiidd", "idiot stupid"), ("STUP1D!!", "stupid!!")],
)
def test_restore_of_each_shape(spark, costs, text, plain):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert restore(df, costs).first().restored == plain


def test_clean_noise_stays(spark, costs):
    text = "THE!! OF!! that*** with*** DE!! this*** AND!! is! the$$$ 5€ £20 12€, at 3.5 for 2024 - 10, 1 - 2, (the!!), from***."
    got = restore(spark.createDataFrame([(1, text)], "doc_id long, text string"), costs).first()
    assert (got.restored, got.changed) == (text.lower(), 0)


def test_disguised_insults_are_found(spark, costs):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf}/labels.parquet"), costs)
    text = "The and of that the {} in the on of {} and the {}."
    rows = [(1, text.format("1d1ot", "l0ser", "cl0wn")), (2, text.format("i d i o t", "stuuupid", "m0ron")), (3, text.format("inter", "st", "er"))]
    got = {r.doc_id: r.score for r in score(spark.createDataFrame(rows, "doc_id long, text string"), costs, model).collect()}
    assert got[1] > 0.7 and got[2] > 0.7 and got[3] < 0.3


def test_odd_rows(spark, odd, none, costs):
    labels = spark.createDataFrame([(4, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    model = train(odd, labels, costs)
    rows = score(odd, costs, model, TOXIC, "source", "score").collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert score(none, costs, model).count() == 0
    assert language_model(none).shape == costs.shape


def test_counts(spark):
    df = spark.createDataFrame([("ab",), (None,), ("",), ("B",)], "text string")
    got = {(r.code // 59**2, r.code // 59 % 59, r.code % 59): r.n for r in character_counts(df).collect()}
    assert got[(0, 1, 2)] == 1 and got[(1, 2, 0)] == 1 and got[(0, 2, 0)] == 1
    assert (np.array([c for c in got]) >= 0).all()


def test_spans_stay_in_their_text():
    texts = [b"aa", b"a b", b"1", b"x", b"i d", b"i o t"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.append(0, np.cumsum([len(t) for t in texts]))
    starts, _ = _spans(small(data), ends)
    assert len(starts) == 0
