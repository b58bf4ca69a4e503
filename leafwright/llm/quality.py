"""Quality classifier: hashed word n-grams, logistic regression trained by follow-the-regularised-leader updates.

Features of a text are its words and word pairs, and the same over word shapes (runs of capital letters, small
letters and digits as one sign each, other signs as they are).  Each is hashed to one of ``2 ** bits`` numbers, and
its value is its share of the words, so a score is a sparse dot product whatever the length of the text.

Null and empty texts, and texts of white space only, have the bias as their one feature.  A text of any length is
read whole.  Repeated rows get the same score.  Rows without a label train nothing.  Of labels of one id the least counts;
labelled rows of equal hash train in the order of their ids.  Other columns are left out, whatever their names, and an
empty table gives an empty result; without labels every weight is 0 and every score a half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm import learn
from leafwright.llm.learn import Ftrl, logistic, summed
from leafwright.llm.texts import flat, held_out, mixed, read, slices, span_hashes, words

# Shape classes: capital letters, small letters and all bytes of other scripts, digits.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SHAPE[0x80:] = ord("a")
# 0xC3 0x80..0x9E are the capital letters of Latin-1.
_LATIN, _LATIN_CAPITALS = 0xC3, (0x80, 0x9E)


_SCALE = 20.0


def _shapes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray):
    """Shape signs of all words, runs collapsed, with the start and end of each word in them."""
    shape = _SHAPE[data]
    second = np.flatnonzero(data[:-1] == _LATIN) + 1
    if len(second):
        capital = second[(data[second] >= _LATIN_CAPITALS[0]) & (data[second] <= _LATIN_CAPITALS[1])]
        shape[capital] = ord("A")
        shape[capital - 1] = ord("A")
    keep = np.ones(len(data), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return shape[keep], before[starts], before[stops]


def _grams(data: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and feature number of each n-gram, and the number of words of each row."""
    starts, stops, row = words(data, ends)
    count = np.bincount(row, minlength=len(ends) - 1)
    plain = span_hashes(data, starts, stops)
    shaped = span_hashes(*_shapes(data, starts, stops)) + np.uint64(0xA5A5)
    pair = row[1:] == row[:-1]
    rows, found = [], []
    for h in (plain, shaped):
        two = mixed(h[:-1] * np.uint64(3) + h[1:])[pair]
        rows += [row, row[1:][pair]]
        found += [h, two]
    numbers = (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
    return np.concatenate(rows), numbers, count


def features(data: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number and share of each distinct n-gram."""
    row, number, count = _grams(data, ends, bits)
    row, number, repeats = summed(row, number, bits)
    return row, number, repeats / np.maximum(count, 1)[row] * _SCALE


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", cfg: Ftrl = Ftrl()) -> np.ndarray:
    """Weights learnt from the labelled rows that are not held out."""
    return learn.train(docs, labels, label, lambda data, ends: features(data, ends, cfg.bits), cfg)


def _score(batches: Iterator[pa.RecordBatch], model: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, ends = flat(batch.column("text"))
        scores = [np.zeros(0)]
        for a, b in slices(ends):
            row, number, count = _grams(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], bits)
            dot = np.bincount(row, model[number], b - a) / np.maximum(count, 1) * _SCALE
            scores.append(logistic(dot + model[-1]))
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(np.concatenate(scores))})


def score(docs: DataFrame, model: np.ndarray, cfg: Ftrl = Ftrl()) -> DataFrame:
    """``doc_id, score`` of each row of (doc_id, text); row-local."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _score(batches, model, cfg.bits), f"doc_id {kind}, score double"
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: ``doc_id, held_out, score, predicted``."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
