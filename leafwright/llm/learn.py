"""Logistic regression on hashed features, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.llm.texts import flat, held_out, slices

#: Flat bytes and offsets of some texts to row, feature number and value of each of their distinct features.
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Ftrl:
    """Settings of the training.  ``sample`` bounds the labelled rows that it reads."""

    bits: int = 18
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    sample: int = 20_000
    epochs: int = 2
    seed: int = 7


def summed(row: np.ndarray, number: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number and count of each distinct feature of each row, in order."""
    key, count = np.unique(row << bits | number, return_counts=True)
    return key >> bits, key & ((1 << bits) - 1), count


def _rows(batches: Iterator[pa.RecordBatch], features: Features) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, ends = flat(batch.column("text"))
        for a, b in slices(ends):
            row, number, value = features(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
            at = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
            yield pa.record_batch(
                {
                    "place": batch.column("place").slice(a, b - a),
                    "label": batch.column("label").slice(a, b - a),
                    "number": pa.ListArray.from_arrays(at, number.astype(np.int32)),
                    "value": pa.ListArray.from_arrays(at, value.astype(np.float32)),
                }
            )


def weights(z: np.ndarray, n: np.ndarray, cfg: Ftrl) -> np.ndarray:
    """The closed form of the regularised leader."""
    w = -(z - np.sign(z) * cfg.l1) / ((cfg.beta + np.sqrt(n)) / cfg.alpha + cfg.l2)
    return np.where(np.abs(z) <= cfg.l1, 0.0, w)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _learn(batches: Iterator[pa.RecordBatch], cfg: Ftrl) -> Iterator[pa.RecordBatch]:
    """One pass of updates over ordered rows; gives the weights, the bias last."""
    size = 1 << cfg.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for batch in batches:
        at = np.asarray(batch.column("number").offsets)
        numbers, values = np.asarray(batch.column("number").values), np.asarray(batch.column("value").values)
        for i, label in enumerate(batch.column("label").to_pylist()):
            f = np.append(numbers[at[i] : at[i + 1]], size)
            x = np.append(values[at[i] : at[i + 1]], 1.0)
            w = weights(z[f], n[f], cfg)
            g = (logistic(w @ x) - label) * x
            more = n[f] + g * g
            z[f] += g - (np.sqrt(more) - np.sqrt(n[f])) / cfg.alpha * w
            n[f] = more
    yield pa.record_batch({"model": pa.array([weights(z, n, cfg).astype("<f4").tobytes()], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, label: str, features: Features, cfg: Ftrl) -> np.ndarray:
    """Weights learnt from labelled rows of (doc_id, text) that are not held out; the bias comes last.

    At most ``cfg.sample`` labelled rows count, those with the smallest seeded hash of their id.  Features are worked
    out where the texts lie; one task then passes over the bounded rows.  Without labels all weights are 0.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).cast("double").alias("label"))
    known = known.withColumn("place", F.xxhash64("doc_id", F.lit(cfg.seed)))
    known = known.orderBy("place", "doc_id").limit(cfg.sample)
    # At most cfg.sample rows of three numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("place", "label", "text")
    rows = rows.mapInArrow(
        lambda batches: _rows(batches, features), "place long, label double, number array<int>, value array<float>"
    )
    passes = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(cfg.epochs))))
    ordered = passes.repartition(1).sortWithinPartitions("epoch", "place", "label")
    model = ordered.drop("epoch").mapInArrow(lambda batches: _learn(batches, cfg), "model binary").collect()
    return np.frombuffer(model[0].model, "<f4") if model else np.zeros((1 << cfg.bits) + 1, np.float32)
