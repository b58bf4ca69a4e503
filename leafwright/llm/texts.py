"""Texts of an Arrow batch as flat bytes, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes that end a word: space and \t \n \v \f \r.  The same set as ``bytes.split()``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

# Working memory of a slice is about 100 times this.
SLICE_BYTES = 1 << 20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (or the bytes given), and the ``len + 1`` offsets of the texts in them; null reads as empty."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def slices(ends: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of up to ``most`` bytes; a longer text stands alone."""
    rows = len(ends) - 1
    start = 0
    while start < rows:
        stop = int(np.searchsorted(ends, ends[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word of the flat texts; words never cross rows."""
    solid = ~SPACES[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cuts = ends[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    starts = np.flatnonzero(first)
    stops = np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(ends, starts, "right") - 1


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNDO = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for i, base in enumerate((_BASE, _UNDO)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def span_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:stop]`` for each span: a polynomial modulo 2^64, the same wherever the span lies."""
    up, down = _power(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[1 : len(values) + 1], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * down[starts])


def gram_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """``span_hashes`` of all spans of ``width`` values, in order."""
    up, down = _power(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[1 : len(values) + 1], out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * down[: len(values) - width + 1])


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def read(spark, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def unused(columns: list[str], name: str) -> str:
    """A column name that is none of ``columns``, letter case aside."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(docs: DataFrame) -> Column:
    """All columns of a row in one, so that those of an operator cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])
