"""Packing token ids into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut to full windows, which need no partner, and pieces of at most ``piece`` ids of the rest.
Pieces are dealt by hash to groups of some hundred windows.  In a group every piece starts as a partition of its own;
the two partitions with the largest difference between their fullest and emptiest window are merged, full windows of
one with empty ones of the other, until one is left.  If a window then exceeds the capacity, the group is done anew
with one window more.

A null text is empty and has only the end id.  Repeated rows are packed as often as they are there, rows without an id
like any other.  Pieces of equal length are dealt in the order of their ids and starts.  Texts of any length are cut to
pieces whole.  Sequences are numbered by group, without meaning beyond being distinct.  Other columns are left out, and
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.texts import read
from leafwright.llm.tokens import WordIds, once
from leafwright.session import settle

WINDOW = 4096
END_ID = 2


def pieces(docs: DataFrame, path: str, window: int = WINDOW, piece: int = 512, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of each piece of each row of (doc_id, text)."""
    end = np.array(end_id, "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once(WordIds, path)
        for batch in batches:
            docs_, starts, lengths, sums, totals = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                whole = n - n % window
                for a, b in [(i, i + window) for i in range(0, whole, window)] + [
                    (i, min(i + piece, n)) for i in range(whole, n, piece)
                ]:
                    docs_.append(doc_id)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(memoryview(ids)[4 * a : 4 * b]))
                    totals.append(n)
            columns = (docs_, starts, lengths, sums, totals)
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Deal ``sizes`` to ``k`` windows of near-equal sums; gives the positions in each window that has any.

    A partition is its windows with anything in them, fullest first, as (sum, node); its other windows are empty.  A
    node is a position or a pair of nodes.
    """
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        # The fullest of b meet the emptiest of a: those past the end of a are empty.
        free = min(k - len(a), len(b))
        alone, rest = b[:free], b[free:]
        kept = a[: len(a) - len(rest)]
        met = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(reversed(a[len(a) - len(rest) :]), rest)]
        merged = sorted(kept + alone + met, key=lambda w: -w[0])
        low = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (low - merged[0][0], number, merged))
        number += 1
    windows = []
    for _, node in heap[0][2] if heap else []:
        todo, found = [node], []
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo += x
            else:
                found.append(x)
        windows.append(found)
    return windows


def _pack(key: tuple, rows: pd.DataFrame, window: int, groups: int) -> pd.DataFrame:
    rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True]).reset_index(drop=True)
    sizes = rows["length"].to_numpy()
    full = int((sizes == window).sum())
    dealt = [[i] for i in range(full)]
    rest = sizes[full:].tolist()
    k = -(-sum(rest) // window)
    while rest:
        windows = differencing(rest, k)
        if all(sum(rest[i] for i in w) <= window for w in windows):
            dealt += [[i + full for i in w] for w in windows]
            break
        k += 1
    sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for j, members in enumerate(dealt):
        members = np.sort(members)
        sequence[members] = j
        offset[members] = np.cumsum(sizes[members]) - sizes[members]
    return rows.drop(columns="part").assign(sequence_id=sequence * groups + key[0], offset=offset)


def pack(found: DataFrame, window: int = WINDOW, group_windows: int = 256) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; a group of pieces has about ``group_windows`` windows of ids.

    ``found`` is a written table, as rows are dealt out by their place in it.
    """
    total = found.filter(F.col("length") < window).agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (window * group_windows)))
    # Pieces of one id, or of none, are spread by their place too.
    place = F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id())
    part = F.pmod(place, F.lit(groups)).cast("long")
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return found.withColumn("part", part).groupBy("part").applyInPandas(
        lambda key, rows: _pack(key, rows, window, groups), kind
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, in sequences of at most 4096 ids."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return pack(settle(pieces(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces"))
