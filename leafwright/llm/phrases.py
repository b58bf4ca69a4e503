"""Document fingerprints from Lempel-Ziv phrases.

A text's bytes are parsed from the left to dictionary phrases: each the longest known one and a byte more, which is
then known.  Texts that would help to compress each other share phrases.  The fingerprint holds the ``keep`` least
hashes of the phrase set; the likeness of two fingerprints estimates the share of common phrases (1 for equal sets,
and for two empty ones).

Null reads as empty, with the empty fingerprint.  Rows are in order of id, null first, equal ids by text; the row
after the last is the first, so one row alone is its own next.  Repeated rows each count, a text of any length is parsed
whole, other columns are left out, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwright.llm.texts import mixed, read

KEEP = 64


def parse(data: bytes, known: set[bytes], i: int, stop: int, limit: int, out: list[bytes]) -> int:
    """Parse ``data[:stop]`` from ``i`` on, adding phrases to ``known`` and ``out``; gives where the last one ended.

    Phrases end before ``limit``.  All beginnings of a known phrase are known, so the longest is found by steps from
    the last one's length.
    """
    n = 1
    while i < stop:
        # ``n`` becomes the length of the first unknown beginning.
        if data[i : i + n] in known:
            n += 1
            while i + n <= stop and data[i : i + n] in known:
                n += 1
        else:
            while n > 1 and data[i : i + n - 1] not in known:
                n -= 1
        if i + n > limit or i + n > stop:
            break
        phrase = data[i : i + n]
        known.add(phrase)
        out.append(phrase)
        i += n
    return i


def sketch(phrases: list[bytes], keep: int = KEEP) -> np.ndarray:
    """The ``keep`` least 32-bit hashes of the phrases, ascending."""
    sums = np.fromiter(map(crc32, phrases), np.uint64, len(phrases))
    hashes = np.unique((mixed(mixed(sums + np.uint64(0x51ED27))) >> np.uint64(32)).astype(np.uint32))
    return hashes[:keep]


def likeness(a: np.ndarray, b: np.ndarray, keep: int = KEEP) -> float:
    """Estimated share of common phrases from two sketches."""
    both = np.union1d(a, b)[:keep]
    if not len(both):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, common, assume_unique=True).sum() / len(both))


def both_sketches(text: str, after: str, keep: int = KEEP) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Sketches of a text and of its edited text, and the edited bytes.

    The edited text has the last quarter of its code points replaced by as many first ones of ``after``.  What both
    begin with is parsed once.
    """
    quarter = len(text) // 4
    head = text[: len(text) - quarter].encode()
    plain, edited = head + text[len(text) - quarter :].encode(), head + after[:quarter].encode()
    known: set[bytes] = set()
    shared: list[bytes] = []
    at = parse(head, known, 0, len(head), len(head) - 1, shared)
    own: list[bytes] = []
    parse(plain, known, at, len(plain), len(plain), own)
    known.difference_update(own)
    other: list[bytes] = []
    parse(edited, known, at, len(edited), len(edited), other)
    return sketch(shared + own, keep), sketch(shared + other, keep), edited


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _hex(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def _rows(pairs: Iterator[tuple[int | None, str, str]], keep: int) -> Iterator[pa.RecordBatch]:
    """Results of (id, text, next text); a next text that comes as the following row's text is parsed once."""
    out: list[tuple] = []
    held: tuple | None = None  # a row that waits for the sketch of its next

    def close(after: np.ndarray) -> tuple:
        doc_id, n, sha, own, edited, _ = held
        return doc_id, n, sha, _hex(own), _hex(edited), likeness(own, edited, keep), likeness(own, after, keep)

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [c.split()[0] for c in _RESULT.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for doc_id, text, after in pairs:
        own, edited, data = both_sketches(text, after, keep)
        if held:
            same = held[5] == text
            out.append(close(own if same else both_sketches(held[5], "", keep)[0]))
        held = (doc_id, len(text), hashlib.sha256(data).hexdigest(), own, edited, after)
        if len(out) >= 2000:
            yield batch()
            out = []
    if held:
        out.append(close(both_sketches(held[5], "", keep)[0]))
    if out:
        yield batch()


def fingerprint_pairs(docs: DataFrame, keep: int = KEEP, parts: int | None = None) -> DataFrame:
    """Each row of (doc_id, text) with its edited text and its next row compared.

    Texts are shuffled once, to ranges of ids in order; a range's last row meets the first of the next range in a
    side table of two rows for each range.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    asked = [i / parts for i in range(1, parts)]
    ids = docs.select(F.col("doc_id").cast("double")).filter("doc_id IS NOT NULL")
    found = ids.approxQuantile("doc_id", asked, 0.2 / parts) if asked else []
    bounds = np.array(sorted({int(x) for x in found}), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            part = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), "right") + 1
            part[ids.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.record_batch([pa.array(part.astype(np.int32)), *batch.columns], ["part", "doc_id", "text"])

    dealt = docs.mapInArrow(deal, "part int, doc_id long, text string")
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "text")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, str]]:
        for batch in batches:
            columns = [batch.column(c) for c in ("part", "doc_id", "text")]
            for part, doc_id, text in zip(*columns):
                yield part.as_py(), doc_id.as_py(), text.as_py()

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            last = None
            for row in stream(batches):
                if last and last[0] == row[0]:
                    yield last[1], last[2], row[2]
                last = row

        return _rows(pairs(), keep)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, last = [], None
        for row in stream(batches):
            if last is None or last[0] != row[0]:
                found += [(*last, False)] if last else []
                found.append((*row, True))
            last = row
        found += [(*last, False)] if last else []
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.bool_()]
        if found:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["part", "doc_id", "text", "head"])

    ends = ordered.mapInArrow(edges, "part int, doc_id long, text string, head boolean")
    heads = ends.filter("head").select("part", F.col("text").alias("after"))
    # One row of a number for each range.
    order = Window.orderBy("part")
    following = heads.select("part").withColumn("next", F.lead("part").over(order))
    following = following.withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy())))
    tails = ends.filter("NOT head").drop("head").join(following, "part")
    tails = tails.join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "after")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for batch in batches:
                columns = [batch.column(c) for c in ("doc_id", "text", "after")]
                for row in zip(*columns):
                    yield tuple(x.as_py() for x in row)

        return _rows(pairs(), keep)

    return ordered.mapInArrow(inside, _RESULT).unionByName(tails.mapInArrow(across, _RESULT))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its edited text and the next document compared."""
    return fingerprint_pairs(read(spark, sf_dir, "documents", "doc_id", "text"))
