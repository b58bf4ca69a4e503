"""One big JSON object read in parallel: its entries as rows.

A file is cut at commas by Spark's own text reader, which splits it by byte ranges, so no task reads more than its ranges
whatever the size of the file.  Whether a comma parts two entries hangs on what stands before it: quotes and brackets
that are open.  Each range is summed up for both cases, begun inside a string or not; running over these few sums, a row
per range, gives the true state at each range's start.  Then each range gives its entries; those that reach over
its end are put together from their parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.session import settle

_SIGNS = re.compile(r'\\.|["{}\[\]]', re.S)
_OPENS = re.compile(r"\s*\{")
_CLOSES = re.compile(r"\}\s*$")
_SUMS = ("out_open", "out_depth", "in_open", "in_depth")


def _step(text: str, inside: bool, depth: int) -> tuple[bool, int]:
    """Whether a string is open after ``text``, and how many brackets are."""
    for sign in _SIGNS.findall(text):
        if sign == '"':
            inside = not inside
        elif not inside and len(sign) == 1:
            depth += 1 if sign in "{[" else -1
    return inside, depth


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    """The range, told by its file and start, and the text of each fragment."""
    for batch in batches:
        yield from zip(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()), batch.column("value").to_pylist())


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: the state after it and its net brackets, begun outside and inside a string."""
    found: dict[tuple[str, int], list[tuple[bool, int]]] = {}
    for name, text in _rows(batches):
        found[name] = [_step(text, *s) for s in found.get(name, [(False, 0), (True, 0)])]
    columns = list(zip(*[(*name, *out, *in_) for name, (out, in_) in found.items()])) or [[]] * 6
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64())
    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "start", *_SUMS])


def _begins(sums: DataFrame) -> dict[tuple[str, int], tuple[bool, int]]:
    """The state at the start of each range, of the files that end with nothing open: four values per range."""
    out: dict[tuple[str, int], tuple[bool, int]] = {}
    held: dict[tuple[str, int], tuple[bool, int]] = {}
    file, inside, depth = None, False, 0
    for r in [*sums.orderBy("file", "start").collect(), None]:
        if r is None or r.file != file:
            if not inside and depth == 0:
                out |= held
            if r is None:
                break
            file, inside, depth, held = r.file, False, 0, {}
        held[file, r.start] = (inside, depth)
        opened, more = (r.in_open, r.in_depth) if inside else (r.out_open, r.out_depth)
        inside, depth = opened, depth + more
    return out


def _pieces(batches: Iterator[pa.RecordBatch], begins: dict[tuple[str, int], tuple[bool, int]]) -> Iterator[pa.RecordBatch]:
    """``file, start, number, last, text``: entries of each range; number 0 is what an earlier range began.

    The brackets of the object itself are taken off; text is null where they are not where they should be.
    """
    now, inside, depth, number = None, False, 0, 0
    held: list[str | None] = []
    out: list[tuple] = []

    def piece(last: bool) -> None:
        out.append((*now, number, last, None if None in held else ",".join(held)))

    def made() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        columns = list(zip(*out)) if out else [[]] * 5
        out.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "start", "number", "last", "text"])

    for name, text in _rows(batches):
        if name not in begins:
            continue
        if name != now:
            if now is not None:
                piece(True)
            now, (inside, depth), number, held = name, begins[name], 0, []
        before = depth
        # Between two entries nothing is open but the object itself.
        if not inside and depth <= 1:
            if held:
                piece(False)
            number, held = number + 1, []
        inside, depth = _step(text, inside, depth)
        if before == 0:
            text = text[m.end() :] if (m := _OPENS.match(text)) else None
        if depth <= 0 and text is not None:
            text = text[: m.start()] if (m := _CLOSES.search(text)) else None
        held.append(text)
        if len(out) >= 10_000:
            yield made()
    if now is not None:
        piece(True)
    yield made()


def _joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Entries that reach over the ends of ranges, put together; a row or two per range of a file."""
    out: list[list[str | None]] = []
    for number, text in rows.sort_values(["start", "number"])[["number", "text"]].itertuples(index=False):
        if number > 0 or not out:
            out.append([text])
        else:
            out[-1].append(text)
    return pd.DataFrame({"file": key[0], "text": [None if None in t else ",".join(t) for t in out]})


def read_json_map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """``file, key, value`` of the entries of each file's JSON object, the values of the type ``value``.

    A file that is not one whole object gives no rows.  Of a key that is there twice both entries come.
    """
    text = spark.read.option("lineSep", ",").text(path)
    text = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    sums = text.mapInArrow(_sums, "file string, start long, out_open boolean, out_depth long, in_open boolean, in_depth long")
    begins = _begins(sums)
    pieces = text.mapInArrow(lambda rows: _pieces(rows, begins), "file string, start long, number long, last boolean, text string")
    pieces = settle(pieces, "json-entries")
    # Most entries lie in one range.  The last of a range may go on in the next ones, up to their first entry.
    whole = pieces.filter("number > 0 AND NOT last").select("file", "text")
    edges = pieces.filter("number = 0 OR last").groupBy("file").applyInPandas(_joined, "file string, text string")
    entries = whole.unionByName(edges)
    parsed = F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), f"map<string, {value}>")
    entries = entries.withColumn("entry", parsed)
    # An empty object has one empty entry; elsewhere an entry without a key is damage.
    counts = entries.groupBy("file").agg(
        F.count("*").alias("n"), F.count_if(F.col("entry").isNull()).alias("damaged"), F.count_if(F.size("entry") == 0).alias("empty")
    )
    sound = counts.filter("damaged = 0 AND (empty = 0 OR n = 1)").select("file")
    return entries.join(sound, "file").select("file", F.explode("entry").alias("key", "value"))
