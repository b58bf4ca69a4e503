"""Paragraph dedup by MinHash banding: passages that an earlier place of the corpus holds are taken out.

Two kinds of paragraphs are compared.  *Lines* of at least ``least`` words are banded by rows of minima of their word
shingles.  Those with the same words are one class before anything is compared; classes that collide in a band are
verified by the exact Jaccard similarity of their sets of shingles, each with the first of its band, and those that are
not like it with all others of the band, in blocks.  Components of the links keep their first line.

*Runs* do not hang on line breaks.  Each run of ``least // 2 + 1`` neighbouring word pairs, wherever it starts, is banded
by its least pair, and the ``least // 2`` words from that pair on are a paragraph.  So any ``least`` words that stand
elsewhere too hold a whole paragraph of both places, however they are wrapped.  Equal paragraphs (128 bits of hash) keep
their first place.  The others of a document are joined to spans, which grow word by word over what else they
have in common with the first place, and go if they are at least ``least`` words then: shorter stock lines stay.  Where
only a later place than the first has more of a passage, up to ``least // 2`` words at its ends stay.

Everything is judged on the input, not on what is left.  Documents come in the order of their ids, and words are compared
in small letters A to Z, white space aside.

Results for odd input: null and empty texts have no paragraphs and stay as they are, as do rows without an id; texts of
any length are taken whole; rows that repeat an id count as one document, what is first in one is first in all of them;
of equal paragraphs that of the smaller id, then of the earlier word, is first; a run that overlaps its own first place
stays.  Columns of other names stay, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.components import components, forest
from leafwright.llm.texts import flat, mixed, packed, read, slices, span_hashes, words
from leafwright.session import settle

SHINGLE = 5
LIKE = 0.8
LEAST_WORDS = 46


def tuned_bands(like: float = LIKE, recall: float = 0.998, rows: int = 3) -> int:
    """The fewest bands of ``rows`` minima that let two sets of just that likeness collide with that chance."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - like**rows)))


def lines(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of all lines, and the row and number in its row of each; a row of n newlines has n + 1 lines."""
    breaks = np.flatnonzero(data == 10)
    stops = np.sort(np.concatenate([breaks, ends[1:]]), kind="stable")
    before = np.searchsorted(breaks, ends[:-1])
    count = np.searchsorted(breaks, ends[1:]) - before + 1
    row = np.repeat(np.arange(len(count)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return np.append(0, stops), row, number


def small_letters(data: np.ndarray) -> np.ndarray:
    """A copy with A to Z as small letters."""
    plain = data.copy()
    plain[(plain >= ord("A")) & (plain <= ord("Z"))] += 32
    return plain


def _two_hashes(word: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    other = mixed(word ^ np.uint64(0x5851F42D4C957F2D))
    return span_hashes(word, starts, stops), span_hashes(other, starts, stops)


def _shingles(data: np.ndarray, offsets: np.ndarray, n: int, least: int):
    """Long lines: their index, two content hashes, and their shingle hashes with the offsets of these."""
    plain = small_letters(data)
    starts, stops, line = words(plain, offsets)
    word = span_hashes(plain, starts, stops)
    count = np.bincount(line, minlength=len(offsets) - 1)
    at = np.cumsum(count) - count
    long = np.flatnonzero(count >= max(least, n))
    one, two = _two_hashes(word, at[long], at[long] + count[long])
    grams = np.zeros(max(len(word) - n + 1, 0), np.uint64)
    for i in range(n):
        grams = grams * np.uint64(0x9FB21C651E98DF25) + word[i : i + len(grams)]
    number = count[long] - n + 1
    edge = np.append(0, np.cumsum(number))
    pick = np.arange(edge[-1]) + np.repeat(at[long] - edge[:-1], number)
    return long, one, two, mixed(grams[pick]), edge


def anchors(word: np.ndarray, row: np.ndarray, reach: int) -> np.ndarray:
    """Places of the least word pair of each run of ``reach`` neighbouring pairs of one row; of equal ones the first."""
    pairs = mixed(word[:-1] * np.uint64(0x9FB21C651E98DF25) + word[1:])
    if len(pairs) < reach:
        return np.zeros(0, np.int64)
    # The hash above, the place below: the least of a run names its place.
    least = (pairs >> np.uint64(32) << np.uint64(32)) | np.arange(len(pairs), dtype=np.uint64)
    span = 1
    while span < reach:
        step = min(span, reach - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    whole = row[: len(least)] == row[reach : reach + len(least)]
    return np.unique(least[whole] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, place, one, two`` of the paragraphs of ``least // 2`` words: the number of the first word, and two hashes."""
    length, reach = least // 2, least - least // 2 - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = flat(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for a, b in slices(ends):
                plain = small_letters(data[ends[a] : ends[b]])
                starts, stops, row = words(plain, ends[a : b + 1] - ends[a])
                word = span_hashes(plain, starts, stops)
                at = anchors(word, row, reach)
                at = at[at + length <= len(word)]
                at = at[row[at] == row[at + length - 1]]
                one, two = _two_hashes(word, at, at + length)
                first = np.searchsorted(row, np.arange(b - a))
                yield pa.record_batch(
                    {
                        "doc_id": ids[a:b][row[at]].astype(np.int64),
                        "place": (at - first[row[at]]).astype(np.int32),
                        "one": one.view(np.int64),
                        "two": two.view(np.int64),
                    }
                )

    kept = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return kept.mapInArrow(run, "doc_id long, place int, one long, two long")


def _joined(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of each document: its repeated paragraphs that touch, with the first places of the two at the ends."""
    for batch in batches:
        out = []
        for doc_id, found in zip(batch.column("doc_id").to_pylist(), batch.column("found").to_pylist()):
            held = None
            for x in found:
                if held and x["place"] <= held["stop"]:
                    held |= {"stop": x["place"] + length, "doc_b": x["doc"], "place_b": x["at"] + length}
                    continue
                held = {"doc_id": doc_id, "start": x["place"], "stop": x["place"] + length}
                held |= {"doc_a": x["doc"], "place_a": x["at"], "doc_b": x["doc"], "place_b": x["at"] + length}
                out.append(held)
        kinds = [("doc_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("doc_a", pa.int64()), ("place_a", pa.int32())]
        yield pa.RecordBatch.from_pylist(out, pa.schema([*kinds, ("doc_b", pa.int64()), ("place_b", pa.int32())]))


def repeated_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, start, stop, doc_a, place_a, doc_b, place_b``: spans of words, not yet grown, that stand elsewhere before.

    The first paragraph of the span stands before at word ``place_a`` of ``doc_a``, the last one ends before word
    ``place_b`` of ``doc_b``.
    """
    length = least // 2
    found = settle(runs(docs, least), "runs")
    place = F.struct(F.col("doc_id").alias("doc"), F.col("place").alias("at"))
    often = found.groupBy("one", "two").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    # Written, so that the join deals out both sides anew and Spark can split the places of one very common paragraph.
    often = settle(often, "common-runs")
    later = (F.col("doc_id") != F.col("first.doc")) | (F.col("place") >= F.col("first.at") + length)
    again = found.join(often, ["one", "two"]).filter(later).select("doc_id", "place", "first")
    again = again.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("place", "first.doc", "first.at"))).alias("found"))
    spans = "doc_id long, start int, stop int, doc_a long, place_a int, doc_b long, place_b int"
    return again.mapInArrow(lambda batches: _joined(batches, length), spans)


def signatures(docs: DataFrame, bands: int, rows: int = 3, n: int = SHINGLE, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, line, one, two, bands`` of each long line: content hashes, and a hash of each band of minima."""
    factors = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = flat(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for a, b in slices(ends):
                offsets, row, number = lines(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                # A newline is white space, so it may stand at a line's end.
                long, one, two, grams, edge = _shingles(data[ends[a] : ends[b]], offsets, n, least)
                if not len(long):
                    continue
                keys = []
                for band in range(bands):
                    key = np.full(len(long), band, np.uint64)
                    for f in factors[band * rows : (band + 1) * rows]:
                        h = grams * f
                        key = mixed(key * f + np.minimum.reduceat(h ^ (h >> np.uint64(31)), edge[:-1]))
                    keys.append(key)
                yield pa.record_batch(
                    {
                        "doc_id": ids[a:b][row[long]].astype(np.int64),
                        "line": number[long].astype(np.int32),
                        "one": one.view(np.int64),
                        "two": two.view(np.int64),
                        "bands": pa.ListArray.from_arrays(
                            np.arange(0, len(long) * bands + 1, bands, dtype=np.int32),
                            np.stack(keys, 1).ravel().view(np.int64),
                        ),
                    }
                )

    kept = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return kept.mapInArrow(run, "doc_id long, line int, one long, two long, bands array<long>")


def shingle_sets(docs: DataFrame, asked: DataFrame, n: int, least: int) -> DataFrame:
    """``doc_id, line, grams`` of the asked lines (doc_id, line): their distinct shingle hashes, sorted, as bytes."""
    wanted = asked.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("lines"))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, asked in zip(*(batch.column(c) for c in ("doc_id", "text", "lines"))):
                # Rows that repeat an id may have no text, or fewer lines.
                parts = (text.as_py() or "").split("\n")
                picked = asked.as_py()
                data, ends = flat(pa.array([parts[i] if i < len(parts) else "" for i in picked], pa.string()))
                long, _, _, grams, edge = _shingles(data, ends, n, least)
                for i, a, b in zip(long.tolist(), edge.tolist(), edge[1:].tolist()):
                    out.append((doc_id.as_py(), picked[i], np.unique(grams[a:b]).tobytes()))
            columns = list(zip(*out)) if out else [[]] * 3
            kinds = (pa.int64(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "line", "grams"])

    # Repeated rows of one id give one set.
    return texts.mapInArrow(run, "doc_id long, line int, grams binary").groupBy("doc_id", "line").agg(F.min("grams").alias("grams"))


def likeness(a: bytes, b: bytes) -> float:
    """Exact Jaccard similarity of two sets of hashes."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common / (len(x) + len(y) - common)


def _verified(batches: Iterator[pd.DataFrame], like: float) -> Iterator[pd.DataFrame]:
    for rows in batches:
        rows["alike"] = [likeness(a, b) >= like for a, b in zip(rows["grams_a"], rows["grams_b"])]
        yield rows.drop(columns=["grams_a", "grams_b"])


def _in_band(band: int, grams: bytes) -> np.ndarray:
    """Shingle hashes that agree only with those of the same band."""
    return np.frombuffer(grams, np.uint64) ^ mixed(np.array([band], np.int64).view(np.uint64))


def _block_links(rows: pd.DataFrame, like: float) -> pd.DataFrame:
    """Links of one block that join what is alike: rows of the left side, and those of the right side of their band.

    Of all alike pairs only a spanning forest counts, so a family of lines gives one link less than its lines.
    """
    left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
    sets = [_in_band(b, g) for b, g in zip(right["band"], right["grams"])]
    columns = ["doc_a", "line_a", "doc_b", "line_b"]
    kinds = {"doc_a": "int64", "line_a": "int32", "doc_b": "int64", "line_b": "int32"}
    if not len(left) or not sets:
        return pd.DataFrame([], columns=columns).astype(kinds)
    names = list(zip(right["doc_id"], right["line"]))
    # A line is one member, in whichever side or band it stands.
    number: dict[tuple, int] = {}
    for name in [*names, *zip(left["doc_id"], left["line"])]:
        number.setdefault(name, len(number))
    member = np.array([number[name] for name in names])
    size = np.array([len(s) for s in sets])
    owner, held = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    order = np.argsort(held)
    owner, held = owner[order], held[order]

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for band, doc_id, line, grams in zip(left["band"], left["doc_id"], left["line"], left["grams"]):
            mine = _in_band(band, grams)
            a, b = np.searchsorted(held, mine), np.searchsorted(held, mine, "right")
            hits = np.concatenate([owner[i:j] for i, j in zip(a.tolist(), b.tolist())])
            common = np.bincount(hits, minlength=len(sets))
            alike = member[common >= like * (len(mine) + size - common)]
            yield np.full(len(alike), number[doc_id, line]), alike

    all_names = list(number)
    a, b = forest(len(number), pairs())
    return pd.DataFrame([(*all_names[i], *all_names[j]) for i, j in zip(a, b)], columns=columns).astype(kinds)


def links(met: DataFrame, sets: DataFrame, like: float, block: int = 2000) -> DataFrame:
    """Verified links ``a, b`` between the lines of each band (band, first, head, size), as structs of document id and line."""
    named = sets.select(F.struct("doc_id", "line").alias("first"), "grams")
    pairs = met.filter("head <> first").select(F.col("head").alias("a"), F.col("first").alias("b")).distinct()
    pairs = pairs.join(named.toDF("b", "grams_b"), "b").join(named.toDF("a", "grams_a"), "a")
    checked = settle(
        pairs.mapInPandas(
            lambda batches: _verified(batches, like),
            "b struct<doc_id: bigint, line: int>, a struct<doc_id: bigint, line: int>, alike boolean",
        ),
        "checked",
    )
    straight = checked.filter("alike").select("a", "b")
    # Those unlike the first of their band meet all others of the band, in blocks of both.
    odd = met.join(checked.filter("NOT alike").select(F.col("a").alias("head"), F.col("b").alias("first")), ["head", "first"])
    odd = odd.select("band", "first", "size")
    count = F.ceil(F.col("size") / block).cast("int")
    spot = F.pmod(F.xxhash64("first"), F.col("parts")).cast("int")
    left = odd.withColumn("parts", count).withColumn("i", spot)
    left = left.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    bands = odd.select("band", "size").distinct().withColumn("parts", count).drop("size")
    right = met.join(bands, "band").filter("first <> head").withColumn("j", spot)
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = left.select("band", "parts", "i", "j", "first", F.lit(0).alias("side"))
    both = both.unionByName(right.select("band", "parts", "i", "j", "first", F.lit(1).alias("side")))
    both = both.join(named, "first").select("band", "parts", "i", "j", "side", "first.doc_id", "first.line", "grams")
    # Small bands share groups; a band that is cut to blocks has its own.
    groups = max(1, met.count() // block)
    shared = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("band"), F.lit(groups))).otherwise(F.col("band"))
    both = both.withColumn("group", shared).drop("parts")
    cross = both.groupBy("group", "i", "j").applyInPandas(
        lambda rows: _block_links(rows, like), "doc_a long, line_a int, doc_b long, line_b int"
    )
    node = lambda side: F.struct(F.col(f"doc_{side}").alias("doc_id"), F.col(f"line_{side}").alias("line"))
    return straight.unionByName(cross.select(node("a").alias("a"), node("b").alias("b")).distinct())


def collisions(classes: DataFrame) -> DataFrame:
    """``band, first, head, size``: the classes (first, bands) of each band that several share, with the first of them."""
    held = classes.select("first", F.explode("bands").alias("band"))
    firsts = held.groupBy("band").agg(F.min("first").alias("head"), F.count("*").alias("size")).filter("size > 1")
    return held.join(firsts, "band")


def repeats(docs: DataFrame, like: float = LIKE, n: int = SHINGLE, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, line, kept_doc, kept_line`` of each long line of (doc_id, text) that an earlier one stands for."""
    found = settle(signatures(docs, tuned_bands(like), n=n, least=least), "paragraphs")
    place = F.struct("doc_id", "line")
    classes = found.groupBy("one", "two").agg(
        F.min(place).alias("first"), F.count("*").alias("copies"), F.min_by("bands", place).alias("bands")
    )
    classes = settle(classes, "paragraph-classes")
    met = settle(collisions(classes), "bands")
    sets = settle(shingle_sets(docs, met.select("first.*").distinct(), n, least), "shingles")
    named = components(links(met, sets, like))
    several = classes.join(named, classes["first"] == named["node"], "left").filter("copies > 1 OR component IS NOT NULL")
    several = several.select("one", "two", F.coalesce("component", "first").alias("kept"))
    out = found.select("doc_id", "line", "one", "two").join(several, ["one", "two"])
    out = out.filter(F.struct("doc_id", "line") != F.col("kept"))
    return out.select("doc_id", "line", F.col("kept.doc_id").alias("kept_doc"), F.col("kept.line").alias("kept_line")).distinct()


def contexts(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """``doc, place, before, words`` of the asked places: hashes of the words before or from there on, the nearest first."""
    wanted = asked.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("place", "before"))).alias("asked"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(wanted, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("doc", pa.int64()), ("place", pa.int32()), ("before", pa.bool_()), ("words", pa.binary())]
        for batch in batches:
            out = []
            for doc, text, asked in zip(*(batch.column(c) for c in ("doc", "text", "asked"))):
                word = _word_hashes(text)[0]
                for x in asked.as_py():
                    at = x["place"]
                    held = word[max(0, at - length) : at][::-1] if x["before"] else word[at : at + length]
                    out.append({"doc": doc.as_py(), **x, "words": held.tobytes()})
            yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    found = texts.mapInArrow(run, "doc long, place int, before boolean, words binary")
    # Rows that repeat an id may differ; the least of them counts.
    return found.groupBy("doc", "place", "before").agg(F.min("words").alias("words"))


def _word_hashes(text: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and stops of the words of a text, and its bytes."""
    data, ends = flat(pa.array([text.as_py()], pa.string()))
    plain = small_letters(data)
    starts, stops, _ = words(plain, ends)
    return span_hashes(plain, starts, stops), starts, stops, data


def _grown(word: np.ndarray, at: int, before: bool, context: bytes | None) -> int:
    """Words next to a span that the first place has there too."""
    if not context:
        return 0
    theirs = np.frombuffer(context, np.uint64)
    mine = word[max(0, at - len(theirs)) : at][::-1] if before else word[at : at + len(theirs)]
    differ = np.flatnonzero(mine != theirs[: len(mine)])
    return int(differ[0]) if len(differ) else len(mine)


def _cut(text: pa.Scalar, spans: list[dict], picked: list[int], least: int) -> tuple[str, list[dict]]:
    """The text without its repeated spans and lines, and what went as spans of words."""
    word, starts, stops, data = _word_hashes(text)
    gone = np.zeros(len(word) + 1, bool)
    for x in spans:
        left, right = (_grown(word, x[at], at == "start", x[name]) for at, name in (("start", "before"), ("stop", "after")))
        if x["clear"] >= 0:
            # The first place is in the same text: it stays, grown as far.
            left = min(left, x["clear"])
            right = min(right, x["clear"] - left)
        start, stop = x["start"] - left, min(x["stop"] + right, len(word))
        if stop - start >= least:
            gone[start:stop] = True
    if picked:
        breaks = np.concatenate([[-1], np.flatnonzero(data == 10), [len(data)]])
        for i in picked:
            if i + 1 < len(breaks):
                gone[np.searchsorted(starts, breaks[i]) : np.searchsorted(starts, breaks[i + 1])] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[:-1], [False]]).astype(np.int8)))
    held, removed, at = [], [], 0
    raw = data.tobytes()
    for a, b in edge.reshape(-1, 2).tolist():
        held.append(raw[at : starts[a]])
        at = int(starts[b]) if b < len(starts) else len(raw)
        # What follows a passage that ended a line does not join the line before it.
        if b"\n" in raw[stops[b - 1] : at] and held[-1] and not held[-1].endswith(b"\n"):
            held.append(b"\n")
        removed.append({"start": a, "length": b - a})
    return b"".join([*held, raw[at:]]).decode(), removed


def without_repeats(
    docs: DataFrame, like: float = LIKE, n: int = SHINGLE, least: int = LEAST_WORDS, mark: str | None = "removed"
) -> DataFrame:
    """The rows of ``docs`` with repeated passages taken out of ``text``, their white space after them too.

    The column ``mark`` has the spans of words that went, null where none did; it takes the place of one of that name.
    """
    spans = settle(repeated_runs(docs, least), "spans")
    side = lambda s, before: (F.col(f"doc_{s}").alias("doc"), F.col(f"place_{s}").alias("place"), F.lit(before).alias("before"))
    asked = spans.select(*side("a", True)).unionByName(spans.select(*side("b", False))).distinct()
    around = settle(contexts(docs, asked, least - least // 2), "contexts")
    for s, before, name in (("a", True, "before"), ("b", False, "after")):
        near = around.filter(F.col("before") == before).select(F.col("doc").alias(f"doc_{s}"), F.col("place").alias(f"place_{s}"), F.col("words").alias(name))
        spans = spans.join(near, [f"doc_{s}", f"place_{s}"], "left")
    # The words between the first place and a span of the same document bound its growth.
    own, both = (F.col(f"doc_{s}") == F.col("doc_id") for s in "ab"), F.col("doc_a") == F.col("doc_b")
    own_a, own_b = own
    clear = F.when(own_a & own_b, F.greatest(F.col("start") - F.col("place_b"), F.lit(0))).otherwise(-1).alias("clear")
    near = [F.when(~of | both, F.col(name)).alias(name) for of, name in ((own_a, "before"), (own_b, "after"))]
    found = spans.select("doc_id", F.struct("start", "stop", *near, clear).alias("span"), F.lit(None).cast("int").alias("line"))
    gone_lines = repeats(docs, like, n, least).select("doc_id", F.lit(None).cast(found.schema["span"].dataType).alias("span"), "line")
    gone = found.unionByName(gone_lines).groupBy("doc_id").agg(
        F.struct(F.array_sort(F.collect_list("span")).alias("spans"), F.array_sort(F.collect_set("line")).alias("lines")).alias("gone")
    )
    out = docs.select(packed(docs).alias("row"), F.col("doc_id").cast("long").alias("id")).join(gone.withColumnRenamed("doc_id", "id"), "id", "left")

    @F.pandas_udf("struct<text:string,removed:array<struct<start:int,length:int>>>")
    def cut(text: pd.Series, gone: pd.DataFrame) -> pd.DataFrame:
        pairs = []
        for t, spans, picked in zip(text, gone["spans"], gone["lines"]):
            if t is None or spans is None:
                pairs.append((None, None))
                continue
            left, removed = _cut(pa.scalar(t), list(spans), list(picked), least)
            pairs.append((left, removed or None))
        return pd.DataFrame(pairs, columns=["text", "removed"])

    out = out.withColumn("cut", cut(F.when(F.col("gone").isNotNull(), F.col("row.text")), F.col("gone")))
    out = out.withColumn("row", F.when(F.col("cut.removed").isNotNull(), F.col("row").withField("text", F.col("cut.text"))).otherwise(F.col("row")))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != mark]
    return out.select(*kept, *([F.col("cut.removed").alias(mark)] if mark else []))


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: ``doc_id, n_removed`` (spans), ``removed`` (spans of words) and the ``text`` that is left."""
    docs = without_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"), "removed", "text")
