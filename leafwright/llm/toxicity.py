"""Toxicity behind a noisy channel: disguised words are restored by Viterbi decoding, then the restored text is scored.

Writers disguise words by look-alike signs (``1d!0t``), by spacing letters out and by repeating them.  A span with
such a trace becomes a lattice of what each sign may stand for, with the channel's cost of each reading.  The cheapest
path under the channel and a character language model of the whole corpus is the restored span.  Where a span has no
trace the lattice has one path, the text itself.

The restored text is scored by logistic regression on hashed beginnings of words and whole words, as an attack word
goes on in many ways.  Null and empty texts have the bias as their one feature; a text of any length is read whole;
repeated rows get the same score; ties do not arise, as each row is scored by itself, and spans that cost the same are
restored the same way each time.  Columns that are kept may have any name but those of the result.  An empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafwright.llm import learn
from leafwright.llm.learn import Ftrl, logistic, summed
from leafwright.llm.texts import SPACES, flat, held_out, read, slices, span_hashes

TOXIC = Ftrl(bits=20, alpha=1.0, l1=3.0, l2=0.1, epochs=3)

# What a sign may stand for.
LOOKS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou", "€": "e", "£": "l",
}

# Channel costs, as negative logarithms of rough chances.
_LOOK, _DROP, _BREAK, _ONCE, _TWICE, _MANY, _JOIN, _PART = 1.0, 3.0, 4.0, 0.3, 1.2, 2.0, 0.3, 2.5
# A look-alike after the last letter may be meant as it is: marks, and three equal signs, more often than digits and
# currency signs.
_MARK, _PLAIN, _MARKS = 0.5, 2.5, "!|+*"
# Weight of the language model against the channel, and of the shorter context in it.
_MODEL, _SHORT = 0.3, 4.0

# Character classes: 0 for all that is no letter, 1 to 26 for a to z, the others for bytes of other letters.
_CLASSES = 27 + 32
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASS[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_CLASS[0x80:] = 27 + (np.arange(0x80, 0x100) & 31)
_LETTER = _CLASS > 0
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[ord("A") : ord("Z") + 1] += 32
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKS if ord(c) < 128]] = True
_WIDE = [c.encode() for c in LOOKS if ord(c) >= 128]
_BETWEEN = " .-_*"
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in _BETWEEN]] = True


def small(data: np.ndarray) -> np.ndarray:
    """Bytes in small letters: ASCII, and Latin-1 where it takes two bytes."""
    out = _SMALL[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = second[(data[second] >= 0x80) & (data[second] <= 0x9E)]
    out[capital] += 0x20
    return out


def character_counts(docs: DataFrame) -> DataFrame:
    """``code, n``: how often each three characters follow each other in all texts, by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_CLASSES**3, np.int64)
        for batch in batches:
            data, ends = flat(batch.column("text"))
            for a, b in slices(ends):
                # Between texts lies a boundary, as before the first.
                c = np.zeros(ends[b] - ends[a] + 2 * (b - a) + 2, np.int64)
                shift = np.repeat(np.arange(1, b - a + 1), np.diff(ends[a : b + 1])) * 2
                c[np.arange(ends[b] - ends[a]) + shift] = _CLASS[data[ends[a] : ends[b]]]
                counts += np.bincount((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:], minlength=_CLASSES**3)
        code = np.flatnonzero(counts)
        yield pa.record_batch({"code": code, "n": counts[code]})

    return docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame) -> np.ndarray:
    """Cost of each character class after two others, from counts over all of ``docs``.

    The table has one number for each three classes, however large the corpus.
    """
    counts = np.zeros(_CLASSES**3)
    for code, n in character_counts(docs).collect():
        counts[code] = n
    three = counts.reshape(_CLASSES, _CLASSES, _CLASSES)
    two, one = three.sum(0), three.sum((0, 1))
    single = (one + 1) / (one.sum() + _CLASSES)
    after_one = (two + _SHORT * single) / (two.sum(1, keepdims=True) + _SHORT)
    after_two = (three + _SHORT * after_one[None]) / (three.sum(2, keepdims=True) + _SHORT)
    return -np.log(after_two).astype(np.float32)


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Readings of each run of equal signs of a span in small letters, with their channel costs."""
    spaced = re.fullmatch(r"\S(?:[%s]{1,2}\S)+" % re.escape(_BETWEEN), span) is not None
    doubled = re.fullmatch(r"\W*?(?:(\S)\1+){3,}\W*", span) is not None
    last = max((i for i, c in enumerate(span) if c.isalpha()), default=-1)
    out = []
    for run in re.finditer(r"(.)\1*", span, re.S):
        c, n = run.group(1), len(run.group())
        if c in LOOKS and not (spaced and c in _BETWEEN):
            once, twice = (_LOOK + _DROP, _LOOK) if n == 2 and not doubled else (_LOOK, _LOOK + _TWICE)
            # Digits and currency signs are dropped or kept sign by sign.
            signs = 1 if c in _MARKS else min(n, 2)
            readings = [(x, once) for x in LOOKS[c]] + [("", _DROP * signs), (" ", _BREAK * signs)]
            if n > 1:
                readings += [(x + x, twice) for x in LOOKS[c]]
            if run.start() > last and not spaced:
                readings.append((run.group(), _MARK if c in _MARKS or n > 2 else _PLAIN * signs))
        elif spaced and c in _BETWEEN:
            readings = [("", _JOIN), (" ", _PART)]
        elif not c.isalpha():
            readings = [(run.group(), 0.0)]
        elif n == 1:
            readings = [(c, 0.0)]
        elif doubled and n == 2:
            readings = [(c, _ONCE), (c * 2, _TWICE)]
        elif n == 2:
            readings = [(c * 2, 0.0), (c, _MANY)]
        else:
            readings = [(c * n, _MANY), (c, _ONCE), (c * 2, _TWICE)]
        out.append(readings)
    return out


def decode(span: str, costs: np.ndarray) -> str:
    """The cheapest path through the lattice of a span under channel and language model."""
    best = {(0, 0): (0.0, "")}
    for readings in [*lattice(span), [(" ", 0.0)]]:
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in best.items():
            for reading, price in readings:
                p, q, total = a, b, cost + price
                # Signs of several bytes are no letters.
                signs = not reading.isascii() and not any(x.isalpha() for x in reading)
                for byte in b" " if signs else reading.encode():
                    c = int(_CLASS[byte])
                    if c or q:
                        total += _MODEL * float(costs[p, q, c])
                    p, q = (q, c) if c or q else (p, q)
                if (p, q) not in following or total < following[p, q][0]:
                    following[p, q] = (total, text + reading)
        best = following
    return " ".join(min(best.values())[1].split())


def _spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the spans with a trace of disguise, in order and apart from each other."""
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~SPACES[data]
    look = _SIGN[data]
    for sign in _WIDE:
        at = np.flatnonzero(data == sign[0])
        at = at[at + len(sign) <= n]
        for i, byte in enumerate(sign):
            at = at[data[at + i] == byte]
        for i in range(len(sign)):
            look[at + i] = True
    letter = _LETTER[data] & ~look
    edge = np.zeros(n + 1, bool)
    edge[ends[1:-1]] = True
    edge[0] = edge[n] = True
    # A look-alike before or after a letter.
    trace = np.zeros(n, bool)
    trace[:-1] = look[:-1] & letter[1:] & ~edge[1:n]
    trace[1:] |= look[1:] & letter[:-1] & ~edge[1:n]
    # Three equal letters; in two-byte letters every other byte.
    same = letter[:-2] & (data[:-2] == data[1:-1]) & (data[1:-1] == data[2:]) & (data[:-2] < 0x80)
    trace[:-2] |= same & ~edge[1 : n - 1] & ~edge[2:n]
    if n >= 6:
        wide = (data[:-5] >= 0xC3) & (data[:-5] < 0xE0) & (data[:-5] == data[2:-3]) & (data[2:-3] == data[4:-1])
        trace[:-5] |= wide & (data[1:-4] == data[3:-2]) & (data[3:-2] == data[5:]) & ~edge[2 : n - 3] & ~edge[4 : n - 1]
        # Three doubled letters in a row.
        pair = letter[:-1] & (data[:-1] == data[1:]) & (data[:-1] < 0x80) & ~edge[1:n]
        trace[:-5] |= pair[:-4] & pair[2:-2] & pair[4:] & ~edge[2 : n - 3] & ~edge[4 : n - 1]
    starts_word = solid.copy()
    starts_word[1:] &= ~solid[:-1] | edge[1:n]
    word_start = np.flatnonzero(starts_word)
    ends_word = solid.copy()
    ends_word[:-1] &= ~solid[1:] | edge[1:n]
    word_stop = np.flatnonzero(ends_word) + 1
    at = np.unique(np.searchsorted(word_start, np.flatnonzero(trace & solid), "right") - 1)
    # Runs of at least four single letters or look-alikes with one or two separators between each two, three if no space
    # is among these.
    single = letter & (data < 0x80) | _SIGN[data]
    alone = np.zeros(n, bool)
    alone[1:-1] = single[1:-1] & _BREAKS[data[:-2]] & _BREAKS[data[2:]]
    first, last = edge[:n], edge[1:]
    alone[0] |= single[0] & _BREAKS[data[1]]
    alone[1:-1] |= single[1:-1] & (first[1:-1] | (data[:-2] == 10)) & _BREAKS[data[2:]]
    alone[1:] |= single[1:] & (last[1:] | np.append(data[2:] == 10, True)) & _BREAKS[data[:-1]]
    run = np.flatnonzero(alone & letter | alone & _SIGN[data])
    run = run[~_BREAKS[data[run]]]
    if len(run):
        step = np.diff(run)
        apart = (step > 3) | edge[run[1:]] | edge[run[1:] - 1] | (step == 3) & edge[run[1:] - 2]
        cut = np.flatnonzero(np.append(True, apart))
        length = np.diff(np.append(cut, len(run)))
        begin, end = run[cut], run[cut + length - 1]
        signs = np.append(0, np.cumsum(letter)), np.append(0, np.cumsum(SPACES[data]))
        letters, blanks = (x[end + 1] - x[begin] for x in signs)
        keep = (length >= 4) & ((end - begin == 2 * (length - 1)) | (letters > 1)) | (length == 3) & (letters > 1) & (blanks == 0)
        spaced = np.stack([run[cut[keep]], run[cut[keep] + length[keep] - 1] + 1], 1)
    else:
        spaced = np.zeros((0, 2), np.int64)
    found = np.concatenate([np.stack([word_start[at], word_stop[at]], 1), spaced])
    found = found[np.lexsort((-found[:, 1], found[:, 0]))]
    # A span inside or across another is left out.
    reach = np.append(0, np.maximum.accumulate(found[:, 1])[:-1]) if len(found) else found[:, 1]
    found = found[found[:, 0] >= reach]
    return found[:, 0], found[:, 1]


class Restorer:
    """Restores texts under a language model; decoded spans are kept in a bounded cache."""

    def __init__(self, costs: np.ndarray):
        self.decode = lru_cache(1 << 16)(lambda span: decode(span, costs))

    def __call__(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts in small letters with their spans restored, their offsets, and the number of changed spans of each."""
        data = small(data)
        starts, stops = _spans(data, ends)
        changed = np.zeros(len(ends) - 1, np.int64)
        if not len(starts):
            return data, ends, changed
        held, parts, at = data.tobytes(), [], 0
        row = np.searchsorted(ends, starts, "right") - 1
        grown = np.zeros(len(ends), np.int64)
        for a, b, r in zip(starts.tolist(), stops.tolist(), row.tolist()):
            span = held[a:b].decode()
            better = self.decode(span)
            if better != span:
                new = better.encode()
                parts += [held[at:a], new]
                at = b
                grown[r + 1] += len(new) - (b - a)
                changed[r] += 1
        parts.append(held[at:])
        return np.frombuffer(b"".join(parts), np.uint8), ends + np.cumsum(grown), changed


def restore(docs: DataFrame, costs: np.ndarray) -> DataFrame:
    """``doc_id, restored, changed`` of each row of (doc_id, text): the text in small letters, disguises undone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = Restorer(costs)
        for batch in batches:
            data, ends = flat(batch.column("text"))
            for a, b in slices(ends):
                new, at, changed = again(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                texts = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(new.tobytes()))
                ids = batch.column("doc_id").slice(a, b - a)
                yield pa.record_batch([ids, texts.cast(pa.string()), pa.array(changed)], ["doc_id", "restored", "changed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, restored string, changed long")


# Lengths in bytes of the beginnings of words that are features.
_BEGINNINGS = (4, 5, 6, 7, 8)


def _beginnings(data: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature number of each whole word and each beginning of a word; words are runs of letters."""
    letter = _LETTER[data]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    cuts = ends[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts], last[cuts - 1] = letter[cuts], letter[cuts - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(ends, starts, "right") - 1
    rows, a, b, kind = [row], [starts], [stops], [np.zeros(len(row), np.uint64)]
    for n in _BEGINNINGS:
        long = stops - starts > n
        rows.append(row[long])
        a.append(starts[long])
        b.append(starts[long] + n)
        kind.append(np.ones(long.sum(), np.uint64))
    h = span_hashes(data, np.concatenate(a), np.concatenate(b)) + np.concatenate(kind) * np.uint64(0x9E3779B97F4A7C15)
    return np.concatenate(rows), (h >> np.uint64(64 - bits)).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, costs: np.ndarray, cfg: Ftrl = TOXIC) -> np.ndarray:
    """Weights of the features of restored texts, from the labelled rows that are not held out."""

    def features(data: np.ndarray, ends: np.ndarray):
        new, at, _ = Restorer(costs)(data, ends)
        row, number, _ = summed(*_beginnings(new, at, cfg.bits), cfg.bits)
        return row, number, np.ones(len(row))

    return learn.train(docs, labels, "toxic", features, cfg)


def score(docs: DataFrame, costs: np.ndarray, model: np.ndarray, cfg: Ftrl = TOXIC, *keep: str) -> DataFrame:
    """``doc_id`` and the columns ``keep``, with ``score`` and ``changed`` (restored spans) of each row; row-local.

    Columns of ``docs`` of these two names are not kept.
    """
    columns = ["doc_id", *[c for c in keep if c not in ("doc_id", "score", "changed")]]
    kinds = StructType([docs.schema[c] for c in columns]).add("score", "double").add("changed", "long")
    known = np.flatnonzero(model[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = Restorer(costs)
        used = np.zeros(len(model) - 1, bool)
        used[known] = True
        for batch in batches:
            data, ends = flat(batch.column("text"))
            scores, changes = [np.zeros(0)], [np.zeros(0, np.int64)]
            for a, b in slices(ends):
                new, at, changed = again(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                row, number = _beginnings(new, at, cfg.bits)
                hit = used[number]
                row, number, _ = summed(row[hit], number[hit], cfg.bits)
                scores.append(logistic(np.bincount(row, model[number], b - a) + model[-1]))
                changes.append(changed)
            found = [pa.array(np.concatenate(scores)), pa.array(np.concatenate(changes))]
            yield pa.record_batch([*[batch.column(c) for c in columns], *found], [*columns, "score", "changed"])

    text = [] if "text" in columns else ["text"]
    return docs.select(*columns, *text).mapInArrow(run, kinds)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: ``doc_id, held_out, score, predicted, changed``."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    costs = language_model(docs)
    model = train(docs, read(spark, sf_dir, "labels"), costs)
    return score(docs, costs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "changed",
    )
