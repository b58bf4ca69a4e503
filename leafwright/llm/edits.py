"""Token counts kept up to date under edits: a segment tree of pre-tokens for each document.

The leaves of a tree are runs of pre-tokens, its nodes hold sums of characters and tokens.  An edit is found by going
down the character sums; the pre-tokens that it touches, with those whose match could have looked at the edited
characters, are cut and encoded anew until a new cut falls on an old one after the edit; then only the sums above the
changed leaves are worked out again.

A null text is empty and counts 0 tokens.  Edits past the end of a text append; negative starts count as 0.  A
document without edits keeps its counts.  Edits of a document are applied one after another in their given order, those of
one place too.  Rows that repeat an id are each edited.  A very long text is one tree, held by the task that has its
row.  Other columns are left out, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.texts import read
from leafwright.llm.tokens import PieceCounts, once

# How far past its end the match of a pre-token can look: a run of white space tests the sign after its last one, an
# apostrophe the two after it.
_LOOK = 2
_LEAF = 64


class PieceTree:
    """Pre-tokens of a text with their token counts, in leaves under a tree of sums."""

    def __init__(self, text: str, counter: PieceCounts):
        self.counter = counter
        pieces = counter.pieces(text)
        counts = counter.counts(pieces)
        self.leaves = [(pieces[i : i + _LEAF], counts[i : i + _LEAF]) for i in range(0, len(pieces), _LEAF)] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        self.encoded = 0
        for i in range(len(self.leaves)):
            self._sum(i)
        for node in range(self.width - 1, 0, -1):
            self._join(node)

    def _sum(self, leaf: int) -> None:
        pieces, counts = self.leaves[leaf]
        self.chars[self.width + leaf] = sum(map(len, pieces))
        self.tokens[self.width + leaf] = sum(counts)

    def _join(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _find(self, at: int) -> tuple[int, int, int]:
        """Leaf, piece in it and start of the piece that holds character ``at``; the last piece if none does."""
        node, start = 1, 0
        at = min(at, self.chars[1] - 1)
        while node < self.width:
            node *= 2
            if at - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        leaf = node - self.width
        for i, piece in enumerate(self.leaves[leaf][0]):
            if start + len(piece) > at:
                return leaf, i, start
            start += len(piece)
        return leaf, 0, start

    def edit(self, start: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters from ``start`` on by ``inserted``."""
        total = self.chars[1]
        start = min(max(start, 0), total)
        stop = min(start + max(removed, 0), total)
        if total == 0:
            self.__init__(inserted, self.counter)
            self.encoded = len(inserted)
            return
        first, low, at = self._find(max(0, start - _LOOK))
        shift = len(inserted) - (stop - start)
        old, places, spare = [], [], 8
        source = self._from(first, low)
        ended = False
        while True:
            # Old pieces up to the edit's end and some more; if no common cut is among these, four times as many.
            gathered, beyond = at + sum(map(len, old)), 0
            while not ended and beyond < spare:
                held = next(source, None)
                if held is None:
                    ended = True
                    break
                places.append(held)
                old.append(self.leaves[held[0]][0][held[1]])
                gathered += len(old[-1])
                beyond += gathered > stop
            text = "".join(old)
            text = text[: start - at] + inserted + text[stop - at :]
            cuts, position = {}, at
            for number, piece in enumerate([*old, ""]):
                if position >= stop:
                    cuts[position + shift - at] = number
                position += len(piece)
            new, position, met = [], 0, None
            while met is None:
                if position >= start - at + len(inserted) and position in cuts:
                    met = cuts[position]
                elif position >= len(text):
                    met = len(old) if ended else -1
                else:
                    found = self.counter.match(text, position)
                    if not ended and found.end() + _LOOK > len(text):
                        met = -1
                    else:
                        new.append(found.group())
                        position = found.end()
            self.encoded += position
            if met >= 0:
                break
            spare *= 4
        self._replace((first, low), places[met] if met < len(places) else None if ended else next(source, None), new)

    def _from(self, leaf: int, i: int) -> Iterator[tuple[int, int]]:
        """Places of all pieces from the given one on."""
        while leaf < len(self.leaves):
            for j in range(i, len(self.leaves[leaf][0])):
                yield leaf, j
            leaf, i = leaf + 1, 0

    def _replace(self, first: tuple[int, int], stop: tuple[int, int] | None, new: list[str]) -> None:
        """Put new pieces in the place of those from ``first`` up to ``stop``, and sum again what stands above them."""
        (a, i), (b, j) = first, stop or (len(self.leaves) - 1, len(self.leaves[-1][0]))
        head = tuple(x[:i] for x in self.leaves[a])
        tail = tuple(x[j:] for x in self.leaves[b])
        counts = self.counter.counts(new)
        for leaf in range(a, b + 1):
            self.leaves[leaf] = ([], [])
        if a == b:
            self.leaves[a] = (head[0] + new + tail[0], head[1] + counts + tail[1])
        else:
            self.leaves[a], self.leaves[b] = (head[0] + new, head[1] + counts), tail
        nodes = set()
        for leaf in range(a, b + 1):
            self._sum(leaf)
            nodes.add((self.width + leaf) // 2)
        while nodes - {0}:
            for node in nodes:
                self._join(node)
            nodes = {node // 2 for node in nodes}

    def text(self) -> str:
        return "".join(p for pieces, _ in self.leaves for p in pieces)


def edit_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, edited_tokens, edited_chars, encoded_chars`` of rows (doc_id, text, edits).

    ``edits`` is an array of (start, removed, inserted), in characters of the text as the edits before it left it.
    ``encoded_chars`` is how many characters were cut and encoded anew for all edits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once(PieceCounts, path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text, edits in zip(*(batch.column(c) for c in ("doc_id", "text", "edits"))):
                tree = PieceTree(text.as_py() or "", counter)
                before, encoded = tree.tokens[1], 0
                for edit in edits.as_py() or []:
                    if edit is not None:
                        tree.edit(edit["start"] or 0, edit["removed"] or 0, edit["inserted"] or "")
                rows.append((doc_id.as_py(), before, tree.tokens[1], tree.chars[1], tree.encoded))
            columns = list(zip(*rows)) if rows else [[]] * 5
            names = ("doc_id", "n_tokens", "edited_tokens", "edited_chars", "encoded_chars")
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)

    kind = "doc_id long, n_tokens long, edited_tokens long, edited_chars long, encoded_chars long"
    return docs.select(F.col("doc_id").cast("long"), "text", "edits").mapInArrow(run, kind)


def seeded_edits(docs: DataFrame, n: int = 3, seed: int = 5) -> DataFrame:
    """Adds ``edits``: ``n`` of up to 40 removed characters at a seeded place, and up to 60 put in from elsewhere in the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.char_length(text)

    def drawn(i: int, what: int, below) -> F.Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit(i), F.lit(what)), below + F.lit(1)).cast("long")

    edits = [
        F.struct(
            drawn(i, 0, size).alias("start"),
            drawn(i, 1, F.lit(40)).alias("removed"),
            F.substr(text, (drawn(i, 2, size) + 1).cast("int"), drawn(i, 3, F.lit(60)).cast("int")).alias("inserted"),
        )
        for i in range(n)
    ]
    return docs.withColumn("edits", F.array(*edits))


def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its token count, and the count after three seeded edits."""
    docs = seeded_edits(read(spark, sf_dir, "documents", "doc_id", "text"))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return edit_counts(docs, path, public_tokenizers.PATTERN)
