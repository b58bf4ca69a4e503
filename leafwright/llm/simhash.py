"""SimHash near-duplicates: a binary trie of fingerprints joined with itself under a Hamming budget.

A fingerprint is one bit per bit of the hashes of a text's word shingles.  Two fingerprints that differ in at most
``budget`` bits agree on at least ``blocks - budget`` of ``blocks`` blocks of bits.  For each choice of that many
blocks the bits are turned so that these come first: that is a trie whose walk of node pairs is pruned to equal nodes
down to the depth of the blocks, so Spark can deal the subtrees out by their value.  More blocks mean more tries with
smaller subtrees.  Subtrees with many fingerprints go on by node pairs of further bits,
again only pairs within the budget, until a task's part is small.  There the walk goes on pair by pair of nodes.

Equal fingerprints are one trie leaf, so thousands of copies cost one.  Null and empty texts have the fingerprint zero
and link like any other.  Rows without an id take no part in naming a component, but get one.  Rows that repeat an id or a text
each get a row.  Texts of any length are taken whole, other columns left out, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.components import components, forest
from leafwright.llm.texts import flat, packed, read
from leafwright.session import settle

BITS = 64
SEED = 42


def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """XXH64 of all ``n``-word shingles of ``text`` in small letters; of all its words if these are fewer."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= n:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    stops = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *stops[: len(parts) - n].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (stops[n - 1 :] - 1).tolist())], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        held = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(held, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, n: int) -> int:
    """Majority bits of the hashes of all ``n``-word shingles of ``text``."""
    return majority(shingle_hashes(text, n))


def fingerprints(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, fp`` of each row of (doc_id, text); ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = flat(batch.column("text"))
            held = data.tobytes()
            at = ends.tolist()
            fps = np.array([fingerprint(held[a:b], n) for a, b in zip(at, at[1:])], np.uint64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(fps.view(np.int64))})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def walk(
    left: np.ndarray, right: np.ndarray | None, budget: int, leaf: int = 64
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct 64-bit values within ``budget`` differing bits.

    Walks two binary tries together (one with itself if ``right`` is None).  A node is a range of sorted values with
    a common prefix.  A pair of nodes goes on to the pairs of their children with the bits that differ so far, and
    ends when these exceed the budget; the bits below a pair's next branching are skipped at once.
    """
    same = right is None
    right = left if same else right
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if (b - a) * (d - c) <= leaf * leaf or min(b - a, d - c) == 1:
            x, y = np.nonzero(_differing(left[a:b, None], right[None, c:d]) <= budget)
            x, y = x + a, y + c
            yield (x[x < y], y[x < y]) if same else (x, y)
            continue
        # Bits above the highest that varies inside either node are the nodes' prefixes.
        inside = int((left[a] ^ left[b - 1]) | (right[c] ^ right[d - 1]))
        depth = inside.bit_length()
        if ((int(left[a]) ^ int(right[c])) >> depth).bit_count() > budget:
            continue
        bit = np.uint64(depth - 1)
        m = a + int(np.searchsorted(left[a:b] >> bit & np.uint64(1), 1))
        k = c + int(np.searchsorted(right[c:d] >> bit & np.uint64(1), 1))
        if same and (a, b) == (c, d):
            todo += [(a, m, a, m), (m, b, m, b), (a, m, m, b)]
        else:
            todo += [(a, m, c, k), (m, b, k, d), (a, m, k, d), (m, b, c, k)]


def deal(distinct: DataFrame, budget: int, blocks: int, level: int) -> DataFrame:
    """``turn, node, width, bits, fp``: each fingerprint under every choice of ``blocks - budget`` blocks of bits.

    ``bits`` is the fingerprint with the chosen blocks first, ``node`` its first ``width`` bits: at most ``level``,
    and none beyond the chosen blocks.
    """
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    spans = list(zip(edges, edges[1:]))
    choices = list(combinations(range(blocks), blocks - budget))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            parts = [fp << np.uint64(a) >> np.uint64(BITS - b + a) for a, b in spans]
            for turn, chosen in enumerate(choices):
                bits = np.zeros(len(fp), np.uint64)
                for i in [*chosen, *(i for i in range(blocks) if i not in chosen)]:
                    a, b = spans[i]
                    bits = bits << np.uint64(b - a) | parts[i]
                width = min(level, sum(spans[i][1] - spans[i][0] for i in chosen))
                node = bits >> np.uint64(BITS - width) if width else np.zeros(len(fp), np.uint64)
                yield pa.record_batch(
                    {
                        "turn": np.full(len(fp), turn, np.int32),
                        "node": node.view(np.int64),
                        "width": np.full(len(fp), width, np.int32),
                        "bits": bits.view(np.int64),
                        "fp": fp.view(np.int64),
                    }
                )

    return distinct.select("fp").mapInArrow(run, "turn int, node long, width int, bits long, fp long")


def links(distinct: DataFrame, budget: int = 2, blocks: int | None = None, part: int = 1024) -> DataFrame:
    """Links ``fp_a, fp_b`` that join all distinct fingerprints ``fp`` within ``budget`` differing bits.

    ``blocks - budget`` blocks agree in every such pair.  Tries are dealt out at the depth where a node of evenly spread
    fingerprints has about ``part`` of them, at most at the depth of the chosen blocks.  Of the pairs within a part only
    a spanning forest leaves it, so links never grow with the square of a group.
    """
    blocks = blocks or budget + 1
    dealt = deal(distinct, budget, blocks, max(0, (distinct.count() // part).bit_length()))
    # Large subtrees: as many further bits as bring a node near the size of a part.
    large = dealt.groupBy("turn", "node").agg(F.count("*").alias("_n")).filter(F.col("_n") > 4 * part)
    depth = F.least(F.ceil(F.log2(F.col("_n") / part)).cast("int"), F.lit(12))
    large = large.select("turn", "node", depth.alias("depth"))
    dealt = dealt.join(large, ["turn", "node"], "left").fillna({"depth": 0})
    # The child at that depth, and all children within the budget of it: a pair of nodes is named by the lesser first.
    child = F.expr("CASE WHEN depth = 0 THEN 0L ELSE shiftrightunsigned(shiftleft(bits, width), 64 - depth) END")
    flips = F.expr(
        "CASE WHEN depth = 0 THEN array(0L) ELSE array_distinct(flatten(transform(sequence(0, depth), i -> "
        "transform(sequence(0, depth), j -> (CASE WHEN i = depth THEN 0L ELSE shiftleft(1L, i) END) | "
        "(CASE WHEN j = depth THEN 0L ELSE shiftleft(1L, j) END))))) END"
    )
    if budget != 2:
        flips = F.expr(
            "CASE WHEN depth = 0 THEN array(0L) ELSE "
            f"filter(sequence(0L, shiftleft(1L, depth) - 1), x -> bit_count(x) <= {int(budget)}) END"
        )
    dealt = dealt.withColumn("child", child).withColumn("flip", F.explode(flips))
    other = F.expr("child ^ flip")
    dealt = dealt.select(
        "turn", "node", F.least("child", other).alias("one"), F.greatest("child", other).alias("two"), "child", "bits", "fp"
    )

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, _, one, two = key
        fps, bits = (rows[c].to_numpy().view(np.uint64) for c in ("fp", "bits"))
        order = np.argsort(bits)
        bits, fps, child = bits[order], fps[order], rows["child"].to_numpy()[order]
        if one == two:
            a, b = forest(len(bits), walk(bits, None, budget))
        else:
            # Values of the lesser node sort first.
            cut = int((child == one).sum())
            a, b = forest(len(bits), ((x, y + cut) for x, y in walk(bits[:cut], bits[cut:], budget)))
        return pd.DataFrame({"fp_a": fps[a].view(np.int64), "fp_b": fps[b].view(np.int64)})

    return dealt.groupBy("turn", "node", "one", "two").applyInPandas(run, "fp_a long, fp_b long")


def near_classes(docs: DataFrame, n: int = 3, budget: int = 2, blocks: int | None = None) -> DataFrame:
    """``doc_id, fp, component_id`` of each row of (doc_id, text).

    ``component_id`` is the smallest id that can be reached over links, a row's own included.
    """
    rows = settle(fingerprints(docs, n), "simhash")
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    pairs = links(classes.select("fp"), budget, blocks)
    names = classes.select(F.col("fp").alias("fp_a"), F.col("first").alias("a"))
    pairs = pairs.join(names, "fp_a").join(names.toDF("fp_b", "b"), "fp_b").select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    found = components(pairs)
    named = classes.join(found, classes["first"] == found["node"], "left").select(
        "fp", F.coalesce("component", "first").alias("component_id")
    )
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, n: int = 3, budget: int = 2) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row of the smallest id stays.

    Null and empty texts are one group, as they have one fingerprint.  Of rows that repeat the id that stays, the one of
    the least row counts, by text first.  Rows without an id stay.  All columns stay as they are, whatever their names.
    """
    held = docs.select(F.col("doc_id").cast("long").alias("id"), packed(docs).alias("row"))
    found = near_classes(docs.filter("doc_id IS NOT NULL").select("doc_id", "text"), n, budget)
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("id")).distinct()
    rest = held.join(gone, "id", "left_anti")
    again = found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("id"))
    # Repeats of an id are few; one row of each is picked, all other rows are not touched.
    first = F.struct(F.col("row.text").alias("text"), F.to_json("row").alias("rest"))
    single = rest.join(again, "id", "left_semi").groupBy("id").agg(F.min_by("row", first).alias("row"))
    return rest.join(again, "id", "left_anti").select("row.*").unionByName(single.select("row.*"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: ``doc_id, fingerprint, component_id``; 3-word shingles, links at 2 differing bits."""
    found = near_classes(read(spark, sf_dir, "documents", "doc_id", "text"), n=3, budget=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
