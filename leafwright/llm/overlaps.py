"""Exact Jaccard join of word n-gram sets by an R-tree over count vectors.

Shingles are hashed into groups, and a set is the point of its counts in the groups.  Two sets have no more in common than
the sum over the groups of the lesser of their counts, and boxes of points no more than that of their greatest counts.

The index has two levels.  At the top the groups are very many, in blocks of groups, and the sets are parted by size, in
overlapping trees.  Sets that link differ in at most ``D`` shingles, so of more than ``D`` blocks they have the same
counts in all but ``D``: a *cell* holds the points that agree in one block.  Of its blocks a set enters only the ``D + 1``
of fewest sets, blocks of its own included, which still meets every partner; so unrelated sets enter none, and a passage
that many texts share makes no cell.  In each cell an R-tree over 128 groups is joined with itself: pairs of nodes go on
while the summed minima of their boxes can reach the overlap that the threshold needs of their least sizes.  The pairs of
points that are left are verified by their exact sets.

Equal sets are one point.  In cells of many points these are compared with the cell's first before; what is joined by
that needs no further comparison with each other, so close copies cost a pair each.  Cells that are not joined so are cut
to parts that are joined pair by pair, and give a spanning forest of their links.  No result depends on that.

Results for odd input: null texts and texts without words have an empty set, linked with nothing; fewer words than a
shingle has are one shingle; texts of any length are taken whole; rows that repeat an id are each their own text, named
by the least id that their links reach; rows without an id link others, and have a null component if only such are
reached.  An empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.components import components, forest
from leafwright.llm.texts import flat, mixed, read, slices, span_hashes, words
from leafwright.session import settle

#: Groups of the trees in the cells.  A count goes up to 255; what a set has above that is a coordinate of its own.
GROUPS = 128
MOST = 255
ALL = 1 << 30


def shingle_sets(data: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the ``n``-word shingles of each text, sorted, and the offsets of the texts in them."""
    plain = data.copy()
    plain[(plain >= ord("A")) & (plain <= ord("Z"))] += 32
    starts, stops, row = words(plain, ends)
    word = span_hashes(plain, starts, stops)
    count = np.bincount(row, minlength=len(ends) - 1)
    at = np.cumsum(count) - count
    grams = np.zeros(max(len(word) - n + 1, 0), np.uint64)
    for i in range(n):
        grams = grams * np.uint64(0x9FB21C651E98DF25) + word[i : i + len(grams)]
    number = np.maximum(count - n + 1, 0)
    edge = np.append(0, np.cumsum(number))
    pick = np.arange(edge[-1]) + np.repeat(at - edge[:-1], number)
    few = np.flatnonzero((count > 0) & (count < n))
    hashes = np.concatenate([mixed(grams[pick]), mixed(span_hashes(word, at[few], at[few] + count[few]) ^ np.uint64(n))])
    owner = np.concatenate([np.repeat(np.arange(len(count)), number), few])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(ends)))


def trees(like: int, step: float = 1.6, most: int = 1 << 40) -> list[tuple[int, int, int]]:
    """Least, next tree's least and greatest size of the sets of each tree, for a likeness of ``like`` hundredths.

    A set links only with sets of up to 100 / like its size; a tree has the sets of its sizes and those partners.
    Smaller sets than the first tree's can only be equal to link: with others they differ in no shingle.
    """
    low = next(x for x in range(1, most) if budget(x + x * 100 // like, like) >= 1)
    out = []
    while low < most:
        after = max(low + 1, int(low * step))
        out.append((low, after, (after - 1) * 100 // like))
        low = after
    return out


def budget(total: np.ndarray | int, like: int) -> np.ndarray | int:
    """Shingles in which two linked sets of that total size may differ: 100 i >= like (total - i), total - 2 i left."""
    return total * (100 - like) // (100 + like)


def points(docs: DataFrame, n: int, like: int) -> DataFrame:
    """Rows for each text and tree: ``doc_id, n, one, two, main, vector, tree, slack, keys``.

    ``one`` and ``two`` are hashes of the whole set, ``main`` marks one row of each text, ``keys`` are those of its blocks,
    and ``slack`` is what the number of keys to enter is above that of its keys.
    """
    sizes = trees(like)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = flat(batch.column("text"))
            for a, b in slices(ends):
                yield part(batch.column("doc_id").slice(a, b - a), data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])

    def part(ids: pa.Array, data: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        hashes, edge = shingle_sets(data, ends, n)
        size = np.diff(edge)
        sums = [np.append(np.uint64(0), np.cumsum(mixed(hashes ^ np.uint64(c)))) for c in (0x632BE59BD9B4E019, 0xE220A8397B1DCDAF)]
        one, two = (mixed(s[edge[1:]] - s[edge[:-1]] + size.astype(np.uint64)) for s in sums)
        owner = np.repeat(np.arange(len(size)), size)
        counts = np.bincount(owner * GROUPS + (hashes & np.uint64(GROUPS - 1)).astype(np.int64), minlength=len(size) * GROUPS)
        counts = np.minimum(counts, MOST).reshape(-1, GROUPS).astype(np.uint8)
        none = np.flatnonzero(size < sizes[0][0])
        nothing = np.zeros(len(none), np.int64)
        held = [(none, nothing, nothing, np.zeros(0, np.uint64), -1)]
        for t, (low, after, top) in enumerate(sizes):
            rows = np.flatnonzero((size >= low) & (size <= top))
            if len(rows):
                held.append((rows, *keys(t, low, after, top, rows, hashes, edge, size), t))
            if low > size.max(initial=0):
                break
        row, number, slack, found, _ = (np.concatenate(c) if i < 4 else c for i, c in enumerate(zip(*held)))
        tree = np.repeat([h[4] for h in held], [len(h[0]) for h in held]).astype(np.int32)
        offsets = np.append(0, np.cumsum(number)).astype(np.int32)
        main = np.zeros(len(row), bool)
        main[np.unique(row, return_index=True)[1]] = True
        return pa.record_batch(
            {
                "doc_id": ids.take(pa.array(row)),
                "n": size[row],
                "one": one[row].view(np.int64),
                "two": two[row].view(np.int64),
                "main": main,
                "vector": pa.array([counts[i].tobytes() for i in row], pa.binary()),
                "tree": tree,
                "slack": slack.astype(np.int32),
                "keys": pa.ListArray.from_arrays(offsets, found.view(np.int64)),
            }
        )

    def keys(t: int, low: int, after: int, top: int, rows, hashes, edge, size):
        """Number of keys, slack and keys of the sets ``rows`` in a tree."""
        mine = size[rows]
        most = budget(mine + np.where(mine < after, np.minimum(mine * 100 // like, top), after - 1), like)
        greatest = int(budget(after - 1 + top, like))
        blocks = np.uint64(greatest + 1 + greatest // 8)
        pick = np.arange(mine.sum()) + np.repeat(edge[rows] - (np.cumsum(mine) - mine), mine)
        h = hashes[pick]
        owner = np.repeat(np.arange(len(rows)), mine)
        # Blocks are ranges of the hash, so a set's sorted hashes have each block together.
        block = (h >> np.uint64(32)) * blocks >> np.uint64(32)
        new = np.ones(len(h), bool)
        new[1:] = (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        held = np.add.reduceat(mixed(h ^ np.uint64(0xA0761D6478BD642F)), at)
        salt = mixed(block[at] * np.uint64(64) + np.uint64(t) + np.uint64(1))
        found, owner_of = mixed(held + salt), owner[at]
        number = np.bincount(owner_of, minlength=len(rows))
        slack = most + 1 - number
        # With no more blocks than may differ, all of these might: such sets also enter by their single shingles.
        few = np.flatnonzero(number <= most)
        if len(few):
            single = np.isin(owner, few)
            found = np.concatenate([found, mixed(h[single] + np.uint64((t + 1) * 0x8EBC6AF09C88C6E3 % (1 << 64)))])
            owner_of = np.concatenate([owner_of, owner[single]])
            order = np.argsort(owner_of, kind="stable")
            found, owner_of = found[order], owner_of[order]
            number = np.bincount(owner_of, minlength=len(rows))
            slack[few] = ALL
        return number, slack, found

    schema = "doc_id long, n long, one long, two long, main boolean, vector binary, tree int, slack int, keys array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def cells(found: DataFrame) -> DataFrame:
    """``key, id, tree`` of the sets in each cell: of the keys of a set those of fewest rows, that meet every partner."""
    dealt = found.filter("tree >= 0").select(F.col("one").alias("id"), "tree", "slack", F.explode("keys").alias("key"))
    often = dealt.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    met = dealt.join(often, "key")
    held = met.groupBy("id", "tree").agg(F.first("slack").alias("slack"), F.array_sort(F.collect_set(F.struct("rows", "key"))).alias("keys"))
    # Keys of its own come first in that order, and are not among these.
    held = held.withColumn("take", F.least(F.col("slack") + F.size("keys"), F.size("keys"))).filter("take > 0")
    return held.select("id", "tree", F.explode(F.slice("keys", 1, F.col("take"))["key"]).alias("key"))


def tree_pairs(
    vectors: np.ndarray, size: np.ndarray, label: np.ndarray, side: np.ndarray, like: int, leaf: int = 32
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of points that may link, by a join of their R-tree with itself; those of a pair of leaves at a time.

    Points are counts of ``size`` shingles in the groups, up to ``MOST`` each.  Pairs of one label (0 and above) are known
    to be joined.  If there are two sides, only pairs across them count.
    """
    if len(size) < 2:
        return
    across = side.min() != side.max()
    need = np.int64(like)
    above = size - vectors.sum(1, dtype=np.int64)
    nodes: list[tuple] = []

    def build(rows: np.ndarray) -> int:
        """Bulk loading: halves along the group, or the size, that is spread most."""
        v = vectors[rows]
        same = int(label[rows[0]]) if (label[rows] == label[rows[0]]).all() else -1
        sides = 3 if across and side[rows].min() != side[rows].max() else 1 + int(side[rows[0]])
        below = None
        if len(rows) > leaf:
            spread = v.max(0) - v.min(0)
            along = size[rows] if np.ptp(size[rows]) > spread.max() else v[:, spread.argmax()]
            order = np.argsort(along, kind="stable")
            half = len(rows) // 2
            below = (build(rows[order[:half]]), build(rows[order[half:]]))
        nodes.append((rows, v.max(0), int(above[rows].max()), int(size[rows].min()), same, sides, below))
        return len(nodes) - 1

    top = build(np.arange(len(size)))
    todo = [(top, top)]
    while todo:
        i, j = todo.pop()
        rows, high, rest, low, same, sides, below = nodes[i]
        rows2, high2, rest2, low2, same2, sides2, below2 = nodes[j]
        if (same >= 0 and same == same2) or (across and sides == sides2 and sides < 3):
            continue
        if (100 + need) * (np.minimum(high, high2).sum(dtype=np.int64) + min(rest, rest2)) < need * (low + low2):
            continue
        if below is None and below2 is None:
            a, b = vectors[rows], vectors[rows2]
            common = np.minimum(a[:, None], b[None]).sum(2, dtype=np.int64)
            common += np.minimum(above[rows][:, None], above[rows2][None])
            fits = (100 + need) * common >= need * (size[rows][:, None] + size[rows2][None])
            if across:
                fits &= side[rows][:, None] != side[rows2][None]
            fits &= (label[rows][:, None] != label[rows2][None]) | (label[rows][:, None] < 0)
            x, y = np.nonzero(np.triu(fits, 1) if i == j else fits)
            yield rows[x], rows2[y]
        elif i == j:
            todo += [(below[0], below[0]), (below[0], below[1]), (below[1], below[1])]
        elif below2 is None or (below is not None and len(rows) >= len(rows2)):
            todo += [(below[0], j), (below[1], j)]
        else:
            todo += [(i, below2[0]), (i, below2[1])]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell; they come a cell after the other, and one cell and one batch are held at a time."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        names = rows.column("cell").to_numpy()
        starts = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, np.int64)
        for a, b in zip(starts.tolist(), starts[1:].tolist()):
            yield rows.slice(a, b - a)
        rest = rows.slice(starts[-1]).combine_chunks() if len(starts) else rest
    if rest is not None:
        yield rest


def _points_of(cell: pa.Table) -> tuple[np.ndarray, ...]:
    ids, size, label, side = (cell.column(c).to_numpy() for c in ("id", "n", "label", "side"))
    # Labels are hashes; none is -1.
    label = np.where(label == -1, -1, label & np.int64((1 << 63) - 1))
    vectors = np.frombuffer(b"".join(cell.column("vector").to_pylist()), np.uint8).reshape(-1, GROUPS)
    return ids, vectors, size, label, side


def _walk(batches: Iterator[pa.RecordBatch], like: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of the cells."""
    found, held = [], 0
    for cell in _cells(batches):
        ids, *points_ = _points_of(cell)
        for x, y in tree_pairs(*points_, like):
            found.append((np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])))
            held += len(x)
        if held >= 1 << 17:
            yield _pairs(found)
            found, held = [], 0
    yield _pairs(found)


def _exact(grams: list[bytes], size: np.ndarray, like: int, most: int = 1 << 13):
    """The exact test of pairs of members, by numbers: of products of their sets where few shingles are shared."""
    sets = [np.frombuffer(g, np.uint64) for g in grams]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    if shared.sum() > most:
        return lambda x, y: np.array([linked(grams[i], grams[j], like) for i, j in zip(x.tolist(), y.tolist())], bool)
    place = np.cumsum(shared) - 1
    held = np.zeros((len(sets), int(shared.sum())), np.float32)
    met = shared[number]
    held[owner[met], place[number[met]]] = 1

    def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        common = np.concatenate([np.einsum("ij,ij->i", held[x[i : i + 256]], held[y[i : i + 256]]) for i in range(0, len(x), 256)])
        return 100 * common.astype(np.int64) >= like * (size[x] + size[y] - common.astype(np.int64))

    return alike


def _links_in(batches: Iterator[pa.RecordBatch], like: int) -> Iterator[pa.RecordBatch]:
    """Links of the tiles of large cells, verified there: a spanning forest of what each joins anew."""
    for cell in _cells(batches):
        ids, vectors, size, label, side = _points_of(cell)
        _, first, group = np.unique(label, return_index=True, return_inverse=True)
        alike = _exact(cell.column("grams").to_pylist(), size, like)
        x, y = forest(len(ids), tree_pairs(vectors, size, label, side, like), alike, first[group])
        yield pa.record_batch([pa.array(ids[x]), pa.array(ids[y])], ["a", "b"])


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """The pairs of some cells, each once."""
    a, b = (np.concatenate([np.zeros(0, np.int64), *v]) for v in ([f[i] for f in found] for i in (0, 1)))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.record_batch([pa.array(a[new]), pa.array(b[new])], ["a", "b"])


def sets_of(docs: DataFrame, rows: DataFrame, asked: DataFrame, n: int) -> DataFrame:
    """``id, grams`` of the sets ``id``: their sorted hashes as bytes, from the text of the least row that has each."""
    wanted = rows.join(asked, rows["one"] == asked["id"], "left_semi").groupBy("one").agg(F.min("doc_id").alias("_id"))
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    texts = texts.join(wanted.select("_id").distinct(), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = flat(batch.column("text"))
            for a, b in slices(ends):
                hashes, edge = shingle_sets(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], n)
                sums = np.append(np.uint64(0), np.cumsum(mixed(hashes ^ np.uint64(0x632BE59BD9B4E019))))
                one = mixed(sums[edge[1:]] - sums[edge[:-1]] + np.diff(edge).astype(np.uint64)).view(np.int64)
                grams = [hashes[i:j].tobytes() for i, j in zip(edge.tolist(), edge[1:].tolist())]
                yield pa.record_batch([pa.array(one), pa.array(grams, pa.binary())], ["id", "grams"])

    # Written, so that the joins with it deal out both sides anew and Spark can split the pairs of one set.
    return settle(texts.mapInArrow(run, "id long, grams binary").join(asked, "id", "left_semi").dropDuplicates(["id"]), "sets")


def linked(a: bytes, b: bytes, like: int) -> bool:
    """Exact test of two sets of hashes."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= like * (len(x) + len(y) - common)


def verified(pairs: DataFrame, sets: DataFrame, like: int) -> DataFrame:
    """The pairs ``a, b`` whose exact sets link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            keep = [linked(a, b, like) for a, b in zip(rows["grams_a"], rows["grams_b"])]
            yield rows.loc[keep, ["a", "b"]]

    both = pairs.join(sets.toDF("b", "grams_b"), "b").join(sets.toDF("a", "grams_a"), "a")
    return both.mapInPandas(run, "a long, b long")


def _labels(links: DataFrame) -> DataFrame:
    return settle(components(links).select(F.col("node").alias("id"), F.col("component").alias("label")), "labels")


def _parted(cells_: DataFrame, label: DataFrame) -> DataFrame:
    """``key, id, size, head, label`` of the cells whose points are not all joined."""
    named = cells_.select("key", "id", "size", "head").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    several = named.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    return settle(named.join(several.select("key"), "key").select("key", "id", "size", "head", "label"), "parted")


def _tiles(cells_: DataFrame, part: int) -> DataFrame:
    """``cell, side, id, label`` of the tiles of cells (key, id, label): pairs of parts of about ``part`` points.

    Where the cells that share points have more pairs than all their points together, as in a family of copies that
    differ in many places, these are one cell, so that each pair is met once.
    """
    joined = components(cells_.filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")))
    named = cells_.join(joined.withColumnRenamed("node", "id").withColumnRenamed("component", "family"), "id")
    named = settle(named.select("family", "key", "id", "label"), "families")
    points_ = named.select("family", "id").distinct().groupBy("family").agg((F.count("*") * F.count("*")).alias("all"))
    each = named.groupBy("family", "key").agg(F.count("*").alias("n")).groupBy("family").agg(F.sum(F.col("n") * F.col("n")).alias("apart"))
    whole = points_.join(each, "family").select("family", (F.col("all") <= F.col("apart")).alias("whole"))
    unit = F.when(F.col("whole"), F.concat(F.lit("f"), F.col("family"))).otherwise(F.concat(F.lit("k"), F.col("key")))
    units = named.join(whole, "family").select(unit.alias("unit"), "id", "label").distinct()
    units = settle(units, "units")
    parts = units.groupBy("unit").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    spread = units.join(parts, "unit").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    cell = F.concat_ws(" ", "unit", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell")
    return spread.select(cell, F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"), "id", "label")


def join(docs: DataFrame, n: int = 4, like: int = 85, small: int = 8, part: int = 512) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of (doc_id, text): links at ``like`` hundredths of Jaccard similarity."""
    found = settle(points(docs, n, like), "points")
    rows = found.filter("main").select("doc_id", "n", "one", "two")
    point = found.filter("main AND tree >= 0").select(F.col("one").alias("id"), "n", "vector").dropDuplicates(["id"])
    members = settle(cells(found), "members")
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("head")).filter("size > 1")
    inside = settle(members.join(sizes, "key").select("key", "id", "size", "head"), "cells")
    sets = sets_of(docs, rows, inside.select("id").distinct(), n)
    # Cells of many points: all with the first of them.
    many = inside.filter(F.col("size") > small)
    star = many.filter(F.col("id") > F.col("head")).select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    heads = settle(verified(star, sets, like), "star-links")
    # What is left is joined in tiles, with the sets there.
    label = _labels(heads)
    tiled = settle(_tiles(_parted(many, label), part).join(point, "id").join(sets, "id"), "tiles")
    tiled = tiled.repartition("cell").sortWithinPartitions("cell", "id").select("cell", "id", "n", "label", "side", "vector", "grams")
    heads = heads.unionByName(settle(tiled.mapInArrow(lambda b: _links_in(b, like), "a long, b long"), "tile-links"))
    # Cells of few points: candidates first, as many cells have the same ones.
    few = inside.filter(F.col("size") <= small).groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    few = settle(few.select("ids").distinct().withColumn("cell", F.monotonically_increasing_id()), "lists")
    placed = few.select("cell", F.explode("ids").alias("id")).join(point, "id").join(label, "id", "left")
    placed = placed.select("cell", "id", "n", F.coalesce("label", F.lit(-1)).alias("label"), F.lit(0).alias("side"), "vector")
    # A cell's points pass one after the other, so a task holds one cell.
    laid = placed.repartition("cell").sortWithinPartitions("cell", "id")
    pairs = settle(laid.mapInArrow(lambda b: _walk(b, like), "a long, b long").distinct(), "pairs")
    links = heads.unionByName(verified(pairs, sets, like))
    named = components(links)
    classes = rows.groupBy("one", "two").agg(F.min("doc_id").alias("first"))
    classes = classes.join(named, classes["one"] == named["node"], "left").withColumn("component", F.coalesce("component", "one"))
    least = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = classes.join(least, "component").select("one", "two", "component_id")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(classes, ["one", "two"]).select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: ``doc_id, n_shingles, component_id``; 4-word shingles, links at 85 hundredths."""
    return join(read(spark, sf_dir, "documents", "doc_id", "text"))


SQL = r"""
WITH RECURSIVE word AS MATERIALIZED (
  SELECT rid, doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word, len(w) AS n FROM (
    SELECT row_number() OVER () AS rid, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents)),
gram AS MATERIALIZED (
  SELECT DISTINCT rid, g FROM (
    SELECT rid, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w AS g
    FROM word WINDOW w AS (PARTITION BY rid ORDER BY pos)) WHERE g IS NOT NULL
  UNION ALL SELECT rid, string_agg(word, ' ' ORDER BY pos) FROM word WHERE n < 4 GROUP BY rid),
doc AS MATERIALIZED (
  SELECT d.rid, d.doc_id, coalesce(n, 0) AS n FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) d
  LEFT JOIN (SELECT rid, count(*) AS n FROM gram GROUP BY rid) USING (rid)),
met AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS i FROM gram a JOIN gram b ON a.g = b.g AND a.rid < b.rid GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT a, b FROM met JOIN doc x ON x.rid = a JOIN doc y ON y.rid = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
both_ways AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(rid, other) AS (
  SELECT rid, rid FROM doc
  UNION SELECT reach.rid, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other)
SELECT doc.doc_id, doc.n AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN doc USING (rid) JOIN doc o ON o.rid = reach.other GROUP BY doc.rid, doc.doc_id, doc.n
"""
