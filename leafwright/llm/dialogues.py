"""Conversation repair: the cheapest edits that make the roles of a conversation take turns.

A conversation is its rows by turn (nulls first, then role and text).  The first fault of a row counts: *blank* (no
sign but white space), *duplicate* (its role and text stand in an earlier row), *truncated* (its last sign but white
space ends no sentence).  Edits go from left to right: keep a row (0), give it the role user or assistant (2), delete
it (3; blank and duplicate rows must go), or insert an empty user or assistant row (2).  Truncated rows that stay add 1.
The roles' initials must then read ``(s?(ua)+)?``.  Of the cheapest edits those of the least initials (D, I, K, R) count.

The search is iterative-deepening A*: depth first in the order of the initials under a cost bound that rises by 1 from
the estimate of the start, with a table of the states that failed and the budget they failed with.  So the first path
that accepts is the answer.  The estimate never exceeds the true cost: rows that must go, truncated rows, and 2 for
each of the most row-disjoint neighbours that cannot stand side by side.

Conversations of up to ``length`` rows are one task's row.  Longer ones are cut to parts of that many rows; each part is
searched for every state before and after it, and a conversation chains the parts' best edits.  As equal costs between
two states never have initials of which one begins the other, that gives the same answer, and no task holds the texts
of more than one part.

Results for odd input: null role and text read as one space, null turns come first and count in no gap, rows without a
conversation id are one conversation, repeated rows are duplicates, other columns are left out.  An empty table gives an
empty result; texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm.texts import read
from leafwright.operators.groups import split_in_order
from leafwright.session import settle

OK, BLANK, DUPLICATE, TRUNCATED = range(4)
# States of the role pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# The role that an insert or a new role has in each state, and the state after it.
FILL = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
WHOLE = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
_SIGN = re.compile(r"[^\x20\x09-\x0D]")


def faults(lines: list[tuple[str, str]], seen: set | None = None) -> list[int]:
    """The first fault of each (role, text); ``seen`` holds those of earlier parts."""
    seen = set() if seen is None else seen
    out = []
    for line in lines:
        signs = line[1].rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        if not signs:
            out.append(BLANK)
        elif line in seen:
            out.append(DUPLICATE)
        else:
            out.append(OK if signs[-1] in ".!?" else TRUNCATED)
        seen.add(line)
    return out


def estimates(initials: str, kinds: list[int], accept: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """For each place and state a cost that no way to an accepting end goes below."""
    n = len(kinds)
    # Matching of the path of rows from a place to the end: `one` starts at the next row that can stay, `two` after it.
    one = two = base = 0
    after: str | None = None
    end = [0 if q in accept else 1 for q in range(4)]
    out = [(0, 0, 0, 0)] * (n + 1)
    out[n] = tuple(2 * e for e in end)
    # A row's own state, if it stands; rows of other roles stand nowhere.
    own = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
    for i in range(n - 1, -1, -1):
        kind = kinds[i]
        if kind in (BLANK, DUPLICATE):
            base += 3
        else:
            base += kind == TRUNCATED
            c = initials[i]
            state = own.get(c)
            if after is None:
                clash = end[state] if state is not None else 1
            else:
                clash = state is None or (state, after) not in STEP
            one, two = max(one, int(clash) + two), one
            after = c
        if after is None:
            out[i] = tuple(base + 2 * e for e in end)
        else:
            out[i] = tuple(base + 2 * max(one, int((q, after) not in STEP) + two) for q in range(4))
    return out


def cheapest(initials: str, kinds: list[int], start: int = START, accept: tuple[int, ...] = WHOLE) -> tuple[int, str] | None:
    """Cost and initials of the least cheapest edits from ``start`` to a state of ``accept``; None if there are none."""
    n = len(kinds)
    estimate = estimates(initials, kinds, accept)
    failed = [-1] * (4 * (n + 1))
    for bound in range(estimate[0][start], 3 * n + 5):
        place, state, spent, move = 0, start, 0, 0
        stack: list[tuple[int, int, int, int]] = []
        edits: list[str] = []
        while True:
            if move == 0 and place == n and state in accept:
                return spent, "".join(edits)
            left = bound - spent
            forced = place < n and kinds[place] in (BLANK, DUPLICATE)
            found = None
            while move < 4:
                if move == 0 and place < n:
                    to, cost = (place + 1, state), 3
                elif move == 1:
                    to, cost = (place, FILL[state][1]), 2
                elif move == 2 and place < n and not forced and (state, initials[place]) in STEP:
                    to, cost = (place + 1, STEP[state, initials[place]]), int(kinds[place] == TRUNCATED)
                elif move == 3 and place < n and not forced:
                    to, cost = (place + 1, FILL[state][1]), 2 + (kinds[place] == TRUNCATED)
                else:
                    move += 1
                    continue
                move += 1
                rest = left - cost
                if estimate[to[0]][to[1]] <= rest and failed[4 * to[0] + to[1]] < rest:
                    found = to
                    break
            if found:
                stack.append((place, state, spent, move))
                edits.append("DIKR"[move - 1])
                (place, state), spent, move = found, spent + cost, 0
                continue
            failed[4 * place + state] = max(failed[4 * place + state], left)
            if not stack:
                break
            place, state, spent, move = stack.pop()
            edits.pop()
    return None


def ways(initials: str, kinds: list[int]) -> list[dict]:
    """The least cheapest edits of a part for each state before and after it."""
    out = []
    for start in range(4):
        for end in range(4):
            # Nothing that is written leads back to the start, and only a system row leads to the state after it.
            if end <= SYSTEM and (start > end or (end == SYSTEM and start == START and "s" not in initials)):
                continue
            if (best := cheapest(initials, kinds, start, (end,))) is not None:
                out.append({"start": start, "end": end, "cost": best[0], "audit": best[1]})
    return out


def apply(lines: list[tuple[str, str]], audit: str, state: int = START) -> list[tuple[str, str]]:
    """The (role, text) rows that the edits leave."""
    out, at = [], 0
    for edit in audit:
        if edit == "I":
            out.append((FILL[state][0], ""))
            state = FILL[state][1]
            continue
        role, text = lines[at]
        at += 1
        if edit == "K":
            out.append((role, text))
            state = STEP[state, role[:1]]
        elif edit == "R":
            out.append((FILL[state][0], text))
            state = FILL[state][1]
    return out


def _initials(lines: list[tuple[str, str]]) -> str:
    return "".join(role[:1] or "-" for role, _ in lines)


_LINES = "array<struct<role:string,text:string>>"
_COUNTS = "n_rows long, blank long, duplicate long, truncated long, illegal long, first string, last string"
_PART = f"conv string, part long, whole boolean, {_COUNTS}, lines {_LINES}, cost long, audit string, ways array<struct<start:int,end:int,cost:long,audit:string>>"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pair = pa.struct([("role", pa.string()), ("text", pa.string())])
    way = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    schema = pa.schema(
        [("conv", pa.string()), ("part", pa.int64()), ("whole", pa.bool_())]
        + [(c, pa.int64()) for c in ("n_rows", "blank", "duplicate", "truncated", "illegal")]
        + [("first", pa.string()), ("last", pa.string()), ("lines", pa.list_(pair))]
        + [("cost", pa.int64()), ("audit", pa.string()), ("ways", pa.list_(way))]
    )
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            out = []
            for row in batch.slice(i, 256).to_pylist():
                lines = [(x["role"], x["text"]) for x in row["rows"]]
                kinds = faults(lines, {(x["role"], x["text"]) for x in row["seen"] or ()})
                initials = _initials(lines)
                best = cheapest(initials, kinds) if row["whole"] else None
                out.append(
                    {
                        "conv": row["conv"],
                        "part": row["part"],
                        "whole": row["whole"],
                        "n_rows": len(lines),
                        "blank": kinds.count(BLANK),
                        "duplicate": kinds.count(DUPLICATE),
                        "truncated": kinds.count(TRUNCATED),
                        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
                        "first": initials[:1],
                        "last": initials[-1:],
                        "lines": [dict(zip(("role", "text"), x)) for x in (apply(lines, best[1]) if best else lines)],
                        "cost": best[0] if best else None,
                        "audit": best[1] if best else None,
                        "ways": None if best else ways(initials, kinds),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema)


def chain(parts: list[list[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost, and each part's state before it and edits, of the least cheapest edits of parts in their order."""
    best: dict[int, tuple[int, str, list]] = {START: (0, "", [])}
    for part in parts:
        after: dict[int, tuple[int, str, list]] = {}
        for way in part:
            if way["start"] not in best:
                continue
            cost, audit, held = best[way["start"]]
            new = (cost + way["cost"], audit + way["audit"], [*held, (way["start"], way["audit"])])
            if way["end"] not in after or new[:2] < after[way["end"]][:2]:
                after[way["end"]] = new
        best = after
    # Empty rows after the last part belong to its edits: a part has them already for each state after it.
    cost, _, held = min((best[q] for q in WHOLE if q in best), key=lambda x: x[:2])
    return cost, held


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("part", pa.int64()), ("start", pa.int32()), ("edits", pa.string())]))
    schema = pa.schema([("conv", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("steps", kind)])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            parts = row["parts"]
            edges = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
            cost, held = chain([p["ways"] for p in parts])
            steps = [{"part": p["part"], "start": start, "edits": edits} for p, (start, edits) in zip(parts, held)]
            audit = "".join(edits for _, edits in held)
            out.append({"conv": row["conv"], "illegal": edges, "cost": cost, "audit": audit, "steps": steps})
        yield pa.RecordBatch.from_pylist(out, schema)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pair = pa.struct([("role", pa.string()), ("text", pa.string())])
    schema = pa.schema([("conv", pa.string()), ("part", pa.int64()), ("lines", pa.list_(pair))])
    for batch in batches:
        for row in batch.to_pylist():
            lines = apply([(x["role"], x["text"]) for x in row["lines"]], row["edits"], row["start"])
            held = [dict(zip(("role", "text"), x)) for x in lines]
            yield pa.RecordBatch.from_pylist([{"conv": row["conv"], "part": row["part"], "lines": held}], schema)


def named(conv_id: Column) -> Column:
    """A name of a conversation that is never null."""
    return F.coalesce(F.concat(F.lit(":"), conv_id.cast("string")), F.lit(""))


def repair(rows: DataFrame, length: int = 512) -> tuple[DataFrame, DataFrame]:
    """Repairs of (conv_id, turn, role, text): a row per conversation, and the repaired texts.

    The first has ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``, the second ``conv, part, lines``: the
    repaired (role, text) rows in order, those of a long conversation in parts.  ``conv`` is ``named(conv_id)``.
    """
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(named(F.col("conv_id")).alias("conv"), F.col("turn").cast("long"), one("role"), one("text"))
    order = ["turn", "role", "text"]
    long = rows.groupBy("conv").agg(F.count("*").alias("n")).filter(F.col("n") > length).select("conv")
    long = settle(long, "long-conversations")
    line = F.struct(*order)
    short = rows.join(long, "conv", "left_anti").groupBy("conv").agg(F.array_sort(F.collect_list(line)).alias("rows"))
    nothing = F.lit(None).cast("array<struct<role:string,text:string>>")
    short = short.select("conv", F.lit(0).cast("long").alias("part"), F.lit(True).alias("whole"), "rows", nothing.alias("seen"))
    # Parts of long conversations, with the lines of earlier parts that they hold too.
    cut = settle(split_in_order(rows.join(long, "conv", "left_semi"), ["conv"], order, length), "long-parts")
    again = cut.groupBy("conv", "role", "text").agg(F.min("part").alias("from"), F.max("part").alias("to")).filter(F.col("from") < F.col("to"))
    late = cut.join(again, ["conv", "role", "text"]).filter(F.col("part") > F.col("from"))
    late = late.groupBy("conv", "part").agg(F.collect_set(F.struct("role", "text")).alias("seen"))
    parts = cut.groupBy("conv", "part").agg(F.array_sort(F.collect_list(line)).alias("rows")).join(late, ["conv", "part"], "left")
    every = short.unionByName(parts.select("conv", "part", F.lit(False).alias("whole"), "rows", "seen"))
    found = settle(every.mapInArrow(_search, _PART), "repairs")
    # Conversations of several parts are chained; only counts and edits meet there, no texts.
    several = found.filter("NOT whole")
    held = F.array_sort(F.collect_list(F.struct("part", "first", "last", "ways"))).alias("parts")
    joined = several.groupBy("conv").agg(held).mapInArrow(
        _chained, "conv string, illegal long, cost long, audit string, steps array<struct<part:long,start:int,edits:string>>"
    )
    joined = settle(joined, "chains")
    steps = joined.select("conv", F.explode("steps").alias("s")).select("conv", "s.*")
    mended = several.select("conv", "part", "lines").join(steps, ["conv", "part"]).mapInArrow(_applied, f"conv string, part long, lines {_LINES}")
    texts = found.filter("whole").select("conv", "part", "lines").unionByName(mended)
    counts = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    chained = joined.select("conv", "illegal", "cost", "audit")
    whole = found.filter("whole").select("conv", "illegal", "cost", "audit").withColumn("illegal", F.lit(0).cast("long"))
    sums = found.groupBy("conv").agg(*counts).join(
        whole.unionByName(chained).withColumnRenamed("illegal", "edges"), "conv"
    )
    # Distinct turns are counted in two steps, so a long conversation has no task of its own.
    turns = rows.filter("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    turns = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    result = sums.join(turns, "conv", "left").select(
        "conv", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        (F.col("illegal") + F.col("edges")).alias("illegal"), "cost", "audit",
    )
    return result, texts


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) damaged by a hash of conversation and turn."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), fate.alias("fate")).filter("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.expr("array_repeat(0, IF(fate = 3, 2, 1))")))
    return rows.drop("col")


def digests(texts: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of repaired texts: the lines ``role:text`` of all parts in order, joined by newlines."""
    line = F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    texts = texts.select("conv", "part", F.size("lines").alias("n"), F.array_join(line, "\n").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, empty = None, None, True
        for batch in batches:
            names, sums = [], []
            for name, n, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "n", "text"))):
                if name != conv:
                    if conv is not None:
                        names.append(conv)
                        sums.append(digest.hexdigest())
                    conv, digest, empty = name, hashlib.sha256(), True
                if n:
                    digest.update(text.encode() if empty else b"\n" + text.encode())
                    empty = False
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(sums, pa.string())], ["conv", "repaired_sha256"])
        if conv is not None:
            yield pa.record_batch([pa.array([conv]), pa.array([digest.hexdigest()])], ["conv", "repaired_sha256"])

    # A digest is a chain over the text, so the parts of one conversation pass one after the other.
    laid = texts.repartition("conv").sortWithinPartitions("conv", "part")
    return laid.mapInArrow(run, "conv string, repaired_sha256 string")


def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired: gaps, faults, cost, edits, and the digest of its repaired text."""
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    found, texts = repair(damaged(rows))
    every = rows.select("conv_id").distinct().withColumn("conv", named(F.col("conv_id")))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = hashlib.sha256(b"").hexdigest()
    out = every.join(found, "conv", "left").join(digests(texts), "conv", "left")
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
