import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from leafwright.llm import dialogues
from tests.llm.conftest import SF

PATTERN = re.compile(r"(s?(ua)+)?")


def plain_faults(lines):
    out = []
    for i, (role, text) in enumerate(lines):
        signs = re.findall(r"[^\x20\x09-\x0D]", text)
        if not signs:
            out.append("blank")
        elif (role, text) in lines[:i]:
            out.append("duplicate")
        else:
            out.append("" if signs[-1] in ".!?" else "truncated")
    return out


def brute(lines):
    """Uniform-cost search over (cost, initials): the first end that fits the pattern is the answer."""
    kinds = plain_faults(lines)
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(lines) and PATTERN.fullmatch(roles):
            return cost, audit, list(out)
        state = (at, "s" if roles == "s" else roles[-1:])
        if state in done:
            continue
        done.add(state)
        steps = [("I", 2, at, role, "") for role in ("user", "assistant")]
        if at < len(lines):
            role, text = lines[at]
            steps.append(("D", 3, at + 1, None, ""))
            if kinds[at] not in ("blank", "duplicate"):
                more = kinds[at] == "truncated"
                steps.append(("K", more, at + 1, role, text))
                steps += [("R", 2 + more, at + 1, r, text) for r in ("user", "assistant")]
        for edit, price, to, role, text in steps:
            now = roles if role is None else roles + (role[:1] or "-")
            if now and not any(PATTERN.fullmatch(now + rest) for rest in ("", "a", "ua")):
                continue
            heapq.heappush(heap, (cost + price, audit + edit, to, now, out if role is None else (*out, (role, text))))
    raise AssertionError


def talk(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", ""]
    texts = ["Yes.", "No!", "Cut off", "", " \n", "Yes. ", "Why?", "a b"]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"Text {i}.") for i in range(n)]


@pytest.mark.parametrize("seed", range(150))
def test_search_is_least_and_cheapest(seed):
    rng = random.Random(seed)
    lines = talk(rng, rng.randint(0, 14))
    kinds = dialogues.faults(lines)
    cost, audit = dialogues.cheapest(dialogues._initials(lines), kinds)
    assert (cost, audit, dialogues.apply(lines, audit)) == brute(lines)


@pytest.mark.parametrize("seed", range(60))
def test_chained_parts_equal_the_whole(seed):
    rng = random.Random(1000 + seed)
    lines = talk(rng, rng.randint(2, 16))
    kinds, initials = dialogues.faults(lines), dialogues._initials(lines)
    size = rng.randint(1, 5)
    parts = [dialogues.ways(initials[i : i + size], kinds[i : i + size]) for i in range(0, len(lines), size)]
    cost, held = dialogues.chain(parts)
    assert (cost, "".join(e for _, e in held)) == dialogues.cheapest(initials, kinds)


def test_estimates_never_exceed_the_cost():
    for seed in range(200):
        rng = random.Random(seed)
        lines = talk(rng, rng.randint(0, 10))
        kinds, initials = dialogues.faults(lines), dialogues._initials(lines)
        for q in range(4):
            found = dialogues.cheapest(initials, kinds, q)
            assert dialogues.estimates(initials, kinds, dialogues.WHOLE)[0][q] <= found[0]


def test_a_long_talk_is_searched_in_time():
    rng = random.Random(5)
    lines = talk(rng, 5000)
    cost, audit = dialogues.cheapest(dialogues._initials(lines), dialogues.faults(lines))
    assert PATTERN.fullmatch("".join(r[:1] for r, _ in dialogues.apply(lines, audit)))


def expected(rows):
    """The contract read plainly, in Python."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        held = talks[conv]
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(name.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        held += [((turn is not None, turn or 0), "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv, held in talks.items():
        held.sort()
        lines = [x[1:] for x in held]
        kinds = plain_faults(lines)
        turns = {x[0][1] for x in held if x[0][0]}
        initials = [r[:1] or "-" for r, _ in lines]
        cost, audit, left = brute(lines)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def result(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_query_equals_the_plain_reading(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(dialogues.op12_dialogue_repair(spark, SF)) == expected(rows)


def query(spark, path, rows, length=None, monkeypatch=None):
    schema = "conv_id long, turn long, role string, text string, part long, lines string, audit string"
    spark.createDataFrame([(*r, 7, "x", "y") for r in rows], schema).write.parquet(f"{path}/conversations.parquet")
    if length:
        plain = dialogues.repair
        monkeypatch.setattr(dialogues, "repair", lambda df: plain(df, length))
    return result(dialogues.op12_dialogue_repair(spark, str(path)))


def odd_rows():
    rng = random.Random(3)
    rows = [(1, None, None, None), (2, 0, "user", "Hi."), (2, 0, "user", "Hi."), (None, 1, "system", "S."), (None, None, "user", "A.")]
    rows += [(3, 5, "assistant", ""), (4, 9, "", "x" * 100_000 + "."), (5, None, "user", None)]
    for conv in range(10, 40):
        rows += [(conv, rng.choice([None, *range(12)]), r, t) for r, t in talk(rng, rng.randint(1, 12))]
    return rows


def test_odd_rows(spark, tmp_path):
    rows = odd_rows()
    assert query(spark, tmp_path, rows) == expected(rows)


def test_long_conversations_in_parts(spark, tmp_path, monkeypatch):
    rows = odd_rows()
    assert query(spark, tmp_path, rows, 3, monkeypatch) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, []) == {}
