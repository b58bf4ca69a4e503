import random

import pytest
from pyspark.sql import functions as F

from leafwright.llm.components import components
from leafwright.llm.paragraphs import LEAST_WORDS, collisions, links, op9_paragraphs, repeats, shingle_sets, tuned_bands, without_repeats

from .conftest import ODD, SF


def split(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()


def shingles(line, least=LEAST_WORDS):
    words = split(line)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= least else None


def brute(docs, like=0.8, least=LEAST_WORDS):
    """Removed lines of each document, all pairs of lines compared."""
    places = sorted({(d, i, line) for d, t in docs if d is not None and t for i, line in enumerate(t.split("\n")) if shingles(line, least)})
    sets = [shingles(p[2], least) for p in places]
    holders, name = {}, list(range(len(places)))

    def find(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, s in enumerate(sets):
        seen = {}
        for g in s:
            for j in holders.get(g, ()):
                seen[j] = seen.get(j, 0) + 1
            holders.setdefault(g, []).append(i)
        for j, common in seen.items():
            if common >= like * (len(s) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                name[b] = a
    return {(places[i][0], places[i][1], places[find(i)][0], places[find(i)][1]) for i in range(len(places)) if find(i) != i}


def lines_gone(docs):
    """Words of each document that go with whole lines."""
    out = {}
    texts = dict(docs)
    for d, line, *_ in brute(docs):
        before = len(split("\n".join(texts[d].split("\n")[:line])))
        out.setdefault(d, set()).update(range(before, before + len(split(texts[d].split("\n")[line]))))
    return out


def covered(docs, length):
    """Words of each document that stand in a run of ``length`` words that an earlier place holds; whole texts, all runs."""
    first, out = {}, {}
    for d, text in sorted((d, t) for d, t in docs if d is not None and t):
        words = split(text)
        for i in range(len(words) - length + 1):
            run = tuple(words[i : i + length])
            at = first.setdefault(run, (d, i))
            if at[0] != d or i >= at[1] + length:
                out.setdefault(d, set()).update(range(i, i + length))
    return out


def check(docs, rows):
    """What went stood before; no long run that an earlier document holds is left; nothing else changed."""
    texts, by_line, long, short = dict(docs), lines_gone(docs), covered(docs, LEAST_WORDS), covered(docs, LEAST_WORDS // 2)
    for r in rows:
        words = split(texts[r.doc_id])
        gone = {i for x in r.removed or () for i in range(x["start"], x["start"] + x["length"])}
        assert split(r.text) == [w for i, w in enumerate(words) if i not in gone]
        assert gone or r.text == texts[r.doc_id]
        assert by_line.get(r.doc_id, set()) <= gone
        # A word of a span was found by a paragraph, or by growing over what its first place has too.
        assert gone - by_line.get(r.doc_id, set()) <= short.get(r.doc_id, set())
        # Where another place than the first has more of a passage, its ends may stay: less than a paragraph.
        assert all(gone & set(range(i - 23, i + 24)) for i in long.get(r.doc_id, set()) - gone)


def test_query(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert {tuple(r) for r in repeats(documents).collect()} == brute(docs)
    rows = op9_paragraphs(spark, SF).collect()
    assert len(rows) == len(docs)
    check(docs, rows)
    assert all(r.n_removed == len(r.removed or ()) for r in rows)


def test_passages_in_any_place(spark):
    """Spliced, wrapped anew, in other letters, at the ends of texts; short stock lines and clean documents stay."""
    rng = random.Random(7)
    own = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [own(n) for n in (46, 51, 60, 75, 120)]
    stock = [" ".join(own(17)) for _ in range(3)]
    docs, caught = [], {}
    for i in range(200):
        parts = [" ".join(own(rng.randint(0, 80))) for _ in range(3)] + [rng.choice(stock)]
        rng.shuffle(parts)
        if i % 3:
            passage = passages[i % 5]
            at = rng.randrange(len(passage))
            wrapped = [" ".join(passage[:at]) + rng.choice(["\n", " ", "\n\n", "\t"]) + " ".join(passage[at:]), " ".join(passage).upper()]
            k = rng.randrange(len(parts) + 1)
            parts[k:k] = [rng.choice(wrapped)]
            caught[i] = passage
        docs.append((i, rng.choice([" ", "\n"]).join(parts)))
    rows = without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(docs, rows)
    first = {}
    for i, p in caught.items():
        first.setdefault(tuple(p), i)
    for r in rows:
        later = r.doc_id in caught and first[tuple(caught[r.doc_id])] != r.doc_id
        assert (r.removed is not None) == later
        if later:
            # A stock line beside the passage in both places is one run with it.
            assert len(r.removed) == 1 and len(caught[r.doc_id]) <= r.removed[0]["length"] <= len(caught[r.doc_id]) + 3 * 17


def test_runs_in_one_document(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(1, f"{passage} a b c {passage}\nd"), (2, "again and " * 200), (3, "x " + passage[:-3].replace("p30", "p30\n") + " y")]
    rows = {r.doc_id: r for r in without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[1].text == f"{passage} a b c \nd"
    assert split(rows[2].text) == split("again and " * 200)[: len(split(rows[2].text))] and len(split(rows[2].text)) <= 50
    assert split(rows[3].text) == [b"x", b"y"]


def test_family_of_near_copies(spark):
    """Chains of edits: members unlike the first of their band are still linked through others."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(1000)}" for _ in range(40)]
    docs = []
    for i in range(120):
        line = list(base)
        for _ in range(rng.randrange(3)):
            line[rng.randrange(40)] = f"x{rng.randrange(50)}"
        docs.append((i, " ".join(line) + f"\nshort line\nown {i} " + " ".join(str(rng.random()) for _ in range(9))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(r) for r in repeats(df, least=8).collect()} == brute(docs, least=8)


@pytest.mark.parametrize("block", [3, 2000])
def test_blocks_lose_nothing(spark, block):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(30)]
    lines = []
    for i in range(60):
        line = list(base)
        line[rng.randrange(30)] = line[rng.randrange(30)] = f"x{i}"
        lines.append((i, " ".join(line)))
    df = spark.createDataFrame(lines, "doc_id long, text string")
    # One band for all: every pair has to be joined, by whatever links.
    first = F.struct("doc_id", F.lit(0).alias("line")).alias("first")
    met = collisions(df.select(first, F.array(F.lit(1).cast("long")).alias("bands")))
    sets = shingle_sets(df, met.select("first.*"), 5, 8)
    found = components(links(met, sets, 0.8, block))
    got = {r.node.doc_id: r.component.doc_id for r in found.collect()}
    want = {d: kept for d, _, kept, _ in brute(lines, least=8)}
    assert {d: k for d, k in got.items() if d != k} == want


def test_odd_rows(spark, odd, none):
    assert without_repeats(none).count() == 0
    # Of the long text of one word all but the first paragraph repeats what stood before.
    out = {(r.doc_id, r.text) for r in without_repeats(odd, mark=None).collect() if r.doc_id != 7}
    assert out == {(r.doc_id, r.text) for r in odd.collect() if r.doc_id != 7}
    assert without_repeats(odd, mark=None).columns == odd.columns
    line = " ".join(f"a{i}" for i in range(50))
    other = " ".join(f"b{i}" for i in range(50))
    rows = [(1, line + "\n" + line.upper()), (2, None), (3, line), (None, line), (4, ""), (3, line), (5, other), (5, "x " + other), (6, other)]
    df = spark.createDataFrame([(*r, "x", "y", [1], 3) for r in rows], "doc_id long, text string, removed string, row string, gone array<int>, `a.b` int")
    out = without_repeats(df, mark=None)
    assert out.columns == df.columns and {(r.removed, r.row, r["a.b"]) for r in out.collect()} == {("x", "y", 3)}
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [(1, line + "\n"), (2, None), (3, ""), (3, ""), (None, line), (4, ""), (5, other), (5, "x " + other), (6, "")]
    assert got == sorted(want, key=str)
    assert without_repeats(df).columns == ["doc_id", "text", "row", "gone", "a.b", "removed"]


def test_bands():
    b = tuned_bands(0.8, 0.998, 3)
    assert 1 - (1 - 0.8**3) ** b >= 0.998 > 1 - (1 - 0.8**3) ** (b - 1)
    assert len(ODD) == 9
