import random

import public_tokenizers
import pytest
import tiktoken

from leafwright.llm.edits import PieceTree, edit_counts, op6_edit_counts, seeded_edits
from leafwright.llm.tokens import PieceCounts, once

from .conftest import ODD, SF

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def whole():
    import base64

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def edited(text, edits):
    text = text or ""
    for start, removed, inserted in edits:
        start = min(max(start, 0), len(text))
        text = text[:start] + inserted + text[start + max(removed, 0) :]
    return text


def test_query(spark, documents, whole):
    rows = {r.doc_id: r for r in op6_edit_counts(spark, SF).collect()}
    for r in seeded_edits(documents).collect():
        text = edited(r.text, r.edits)
        got = rows[r.doc_id]
        assert got.n_tokens == len(whole.encode_ordinary(r.text))
        assert (got.edited_tokens, got.edited_chars) == (len(whole.encode_ordinary(text)), len(text))
        assert got.encoded_chars < 1500


@pytest.mark.parametrize("seed", range(60))
def test_edits_as_whole_text(whole, seed):
    """Random edits at piece borders, runs of blanks and apostrophes."""
    rng = random.Random(seed)
    bits = ["word", " ", "  ", "\n", "'", "'re", "s", "12", "!", "...", "é", "\t ", "a b c " * 30]
    text = "".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 60, 800])))
    tree = PieceTree(text, once(PieceCounts, PATH, PATTERN))
    for _ in range(12):
        start, removed = rng.randrange(-2, len(text) + 4), rng.choice([0, 0, 1, 3, 50, 2000])
        put = "".join(rng.choice(bits) for _ in range(rng.randrange(4)))
        tree.edit(start, removed, put)
        text = edited(text, [(start, removed, put)])
        assert tree.text() == text
        assert tree.tokens[1] == len(whole.encode_ordinary(text)), (text, start, removed, put)
        assert tree.chars[1] == len(text)


def test_odd_rows(odd, none):
    rows = edit_counts(seeded_edits(odd), PATH, PATTERN).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.n_tokens) for r in rows if r.doc_id in (1, 2)} == {(1, 0), (2, 0)}
    assert edit_counts(seeded_edits(none), PATH, PATTERN).count() == 0
    bare = odd.selectExpr("doc_id", "text", "CAST(NULL AS array<struct<start:long,removed:long,inserted:string>>) AS edits")
    assert all(r.n_tokens == r.edited_tokens for r in edit_counts(bare, PATH, PATTERN).collect())
