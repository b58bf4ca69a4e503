import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leafwright.llm.packing import differencing, op10_packing, pack, pieces
from leafwright.llm.tokens import WordIds

from .conftest import ODD, SF

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, window=4096):
    """Each id lies in exactly one piece, and sequences have no gaps; gives the share of padding."""
    whole = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for doc_id, text in docs:
        want[doc_id, np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    ids_of = defaultdict(list)
    for (doc_id, ids), n in want.items():
        ids_of[doc_id] += [ids] * n
    for doc_id, texts in ids_of.items():
        left = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc_id])
        assert sum(n for _, n, _, _ in left) == sum(len(t) // 4 for t in texts)
        for ids in texts:
            at, n = 0, len(ids) // 4
            while at < n:
                piece = next(p for p in left if p[0] == at and p[3] == n and p[2] == zlib.crc32(ids[4 * at : 4 * (at + p[1])]))
                left.remove(piece)
                at += piece[1]
        assert not left
    assert set(by_doc) == set(ids_of)
    padded = used = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        used += at
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded / used


def test_query(spark, documents):
    share = check(op10_packing(spark, SF).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    assert share < 0.03


def test_odd_rows(odd, none):
    check(pack(pieces(odd, PATH)).collect(), [(r[0], r[1]) for r in ODD])
    check(pack(pieces(odd, PATH, window=256, piece=100), window=256, group_windows=50).collect(), [(r[0], r[1]) for r in ODD], 256)
    assert pack(pieces(none, PATH)).count() == 0


@pytest.mark.parametrize("k", [1, 2, 5, 40])
def test_differencing(k):
    rng = np.random.default_rng(k)
    sizes = rng.integers(1, 513, 320).tolist()
    windows = differencing(sizes, k)
    assert sorted(i for w in windows for i in w) == list(range(320))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert len(windows) == k and max(sums) - min(sums) <= 60


def test_same_ids_as_library():
    whole, words = Tokenizer.from_file(PATH), WordIds(PATH)
    texts = [
        "It's We'RE they'LL 'tis ''s 're-do", "İstanbul ΑΣ ΑΣ. ǅ ﬁ", "á ẹ́ café", "x y z\tq\x1cw",
        "ÀÉÎ ßẞ ñandú ÿ 12³ 4½ ª º µ", "<|endoftext|> plain <|startoftext|>x", "日本語 text 한국어 🙂🙂 ​", "a.b,c;d!!! ?? --", "  two  spaces \n\n",
        "{'s': 1, 't': [2]} #### $$$ %%%", "\x00\x01 \x7f \x85", "don’t ‘quote’",
    ]
    rng = np.random.default_rng(3)
    signs = [chr(c) for c in [*range(0x20, 0x180), 0x3A3, 0x301, 0x1F600, 0x4E2D]]
    texts += ["".join(rng.choice(signs, 40)) for _ in range(400)]
    for text in texts:
        want = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert words(text) == want, text
