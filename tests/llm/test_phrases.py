import hashlib
from zlib import crc32

import numpy as np
import pytest

from leafwright.llm.phrases import fingerprint_pairs, op7_fingerprints, parse, sketch
from leafwright.llm.texts import mixed

from .conftest import ODD, SF


def phrases(data):
    known, out, i = set(), [], 0
    for j in range(1, len(data) + 1):
        if data[i:j] not in known:
            known.add(data[i:j])
            out.append(data[i:j])
            i = j
    return out


def hashes(text):
    return {int(mixed(mixed(np.array([crc32(p)], np.uint64) + np.uint64(0x51ED27)))[0] >> np.uint64(32)) for p in phrases(text.encode())}


def print_of(text):
    return "".join(f"{h:08x}" for h in sorted(hashes(text))[:64])


def near(a, b):
    a, b = sorted(hashes(a))[:64], sorted(hashes(b))[:64]
    both = sorted({*a, *b})[:64]
    return len({*a} & {*b} & {*both}) / len(both) if both else 1.0


def brute(docs):
    docs = sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for (d, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        q = len(text) // 4
        changed = text[: len(text) - q] + after[:q]
        out.append((d, len(text), hashlib.sha256(changed.encode()).hexdigest(), print_of(text), print_of(changed), near(text, changed), near(text, after)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r[0], r[1], r[2], r[3], r[4], pytest.approx(r[5]), pytest.approx(r[6])) for r in df.collect()), key=lambda r: str((*r[:5], r[5].expected, r[6].expected)))


def test_query(spark, documents):
    assert rows(op7_fingerprints(spark, SF)) == brute([(r.doc_id, r.text) for r in documents.collect()])


@pytest.mark.parametrize("parts", [1, 2, 50])
def test_odd_rows(odd, parts):
    assert rows(fingerprint_pairs(odd, parts=parts)) == brute([(r[0], r[1]) for r in ODD])


def test_few_rows(odd, none):
    assert fingerprint_pairs(none).count() == 0
    assert rows(fingerprint_pairs(odd.filter("doc_id = 6"))) == brute([ODD[6][:2]])


def test_parse_by_steps():
    data = b"abracadabra" * 40 + bytes(range(256)) * 3
    out = []
    parse(data, set(), 0, len(data), len(data), out)
    assert out == phrases(data)
    assert len(sketch(out)) == 64
