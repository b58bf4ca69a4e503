"""Token ids from public tokenizer files, word by word with a bounded cache in each worker."""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import regex
import tiktoken

# Entries of a worker's cache; it starts again empty when they are reached.
CACHED = 600_000


class _Cache(dict):
    """Values by piece; a missing one is worked out and kept."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, piece):
        if len(self) >= CACHED:
            self.clear()
        value = self[piece] = self.work(piece)
        return value


class WordIds:
    """Ids of a vocabulary file of lower-case words with word ends, as little-endian 32-bit bytes.

    The file's own library gives the ids of a text that holds anything but ASCII and small or capital letters of
    Latin-1.  Words of those are cut by the file's pattern and merged in the order of the file's merges, which is
    the same and needs no new start for each word; white space parts words, so each is worked out by itself.
    """

    # The byte that stands for a word's end while merging: no UTF-8 text holds it.
    _END = b"\xff"
    _PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
    _PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        vocabulary = held["model"]["vocab"]
        self.special = [t["content"] for t in held["added_tokens"]]
        # The printable stand-ins of bytes: printable ones stand for themselves, the others follow from 256 on.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        signs = {b: chr(b) for b in printable}
        signs |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in signs)}
        byte = {c: b for b, c in signs.items()}

        def raw(token: str) -> bytes:
            word = token.removesuffix("</w>")
            return bytes(byte[c] for c in word) + (self._END if word != token else b"")

        ranks: dict[bytes, int] = {}
        ids: list[int] = []
        for end in ("", "</w>"):
            for b in range(256 if not end else 255):
                ranks[bytes([b]) + (self._END if end else b"")] = len(ids)
                ids.append(vocabulary[signs[b] + end])
        for merge in held["model"]["merges"]:
            token = "".join(merge if isinstance(merge, list) else merge.split(" "))
            if raw(token) not in ranks:
                ranks[raw(token)] = len(ids)
                ids.append(vocabulary[token])
        self._merge = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._bytes = [np.array(i, "<u4").tobytes() for i in ids]
        self._cache = _Cache(self._word)

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if not self._PLAIN.fullmatch(word):
            return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        single = self._merge.encode_single_piece
        held = self._bytes
        return b"".join(
            [held[i] for part in self._PARTS.findall(word.lower()) for i in single(part.encode() + self._END)]
        )

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self._cache.__getitem__, text.replace("\n", " ").split(" ")))


class PieceCounts:
    """Token counts of the pre-tokens of a byte-level vocabulary file of ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        merge = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.pieces = regex.compile(pattern).findall
        self.match = regex.compile(pattern).match
        # A lone surrogate cannot be in a text that Spark holds.
        self._cache = _Cache(lambda piece: len(merge.encode_single_piece(piece.encode())))

    def counts(self, pieces: list[str]) -> list[int]:
        return list(map(self._cache.__getitem__, pieces))


_made: dict[tuple, object] = {}


def once(kind, *args):
    """A tokenizer that is built once in each worker process."""
    if (kind, *args) not in _made:
        _made[(kind, *args)] = kind(*args)
    return _made[(kind, *args)]
