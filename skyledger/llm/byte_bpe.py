"""Byte-level BPE with the results of the public tokenizer file, by pieces that are surely split from each other.

A text without a space before another white-space character is split by the tokenizer's pattern at every space (a
space and the letters, digits or signs after it are one match, and no match runs across it). Such pieces repeat, so
each worker keeps the ids of the pieces it has met. Other texts are encoded whole.
"""

from __future__ import annotations

import base64
import re

import numpy as np

SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
#: Pieces that a worker keeps before it starts anew; about 60 MB.
CACHE_PIECES = 300_000
_SPACE_RUN = re.compile(r" \s")
_loaded: dict[str, ByteBpe] = {}


class _Pieces(dict):
    """Ids of `` piece``, as bytes of little-endian 32-bit numbers."""

    def __init__(self, encode, prefix: str):
        self.encode, self.prefix = encode, prefix

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.clear()
        ids = np.array(self.encode(self.prefix + piece), "<u4").tobytes()
        if len(piece) < 64:
            self[piece] = ids
        return ids


class ByteBpe:
    def __init__(self, name: str):
        import public_tokenizers as public
        import tiktoken

        with open(public.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.core = tiktoken.Encoding("bytes", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in ranks.items()} | {SPECIAL_ID: SPECIAL.encode()}
        self.lengths = np.zeros(SPECIAL_ID + 1, np.int64)
        for i, b in self.bytes_of.items():
            self.lengths[i] = len(b)
        self.first, self.later = _Pieces(self.core.encode_ordinary, ""), _Pieces(self.core.encode_ordinary, " ")

    def _plain(self, text: str) -> bytes:
        if _SPACE_RUN.search(text):
            return np.array(self.core.encode_ordinary(text), "<u4").tobytes()
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.later.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Ids as bytes; the special string is one id wherever it stands, as the tokenizer has it."""
        if SPECIAL not in text:
            return self._plain(text)
        special = np.array([SPECIAL_ID], "<u4").tobytes()
        return special.join(self._plain(x) if x else b"" for x in text.split(SPECIAL))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def load(name: str = "byte_bpe_50k.tiktoken") -> ByteBpe:
    """The tokenizer of this worker; ``name`` is the rank file of the same vocabulary as ``byte_bpe_50k.json``."""
    if name not in _loaded:
        _loaded[name] = ByteBpe(name)
    return _loaded[name]
