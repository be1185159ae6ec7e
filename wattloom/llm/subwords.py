"""Tokens of plain words, straight from a tokenizer's merges.

Most chunks are letters with a few signs behind them. For those the pre-tokens are known (the letters,
the signs), so the model can be asked without building an encoding; other chunks go through the
library's whole pipeline.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Latin letters, less one that lower-casing turns into two, then ASCII signs without the apostrophe.
PLAIN = re.compile(
    "([A-Za-zÀ-ÖØ-öø-įı-ɏ]*)([!-&(-/:-@\\[-`{-~]*)\\Z"
)


def byte_characters() -> list[str]:
    """The character a byte-level vocabulary writes for each byte: itself where it prints, else the
    next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class PlainWords:
    """`ids(chunk)`: the token ids of a chunk that PLAIN describes, else None.

    `space` says that the chunk stands behind a space which goes with its first pre-token; `lower`
    that the tokenizer lower-cases.
    """

    def __init__(self, tokenizer, space: bool, lower: bool):
        self.model = tokenizer.model
        self.table = byte_characters()
        self.space, self.lower = self.table[0x20] if space else "", lower
        self.signs = lru_cache(maxsize=10_000)(self._ids)

    def _ids(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(piece)]

    def ids(self, chunk: str) -> list[int] | None:
        if chunk.isascii() and chunk.isalpha():
            return self._ids(self.space + (chunk.lower() if self.lower else chunk))
        found = PLAIN.match(chunk)
        if found is None or "<|" in chunk or not chunk:
            return None
        letters, signs = found.groups()
        if not letters:
            return self.signs(self.space + signs)
        if self.lower:
            letters = letters.lower()
        if not letters.isascii():
            letters = "".join(map(self.table.__getitem__, letters.encode()))
        ids = self._ids(self.space + letters)
        return ids + self.signs(signs) if signs else ids
