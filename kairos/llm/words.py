"""Interned words of byte texts: shared by the operators that count words or phrases per task.

Texts are folded by a byte table (letters lowered, separators made blank), cut
into blocks at separators and split; each distinct word gets a small number.
UTF-8 bytes of other characters pass unchanged, so words stay valid UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: ends a text or a piece in a token list; not a byte of UTF-8 text
MARK = b"\xff"
BLOCK = 1 << 20


class Vocabulary(dict):
    """Word -> number in order of appearance; the mark is 0."""

    def __init__(self):
        super().__init__()
        self[MARK]  # noqa: B018

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word, alike on every machine."""
        return np.fromiter(map(xxhash.xxh64_intdigest, self), np.uint64, len(self))


def fold_table(blank: bytes, breaks: bytes = b"") -> bytes:
    """Byte table: A-Z lowered, ``blank`` bytes become a space, ``breaks`` a line feed."""
    t = bytearray(range(256))
    t[255] = 254  # only broken text has this byte, and the mark must stand alone
    t[65:91] = bytes(range(97, 123))
    for b in blank:
        t[b] = 32
    for b in breaks:
        t[b] = 10
    return bytes(t)


def token_blocks(data: bytes, table: bytes | None = None, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Words of ``data`` (folded here by ``table``, or before) in order, a block at a time; a mark stands for every break."""
    if table is not None:
        data = data.translate(table)
    at, n = 0, len(data)
    while at < n:
        end = at + size
        if end < n:
            cut = max(data.rfind(b" ", at, end), data.rfind(b"\n", at, end))
            if cut < at:  # one word longer than a block: go on to its end
                ends = [x for x in (data.find(b" ", end), data.find(b"\n", end)) if x >= 0]
                cut = min(ends, default=n - 1)
            end = cut + 1
        yield data[at:end].replace(b"\n", b" " + MARK + b" ").split()
        at = end
