"""SentencePiece encoding and decoding by a distinct-chunk table.

In a vocabulary in which no piece has a whitespace marker after another
character, merges never cross the place before a marker.  A normalised text is
then a sequence of marked chunks (markers, then one word) that can be segmented
alone.  Each task keeps a table chunk -> (ids, decoded text), segments every
chunk it has not seen once with the library, and joins ids back by position.

The proof (``chunks_are_independent``) runs over the whole vocabulary on the
driver; a vocabulary that fails it is refused.

Defined cases: null and empty text give the begin and end ids only and decode
to "".  Blank texts, control characters and very long texts are whole texts
like any other.  Extra columns pass through; columns named like a result are
replaced.  Duplicate rows stay.  An empty table gives an empty table.
"""

from __future__ import annotations

import re
import struct

import numpy as np
from pyspark.sql import DataFrame

from kairos.llm.common import map_texts

MARK = "▁"
#: entries of a task's table before it starts anew, and the longest chunk it keeps; both bound memory only
TABLE_MAX, CHUNK_MAX = 600_000, 64
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_LOADED: dict[str, object] = {}


def load(model: str):
    if model not in _LOADED:
        import sentencepiece

        _LOADED[model] = sentencepiece.SentencePieceProcessor(model_file=model)
    return _LOADED[model]


def chunks_are_independent(model: str) -> bool:
    """No piece continues past a marker, texts are not rewritten, and a marker is put in front."""
    sp = load(model)
    crossing = re.compile(f"[^{MARK}]{MARK}")
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    if any(crossing.search(p) for p in pieces):
        return False
    probe = "a  ÉＡ \n xﬁ"
    return sp.decode(sp.encode(probe)) == probe and sp.encode(MARK + "a") != sp.encode("a")


class ChunkTable:
    """Segments texts through a bounded table of distinct chunks."""

    def __init__(self, model: str, begin: bool = True, end: bool = True):
        self.sp = load(model)
        self.head = np.array([self.sp.bos_id()] if begin else [], "<u4").tobytes()
        self.tail = np.array([self.sp.eos_id()] if end else [], "<u4").tobytes()
        self.table: dict[str, tuple[bytes, str]] = {}

    def learn(self, chunks: list[str]) -> list[tuple[bytes, str]]:
        # the library puts the first marker of each chunk in front again
        ids = self.sp.encode([c[1:] if len(c) > 1 else " " for c in chunks], num_threads=1)
        for i, c in enumerate(chunks):
            if len(c) == 1:  # the marker alone; "" would encode to nothing
                ids[i] = [self.sp.piece_to_id(MARK)]
        texts = self.sp.decode(ids, num_threads=1)
        return [(struct.pack(f"<{len(x)}I", *x), t) for x, t in zip(ids, texts)]

    def __call__(self, texts: list) -> tuple[list[bytes], list[str]]:
        cut = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        table = self.table
        new = sorted({c for chunks in cut for c in chunks}.difference(table))
        if len(table) + len(new) > TABLE_MAX:
            table.clear()
            new = sorted({c for chunks in cut for c in chunks})
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            table.update(zip(part, self.learn(part)))
        packed, decoded = [], []
        for chunks in cut:
            got = [table[c] for c in chunks]
            packed.append(self.head + b"".join([g[0] for g in got]) + self.tail)
            decoded.append(" ".join([g[1] for g in got]))
        for c in [c for c in new if len(c) > CHUNK_MAX]:
            del table[c]
        return packed, decoded


def encode(docs: DataFrame, model: str, text_col: str = "text", begin: bool = True, end: bool = True,
           ids_col: str = "packed_ids", decoded_col: str = "decoded") -> DataFrame:
    """Add the ids (little-endian unsigned 32-bit, as binary) and the text they decode to; ``text_col`` goes."""
    if not chunks_are_independent(model):
        raise ValueError("pieces of this vocabulary cross whitespace markers; chunks can't be segmented alone")
    return map_texts(docs, text_col, {ids_col: "binary", decoded_col: "string"},
                     lambda: ChunkTable(model, begin, end), drop_text=True)


def decode(df: DataFrame, model: str, ids_col: str = "packed_ids", out_col: str = "decoded") -> DataFrame:
    """Text of packed ids, by the library's decode; null ids give ""."""
    def make():
        sp = load(model)
        return lambda blobs: [[sp.decode(np.frombuffer(b, "<u4").astype(int).tolist()) if b else "" for b in blobs]]

    return map_texts(df, ids_col, {out_col: "string"}, make)
