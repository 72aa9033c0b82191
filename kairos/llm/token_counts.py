"""Token counts with a whole-token shortcut.

Offline proof, once on the driver: every vocabulary string that ends a word is
turned back into text and encoded alone; those that come back as exactly one
token form the shortcut set (at most one entry per vocabulary entry, so it may
be broadcast).  In the corpus pass a pre-token in that set counts 1 without
merging; the others are merged once per distinct pre-token and task.

Texts are cut at the special strings (one token each) as the library does.
Texts with characters beyond Latin letters, ASCII and plain white space go
through the library whole: their normalisation is not restated here.

Defined cases: null and empty text count 0 tokens and 0 bytes.  Extra columns
pass through, columns named like a result are replaced, repeated rows stay.
"""

from __future__ import annotations

import json
import os
import re

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairos.llm.common import map_texts

#: entries of a task's table of merged pre-tokens before it starts anew, and its longest entry; both bound memory only
TABLE_MAX, WORD_MAX = 500_000, 64
#: texts for which lower-casing and white space need no Unicode tables beyond Latin
_PLAIN = "\t\n\r\x20-\x7e\xa1-\u024f"
_OTHER = re.compile(f"[^{_PLAIN}]")
_LOADED: dict[str, object] = {}


def load(path: str):
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = t
    return _LOADED[path]


def rules(path: str) -> tuple[str, list[str]]:
    """Pre-token pattern and special strings of a word-end BPE file; other kinds are refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = spec["pre_tokenizer"]["pretokenizers"]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    ok = (spec["model"].get("end_of_word_suffix") and kinds == ["NFC", "Replace", "Lowercase"]
          and [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["invert"])
    if not ok:
        raise ValueError("expected a lower-casing BPE with word ends")
    return steps[0]["pattern"]["Regex"], [t["content"] for t in spec["added_tokens"]]


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that, encoded alone, give one token: the offline proof."""
    tok, suffix, byte = load(path), "</w>", byte_alphabet()
    texts = {}
    for piece, i in tok.get_vocab(with_added_tokens=False).items():
        if piece.endswith(suffix):
            try:
                texts[bytes(byte[c] for c in piece[:-len(suffix)]).decode()] = i
            except (KeyError, UnicodeDecodeError):
                continue
    names = sorted(texts)
    got = tok.encode_batch(names, add_special_tokens=False)
    return frozenset(n for n, e in zip(names, got) if e.ids == [texts[n]])


def plain_pattern(pattern: str) -> re.Pattern:
    """The pre-token pattern for plain texts, its Unicode classes written out for their characters."""
    plain = [c for c in map(chr, range(0x250)) if not _OTHER.match(c)]
    for name in ("L", "N"):
        members = "".join(re.escape(c) for c in plain if regex.match(rf"\p{{{name}}}", c))
        pattern = pattern.replace(f"\\p{{{name}}}", members).replace(f"[[{members}]", f"[{members}")
    return re.compile(pattern)


class Seen(dict):
    """Token counts by pre-token; notes what it doesn't have."""

    def __init__(self, whole):
        super().__init__(dict.fromkeys(whole, 1))
        self.missed: list[str] = []

    def __missing__(self, word):
        self.missed.append(word)
        return 0


class Counter:
    def __init__(self, path: str, whole: frozenset[str]):
        pattern, special = rules(path)
        self.tok = load(path)
        self.words = plain_pattern(pattern).findall
        self.special = re.compile("|".join(map(re.escape, special)))
        self.whole = whole
        self.table = Seen(whole)

    def merged(self, words: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def __call__(self, texts: list) -> list:
        table = self.table
        size, missed, counts, ends = table.__getitem__, table.missed, [], []
        for t in texts:
            n = 0
            if t and _OTHER.search(t):
                n = len(self.tok.encode(t, add_special_tokens=False).ids)
            elif t:
                parts = self.special.split(t) if "<|" in t else [t]
                n = len(parts) - 1 + sum(sum(map(size, self.words(p.lower()))) for p in parts)
            counts.append(n)
            ends.append(len(missed))
        new = sorted(set(missed))
        sizes: dict[str, int] = {}
        for at in range(0, len(new), 4096):
            sizes.update(zip(new[at:at + 4096], self.merged(new[at:at + 4096])))
        at = 0
        for i, end in enumerate(ends):
            counts[i] += sum(map(sizes.__getitem__, missed[at:end]))
            at = end
        missed.clear()
        if len(table) + len(sizes) > TABLE_MAX + len(self.whole):
            self.table = table = Seen(self.whole)
        table.update((w, n) for w, n in sizes.items() if len(w) <= WORD_MAX)
        return [counts]


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of every whole text, without begin, end or added special tokens."""
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))  # at most one entry per vocabulary entry
    return map_texts(docs, text_col, {out_col: "bigint"}, lambda: Counter(path, whole.value))


def report(docs: DataFrame, path: str, limit: int = 2048, text_col: str = "text") -> DataFrame:
    """count_tokens plus UTF-8 bytes and whether the text exceeds ``limit`` tokens."""
    return (count_tokens(docs, path, text_col)
            .withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("bigint"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
