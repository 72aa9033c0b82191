"""Chat formatting as prefix trees.

Conversations that share their initial turns are merged: a pack is a forest of
turns in which a shared turn is written once, depth-first.  Each node carries
its interval in the pack's text, the position id of its first character (its
depth in characters along its own conversation, not its place in the pack), the
intervals of its ancestors, which with its own are all it may attend to, and the
interval under the loss mask (the text of an assistant turn).

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline.  Inside
roles and texts every control string (CONTROLS) is broken by a backslash after
its first character, backslashes are doubled and a role's newline is a
backslash and \\x1f; ``unescape`` reverses that exactly.

Ancestor intervals that meet are one interval, so a conversation written in one
piece has one, however many turns it has.

Packs: a prefix (the turns from the first to some turn) is heavy if more than
``pack_size`` different conversations, or ``pack_chars`` characters of them, begin
with it.  A conversation belongs to its longest heavy prefix, and the
conversations of a heavy prefix are dealt by their next turn to as many packs as
that size asks for: what shares more turns than that stays together.  Without a
heavy prefix the first turn is the pack.  Equal conversations are one leaf, joined
back by key.  So a first turn, or a whole conversation, held by a third of all
rows makes more packs or one leaf, not one large task, and a shared turn is
written once per pack.  A conversation itself is one record and is gathered whole.

Defined cases: null text and null role are empty; turns are ordered by turn
number (nulls first), then role, then text, and repeated rows are turns of
their own.  A null conversation id is one conversation.  Extra columns are not
looked at.  An empty table gives no packs.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates.
CONTROLS = [START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
            "<|system|>", "<|user|>", "<|assistant|>"]
_SPECIAL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROLS)))
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub("\\\\(\\\\|\x1f|)", lambda m: {"\\": "\\", "\x1f": "\n", "": ""}[m[1]], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn and the interval of its text in it."""
    head = START + escape(role).replace("\n", "\\\x1f") + "\n"
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


NODE = "struct<start:bigint,stop:bigint,position:bigint,parent:int,loss_start:bigint,loss_stop:bigint,ancestors:array<struct<start:bigint,stop:bigint>>>"
PACK = f"pack string, text string, nodes array<{NODE}>, leaves array<struct<leaf:string,node:int>>"
_NODE = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("position", pa.int64()), ("parent", pa.int32()), ("loss_start", pa.int64()),
                   ("loss_stop", pa.int64()), ("ancestors", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
_LEAF = pa.struct([("leaf", pa.string()), ("node", pa.int32())])


def _with_interval(intervals: list[dict], start: int, stop: int) -> list[dict]:
    """``intervals`` and one that follows them, joined to the last one where they meet."""
    if intervals and intervals[-1]["stop"] == start:
        return intervals[:-1] + [{"start": intervals[-1]["start"], "stop": stop}]
    return intervals + [{"start": start, "stop": stop}]


def build_pack(name: str, conversations: list[tuple[str, list[tuple[str, str]]]], learn: tuple[str, ...] = ("assistant",)) -> dict:
    """Merge (leaf, turns) by shared initial turns and write the forest depth-first."""
    children: list[dict] = [{}]  # node -> its children by turn; node 0 is above the roots
    turn_of: list[tuple[str, str] | None] = [None]
    ends: list[list[str]] = [[]]
    for leaf, turns in conversations:
        at = 0
        for turn in turns:
            nxt = children[at].get(turn)
            if nxt is None:
                nxt = children[at][turn] = len(children)
                children.append({}), turn_of.append(turn), ends.append([])
            at = nxt
        ends[at].append(leaf)
    nodes, leaves, text, length = [], [{"leaf": x, "node": -1} for x in ends[0]], [], 0
    stack = [(c, -1) for c in reversed(list(children[0].values()))]
    while stack:
        n, parent = stack.pop()
        role, said = turn_of[n]
        written, lo, hi = format_turn(role, said)
        up = nodes[parent] if parent >= 0 else None
        above = _with_interval(up["ancestors"], up["start"], up["stop"]) if up else []
        first = up["position"] + up["stop"] - up["start"] if up else 0
        loss = (length + lo, length + hi) if role in learn else (None, None)
        nodes.append({"start": length, "stop": length + len(written), "position": first, "parent": parent,
                      "loss_start": loss[0], "loss_stop": loss[1], "ancestors": above})
        text.append(written)
        length += len(written)
        leaves += [{"leaf": x, "node": len(nodes) - 1} for x in ends[n]]
        stack += [(c, len(nodes) - 1) for c in reversed(list(children[n].values()))]
    return {"pack": name, "text": "".join(text), "nodes": nodes, "leaves": leaves}


def gather(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turns, leaf): each conversation's turns in order, and a key of its whole content."""
    said = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (turns.groupBy(F.col(id_col).alias("conv")).agg(F.sort_array(F.collect_list(said)).alias("t"))
            .select("conv", F.expr("transform(t, x -> struct(x.role as role, x.text as text))").alias("turns"))
            .withColumn("leaf", F.sha2(F.to_json("turns"), 256)))


@F.pandas_udf(T.ArrayType(T.LongType()))
def _prefixes(turns: pd.Series) -> pd.Series:
    """A number for every prefix of a conversation, from the numbers of its turns.

    Prefixes that share a number by chance only share packs.
    """
    def chain(numbers) -> np.ndarray:
        out, h = np.empty(len(numbers), np.uint64), 0
        for i, t in enumerate(numbers.tolist()):
            h = ((h * 6364136223846793005 + t) ^ (h >> 29)) & (2**64 - 1)
            out[i] = h
        return out.view(np.int64)
    return turns.map(chain)


def deal(different: DataFrame, pack_size: int, pack_chars: int) -> DataFrame:
    """(leaf, pack) of the different conversations (leaf, turns), by their prefixes."""
    paths = different.select(
        "leaf", F.expr("aggregate(turns, 0L, (n, t) -> n + length(t.role) + length(t.text))").alias("chars"),
        _prefixes(F.expr("transform(turns, t -> xxhash64(t.role, t.text))")).alias("path"))
    steps = paths.select("leaf", "chars", F.posexplode_outer("path").alias("depth", "prefix"), "path")
    steps = steps.withColumn("next", F.expr("get(path, depth + 1)")).drop("path")
    heavy = (steps.groupBy("prefix").agg(F.count("*").alias("n"), F.sum("chars").alias("c"))
             .where((F.col("n") > pack_size) | (F.col("c") > pack_chars)).select("prefix", F.lit(True).alias("heavy")))
    # the longest heavy prefix, or the first turn; a conversation that ends there goes by its key
    own = (steps.join(heavy, "prefix", "left")
           .groupBy("leaf").agg(F.max(F.when(F.col("heavy") | (F.col("depth") == 0), F.struct("depth", "prefix", "heavy", "next", "chars"))).alias("s"))
           .select("leaf", F.col("s.prefix").alias("prefix"), F.col("s.chars").alias("chars"),
                   F.when(F.col("s.heavy"), F.coalesce("s.next", F.xxhash64("leaf"))).alias("next")))
    parts = (own.where("next is not null").groupBy("prefix")
             .agg(F.greatest(F.ceil(F.count("*") / pack_size), F.ceil(F.sum("chars") / pack_chars)).alias("parts")))
    return (own.join(parts, "prefix", "left")
            .select("leaf", F.concat_ws("-", F.hex("prefix"), F.expr("pmod(xxhash64(next), parts)")).alias("pack")))


def pack(gathered: DataFrame, pack_size: int = 512, learn: tuple[str, ...] = ("assistant",), pack_chars: int = 1 << 22) -> DataFrame:
    """Packs (see PACK) of the different conversations of ``gathered``."""
    different = gathered.groupBy("leaf").agg(F.first("turns").alias("turns"))
    dealt = different.join(deal(different, pack_size, pack_chars), "leaf").select("pack", "leaf", "turns")

    def build(batches):
        name, held = None, []

        def out():
            p = build_pack(name, held, learn)
            return pa.RecordBatch.from_arrays(
                [pa.array([p["pack"]]), pa.array([p["text"]]), pa.array([p["nodes"]], pa.list_(_NODE)), pa.array([p["leaves"]], pa.list_(_LEAF))],
                names=["pack", "text", "nodes", "leaves"])

        for batch in batches:
            for n, leaf, turns in zip(*(batch.column(c).to_pylist() for c in ("pack", "leaf", "turns"))):
                if n != name:
                    if held:
                        yield out()
                    name, held = n, []
                held.append((leaf, [(t["role"], t["text"]) for t in turns]))
        if held:
            yield out()

    return dealt.repartition("pack").sortWithinPartitions("pack", "leaf").mapInArrow(build, PACK)


def read_back(packs: DataFrame) -> DataFrame:
    """(leaf, turns, formatted_chars, loss): each different conversation from its pack, by intervals alone."""
    schema = "leaf string, turns array<struct<role:string,text:string>>, formatted_chars bigint, loss array<string>"
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def read(batches):
        for batch in batches:
            leaf, turns, chars, loss = [], [], [], []
            for text, nodes, leaves in zip(*(batch.column(c).to_pylist() for c in ("text", "nodes", "leaves"))):
                starts = [n["start"] for n in nodes]  # ascending: nodes are written depth-first
                for x in leaves:
                    path = []
                    if x["node"] >= 0:
                        own = nodes[x["node"]]
                        path = _with_interval(own["ancestors"], own["start"], own["stop"])
                    masks = [m for p in path for m in nodes[bisect_left(starts, p["start"]):bisect_left(starts, p["stop"])]]
                    formatted = "".join(text[p["start"]:p["stop"]] for p in path)
                    leaf.append(x["leaf"])
                    turns.append([{"role": r, "text": t} for r, t in parse(formatted)])
                    chars.append(len(formatted))
                    loss.append([unescape(text[m["loss_start"]:m["loss_stop"]]) for m in masks if m["loss_start"] is not None])
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.string()), pa.array(turns, kind), pa.array(chars, pa.int64()),
                                              pa.array(loss, pa.list_(pa.string()))], names=["leaf", "turns", "formatted_chars", "loss"])

    return packs.mapInArrow(read, schema)
