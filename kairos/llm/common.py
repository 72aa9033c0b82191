"""Shared helpers of the text operators.

* ``map_texts``: one Arrow pass over a text column that keeps the other columns.
* ``hash_words`` / ``hash_shingles``: 64-bit word and shingle hashes of whole texts with numpy.
* ``id_bitmap`` / ``in_bitmap``: a pre-filter of fixed size for "is this id wanted"; an exact join follows.
* ``connected_components``: smallest reachable id by repeated min-neighbour hops, layers in the shared folder.
* ``materialise``: write a layer under ``spark.checkpoint.dir`` and read it back.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from kairos.session import hadoop_path, scratch_path

#: rows handed to the per-task text functions at a time
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: layers that this process wrote, oldest first
LAYERS: list[str] = []


def materialise(df: DataFrame, **options: str) -> DataFrame:
    """Parquet layer in the shared checkpoint folder: survives lost executors, each use reads it."""
    path = scratch_path(df.sparkSession, "llm")
    df.write.options(**options).parquet(path)
    LAYERS.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete layers that no DataFrame in use reads any more, and let Spark drop the shuffle files and broadcasts behind them.

    Spark's cleaner goes by what the driver's garbage collectors find unreachable, so both run here.
    """
    for path in paths:
        fs, p = hadoop_path(spark, path)
        fs.delete(p, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- Arrow passes over texts
def arrow_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def map_texts(df: DataFrame, text_col: str, fields: dict[str, str],
              make: Callable[[], Callable[[list], list]], drop_text: bool = False) -> DataFrame:
    """Add columns computed from ``text_col``; other columns pass through.

    ``fields`` maps new column names to Spark types; existing columns of those
    names are replaced.  ``make`` is called once per task and returns a function
    from a list of texts (None kept) to one list/array per new column.
    """
    kept = [c for c in df.columns if c not in fields]
    src = df.select(*[F.col(f"`{c}`") for c in kept])
    out_cols = [c for c in kept if not (drop_text and c == text_col)]
    schema = ", ".join([f"`{c}` {src.schema[c].dataType.simpleString()}" for c in out_cols]
                       + [f"`{c}` {t}" for c, t in fields.items()])
    types = [to_arrow_type(StructType.fromDDL(f"x {t}")[0].dataType) for t in fields.values()]
    names = out_cols + list(fields)

    def run(batches):
        f = make()
        for part in arrow_slices(batches):
            made = f(part.column(text_col).to_pylist())
            cols = [part.column(c) for c in out_cols]
            cols += [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)


# ---------------------------------------------------------------- word hashes
_SEG = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
#: multipliers of the words of a shingle; odd 64-bit values from a fixed seed
_MULT = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int):
    have = _POWERS.get("pow")
    if have is None or len(have) < n:
        n = max(n, _SEG + 4096)
        for key, base in (("pow", _BASE), ("inv", _BASE_INV)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["pow"], _POWERS["inv"]


class WordTable:
    """Byte classes of a word definition: separators and the value of each word byte."""

    def __init__(self, separators: bytes, fold_ascii_case: bool = True):
        value = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
        if fold_ascii_case:
            value[65:91] = value[97:123]
        self.sep = np.zeros(256, dtype=bool)
        self.sep[list(separators)] = True
        self.value = np.where(self.sep, np.uint64(0), value)


#: words are runs of anything but space and \\x09-\\x0D
WHITE = WordTable(b" \x09\x0a\x0b\x0c\x0d")
#: words are runs of ASCII letters, digits and non-ASCII bytes (punctuation separates)
ALNUM = WordTable(bytes(b for b in range(128) if not chr(b).isalnum()))


def _segments(data: bytes, table: WordTable):
    """Cut long data at separators, so that the working arrays stay small."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + _SEG)
        if end < n:
            cut = np.flatnonzero(table.sep[np.frombuffer(data, np.uint8, end - at, at)])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:  # one word longer than a segment: go on to its end
                while end < n and not table.sep[data[end]]:
                    end += 1
        yield at, data[at:end]
        at = end


def hash_words(data: bytes, table: WordTable = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte starts of the words of ``data``, in order."""
    hashes, starts = [], []
    for at, seg in _segments(data, table):
        b = np.frombuffer(seg, np.uint8)
        word = np.zeros(len(b) + 2, dtype=bool)
        word[1:-1] = ~table.sep[b]
        edge = np.flatnonzero(word[1:] != word[:-1])
        s, e = edge[0::2], edge[1::2]
        if not len(s):
            continue
        p, inv = _powers(len(b) + 1)
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(table.value[b] * p[:len(b)], out=total[1:])
        h = (total[e] - total[s]) * inv[s]
        hashes.append(mix64(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(s + at)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; shorter sequences are one shingle, no words none."""
    n = len(words)
    if n == 0:
        return words
    size = min(k, n)
    h = np.full(n - size + 1, np.uint64(size * 0xA24BAED4963EE407 % 2**64), dtype=np.uint64)
    for j in range(size):
        h += words[j:n - size + 1 + j] * _MULT[j]
    return mix64(h)


def batch_words(texts: list, table: WordTable = WHITE) -> list[np.ndarray]:
    """Word hashes per text; the short texts of a batch are hashed together."""
    data = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    hashes, starts = hash_words(b"\n".join(data), table)
    ends = np.cumsum([len(d) + 1 for d in data])
    return np.split(hashes, np.searchsorted(starts, ends[:-1])) if len(data) else []


# ---------------------------------------------------------------- id pre-filter of fixed size
def id_bitmap(ids: DataFrame, col: str, bits: int = 1 << 26) -> DataFrame:
    """Hash bitmap of ids in blocks of 32,768 bits: at most bits / 8 bytes, whatever the number of ids."""
    return (ids.where(F.col(col).isNotNull()).select(F.pmod(F.xxhash64(F.col(col)), F.lit(bits)).alias("h"))
            .groupBy(F.expr("bitmap_bucket_number(h)").alias("_kl_block"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("_kl_bits")))


def maybe_in(df: DataFrame, col: str, bitmap: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """Add ``_kl_maybe``: whether the id may be in the bitmap (true for all that are, for few others)."""
    bit = ("(conv(hex(substring(_kl_bits, cast(bitmap_bit_position(_kl_h) div 8 as int) + 1, 1)), 16, 10)"
           " & shiftleft(1, cast(bitmap_bit_position(_kl_h) % 8 as int))) != 0")
    return (df.withColumn("_kl_h", F.pmod(F.xxhash64(F.col(col)), F.lit(bits)))
            .withColumn("_kl_block", F.expr("bitmap_bucket_number(_kl_h)"))
            .join(F.broadcast(bitmap), "_kl_block", "left")
            .select(*df.columns, F.expr(f"coalesce({bit}, false)").alias("_kl_maybe")))


def in_bitmap(df: DataFrame, col: str, bitmap: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """Rows whose id may be in the bitmap (a superset of the wanted rows)."""
    return maybe_in(df, col, bitmap, bits).where("_kl_maybe").drop("_kl_maybe")


# ---------------------------------------------------------------- connected components
def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """(id, component): the smallest id reachable over undirected ``edges``.

    Alternating star contraction: every round replaces each node's larger
    neighbours' link by one to its smallest neighbour, then links smaller
    neighbours among themselves to the smallest.  The number of rounds grows
    with the logarithm of the longest path.  Group-wise work is a ``min``
    (combined map-side) and an equi-join that AQE can split, so a hub with a
    third of all links is no single task.  Ids without edges are not returned.
    """
    e = materialise(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a != b")
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        # large star: link every larger neighbour to the smallest of the neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").distinct()
        # small star: each node's smaller neighbours are linked to the smallest of them
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(down, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .unionByName(down.select(F.col("m").alias("a"), "b"))).distinct()
        e = materialise(small)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if before is not None and (now["n"], now["s"]) == before:
            break
        before = (now["n"], now["s"])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    lone = e.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("id"), "component")
    roots = lone.select(F.col("component").alias("id"), "component").distinct()
    return lone.unionByName(roots)
