"""Change rows (insert, update, delete) whose order of arrival doesn't matter.

The state keeps one row per key: its greatest change by sequence number, deletes
included (``_deleted``, without their values).  Merging takes the greater of two
rows, so it is commutative, associative and repeatable: batches may come in any order, late or twice, and a
late update older than a delete doesn't bring the key back.

At an equal sequence number a delete counts as the later change, then the greater values do.
Tombstones are kept until a *horizon* passes them.  What is older than the horizon can't be judged any
more (its key's delete may be forgotten), so such changes are refused and kept apart, whenever they arrive.

``merge`` and ``live`` are plain functions; ``ChangeTable`` is the stored form: a batch writes
its reduced rows only, readers merge them with the last compacted state.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kairos.sources.commits import commit, committed, read_note

DELETED = "_deleted"


def _greatest(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The row per key that counts (an aggregate: a hot key is reduced before the shuffle)."""
    rest = [c for c in rows.columns if c not in (*keys, seq, DELETED)]
    row = F.struct(seq, DELETED, *rest)
    return rows.groupBy(*keys).agg(F.max(row).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def as_state(changes: DataFrame, keys: Sequence[str], seq: str, op: str = "op", delete_value: str = "D") -> DataFrame:
    """The state of change rows alone: one row per key; a delete keeps its key and sequence number only."""
    gone = F.coalesce(F.col(op) == delete_value, F.lit(False))
    kept = [F.col(c) if c in (*keys, seq) else F.when(~gone, F.col(c)).alias(c) for c in changes.columns if c != op]
    return _greatest(changes.select(*kept, gone.alias(DELETED)), list(keys), seq)


def merge(a: DataFrame | None, b: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Two states as one, in any order and any number of times."""
    return b if a is None else _greatest(a.unionByName(b), list(keys), seq)


def live(state: DataFrame) -> DataFrame:
    """The rows that are not deleted."""
    return state.where(~F.col(DELETED)).drop(DELETED)


def expire(state: DataFrame, seq: str, horizon) -> DataFrame:
    """Without the tombstones older than ``horizon`` (a value or column of the sequence's type)."""
    return state.where(~(F.col(DELETED) & (F.col(seq) < horizon)))


@dataclass
class ChangeTable:
    """Stored state under ``path``: ``gen=N/delta`` per batch, ``gen=N/base`` per compaction."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    seq: str
    op: str = "op"
    delete_value: str = "D"

    def _dir(self, gen: int, part: str) -> str:
        return os.path.join(self.path, f"gen={gen:06d}", part)

    def _notes(self) -> list[dict]:
        return [read_note(self.spark, self.path, g) | {"gen": g} for g in committed(self.spark, self.path)]

    def _horizon(self, notes: list[dict], schema: StructType):
        said = [n["horizon"] for n in notes if n.get("horizon") is not None]
        return F.lit(said[-1]).cast(schema[self.seq].dataType) if said else None

    def apply(self, changes: DataFrame, batch: str | None = None) -> None:
        """Store a batch of change rows.  A named batch that is committed already changes nothing."""
        notes = self._notes()
        if batch is not None and any(n.get("batch") == batch for n in notes):
            return
        gen = notes[-1]["gen"] + 1 if notes else 0
        horizon = self._horizon(notes, changes.schema)
        taken = changes
        if horizon is not None:
            late = F.coalesce(F.col(self.seq) < horizon, F.lit(True))
            changes.where(late).write.mode("overwrite").parquet(self._dir(gen, "late"))
            taken = changes.where(~late)
        state = as_state(taken, self.keys, self.seq, self.op, self.delete_value)
        state.write.mode("overwrite").parquet(self._dir(gen, "delta"))
        commit(self.spark, self.path, gen, {"part": "delta", "batch": batch, "schema": state.schema.jsonValue(),
                                            "late": changes.schema.jsonValue() if horizon is not None else None})

    def state(self) -> DataFrame | None:
        """The merged state: the last compaction and the batches since."""
        notes = self._notes()
        if not notes:
            return None
        since = max((i for i, n in enumerate(notes) if n["part"] == "base"), default=0)
        schema = StructType.fromJson(notes[-1]["schema"])
        parts = [self._dir(n["gen"], n["part"]) for n in notes[since:]]
        rows = self.spark.read.schema(schema).parquet(*parts)
        return rows if len(parts) == 1 else _greatest(rows, list(self.keys), self.seq)

    def live(self) -> DataFrame | None:
        state = self.state()
        return None if state is None else live(state)

    def late(self) -> DataFrame | None:
        """Change rows refused because they were older than the horizon when they came."""
        notes = [n for n in self._notes() if n.get("late")]
        if not notes:
            return None
        return self.spark.read.schema(StructType.fromJson(notes[-1]["late"])).parquet(*[self._dir(n["gen"], "late") for n in notes])

    def compact(self, horizon: str | None = None) -> None:
        """Write the state as one layer; ``horizon`` (text, cast to the sequence's type) drops older tombstones for good.

        A horizon never goes back: an earlier one than before is an error.
        """
        notes, state = self._notes(), self.state()
        if state is None:
            return
        if horizon is not None:
            before = self._horizon(notes, state.schema)
            now = F.lit(horizon).cast(state.schema[self.seq].dataType)
            if before is not None and self.spark.range(1).select(now < before).first()[0]:
                raise ValueError(f"the horizon {horizon} lies before an earlier one")
            state = expire(state, self.seq, now)
        gen = notes[-1]["gen"] + 1
        state.write.mode("overwrite").parquet(self._dir(gen, "base"))
        commit(self.spark, self.path, gen, {"part": "base", "horizon": horizon, "schema": state.schema.jsonValue()})
