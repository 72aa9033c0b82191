"""Numbered commit notes under ``{base}/_commits``: what a reader of a stored table goes by.

A writer writes its files first and its note last, under a name that appears at once
(a rename).  Files that no note names don't count, so a job that dies, or is
run again, leaves readers on the last committed state.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession

from kairos.session import hadoop_path


def committed(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the commits under ``base``, ascending."""
    fs, p = hadoop_path(spark, os.path.join(base, "_commits"))
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def commit(spark: SparkSession, base: str, number: int, note: dict) -> None:
    """Write note ``number``; another run's commit of that number is an error."""
    fs, tmp = hadoop_path(spark, os.path.join(base, "_commits", f"{number:06d}.tmp"))
    _, final = hadoop_path(spark, os.path.join(base, "_commits", f"{number:06d}.json"))
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(note).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(tmp, final):
        raise RuntimeError(f"generation {number} was committed by another run")


def read_note(spark: SparkSession, base: str, number: int) -> dict:
    _, p = hadoop_path(spark, os.path.join(base, "_commits", f"{number:06d}.json"))
    return json.loads("".join(r[0] for r in spark.read.text(p.toString()).collect()))
