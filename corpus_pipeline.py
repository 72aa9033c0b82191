"""Corpus pipeline over ``documents``: stages that each apply one text operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  A stage called from ``STAGES`` therefore deletes the layers
that the stage before worked with (its result is written by then).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairos.llm import decontaminate, line_dedup, ngram_join, quality_gam, spiece
from kairos.llm.common import LAYERS, id_bitmap, materialise, maybe_in, read_table, release
from kairos.llm.queries import tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of 0.5 or more), with their columns."""
    model = quality_gam.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_gam.score(docs, model, out_col="_kl_score").where("_kl_score >= 0.5").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one (Jaccard of their words at least 0.8, whatever their length).

    A document that loses lines and keeps only blank ones, or none, goes.  ``n_chars`` follows the text.
    """
    out = line_dedup.drop_emptied(line_dedup.dedup_lines(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group linked by 5-word shingles at a Jaccard similarity of 0.8 or more."""
    groups = ngram_join.jaccard_components(docs, k=5, num=4, den=5)
    gone = materialise(groups.where("component_id != doc_id").select("doc_id").distinct())
    flagged = maybe_in(docs, "doc_id", id_bitmap(gone, "doc_id"))
    kept = flagged.where("not _kl_maybe or doc_id is null").drop("_kl_maybe")
    unsure = flagged.where("_kl_maybe and doc_id is not null").drop("_kl_maybe")
    return kept.unionByName(unsure.join(gone, "doc_id", "left_anti"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, substituted words allowed for."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the text they decode to."""
    out = spiece.encode(docs.select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))
    return out.select("doc_id", (F.octet_length("packed_ids") / 4).cast("bigint").alias("n_tokens"),
                      "packed_ids", "decoded")


#: layers of the stage that ran last
_WORKED_WITH: list[str] = []


def _in_turn(stage):
    """``stage`` without what the stage before left behind, unless ``docs`` reads it."""
    @functools.wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        release(spark, [p for p in _WORKED_WITH if not any(p in f for f in read)])
        _WORKED_WITH.clear()
        at = len(LAYERS)
        out = stage(spark, docs, sf_dir)
        _WORKED_WITH.extend(LAYERS[at:])
        return out
    return call


STAGES = [
    ("quality classifier", _in_turn(keep_quality)),
    ("line dedup", _in_turn(dedup_lines)),
    ("n-gram Jaccard join", _in_turn(one_per_group)),
    ("benchmark decontamination", _in_turn(decontaminated)),
    ("SentencePiece encoding and decoding", _in_turn(tokenise)),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
