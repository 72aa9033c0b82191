"""Registered queries of the operators: thin, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairos.llm import (chat_tree, collocations, decontaminate, divergence, langid, license_scan, line_dedup, mixing, ngram_join,
                        quality_gam, spiece, token_counts, winnow)
from kairos.llm.common import materialise, read_table


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (quality_gam.classify(docs, read_table(spark, sf_dir, "labels"))
            .select("doc_id", "held_out", "score", "predicted"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (token_counts.report(docs, tokenizer_file("word_bpe_49k.json"))
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and license found in it, without those that another license beats at their places."""
    return license_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"), best=True)


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edit_report(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, benchmark item and place of an overlap; clean documents have none."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.overlaps(docs, read_table(spark, sf_dir, "benchmark"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation and of conversation -7, read back from the packs."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))], rows.schema)
    convs = materialise(chat_tree.gather(rows.unionByName(probe)))
    got = chat_tree.read_back(chat_tree.pack(convs))
    return (convs.select("conv", "leaf").join(got, "leaf")
            .withColumn("said", F.expr("array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '')"))
            .withColumn("learnt", F.array_join("loss", ""))
            .select(F.col("conv").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
                    F.length("learnt").cast("bigint").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (spiece.encode(docs, tokenizer_file("piece_bpe_32k.model"))
            .select("doc_id", (F.octet_length("packed_ids") / 4).cast("bigint").alias("n_tokens"),
                    F.sha2("packed_ids", 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return (langid.identify(docs.select("doc_id", "text"), langid.train(docs))
            .select("doc_id", quality_gam.held_out().alias("held_out"), "lang_pred", "score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"), min_count=10, max_words=3, share=50, top=2000)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(read_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, cap=3)
            .select("doc_id", "size", "source_size", "target", "taken"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"), min_docs=3, top=200)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_quality_classifier, op3_token_counts, op4_license_scan, op5_document_fingerprints,
    op6_decontamination, op7_chat_format, op8_sentencepiece, op9_line_dedup, op10_language_id,
    op11_collocations, op12_source_mix, op13_source_divergence)}
