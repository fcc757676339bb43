"""The operators of this subpackage as queries on the supplied tables."""

from __future__ import annotations

import os
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.llm import (
    automata,
    cross_polytope,
    edit_join,
    hilbert,
    hmm_score,
    mixing,
    ordinal,
    permuterm,
    rank_order,
    set_join,
    templates,
    token_files,
    whitening,
)

TOKENIZER = "word_bpe_49k.json"
VOCABULARY = 49_408
END_ID = 1
SHARDS = 40


ROOT = str(Path(__file__).resolve().parents[2])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # Python workers on this machine find the package where the driver did; a cluster gets --py-files.
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, environment.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document."""
    return hmm_score.score_texts(read(spark, sf_dir, "documents"))


def op2_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of every document, and the posteriors it rests on."""
    return mixing.rated_members(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.contamination(docs, read(spark, sf_dir, "benchmark")).drop("text")


def op4_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets and checksums of every document, read back from the token files."""
    docs = read(spark, sf_dir, "documents")
    return token_files.token_table(docs, public_tokenizers.path(TOKENIZER), END_ID, VOCABULARY)


def op5_set_relation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under a 3-word shingle similarity of 0.9."""
    return set_join.jaccard_components(read(spark, sf_dir, "documents")).drop("version", "group")


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return cross_polytope.near_vectors(read(spark, sf_dir, "embeddings"))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    dimensions = [hilbert.category(F.col("source")), hilbert.category(F.col("lang")), hilbert.magnitude(F.col("size") / 64)]
    placed = hilbert.assign_shards(docs, SHARDS, dimensions, ["doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without passages of smaller ones."""
    return automata.dedup_substrings(read(spark, sf_dir, "documents"))


def op9_segment_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and those removed as copies or near copies of earlier lines."""
    return edit_join.dedup_lines(read(spark, sf_dir, "documents"), least=1)


def op10_ordinal_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity and grade of every document."""
    docs = read(spark, sf_dir, "documents")
    model = ordinal.fit_severity(docs, read(spark, sf_dir, "labels"))
    return ordinal.score_severity(docs, model, ["doc_id"])


def op11_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    return rank_order.identify(read(spark, sf_dir, "documents"))


def op12_permuterm_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    return permuterm.group_spellings(read(spark, sf_dir, "documents"))


def op13_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    white = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hidden_markov_scores,
        op2_soft_membership_mixing,
        op3_template_decontamination,
        op4_elias_fano_tokens,
        op5_set_relation_join,
        op6_cross_polytope,
        op7_hilbert_shards,
        op8_suffix_automata,
        op9_segment_edit_join,
        op10_ordinal_severity,
        op11_rank_order_language,
        op12_permuterm_spelling,
        op13_jacobi_whitening,
    )
}
SQL: dict[str, str] = {}


