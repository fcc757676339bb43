"""A pipeline from documents to token files. Each stage is written as Parquet and read again.

Stages: toxicity, n-gram Jaccard join, benchmark decontamination, mixing to target weights,
token files. Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.layout import materialize
from lakestrata.llm import mixing, ordinal, set_join, templates, token_files
from lakestrata.llm.queries import END_ID, TOKENIZER, VOCABULARY, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely than not toxic to some degree go."""
    model = ordinal.fit_severity(docs, read(spark, sf_dir, "labels"))
    return ordinal.score_severity(docs, model).where("NOT toxic").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles at a similarity of 0.8, the first of each group stays."""
    return set_join.one_per_group(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whatever its numbers and names, go."""
    marked = templates.contamination(docs, read(spark, sf_dir, "benchmark"))
    return marked.where("NOT contaminated").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep a document with the chance that its domains' target weights call for.

    The draw is a hash of the row, so a rerun keeps the same rows.
    """
    rated = mixing.mix_to_targets(docs, read(spark, sf_dir, "labels"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    return rated.where(draw < F.col("rate")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Offsets and checksums of every document in the token files."""
    return token_files.token_table(docs, public_tokenizers.path(TOKENIZER), END_ID, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("tokens", tokens),
]
# Learned models and hashed draws have no SQL form; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
