"""From documents to packed sequences: quality, rules, line dedup, near-dedup and packing, one after the other.

Every stage takes what its predecessor kept and, but for the last, returns it with all its columns.
Extra columns pass through, whatever their names. A stage that gets no rows returns none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import classifier, lines, packing, rules, simhash
from wattloom.llm.common import prepare, written
from wattloom.session import configure


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, trained on the labelled rows, predicts to be bad."""
    prepare(configure(spark))
    return classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or a certified cutoff."""
    prepare(configure(spark))
    return rules.kept_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes near-repeated lines out of the texts. Rows stay, be their text empty; n_chars, where it
    is, counts what is left."""
    prepare(configure(spark))
    out = lines.deduplicated(docs)
    return lines.with_length(out, "n_chars") if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    prepare(configure(spark))
    return simhash.one_per_component(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document's pieces in sequences of 4096 tokens."""
    prepare(configure(spark))
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Models, hashes and tokenizers are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name)
    return docs
