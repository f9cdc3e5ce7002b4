"""From raw documents to packed token ids, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of documents; rows that a stage rejects are gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qoelens.llm import decontaminate, jaccard, mixing, quality_rules, token_store
from qoelens.llm.encoding import FEW, public_tokenizer
from qoelens.llm.store import small_batches
from qoelens.operators.skew import materialise
from qoelens.session import run_dir
from qoelens.telemetry import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed votes of the quality rules call good."""
    small_batches(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    small_batches(spark)
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, or one to three times."""
    small_batches(spark)
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of all documents in order, and a digest of each read back from them."""
    small_batches(spark)
    folder = run_dir(spark, "tokens")
    token_store.write(docs, folder, public_tokenizer("word_bpe_49k.json"), FEW)
    return token_store.digests(spark, folder)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mix),
    ("token_output", tokens),
]

#: Weak supervision, cube sampling and tokenization have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
