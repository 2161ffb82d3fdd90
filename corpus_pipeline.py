"""Corpus cleaning in stages, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. Null columns pass through; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmosaic.llm import common, contamination, exact, language, pieces, simhash


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learnt: those that op4 rejects (null text or no letter) go.

    Between languages of equal code length the first name wins; rows with null ids, and repeated rows, are rows like others.
    """
    trees = language.train(docs.where(~language.held_out()))
    marked = language.predict(docs, trees, keep=tuple(docs.columns), names=("__lang", "__share"))
    return marked.where(F.col("__lang") != language.UNKNOWN).drop("__lang", "__share")


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; a null id is the smallest, of rows equal in both one stays."""
    return exact.deduplicated(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; of null ids only, each text once."""
    return simhash.deduplicated(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark, repeated rows and null ids included; without items all stay."""
    return contamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and decoded of every document; a null or empty text has the end id only."""
    import public_tokenizers

    done = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))
    return done.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", known_language),
    ("exact", no_copies),
    ("near", no_near_copies),
    ("decontaminate", no_benchmark),
    ("tokenise", token_ids),
]
#: SQL can't express fuzzy keys, context trees and merge rounds; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.stage(docs, f"pipeline-{name}")
    return docs
