"""A training-corpus pipeline over `documents`: five operators in a row.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its
result is written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orebridge.llm import decontaminate, langid, linededup, packing, simhash
from orebridge.llm.queries import MAX_BITS, SHINGLE_WORDS, vocabulary
from orebridge.session import scratch_path
from orebridge.sources import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter (null texts too) go, and only these; lang becomes the
    prediction, or stays where no language could be learned (score 0)."""
    named = langid.identify_language(docs).where("has_letters")
    return named.withColumn("lang", F.expr("if(score > 0, lang_pred, lang)")).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated line chunks go from the texts; documents left without a word go. n_chars
    follows the cleaned text."""
    return linededup.with_length(linededup.dedup_lines(docs))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest doc_id."""
    return simhash.keep_one_per_component(docs, SHINGLE_WORDS, MAX_BITS)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in their sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("simhash_dedup", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("packing", pack),
]

# Suffix automata, fingerprints and tokenizer ids have no SQL form; tests compare the
# stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
