"""The registered operator queries: each applies its operator, with production parameters,
to its whole table and derives the fixed result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orebridge.llm import (chat, decontaminate, hardnegatives, langid, linededup, merkle, packing,
                           qualitymodel, qualityrules, secrets, simhash, toxicity, urlfilter)
from orebridge.llm.common import held_out
from orebridge.sources import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Values of the fixed results.
SHINGLE_WORDS, MAX_BITS = 4, 4


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


def vocabulary() -> str:
    """Path of the packing query's public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind_no"] < len(secrets.BASE_RULES))
    return rows.select(
        "doc_id", *[secrets.count_kind("secrets", r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES],
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.col("secrets")).alias("spans"))


@register("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), vocabulary())


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.detect_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return rows.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@register("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityrules.run_cascade(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify_language(docs).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register("op6_chat_format")
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "\\### Assistant: </turn> ok"         # the fixed extra conversation
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    messages = chat.thread_messages(rows.unionByName(extra))
    return chat.conversation_digests(chat.format_conversations(messages))


@register("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(read_table(spark, sf_dir, "documents"),
                                       read_table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)


@register("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the two columns the result needs: the operator shuffles what it is given, once
    rows = linededup.remove_repeated_chunks(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.coalesce("__llm_removed", F.array().cast("array<struct<first:int,stop:int>>"))
    return rows.select(
        "doc_id", F.size(gone).cast("long").alias("n_removed_chunks"),
        F.size(F.array_distinct(F.flatten(F.transform(      # windows overlap
            gone, lambda r: F.sequence(r["first"], r["stop"] - 1))))).cast("long").alias("n_removed_lines"),
        F.array_join(F.transform(gone, lambda r: F.concat_ws(":", r["first"].cast("string"),
                                                             r["stop"].cast("string"))), ",").alias("removed_lines"),
        F.length("text").cast("long").alias("kept_chars"), "text")


@register("op10_quality_model")
def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = qualitymodel.classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return rows.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@register("op11_merkle_manifest")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampered copies have one character more in n_chars where 7 divides crc32(doc_id)."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    rows = merkle.prove_documents(read_table(spark, sf_dir, "documents"), {"n_chars": more}, tampered)
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", "verified")


@register("op12_hard_negatives")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False))
    rows = read_table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(moved, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long")))
    return hardnegatives.mine_hard_negatives(rows, "vec_id", "embedding", "label", F.col("vec_id") % 50 == 0)


# The rules of the URL query.
URL_RULES = [urlfilter.Rule("allow", "org", "/"), urlfilter.Rule("block", "example.org", "/es/"),
             urlfilter.Rule("block", "example.org", "/en/1"), urlfilter.Rule("allow", "com", "/fr/"),
             urlfilter.Rule("block", "com", "/de/")]


@register("op13_url_filter")
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = urlfilter.judge_pages(*[read_table(spark, sf_dir, t) for t in ("pages", "documents", "labels")], URL_RULES)
    return rows.select("page_id", "host", "path", "rule", "verdict")
