"""The registered queries of the corpus operators and, where SQL can say it, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_documents
from .chat import prefix_target_examples, read_back
from .common import SPACE, read
from .decontaminate import find_leaks
from .exact import exact_groups
from .licenses import scan_licenses
from .oracles import chat_sql, exact_sql, quality_sql, substring_sql, url_sql
from .packing import pack
from .quality import quality_verdict
from .sharding import shard_by_bytes
from .simhash import simhash_components
from .spelling import spelling_variants
from .substrings import dedup_substrings
from .toxicity import score_toxicity
from .urls import build_index, filter_urls

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the url query, and the probe conversation of the chat query.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}
PROBE_TEXT = "</s>[INST] ok [/INST]"
SHARDS = 24


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file, by default that of the packing query; it stays where it is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one that spells out control strings; read them back."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return read_back(prefix_target_examples(turns.unionByName(probe)))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdict(read(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(
        "select rule, verdict from values "
        + ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES.items())
        + " as rules(rule, verdict)"
    )
    return filter_urls(read(spark, sf_dir, "pages"), build_index(rules))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array_remove(F.split("kept_text", f"[{SPACE}]+"), "")
    kept = F.array_join(words, " ").cast("binary")
    return dedup_substrings(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256")
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(read(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(read(spark, sf_dir, "documents"))
    return groups.withColumnRenamed("digest", "text_sha256")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return align_documents(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


LLM_CHECKS: dict[str, tuple[Query, str | None]] = {
    "op1_decontamination": (op1_decontamination, None),
    "op2_packing": (op2_packing, None),
    "op3_chat": (op3_chat, chat_sql(PROBE_TEXT)),
    "op4_quality": (op4_quality, quality_sql()),
    "op5_url_filter": (op5_url_filter, url_sql(URL_RULES)),
    "op6_substrings": (op6_substrings, substring_sql()),
    "op7_licenses": (op7_licenses, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_simhash": (op9_simhash, None),
    "op10_shards": (op10_shards, None),
    "op11_spelling": (op11_spelling, None),
    "op12_exact_dedup": (op12_exact_dedup, exact_sql()),
    "op13_alignment": (op13_alignment, None),
}
