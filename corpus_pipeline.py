"""Corpus pipeline: raw documents to packed training sequences.

Five stages, each a function of (spark, docs, sf_dir) over all that the one before kept.
All but the last return the columns of ``documents``; each result is written as Parquet
on shared storage and read again, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebook.llm.common import pick, read, whole_text
from lakebook.llm.decontaminate import find_leaks
from lakebook.llm.packing import pack
from lakebook.llm.queries import tokenizer_path
from lakebook.llm.simhash import simhash_components
from lakebook.llm.substrings import dedup_substrings
from lakebook.llm.toxicity import score_toxicity
from lakebook.scratch import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = ("lang", "source")

# No SQL for trees, word hashes with a seed or a tokenizer; tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject, unchanged.

    A row goes by its id and text, so of two texts under one id each is judged for itself,
    and a row without an id goes, too, if its text is rejected. Repeated rows go or stay
    alike; an empty table gives no rows.
    """
    rows = pick(docs, *COLUMNS).withColumn("text_key", F.xxhash64(whole_text()))
    scored = score_toxicity(rows, read(spark, sf_dir, "labels"), carry=("text_key",))
    bad = scored.where("predicted = 1").select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key"))
    same = rows["doc_id"].eqNullSafe(F.col("bad_id")) & (rows["text_key"] == F.col("bad_key"))
    return rows.join(bad.distinct(), same, "left_anti").select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component, unchanged.

    Repeated rows count once. Rows without an id can't be told apart and stay. All texts of
    one id stay if one of them is the first of its group. An empty table gives no rows.
    """
    rows = pick(docs, *COLUMNS)
    first = simhash_components(rows).where("doc_id = component_id").select("doc_id").distinct()
    kept = rows.where("doc_id is not null").join(first, "doc_id", "left_semi").distinct()
    return kept.unionByName(rows.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that earlier documents have.

    A document of which nothing is left goes; one that was empty before stays, with an empty
    text also where it was null. Rows without an id are unchanged. Texts of one id are one
    document: a word number that goes in one of them goes in all. An empty table gives none.
    """
    cut = dedup_substrings(docs, carry=OTHERS).where("n_removed = 0 or n_removed < n_words")
    text = F.col("kept_text")
    return cut.select("doc_id", text.alias("text"), *OTHERS, F.length(text).cast("long").alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item, unchanged.

    Whether a row leaks depends on its text alone: texts are searched under their SHA-256,
    so rows without an id and several texts under one id are judged like any other. An
    empty table gives no rows.
    """
    rows = pick(docs, *COLUMNS).withColumn("text_key", F.sha2(whole_text().cast("binary"), 256))
    leaks = find_leaks(rows, read(spark, sf_dir, "benchmark"), id_col="text_key")
    bad = leaks.select(F.col("doc_id").alias("text_key")).distinct()
    return rows.join(bad, "text_key", "left_anti").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place in it.

    Rows without an id, repeated ones and empty texts (the end id alone) are packed like any
    other; an empty table gives no pieces.
    """
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_each),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
