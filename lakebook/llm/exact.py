"""Exact dedup by skew-safe combining.

Equal texts meet in three steps, and each compares them in full, as the text itself is a
grouping key. Every task first keeps one winner of each text it reads. Winners then meet in
salted digest groups, so a text that a third of all rows have arrives in ``SALTS`` tasks,
from each task once. Last, the few salt winners are combined. The digest only names a
text: where two different texts had one digest, both are told apart by their content again.

Only DataFrame functions. The texts are shuffled twice, once for each distinct text and
task, then for each distinct text and salt; ids meet their winner by digest alone, through
a join that Spark can split where one digest is crowded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import pick, whole_text

SALTS = 32

Change = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(docs: DataFrame, normal: Change | None, digest: Change, id_col: str, text_col: str) -> DataFrame:
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", whole_text())
    if normal is not None:
        rows = rows.withColumn("text", F.coalesce(normal(F.col("text")), F.lit("")))
    return rows.withColumn("digest", digest(F.col("text")))


def _winners(rows: DataFrame, salts: int) -> DataFrame:
    """``digest, text, keep, n`` of every distinct text: the largest id and the number of rows."""
    salted = rows.withColumn("salt", F.spark_partition_id() % salts)
    # Combined in the tasks that read, then by salt; both times by the whole text.
    merged = salted.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("n")
    )
    return merged.groupBy("digest", "text").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))


def exact_groups(
    docs: DataFrame,
    normal: Change | None = None,
    digest: Change = sha256,
    salts: int = SALTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for every row of ``docs``.

    Texts are equal if they are identical after ``normal``. ``keep_id`` is the largest id of
    the equal texts and stays. Null counts as empty. A row without an id has copies like
    any other but is kept only where none of its group has an id (``keep_id`` is then
    null). Rows that repeat id and text count each in ``group_size`` and are all marked
    alike: they are one document. An empty table gives no rows; other columns are ignored.
    """
    rows = _rows(docs, normal, digest, id_col, text_col)
    by_digest = _winners(rows, salts).groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep").alias("keep_id"), F.sum("n").alias("group_size")
    )
    # Written, so that the join has an exchange on either side and can split a crowded digest.
    groups = materialize(by_digest, "digest-groups")
    found = rows.join(groups.where("texts = 1"), "digest").select("doc_id", "digest", "keep_id", "group_size")
    clash = groups.where("texts > 1").select("digest")
    if clash.limit(1).count():
        mixed = materialize(rows.join(clash, "digest", "left_semi"), "clashing-texts")
        apart = materialize(_winners(mixed, salts), "clashing-groups")
        told = mixed.join(apart, ["digest", "text"])
        found = found.union(told.select("doc_id", "digest", F.col("keep").alias("keep_id"), F.col("n").alias("group_size")))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def distinct_texts(
    docs: DataFrame,
    normal: Change | None = None,
    salts: int = SALTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, text, copies``: one row for each text, with the id that stays.

    ``text`` is the normalised one. Other rules as in ``exact_groups``.
    """
    winners = _winners(_rows(docs, normal, sha256, id_col, text_col), salts)
    return winners.select(F.col("keep").alias("doc_id"), "text", F.col("n").alias("copies"))
