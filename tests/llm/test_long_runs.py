"""Texts of one kind of word only: a table of names, a column of numbers."""

from pyspark.sql import functions as F

from lakebook.llm.decontaminate import canonical, find_leaks

WORDS = 20_000


def test_runs_of_names_and_numbers_are_one_placeholder(spark):
    texts = {"names": "Abc " * WORDS, "numbers": "7 " * WORDS, "points": "1.5, 2 " * WORDS}
    rows = spark.createDataFrame(list(texts.items()), "kind string, text string")
    named = {r.kind: r.template for r in rows.select("kind", F.trim(canonical(F.col("text"))[0]).alias("template")).collect()}
    assert named == {"names": "<name>", "numbers": "<num>", "points": "<num>"}


def test_a_leak_behind_a_long_run_of_names_is_found(spark):
    item = "a train leaves the old station and travels north for several hours without any stop"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = spark.createDataFrame([(7, "Abc " * WORDS + ". " + item), (8, "Abc " * WORDS)], "doc_id bigint, text string")
    assert [(r.doc_id, r.item_id, r.start_word) for r in find_leaks(docs, items).collect()] == [(7, 1, WORDS)]
