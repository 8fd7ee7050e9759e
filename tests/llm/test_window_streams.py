"""The windows of op1's streams, which go through a text together."""

import pytest
from pyspark.sql import functions as F

from lakebook.llm import decontaminate as D

TEXTS = [
    "", " ", "plain words and nothing else here", "Then Anna met Bob, Carl. Zoë and Mr. Smith (Bob) went home",
    "it took 3.5 km and 12:30 h, 10 20 30 or 7kg Anna", "ANNA\x01 \x02Bob\tmet \x04Carl!?\n«Zoë» O'Neil", "a1.2 x² ½ 5 Km/h, 3 \x02Km",
    "<num> <name> stay words, Émile. straße",
]


@pytest.fixture()
def docs(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    return rows.withColumn("key", F.xxhash64("text"))


def _rows(windows):
    return sorted(tuple(r) for r in windows.select("id", "stream", "width", "h", "pos").where("pos is not null").collect())


@pytest.mark.parametrize("widths", [[2], [2, 4]])
def test_streams_together_have_the_windows_of_each_alone(docs, widths):
    both = _rows(D._windows(docs, {"named": widths, "plain": widths}))
    assert both == sorted(_rows(D._windows(docs, {"named": widths})) + _rows(D._windows(docs, {"plain": widths})))
    assert {row[1] for row in both} == {"named", "plain"}


def test_plain_words_are_those_of_the_template(docs):
    # The long way: every step on every text.
    template = D._words(D.canonical(F.col("text"), names=False)[0])
    expected = {r.id: r.words for r in docs.select("id", template.alias("words")).collect()}
    words = D._stream_words(docs, ["named", "plain"]).where("stream = 'plain'")
    assert {r.id: r.words for r in words.collect()} == expected


def test_a_text_is_looked_over_once_for_both_streams(spark, docs, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return materialize(df, name)

    materialize = D.materialize
    monkeypatch.setattr(D, "materialize", kept)
    items = spark.createDataFrame([(1, "Then Anna met Bob, and both of them went home by the old road")], "item_id long, text string")
    assert D.find_leaks(docs.withColumnRenamed("id", "doc_id"), items).collect() == []
    (hits,) = [plan for name, plan in plans if name == "template-hits"]
    assert hits.count(", [0-9])") == 1
    assert "Union" not in hits


def test_windows_are_not_shuffled_because_of_many_partitions(spark, monkeypatch):
    # A file of digests for each partition would be 100 kB of footers.
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "32k",
    }
    before = {name: spark.conf.get(name) for name in settings}
    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return materialize(df, name)

    materialize = D.materialize
    monkeypatch.setattr(D, "materialize", kept)
    passages = [" ".join(f"{w}{chr(97 + i)}" for w in ("old", "roads", "lead", "home", "over", "many", "hills", "where", "rivers", "rest")) for i in range(20)]
    items = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string")
    texts = spark.createDataFrame([(i, f"{t} and so on") for i, t in enumerate(passages)], "doc_id long, text string")
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        leaks = D.find_leaks(texts, items)
        assert sorted((r.doc_id, r.item_id) for r in leaks.collect()) == [(i, i) for i in range(20)]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "BroadcastHashJoin" in plans["template-hits"]
    assert "SortMergeJoin" not in plans["template-hits"]
