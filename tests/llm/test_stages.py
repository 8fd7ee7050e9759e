"""Pipeline stages on odd rows, and conversations and urls of the same kind."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from lakebook.llm.chat import prefix_target_examples, read_back
from lakebook.llm.common import read
from lakebook.llm.urls import build_index, filter_urls

LONG = " ".join(f"w{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(20))
ODD = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, text_key string, doc string, h long"


@pytest.fixture(scope="module")
def exact_names(spark):
    """Columns that differ in case alone are different ones."""
    spark.conf.set("spark.sql.caseSensitive", "true")
    yield
    spark.conf.set("spark.sql.caseSensitive", "false")


@pytest.fixture(scope="module")
def leak(spark, sf_dir):
    return max((r.text for r in read(spark, sf_dir, "benchmark").collect()), key=len)


@pytest.fixture(scope="module")
def rows(leak):
    return [
        (1, None), (2, ""), (None, None), (3, f"one {PASSAGE}"), (4, f"two {PASSAGE} end"), (5, "same text here"),
        (5, "same text here"), (None, "same text here"), (6, f"So {leak} there"), (6, "an innocent text of the same id"),
        (None, f"Well {leak} so"), (7, LONG), (8, " \n\t "),
    ]


@pytest.fixture(scope="module")
def odd(spark, rows, exact_names):
    return spark.createDataFrame([(*r, "en", "web", 1, "x", "k", "d", 1) for r in rows], ODD)


def kept(result):
    assert set(result.columns) == set(pipeline.COLUMNS)
    return sorted(((r.doc_id, r.text) for r in result.collect()), key=str)


STAGES = dict(pipeline.STAGES)


@pytest.mark.parametrize("name", list(STAGES))
def test_an_empty_table(spark, sf_dir, odd, name):
    assert STAGES[name](spark, odd.limit(0), sf_dir).collect() == []


def test_toxicity_keeps_odd_rows(spark, sf_dir, odd, rows):
    assert kept(STAGES["toxicity"](spark, odd, sf_dir)) == sorted(rows, key=str)


def test_near_dedup_of_odd_rows(spark, sf_dir, odd, rows):
    got = kept(STAGES["simhash_near_dedup"](spark, odd, sf_dir))
    # 1, 2 and 8 have no words; the repeated row counts once; rows without an id stay
    gone = [(2, ""), (8, " \n\t "), (5, "same text here")]
    want = list(rows)
    for row in gone:
        want.remove(row)
    assert got == sorted(want, key=str)


def test_substrings_of_odd_rows(spark, sf_dir, odd):
    got = kept(STAGES["substring_dedup"](spark, odd, sf_dir))
    assert (4, "two end") in got and (3, f"one {PASSAGE}") in got and (1, "") in got and (None, "") in got
    assert got.count((5, "same text here")) == 2 and (None, "same text here") in got and len(got) == 13


def test_leaks_of_odd_rows(spark, sf_dir, odd, rows, leak):
    got = kept(STAGES["decontamination"](spark, odd, sf_dir))
    # by text: the one without an id goes, the other text of id 6 stays
    assert got == sorted((r for r in rows if leak not in (r[1] or "")), key=str)


def test_packing_of_odd_rows(spark, sf_dir, odd, rows):
    pieces = STAGES["packing"](spark, odd, sf_dir).collect()
    first = [p for p in pieces if p.piece == 0]
    assert len(first) == len(rows) and sum(p.length == 1 for p in first) == 3
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(places, places[1:]))


def test_conversations_without_an_id_and_repeated_rows(spark, exact_names):
    turns = [
        (None, 0, "user", "hi"), (None, 0, "user", "hi"), (None, 1, "assistant", "ho"), (1, 0, "user", None),
        (1, 1, "assistant", "yes"), (1, 1, "assistant", "yes"), (2, None, None, ""), (3, 0, "assistant", LONG),
    ]
    frame = spark.createDataFrame(
        [(*t, "x", 7, 8) for t in turns], "conv_id long, turn int, role string, text string, TEXT string, lone int, example int"
    )
    got = sorted(((r.conv_id, r.n_turns, r.loss_chars) for r in read_back(prefix_target_examples(frame)).collect()), key=str)
    assert got == sorted([(None, 1, 0), (None, 1, 0), (None, 1, 2), (1, 3, 6), (2, 1, 0), (3, 1, len(LONG))], key=str)
    digests = {r.conv_id: r.turns_sha256 for r in read_back(prefix_target_examples(frame)).collect()}
    assert digests[1] == hashlib.sha256(b"user\n\nassistant\nyes\nassistant\nyes\n").hexdigest()
    assert prefix_target_examples(frame.limit(0)).collect() == []


def test_a_third_of_all_turns_without_an_id_is_no_group(spark):
    turns = spark.range(3_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 500).alias("conv_id"), F.col("id").cast("int").alias("turn"),
        F.lit("assistant").alias("role"), F.lit("yes").alias("text"),
    )
    sizes = read_back(prefix_target_examples(turns)).groupBy(F.col("conv_id").isNull().alias("lone")).agg(
        F.count(F.lit(1)).alias("n"), F.max("n_turns").alias("most")
    )
    assert {(r.lone, r.n, r.most) for r in sizes.collect()} == {(True, 1000, 1), (False, 500, 4)}


def test_pages_without_an_id_and_repeated_rows(spark, exact_names):
    rules = spark.createDataFrame([("com/", "block")], "rule string, verdict string")
    rows = [(None, "http://a.com/x"), (1, None), (1, None), (2, ""), (2, "http://A.COM"), (3, "http://b.org/" + "x" * 100_000)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, URL string, rule string")
    got = sorted(((r.page_id, r.host, r.verdict) for r in filter_urls(pages, build_index(rules)).collect()), key=str)
    assert got == sorted(
        [(None, "a.com", "block"), (1, "", "allow"), (1, "", "allow"), (2, "", "allow"), (2, "a.com", "allow"), (3, "b.org", "allow")],
        key=str,
    )
    assert filter_urls(pages.limit(0), build_index(rules)).collect() == []
