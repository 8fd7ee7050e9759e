"""Stored partials, merged layers, mergeable counts: each against the plain computation."""

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakebook.operators import (
    bitmap_counts,
    collisions,
    distinct_bitmaps,
    duplicate_report,
    top_duplicates,
)
from lakebook.plans import compact_month, rollup, run_month, shared_flow_ids
from lakebook.plans.month import read_book
from lakebook.plans.trusted import read_current
from lakebook.runwindow import RunWindow
from lakebook.schemas import ACCIDENTS_TRUSTED, flow_trusted
from tests.test_lake import accident_record, flow_record, lake_at, stage_rows

MD5 = {"id_mode": "md5"}


def book_rows(spark, lake, ref):
    return sorted(map(str, read_book(spark, lake).where(F.col("ref") == ref).collect()))


def months(spark, tmp_path, monkeypatch, deliveries):
    """The same deliveries with full and with incremental books: equal each month; months read."""
    read, real = [], rollup.refresh_days
    monkeypatch.setattr("lakebook.plans.month.refresh_days", lambda *a: read.append(real(*a)))
    for name in ("full", "incremental"):
        (tmp_path / name).mkdir()
    for as_of, stamp, flow, accidents in deliveries:
        books = []
        for name in ("full", "incremental"):
            lake = lake_at(tmp_path / name, flow, accidents)
            run_month(spark, lake, as_of, stamp, book=name, **MD5)
            books.append(book_rows(spark, lake, RunWindow.of(as_of).ref))
        assert books[0] == books[1]
    return read, lake


@pytest.fixture
def flow():
    rng = random.Random(4)
    days = ["10/10/2023", "15/03/2024", "16/03/2024", "01/08/2024", "10/09/2024", "11/09/2024"]
    speeds, kinds = ["51 - 80 KM", "101 - 120 ", "other"], ["Moto", "Ônibus", "Passeio"]
    return [
        flow_record(day, rng.choice([527.2, 529.1]), rng.randint(0, 300), rng.choice(kinds), rng.choice(speeds))
        for day in days for _ in range(4)
    ]


def test_incremental_books_equal_full_ones(spark, tmp_path, monkeypatch, flow):
    accidents = [accident_record(7, "2024-03-15", "527,3"), accident_record(5, "2024-09-10", "526,9")]
    later = flow + [flow_record("02/10/2024", 529.1, 10), flow_record("03/10/2024", 527.2, 20)]
    # accident 7 comes again, now in October: it no longer counts in March
    moved = accidents + [accident_record(7, "2024-10-02", "529,1")]
    read, lake = months(spark, tmp_path, monkeypatch, [
        (date(2024, 9, 30), "20240930120000", flow, accidents),
        (date(2024, 10, 31), "20241031120000", later, moved),
        (date(2024, 10, 31), "20241031130000", later, moved),
    ])
    assert read == [[202310, 202403, 202408, 202409], [202403, 202410], []]
    # the year rolls on: October 2023 leaves the windows, nothing old is read
    more = later + [flow_record("05/11/2024", 527.2, 120)]
    (tmp_path / "on").mkdir()
    read.clear()
    lake = lake_at(tmp_path / "incremental", more, moved)
    run_month(spark, lake, date(2024, 11, 30), "20241130120000", book="incremental", **MD5)
    assert read == [[202411]]
    lake = lake_at(tmp_path / "full", more, moved)
    run_month(spark, lake, date(2024, 11, 30), "20241130120000", **MD5)
    full = book_rows(spark, lake, 202411)
    assert full and full == book_rows(spark, lake_at(tmp_path / "incremental", more, moved), 202411)


def test_an_incremental_book_looks_forward_only(spark, tmp_path, flow):
    lake = lake_at(tmp_path, flow, [accident_record(7, "2024-03-15", "527,3")])
    with pytest.raises(ValueError):
        run_month(spark, lake, date(2024, 9, 30), "20240930120000", book="incremental")
    run_month(spark, lake, date(2024, 9, 30), "20240930120000", book="incremental", **MD5)
    with pytest.raises(ValueError):
        run_month(spark, lake, date(2024, 8, 31), "20240930130000", book="incremental", **MD5)


def test_the_merged_layer_gives_the_same_stage_from_fewer_rows(spark, tmp_path, flow):
    accidents = [accident_record(7, "2024-03-15", "527,3"), accident_record(5, "2024-09-10", "526,9")]
    lake, as_of = lake_at(tmp_path, flow, accidents), date(2024, 9, 30)
    for stamp in ("20240930120000", "20240930130000", "20240930140000"):
        run = run_month(spark, lake, as_of, stamp, conform="all").run
    before = sorted(str(r.asDict() | {"dt_proc": 0}) for r in stage_rows(spark, lake).collect())

    def read(subject, schema):
        return read_current(spark, lake.trusted(subject), schema, run.first_ref, run.ref)

    whole = read("fluxo", flow_trusted()).count()
    assert whole == 3 * len(flow)
    assert compact_month(spark, lake, run) == {"fluxo": [202310, 202403, 202408, 202409], "acidentes": [202403, 202409]}
    assert compact_month(spark, lake, run) == {"fluxo": [], "acidentes": []}
    assert read("fluxo", flow_trusted()).count() == len(flow) and read("acidentes", ACCIDENTS_TRUSTED).count() == 2
    run_month(spark, lake, as_of, "20240930150000")
    assert before == sorted(str(r.asDict() | {"dt_proc": 0}) for r in stage_rows(spark, lake).collect())
    # a further load makes its months stale: their loads are read again until they are merged
    run_month(spark, lake, as_of, "20240930160000", conform="all")
    assert read("fluxo", flow_trusted()).count() == 4 * len(flow)
    assert before == sorted(str(r.asDict() | {"dt_proc": 0}) for r in stage_rows(spark, lake).collect())


def test_merged_distinct_counts(spark):
    rng = random.Random(6)
    spread = [0, 1, -1, 32_767, 32_768, 32_769, -32_768, 2**40, -(2**40), None]
    rows = [(rng.choice("abc"), rng.choice([rng.choice(spread), rng.randint(-9, 9)])) for _ in range(500)] + [("d", None)]
    frame = spark.createDataFrame(rows, "k string, v bigint")
    parts = [distinct_bitmaps(frame.where(F.pmod(F.hash("v", "k"), F.lit(3)) == i), ["k"], F.col("v")) for i in range(3)]
    got = dict(bitmap_counts(parts[0].union(parts[1]).union(parts[2]).union(parts[0]), ["k"], "n").collect())
    assert got == {k: len({v for x, v in rows if x == k and v is not None}) for k in "abcd"}


@pytest.mark.parametrize("top", [1, 5, 50])
def test_top_duplicates_equal_the_full_count(spark, top):
    rng = random.Random(8)
    skewed = [(rng.choice([1, 1, 1, 2, 2, 3, rng.randrange(5_000), None]),) for _ in range(6_000)]
    flat = [(i,) for i in range(3_000)]
    few = [(1,), (2,), (2,), (None,)]
    for rows in (skewed, flat, few, few[:0]):
        frame = spark.createDataFrame(rows, "id bigint").repartition(4)
        got, want = top_duplicates(frame, "id", top), duplicate_report(frame, "id", top)
        assert got.collect() == want.collect()
    assert top_duplicates(spark.createDataFrame(skewed, "id bigint"), "id", 1).first().qtd == Counter(skewed).most_common(1)[0][1]


def test_records_that_share_an_id(spark, tmp_path, flow):
    rows = [(1, "a", None), (1, "a", None), (2, "a", "b"), (2, "ab", ""), (3, None, "x"), (3, "x", None), (None, "q", "r"), (None, "s", "t")]
    frame = spark.createDataFrame(rows, "id int, x string, y string")
    got = {tuple(r) for r in collisions(frame, "id", [F.col("x"), F.col("y")]).collect()}
    assert got == {(2, 2), (3, 2), (None, 2)}
    # without a town the 32-bit id of every record is the same
    nameless = [dict(r, municipio="") for r in flow]
    lake = lake_at(tmp_path, nameless, [])
    report = run_month(spark, lake, date(2024, 9, 30), "20240930120000", check_ids=True)
    assert report.shared_ids == 1
    assert [r.qtd for r in shared_flow_ids(spark, lake, report.run).collect()] == [len(flow)]
