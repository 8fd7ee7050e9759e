"""Operators against hand-made rows and against a plain formulation of the same thing."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakebook.config import SENSOR_KM
from lakebook.operators import (
    BookSpec,
    Family,
    anchor_measure,
    assign_nearest,
    attach_events,
    duplicate_report,
    feature_book,
    filter_new,
    latest_version,
    nearest_sensor,
    numbered_rows,
    segment_table,
    segments,
)
from lakebook.plans import BOOK_SPEC
from tools.direct_book import feature_book_direct


def rows(df):
    return sorted(df.collect(), key=lambda r: tuple((v is None, str(v)) for v in r))


# --- increments ----------------------------------------------------------------------


def test_only_strictly_later_rows_are_new(spark):
    days = ["2024-01-30", "2024-01-31", "2024-02-01", None]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    assert [r.d for r in filter_new(df, "d", "2024-01-31").collect()] == ["2024-02-01"]
    assert filter_new(df, "d", None).count() == 3


# --- dedup ---------------------------------------------------------------------------


def max_and_join(df):
    best = df.groupBy("k").agg(F.max("v").alias("best"))
    return df.join(best, "k").where("v = best").select("k", "v", "x")


def test_ties_stay_and_nulls_drop(spark):
    data = [(1, "v1", 1), (1, "v2", 2), (1, "v2", 3), (None, "v1", 4), (2, None, 5), (3, "v0", 6)]
    df = spark.createDataFrame(data, "k int, v string, x int")
    assert [tuple(r) for r in rows(latest_version(df, "k", F.col("v")))] == [
        (1, "v2", 2), (1, "v2", 3), (3, "v0", 6)]


def test_later_month_wins_whatever_the_load_stamp(spark):
    df = spark.createDataFrame([(1, 202401, "20240901"), (1, 202402, "20240201")],
                               "k int, ref int, dt string")
    version = F.concat(F.col("ref").cast("string"), "dt")
    assert [r.ref for r in latest_version(df, "k", version).collect()] == [202402]


def test_crowded_keys_and_ties(spark):
    """One key holds a third of the rows, many of them exact copies."""
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 42).otherwise(F.col("id") % 400).cast("int").alias("k"),
        F.concat(F.lit("v"), (F.col("id") % 7).cast("string")).alias("v"),
        (F.col("id") % 5).alias("x"),
    )
    got = latest_version(df, "k", F.col("v"))
    assert rows(got) == rows(max_and_join(df))


def test_duplicate_report(spark):
    df = spark.createDataFrame([(k,) for k in [1, 1, 1, 2, 2, 3, 3, 4, 5, 6]], "k int")
    assert [tuple(r) for r in duplicate_report(df, "k").collect()] == [
        (1, 3), (2, 2), (3, 2), (4, 1), (5, 1)]


# --- nearest sensor ------------------------------------------------------------------


def brute_force(position):
    """Closest sensor, the higher one on a tie; none outside the two caps."""
    if position is None or not Decimal("525.25") <= position <= Decimal("544.55"):
        return None
    return min(SENSOR_KM, key=lambda s: (abs(s - position), -s))


def test_segments_are_midpoints_with_mirrored_ends():
    found = segments(SENSOR_KM)
    assert (found[0].low, found[0].high) == (Decimal("525.250"), Decimal("526.550"))
    assert (found[-1].low, found[-1].high) == (Decimal("541.850"), Decimal("544.550"))
    assert [s.last for s in found] == [False] * 14 + [True]


def test_every_position_of_the_road(spark):
    table = spark.createDataFrame([(40, s) for s in SENSOR_KM], "road int, km decimal(14,3)")
    positions = [Decimal(m) / 1000 for m in range(524000, 546001)] + [None]
    df = spark.createDataFrame([(40, p) for p in positions], "road int, at decimal(14,3)")
    by_case = df.withColumn("sensor_km", nearest_sensor(F.col("at"), SENSOR_KM))
    expected = {p: brute_force(p) for p in positions}
    assert {r["at"]: r.sensor_km for r in by_case.collect()} == expected
    for cell in (0.1, 1.0, 50.0):
        joined = assign_nearest(df, "road", "at", segment_table(table, "road", "km"), cell)
        got = joined.collect()
        assert len(got) == len(positions)
        assert {r["at"]: r.sensor_km for r in got} == expected


def test_one_sensor_covers_its_own_position_only(spark):
    df = spark.createDataFrame([(Decimal("1.000"),), (Decimal("1.001"),)], "at decimal(14,3)")
    got = df.select(nearest_sensor(F.col("at"), [Decimal("1.000")]).alias("s")).collect()
    assert [r.s for r in got] == [Decimal("1.000"), None]


# --- join ----------------------------------------------------------------------------


def test_left_join_fans_out_and_keeps_unmatched(spark):
    flow = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "f int, k string")
    events = spark.createDataFrame([(10, "a"), (11, "a"), (12, None)], "e int, j string")
    got = attach_events(flow, events, [("k", "j")]).select("f", "e")
    assert [tuple(r) for r in rows(got)] == [(1, 10), (1, 11), (2, None), (3, None)]


# --- anchors and row numbers ---------------------------------------------------------


def many_copies(spark):
    """Days of very different size; half of the biggest day are exact copies."""
    return spark.range(2000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, "d0")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("d"), (F.col("id") % 11).cast("string")))
        .alias("day"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 17).alias("acc"),
        (F.col("id") % 4).alias("x"),
    )


def in_order():
    return [F.asc_nulls_last("acc"), F.asc_nulls_last("x")]


def test_one_anchor_per_day_even_among_copies(spark):
    df = many_copies(spark)
    got = anchor_measure(df, "day", ("acc", "x"), F.countDistinct("acc"), "n")
    day = Window.partitionBy("day")
    first = df.withColumn("rn", F.row_number().over(day.orderBy(*in_order())))
    counts = df.groupBy("day").agg(F.countDistinct("acc").alias("c"))
    expected = first.join(counts, "day", "left").select(
        "day", "acc", "x", F.when(F.col("rn") == 1, F.col("c")).alias("n")
    )
    assert rows(got) == rows(expected)
    assert got.where("n is not null").count() == df.where("day is not null").select("day").distinct().count()


def test_day_without_accidents_is_anchored_with_zero(spark):
    df = spark.createDataFrame(
        [("d1", 7, 1), ("d1", 5, 2), ("d1", None, 3), ("d2", None, 4), ("d2", None, 5)],
        "day string, acc long, x long")
    got = anchor_measure(df, "day", ("acc", "x"), F.countDistinct("acc"), "n")
    assert {r.x: r.n for r in got.collect()} == {1: None, 2: 2, 3: None, 4: 0, 5: None}


def test_row_numbers_equal_the_plain_window(spark):
    df = many_copies(spark)
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("day").orderBy(*in_order())))
    assert rows(numbered_rows(df, "day", in_order())) == rows(plain)


# --- book ----------------------------------------------------------------------------

SMALL_SPEC = BookSpec(
    keys=("k",),
    families=(Family("c", ("A", "B"), skip=("m",)), Family("d", ("X",))),
    measures=("m", "n"),
    windows=(None, "w1", "w2"),
)

small_int = st.none() | st.integers(-5, 5)
book_row = st.tuples(
    st.sampled_from([1, 2, None]),
    st.sampled_from(["A", "B", "other", None]),
    st.sampled_from(["X", "Y", None]),
    small_int,
    small_int,
    st.integers(0, 1),
    st.integers(0, 1),
)


@settings(
    max_examples=6,
    deadline=None,
    phases=[Phase.generate],  # every example is a Spark job: no shrinking
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(book_row, min_size=1, max_size=30))
def test_book_equals_the_direct_aggregate(spark, data):
    df = spark.createDataFrame(data, "k int, c string, d string, m long, n long, w1 int, w2 int")
    book, direct = feature_book(df, SMALL_SPEC), feature_book_direct(df, SMALL_SPEC)
    assert book.schema == direct.schema or book.dtypes == direct.dtypes
    assert rows(book) == rows(direct)


def test_class_without_rows_is_all_null(spark):
    df = spark.createDataFrame([(1, None, None, 1, 1, 1, 1)],
                               "k int, c string, d string, m long, n long, w1 int, w2 int")
    row = feature_book(df, SMALL_SPEC).first()
    assert row.k == 1 and all(v is None for v in row[1:])


def test_feature_numbering():
    cells = list(BOOK_SPEC.cells())
    assert len(BOOK_SPEC.feature_names()) == 408
    # n = 24 * block + 4 * window + aggregate; the class names are fixed values
    first_of_block = [(c[1], c[2][:3]) for c in cells[::6]]
    assert first_of_block == [
        ("FLUXO_BAIXO", "fvl"), ("FLUXO_MEDIO", "fvl"), ("FLUXO_ALTO", "fvl"),
        ("VELOCIDADE_BAIXA", "flv"), ("VELOCIDADE_BAIXA", "fvl"),
        ("VELOCIDADE_MEDIA", "flv"), ("VELOCIDADE_MEDIA", "fvl"),
        ("VELOCIDADE_ALTA", "flv"), ("VELOCIDADE_ALTA", "fvl"),
        ("VEICULO_COMERCIAL", "flv"), ("VEICULO_COMERCIAL", "fvl"),
        ("VEICULO_PASSEIO", "flv"), ("VEICULO_PASSEIO", "fvl"),
        ("VEICULO_MOTO", "flv"), ("VEICULO_MOTO", "fvl"),
        ("VEICULO_ONIBUS", "flv"), ("VEICULO_ONIBUS", "fvl"),
    ]
    assert [c[3] for c in cells[:6]] == [
        None, "flg_u1m", "flg_u3m", "flg_u6m", "flg_u9m", "flg_u12m"]
    assert BOOK_SPEC.aggregates == ("SUM", "AVG", "MIN", "MAX")
