"""``attach_events`` where keys repeat on both sides."""

from pyspark.sql import functions as F

from lakebook.operators import attach_events

ON = (("k", "ek"), ("d", "ed"))


def many(spark):
    """One key with a third of the rows, keys on one side only, missing keys, equal rows."""
    rows = spark.range(600).select(
        (F.col("id") % 150).alias("id"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 != 0, F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 11 != 0, "x").alias("d"),
    )
    events = spark.range(200).select(
        F.when(F.col("id") % 4 == 0, 1).when(F.col("id") % 5 != 0, F.col("id") % 50).alias("ek"),
        F.when(F.col("id") % 13 != 0, "x").alias("ed"),
        (F.col("id") % 90).alias("event"),
    )
    return rows, events


def plainly(rows, events):
    return rows.join(events, (F.col("k") == F.col("ek")) & (F.col("d") == F.col("ed")), "left")


def values(df):
    return sorted(map(str, df.collect()))


def test_dealt_join_has_the_same_rows(spark):
    rows, events = many(spark)
    expected = plainly(rows, events)
    for task_rows in (40, 400, 700):  # many slices, some, none but more tasks than cores
        joined = attach_events(rows, events, ON, task_rows=task_rows)
        assert joined.columns == expected.columns
        assert values(joined) == values(expected)


def test_columns_of_one_name_on_both_sides_stay(spark):
    rows, events = (df.withColumn("stamp", F.lit(1)) for df in many(spark))
    joined = attach_events(rows, events, ON, task_rows=40)
    assert joined.columns == plainly(rows, events).columns
    assert values(joined) == values(plainly(rows, events))


def test_no_task_makes_most_of_the_result(spark):
    rows, events = many(spark)
    joined = attach_events(rows, events, ON, task_rows=100)
    by_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    # The crowded key makes some 9,000 rows, which one task made before.
    assert sum(by_task) > 9_000 and max(by_task) < 1_000


def test_size_may_come_from_other_rows(spark):
    rows, events = many(spark)
    joined = attach_events(rows.where("id % 2 = 0"), events, ON, sized_by=rows, task_rows=40)
    assert values(joined) == values(plainly(rows.where("id % 2 = 0"), events))
