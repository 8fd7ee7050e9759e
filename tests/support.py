"""Shared helpers of the tests and of ``tools/verify.py``."""

from __future__ import annotations

import datetime
import decimal
import math
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_spark() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("lakebook")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lakebook-tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck_tables(duck, sf_dir: str):
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        duck.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return duck


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.10g}"
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.10g}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def compare(df: DataFrame, duck, sql: str | None) -> str | None:
    """None when both agree on columns and, in any order, on rows; else what differs."""
    rows = df.collect()
    if sql is None:
        return None if rows else "no rows"
    cursor = duck.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(set(df.columns) ^ set(expected_names))}"
    place = [expected_names.index(c) for c in df.columns]
    ours = sorted(tuple(map(_cell, r)) for r in rows)
    theirs = sorted(tuple(_cell(r[i]) for i in place) for r in expected)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    if not rows:
        return "no rows on either side"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} <> {b}"
    return None
