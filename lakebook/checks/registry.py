"""Registered queries: a Spark callable and, where SQL can say it, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"{name} is registered twice")
        CHECKS[name] = Check(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, which every client compares alike."""

    def flat(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(field.name, "yyyy-MM-dd").alias(field.name)
        return F.col(field.name)

    return df.select(*map(flat, df.schema.fields))
