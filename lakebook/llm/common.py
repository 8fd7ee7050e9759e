"""Helpers the corpus operators share."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import new_folder

# What separates words: ASCII white space, as bytes.split() has it.
SPACE = "\\x20\\x09-\\x0D"
# Bytes sent to the file system at once.
CHUNK = 1 << 20
# Rows that go to Python at once: whole texts are long rows, and a task holds a batch of
# them twice, in the JVM and in Python. Spark's default is ten times as many.
BATCH_ROWS = 1_000
ARROW_ROWS, DEFAULT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The first column of each exact name, whatever else the frame has.

    Extra columns go, also those whose names differ in case alone or repeat, which a
    plain ``select`` calls ambiguous.
    """
    places = [df.columns.index(name) for name in names]
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{i}").alias(n) for i, n in zip(places, names)))


def whole_text(column: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def literal_longs(values: list[int]) -> Column:
    """A constant array of bigint that parses and folds as one literal."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def uniform(*columns: Column) -> Column:
    """A repeatable number in [0, 1) for each combination of values."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    return bits.cast("double") / float(1 << 53)


def store(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a file on whatever storage ``path`` names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    for at in range(0, len(data), CHUNK):
        out.write(bytearray(data[at : at + CHUNK]))
    out.close()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, and make batches small.

    A batch size that the session sets itself is left alone.
    """
    if spark.conf.get(ARROW_ROWS) == DEFAULT_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, f"{package.name}/{file.relative_to(package)}")
    path = f"{new_folder(spark, 'package')}/{package.name}.zip"
    store(spark, path, packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
