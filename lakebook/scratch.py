"""Intermediate tables on the storage the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Folders that were tried, by application.
_tried: set[tuple[str, str]] = set()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the warehouse.

    A mount that a cluster shares and a folder of one machine have names alike, so where
    executors may run on other machines such a folder is tried, and refused only if the
    driver does not find in it what tasks wrote.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("spark.sql.warehouse.dir")
    root = root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        files, _ = located(spark, root)
        # Not getScheme(): only some file systems have it, the raw local one has not.
        if files.getUri().getScheme() == "file":
            _try_shared(spark, root)
    return root


def _try_shared(spark: SparkSession, root: str) -> None:
    """Once per application: more tasks than there are cores write a file each, the driver counts them."""
    key = (spark.sparkContext.applicationId, root)
    if key in _tried:
        return
    tasks = 2 * spark.sparkContext.defaultParallelism
    path = f"{root}/lakebook/tried-{uuid.uuid4().hex}"
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    files, place = located(spark, path)
    found = sum(status.getPath().getName().startswith("part-") for status in files.listStatus(place))
    remove(spark, path)
    if found < tasks:
        raise ValueError(
            f"{CHECKPOINT_DIR} must name storage that all executors share, not {root}: "
            f"of {tasks} files that tasks wrote there the driver finds {found}"
        )
    _tried.add(key)


def located(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = located(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, if it is there."""
    files, place = located(spark, path)
    files.delete(place, True)


# The innermost open scope of this thread.
_scope: ContextVar[list[str] | None] = ContextVar("lakebook_scratch", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path no other run uses."""
    path = f"{scratch_root(spark)}/lakebook/{name}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Drop the intermediate tables made inside once the block has finished.

    For jobs whose results are all written by then. After an error they are kept.
    """
    made: list[str] = []
    outer = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(outer)
    for folder in made:
        remove(spark, folder)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of what is written inside as soon as it is written.

    Spark keeps them until the driver happens to collect its garbage, so the steps of a long
    job would pile up. A write plans its own shuffles, so no other ``DataFrame`` reads them.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the files.

    Three uses: the lineage is cut, so a lost executor costs a re-read and not a
    re-run; columns without a repeatable value (row numbers) are frozen; and the
    planner knows the exact size, so it broadcasts the table only below
    ``spark.sql.autoBroadcastJoinThreshold`` and sorts-merges it otherwise.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
