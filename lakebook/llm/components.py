"""Connected components by alternating large and small stars, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize


def _lowest_neighbour(pairs: DataFrame, name: str) -> DataFrame:
    """``u, low`` with the smaller of ``u`` and its lowest neighbour.

    Written out, so that the join with it has an exchange on either side and Spark can
    split a hub with very many neighbours.
    """
    low = F.least(F.col("u"), F.min("v")).alias("low")
    return materialize(pairs.groupBy("u").agg(low), name)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select("v", "u"))
    joined = both.join(_lowest_neighbour(both, "star-lows"), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_lowest_neighbour(down, "star-lows"), "u")
    moved = joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = joined.select("u", F.col("low").alias("v"))
    return moved.union(own)


def _settled(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    kept = materialize(edges.where("u <> v").distinct(), name)
    seen = kept.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
    return kept, tuple(seen)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``u``, ``v``, both bigint).

    ``component`` is the lowest node of the component. Each round leaves a written table,
    so a lost executor costs a re-read. Only a count and a checksum reach the driver.
    Edges with a null end and loops count for nothing.
    """
    current, seen = _settled(edges.select("u", "v").where("u is not null and v is not null"), "edges")
    while seen[0]:
        current, now = _settled(_small_star(_large_star(current)), "edges")
        if now == seen:
            break
        seen = now
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.union(centres).distinct()
