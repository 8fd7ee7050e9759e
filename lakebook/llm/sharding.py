"""Sharding by sampled splitters: near equal bytes, equal texts side by side.

Rows are ordered by (digest of the text, doc_id, row number), so no two have one key and
any range can be divided. A size-weighted sample of these keys
gives quantile boundaries, and rows go to the range between two boundaries. Exact totals
of the ranges then say which are overfull; those are sampled again and subdivided. Last,
running totals (over the few ranges, then inside each) give every row its place in the
whole order of bytes, and with it its shard.

Only DataFrame functions. What reaches the driver: the sampled keys and the totals of
the ranges, both bounded by ``RANGES`` and ``PER_RANGE``, never by the rows.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import literal_longs, pick, uniform, whole_text

# Rows a range should hold at most, and the number of ranges that may come of it.
RANGE_ROWS = 2_000_000
RANGES = (192, 20_000)
# Sampled keys for each range.
PER_RANGE = 24
# A range is overfull from so many times the mean, and split at most so many times.
OVERFULL = 2.0
ROUNDS = 4
# What each row costs besides its text.
ROW_BYTES = 8

Key = tuple[int, int, int]
PARTS = ("k", "i", "s")
# A group of equal texts up to this share of a shard is not divided.
WHOLE_GROUP = 0.02


def _sample(keyed: DataFrame, rate: Column, salt: int) -> list[tuple[Key, float]]:
    """Keys drawn in proportion to size, each with the bytes it stands for."""
    chance = F.col("size") * rate
    drawn = keyed.where(uniform(F.lit(salt), *map(F.col, PARTS)) < chance)
    weight = F.when(chance < 1, 1 / rate).otherwise(F.col("size").cast("double"))
    return sorted((tuple(r)[:-1], r[-1]) for r in drawn.select(*PARTS, weight).collect())


def _quantiles(sample: list[tuple[Key, float]], parts: int) -> list[Key]:
    """Keys that cut the sample into ``parts`` of equal weight."""
    if not sample:
        return []
    sums = list(accumulate(weight for _, weight in sample))
    cuts = (bisect_left(sums, sums[-1] * j / parts) for j in range(1, parts))
    return [sample[min(c, len(sample) - 1)][0] for c in cuts]


def _range_of(boundaries: list[Key]) -> Column:
    """How many boundaries are at or below the row's key, by binary search."""
    count = len(boundaries)
    tables = [literal_longs([key[p] for key in boundaries]) for p in range(len(PARTS))]
    steps = [1 << b for b in reversed(range(max(1, count.bit_length())))]

    def step(found: Column, width: Column) -> Column:
        at = found + width
        below = F.lit(True)
        for part, table in reversed(list(zip(PARTS, tables))):
            edge = F.get(table, at - 1)
            below = (edge < F.col(part)) | ((edge == F.col(part)) & below)
        return F.when((at <= count) & below, at).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def size_ranges(keyed: DataFrame, total: int, rows: int) -> tuple[DataFrame, list[Key]]:
    """Bytes and rows of each range, and the boundaries, after subdividing."""
    least, most = RANGES
    ranges = min(most, max(least, -(-rows // RANGE_ROWS)))
    target = total / ranges
    sample = _sample(keyed, F.lit(PER_RANGE / target), 0)
    boundaries = sorted(set(_quantiles(sample, ranges)))
    for round_ in range(1, ROUNDS + 1):
        totals = (
            keyed.groupBy(_range_of(boundaries).alias("r"))
            .agg(
                F.sum("size").alias("bytes"),
                F.count(F.lit(1)).alias("n"),
                F.min(F.struct(*PARTS)).alias("lo"),
                F.max(F.struct(*PARTS)).alias("hi"),
            )
            .collect()
        )
        # A single row can't be divided.
        full = {t["r"]: t["bytes"] for t in totals if t["bytes"] > OVERFULL * target and t["lo"] != t["hi"]}
        if not full or round_ == ROUNDS:
            break
        inside = keyed.withColumn("r", _range_of(boundaries)).where(F.col("r").isin(list(full)))
        again = _sample(inside, F.lit(2 * PER_RANGE / target), round_)
        edges = list(boundaries)
        new: dict[int, list[tuple[Key, float]]] = {}
        for key, weight in again:
            place = bisect_left(edges, key)
            place += place < len(edges) and edges[place] == key
            new.setdefault(place, []).append((key, weight))
        for place, part in new.items():
            boundaries += _quantiles(part, 1 + int(2 * full.get(place, target) / target))
        boundaries = sorted(set(boundaries))
    return totals, boundaries


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``.

    A row's size is its UTF-8 bytes plus 8 (null: 8). It goes to the shard in which the
    middle of its bytes lies, so a shard misses an equal part by less than one document.
    ``slot`` numbers the rows of a shard from 0 without gaps. Rows with an equal text are
    neighbours. A group of them up to ``WHOLE_GROUP`` of a shard counts as one document: the
    middle of its bytes says where all of it goes. A larger one is divided where a shard ends.

    Null and empty texts count as the same, empty text. Rows with a null id come first
    among equal texts. Repeated rows each get a slot; as they are alike, it does not
    matter which. An empty table gives no rows; other columns are not looked at.
    """
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", whole_text())
    digest = F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long")
    keyed = materialize(
        rows.select(
            "doc_id",
            (F.octet_length("text").cast("long") + ROW_BYTES).alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            digest.alias("k"),
            F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("i"),
            # Frozen by being written.
            F.monotonically_increasing_id().alias("s"),
        ),
        "shard-keys",
    )
    whole = keyed.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not whole[1]:
        return keyed.select(
            "doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")
        )
    total, count = whole
    totals, boundaries = size_ranges(keyed, total, count)
    totals = sorted(totals, key=lambda t: t["r"])
    top = totals[-1]["r"] + 1
    sizes, counts = [0] * top, [0] * top
    for t in totals:
        sizes[t["r"]], counts[t["r"]] = t["bytes"], t["n"]
    byte_base = literal_longs([0, *accumulate(sizes)])
    row_base = literal_longs([0, *accumulate(counts)])

    inside = Window.partitionBy("r").orderBy(*PARTS)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = materialize(
        keyed.withColumn("r", _range_of(boundaries)).select(
            "doc_id",
            "size",
            "text_crc32",
            "k",
            (F.get(byte_base, F.col("r")) + F.sum("size").over(so_far)).alias("end"),
            (F.get(row_base, F.col("r")) + F.row_number().over(inside) - 1).alias("place"),
        ),
        "shard-order",
    )
    # Groups that stay whole, by their digest; the others' rows are placed one by one.
    equal = placed.groupBy("k").agg(F.sum("size").alias("all"), F.max("end").alias("last"), F.count(F.lit(1)).alias("n"))
    small = F.col("all") * shards <= F.lit(WHOLE_GROUP) * total
    whole_groups = materialize(equal.where((F.col("n") > 1) & small).select("k", "all", "last"), "shard-groups")
    # Twice the middle, in units of 1/shards of twice the total.
    own, group = F.col("end") * 2 - F.col("size"), F.col("last") * 2 - F.col("all")
    shard = F.least(F.lit(shards - 1), F.expr("cast(middle div two_totals as int)"))
    numbered = materialize(
        placed.join(whole_groups, "k", "left")
        .withColumn("middle", F.coalesce(group, own) * shards)
        .withColumn("two_totals", F.lit(2 * total).cast("long"))
        .select("doc_id", "size", "text_crc32", shard.alias("shard"), "place"),
        "shard-places",
    )
    # One row for each shard.
    first = numbered.groupBy("shard").agg(F.min("place").alias("first"))
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def write_shards(
    docs: DataFrame, sharded: DataFrame, path: str, id_col: str = "doc_id"
) -> None:
    """Write ``docs`` below ``path/shard=N``, for tables whose ids are unique."""
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    placed = docs.select(*columns).join(
        sharded.select(F.col("doc_id").alias(id_col), "shard", "slot"), id_col
    )
    placed.repartition("shard", F.pmod(F.col("slot"), F.lit(8))).write.partitionBy(
        "shard"
    ).parquet(path)
