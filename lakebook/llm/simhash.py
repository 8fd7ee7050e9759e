"""SimHash near-duplicates over BK-trees.

A fingerprint has 64 bits. Equal fingerprints are merged first, so a group of copies is
one node. Two fingerprints within the radius of 2 agree on at least one of any three
parts of their bits; shards therefore hold the fingerprints that agree on one part. An
overfull shard is divided by the same rule over its remaining bits, and again; after four
levels at most 13 bits are free, so no shard can hold more than 2**13 fingerprints. Each
shard becomes a BK-tree (children keyed by their Hamming distance to the parent; a search
follows only the edges within the radius). A tree goes where its shard's rows are: all
trees together grow with the corpus and are not broadcast. A shard reports a spanning
forest of its links, which is enough for components and never more than its size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import literal_longs, pick, ship_package, whole_text
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
# Shards above this are divided while a level is left.
SHARD = 256
LEVELS = 4
# Hashes whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in more than half of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype="<u8")
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        stops = np.cumsum(lengths) - 1
        starts = stops - lengths + 1
        digest = xxhash.xxh64_intdigest
        spans = zip(starts.tolist(), stops[shingle - 1 :].tolist())
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in spans),
            dtype="<u8",
            count=len(words) - shingle + 1,
        )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, bits`` (bigint with the fingerprint's bit pattern) of every row."""
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", whole_text())
    ship_package(docs.sparkSession)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text, shingle) for text in batch.column("text").to_pylist()]
            bits = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(bits)], names=["doc_id", "bits"]
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"doc_id {id_type}, bits bigint")


class BKTree:
    """Distinct fingerprints; a child hangs at its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the values within ``radius``."""
        found, open_ = [], [0] if self.values else []
        while open_:
            at = open_.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            children = self.edges[at]
            if children:
                for edge in range(distance - radius, distance + radius + 1):
                    child = children.get(edge)
                    if child is not None:
                        open_.append(child)
        return found

    def add(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self.edges.append({})
        at = 0
        while new:
            distance = (self.values[at] ^ value).bit_count()
            child = self.edges[at].get(distance)
            if child is None:
                self.edges[at][distance] = new
                return
            at = child


def spanning_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that join every pair within ``radius``, by a path; at most one per value."""
    tree, parent, links = BKTree(), list(range(len(values))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values):
        for j in tree.within(value, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                links.append((value, values[j]))
        tree.add(value)
    return links


def _masks(levels: int, parts: int) -> list[list[int]]:
    """For each level the bits that members of a shard share; child ``parts * n + j``."""

    def cut(mask: int) -> list[int]:
        free = [b for b in range(64) if not mask >> b & 1]
        return [mask | sum(1 << b for b in free[j::parts]) for j in range(parts)]

    out, level = [], [0]
    for _ in range(levels):
        level = [child for mask in level for child in cut(mask)]
        out.append(level)
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """``u, v``: links between distinct fingerprints (``bits``), a spanning set of them."""
    parts = radius + 1
    found: DataFrame | None = None
    rows = prints.select("bits", F.lit(0).alias("node"))

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            for members in batch.column("members").to_pylist():
                pairs += spanning_links([m % (1 << 64) for m in sorted(members)], radius)
            ends = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"]
            )

    ship_package(prints.sparkSession)
    for depth, masks in enumerate(_masks(LEVELS, parts)):
        table = literal_longs([_signed(m) for m in masks])
        child = F.explode(F.transform(F.array(*map(F.lit, range(parts))), lambda j: F.col("node") * parts + j))
        keyed = rows.select("bits", child.alias("node")).withColumn(
            "key", F.col("bits").bitwiseAND(F.get(table, F.col("node")))
        )
        # Written, so that the join has an exchange on either side and can split a shard.
        sizes = materialize(
            keyed.groupBy("node", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shards"
        )
        shared = keyed.join(sizes, ["node", "key"])
        last = depth == LEVELS - 1
        whole = shared if last else shared.where(F.col("n") <= shard)
        # At most ``shard`` values, or on the last level 2**13.
        trees = whole.groupBy("node", "key").agg(F.collect_list("bits").alias("members"))
        part = trees.select("members").mapInArrow(solve, "u bigint, v bigint")
        found = part if found is None else found.union(part)
        if last or not sizes.where(F.col("n") > shard).limit(1).count():
            break
        rows = materialize(shared.where(F.col("n") > shard).select("bits", "node"), "overfull")
    return found


def simhash_components(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id that links reach. Null and empty texts have no
    words: their fingerprint is zero, linked like any other. Texts shorter than a shingle
    hash as a whole. A row with a null id belongs to its component, but names it only by
    others (null if there are none). Repeated rows are returned as often as they come; an
    empty table gives no rows; other columns are ignored.
    """
    prints = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = materialize(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(links(nodes, radius)).withColumnRenamed("node", "bits")
    member = materialize(nodes.join(found, "bits", "left"), "members")
    linked = member.where("component is not null")
    # Written, so that the join can split a component of very many fingerprints.
    lowest = materialize(linked.groupBy("component").agg(F.min("first").alias("low")), "lowest")
    named = materialize(
        linked.join(lowest, "component")
        .select("bits", F.col("low").alias("component_id"))
        .union(member.where("component is null").select("bits", "first")),
        "named",
    )
    return prints.join(named, "bits").select(
        "doc_id",
        F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        "component_id",
    )
