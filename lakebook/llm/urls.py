"""URL filter over a sorted digest array.

The rule list is written once as files of sorted 64-bit xxHash keys, followed by the rule
strings. Spark ships each file to every executor, where tasks map it into memory, so all
workers of a machine share its pages. A page's candidate rules (every parent domain with
every path prefix of a length that occurs) are hashed in the JVM, looked up with a
vectorised binary search, and confirmed against the stored string, so colliding digests
change nothing. Pages are never shuffled.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import new_folder
from .common import literal_longs, pick, ship_package, store

# Rules in one file: what the driver holds while it writes a file.
FILE_RULES = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class DigestIndex:
    """Names of the shipped files and the path lengths that occur in the rules."""

    files: tuple[str, ...]
    path_lengths: tuple[int, ...]


def _pack(rules: list[tuple[int, bytes, bool]]) -> bytes:
    """``count, keys, ends, blocked, strings`` of rules sorted by unsigned key."""
    keys = np.array([r[0] for r in rules], dtype=np.uint64)
    ends = np.cumsum([len(r[1]) for r in rules], dtype=np.uint64)
    blocked = np.array([r[2] for r in rules], dtype=np.uint8)
    head = struct.pack("<Q", len(rules))
    return head + keys.tobytes() + ends.tobytes() + blocked.tobytes() + b"".join(r[1] for r in rules)


def build_index(rules: DataFrame, file_rules: int = FILE_RULES) -> DigestIndex:
    """Write and ship the digest files of ``rules`` (``rule``, ``verdict``).

    A rule is ``host/path``; its host is lower-cased. Null rules, rules without a slash
    and verdicts other than ``allow`` and ``block`` are refused. Of a repeated rule,
    ``block`` holds. The sorted rules pass the driver one file at a time.
    """
    spark = rules.sparkSession
    rows = pick(rules, "rule", "verdict")
    bad = ~F.coalesce(F.col("rule").contains("/"), F.lit(False)) | ~F.coalesce(
        F.col("verdict").isin("allow", "block"), F.lit(False)
    )
    if wrong := rows.where(bad).first():
        raise ValueError(f"not a rule: {wrong}")
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.expr("substr(rule, instr(rule, '/'))")
    parts = rows.select(F.concat(host, path).alias("rule"), F.length(path).alias("n"), "verdict")
    lengths = tuple(sorted(r[0] for r in parts.select("n").distinct().toLocalIterator()))
    merged = parts.groupBy("rule").agg(F.max("verdict").alias("verdict"))
    key = F.xxhash64("rule")
    # Flipping the sign bit sorts signed keys in their unsigned order.
    ordered = merged.orderBy(key.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))).select(key, "rule", "verdict")
    folder, files = new_folder(spark, "url-digests"), []

    def ship(part: list[tuple[int, bytes, bool]]) -> None:
        name = f"{uuid.uuid4().hex}.digests"
        store(spark, f"{folder}/{name}", _pack(part))
        spark.sparkContext.addFile(f"{folder}/{name}")
        files.append(name)

    part: list[tuple[int, bytes, bool]] = []
    for value, rule, verdict in ordered.toLocalIterator():
        part.append((value % (1 << 64), rule.encode(), verdict == "block"))
        if len(part) == file_rules:
            ship(part)
            part = []
    if part:
        ship(part)
    return DigestIndex(tuple(files), lengths)


class _File:
    """One digest file, mapped into memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n = int(raw[:8].view("<u8")[0])
        self.keys = raw[8 : 8 + 8 * n].view("<u8")
        self.ends = raw[8 + 8 * n : 8 + 16 * n].view("<u8")
        self.blocked = raw[8 + 16 * n : 8 + 17 * n]
        self.strings = raw[8 + 17 * n :]

    def rule(self, at: int) -> bytes:
        start = int(self.ends[at - 1]) if at else 0
        return self.strings[start : int(self.ends[at])].tobytes()

    def find(self, keys: np.ndarray) -> Iterator[tuple[int, int]]:
        """(index into ``keys``, place in the file) of every equal digest."""
        lo = np.searchsorted(self.keys, keys, side="left")
        hi = np.searchsorted(self.keys, keys, side="right")
        for i in np.flatnonzero(hi > lo):
            yield from ((int(i), place) for place in range(int(lo[i]), int(hi[i])))


@lru_cache(maxsize=64)
def _open(name: str) -> _File:
    return _File(SparkFiles.get(name))


def _candidates(lengths: tuple[int, ...]) -> Column:
    """Every parent domain of ``host`` joined to every path prefix that may be a rule's."""
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fitting = F.filter(literal_longs(list(lengths)), lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.substr(F.col("path"), F.lit(1), n.cast("int")))
    return F.flatten(F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.concat(d, p))))


def filter_urls(
    pages: DataFrame, index: DigestIndex, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    The longest fitting rule wins, of equally long ones that with the longer host; a page
    without one gets a null rule and ``allow``. A null url, or one without ``://``, has
    an empty host and path. Repeated rows and null ids are judged like any other; an empty
    table gives no rows; other columns are ignored.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pick(pages, id_col, url_col).toDF("page_id", "url")
    parsed = rows.select(
        "page_id",
        F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, URL, 2).alias("path"),
    )
    candidates = parsed.withColumn("candidates", _candidates(index.path_lengths))
    probes = candidates.withColumn("keys", F.transform("candidates", lambda c: F.xxhash64(c)))
    files = index.files

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = [_open(name) for name in files]
        for batch in batches:
            lists = batch.column("candidates")
            strings = lists.flatten()
            owner = pa.compute.list_parent_indices(lists).to_numpy()
            keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            best: dict[int, tuple[int, int, str, bool]] = {}
            for file in opened:
                for i, place in file.find(keys):
                    rule = strings[i].as_py()
                    if file.rule(place) != rule.encode():
                        continue
                    row = int(owner[i])
                    rank = (len(rule), rule.index("/"), rule, bool(file.blocked[place]))
                    best[row] = max(best.get(row, rank), rank)
            found = [best.get(row) for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("host"),
                    batch.column("path"),
                    pa.array([f and f[2] for f in found], pa.string()),
                    pa.array(["block" if f and f[3] else "allow" for f in found], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    ship_package(pages.sparkSession)
    id_type = rows.schema["page_id"].dataType.simpleString()
    return probes.mapInArrow(
        probe, f"page_id {id_type}, host string, path string, rule string, verdict string"
    )
