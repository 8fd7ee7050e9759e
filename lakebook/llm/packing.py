"""Best-fit packing by minimum bin slack.

A bin takes the longest piece left, and a bitset subset-sum over the lengths still
available finds the fullest combination for the rest. The combination is removed, and as
the next bin would find the same one while its lengths last, it is removed as often as the
counts allow. The search therefore needs only the number of pieces of each length: at most
2,048 counts reach the driver and a few thousand combinations come back, whatever the
corpus holds. Pieces are numbered within their length (per task, plus the counts of the
tasks before) and look up the combination that takes their number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import pick, ship_package, whole_text
from .tokens import byte_bpe

CAPACITY = 2048
END_ID = 0
# Numbers of one length stay below this.
RANK_BITS = 48


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids], task, slot``: the token ids, cut.

    A document is its ids and then id 0. Only one longer than ``capacity`` is cut, into
    pieces of that length; the first takes what is over. ``tokenizer`` is a path every
    executor can open. ``slot`` numbers the pieces of equal length in a task; the result
    is written out, so these numbers hold.
    """
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", whole_text())
    ship_package(docs.sparkSession)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint"
    fields += ", ids array<int>" if with_ids else ""

    def tokenise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = byte_bpe(tokenizer), TaskContext.get().partitionId()
        used = [0] * (capacity + 1)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            owner, out, ids = [], [], []
            for row, text in enumerate(batch.column("text")):
                raw = encoder.ids(text.as_py()).astype("<u4").tobytes() + end
                n, start, piece = len(raw) // 4, 0, 0
                stop = n if n <= capacity else n % capacity or capacity
                while start < n:
                    part = raw[4 * start : 4 * stop]
                    length = stop - start
                    owner.append(row)
                    out.append((piece, start, length, zlib.crc32(part), task, used[length]))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
                    used[length] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
            table = np.array(out, dtype=np.int64).reshape(-1, 6)
            columns = [batch.column("doc_id").take(pa.array(owner, pa.int32()))]
            columns += [pa.array(table[:, 0].astype(np.int32)), *map(pa.array, table[:, 1:4].T.copy())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            columns += [pa.array(table[:, 4].astype(np.int32)), pa.array(table[:, 5].copy())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "task", "slot"])

    made = rows.mapInArrow(tokenise, f"doc_id {id_type}, {fields}, task int, slot bigint")
    return materialize(made, "pieces")


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go.

    Entry ``e`` takes the pieces of one length from number ``key & mask`` on. They fill
    sequences from ``base`` up, ``times`` in each, the first at ``offset``.
    """

    key: np.ndarray
    base: np.ndarray
    times: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entry = np.searchsorted(self.key, (length << RANK_BITS) | rank, side="right") - 1
        local = rank - (self.key[entry] & ((1 << RANK_BITS) - 1))
        times = self.times[entry]
        return self.base[entry] + local // times, self.offset[entry] + local % times * length


def fullest(room: int, counts: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """How many of each length fill ``room`` best. ``lengths`` falls; long ones go first."""
    reach, steps = 1, []
    limit = (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        left, chunk, before = min(counts[length], room // length), 1, reach
        while left:
            take = min(chunk, left)
            reach |= reach << (take * length) & limit
            left, chunk = left - take, chunk * 2
        steps.append((length, before))
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + 1
            total -= length
    return chosen


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Bins of least slack for ``counts`` pieces of each length."""
    counts = {length: n for length, n in counts.items() if n}
    lengths = sorted(counts, reverse=True)
    taken = dict.fromkeys(lengths, 0)
    entries, sequences = [], 0
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        chosen = fullest(capacity - longest, counts, lengths)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        often = min(counts[length] // times for length, times in chosen.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            times = chosen[length]
            entries.append(((length << RANK_BITS) | taken[length], sequences, times, offset))
            taken[length] += often * times
            counts[length] -= often * times
            offset += times * length
        sequences += often
        lengths = [length for length in lengths if counts[length]]
    table = np.array(sorted(entries), dtype=np.int64).reshape(-1, 4)
    return Plan(*table.T.copy(), sequences)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces``; drop ``task`` and ``slot``.

    One row for each task and length is shuffled besides the pieces.
    """
    per_task = materialize(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # At most ``capacity`` rows.
    histogram = dict(per_task.groupBy("length").agg(F.sum("n")).collect())
    plan = plan_bins(histogram, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    kept = [c for c in cut.columns if c not in ("task", "slot")]
    ranked = cut.join(bases, ["length", "task"]).select(*kept, (F.col("base") + F.col("slot")).alias("rank"))
    ship_package(cut.sparkSession)

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = plan.place(length, rank)
            columns = [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    fields = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in kept)
    return ranked.mapInArrow(look_up, f"{fields}, sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``.

    Null and empty texts are the single id 0. Repeated rows and rows with a null id are
    packed like any other; an empty table gives no pieces; other columns are ignored.
    """
    cut = pieces(docs, tokenizer, capacity, with_ids, id_col, text_col)
    return place(cut, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, input_ids, doc_ids, offsets`` of pieces packed ``with_ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return whole.select(
        "sequence_id",
        F.flatten("parts.ids").alias("input_ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.offset").alias("offsets"),
    )
