"""Substring dedup by seed and extend.

Seeds: of every window of 13 words the lowest 5-word gram is its anchor, so equal windows
have equal anchors at the same place. Consecutive windows with one anchor form a segment.
Segments meet by anchor, in one shuffle. Extension goes both ways from the anchor: first
as far as the segment reaches, which settles all copies of a whole segment at once; where
an anchor stands in different segments, every window that fits around it is extended and
compared by itself. Overlapping windows that an earlier document has make up the maximal
repeats, and those words go.

Nothing is paired: each group only needs its smallest document. An anchor of very many
documents is found in a sample beforehand and is not grouped by anchor: its segments are
aggregated in the tasks that cut them, with neighbours of that kind extended to one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import pick, ship_package, uniform, whole_text
from .winnow import Rolling, anchors, split_words, word_hashes

WINDOW = 13
GRAM = 5
# Documents sampled for frequent anchors: so many, and this share of a large corpus. An anchor
# with SAMPLE_HITS segments in the sample is frequent; one that makes three times as many likely
# is missed once in 10**6. So about 10**6 segments of one anchor meet in a task at most, however
# many documents there are, and the anchors held are a fixed share of all segments.
SAMPLE, SAMPLE_SHARE = 10_000, 1 / 16_384
SAMPLE_HITS = 20
# Anchors held by every task at most (8 bytes each): the most frequent ones.
HELD = 4_000_000
# First window and number of windows of a segment share one number.
COUNT_BITS = 24
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def segments(
    hashes: np.ndarray, window: int, gram: int, frequent: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, content, first window and number of windows of each segment, and whether
    the anchor is frequent. Neighbours with frequent anchors are one segment."""
    rolling = Rolling(hashes)
    grams = rolling.grams(gram)
    places = anchors(grams, window - gram + 1)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    often = among(grams[places[first]], frequent)
    alone = np.ones(len(first), dtype=bool)
    alone[1:] = ~(often[1:] & often[:-1])
    first, often = first[alone], often[alone]
    count = np.diff(first, append=len(places))
    content = rolling.stretch(first, first + count + window - 1)
    return grams[places[first]], content, first, count, often


def _segment_rows(docs: DataFrame, window: int, gram: int, frequent: np.ndarray) -> DataFrame:
    """``anchor, content, doc, at, often``: all segments; ``often`` if the anchor is frequent."""
    names = ["anchor", "content", "doc", "at", "often"]
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = held.value
        for batch in batches:
            parts = []
            ids = batch.column("doc").to_pylist()
            for doc, text in zip(ids, batch.column("text").to_pylist()):
                hashes = word_hashes(split_words(text))
                if len(hashes) < window:
                    continue
                anchor, content, first, count, often = segments(hashes, window, gram, frequent)
                at = (first << COUNT_BITS) | count
                owner = np.full(len(at), doc)
                parts.append((anchor.view(np.int64), content.view(np.int64), owner, at, often))
            if parts:
                whole = [pa.array(np.concatenate(c)) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(whole, names=names)

    return docs.mapInArrow(cut, "anchor bigint, content bigint, doc bigint, at bigint, often boolean")


def sample_share(rows: int) -> float:
    """The share of ``rows`` documents in which frequent anchors are looked for."""
    return min(1.0, max(SAMPLE / max(rows, 1), SAMPLE_SHARE))


def frequent_anchors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, held: int = HELD) -> np.ndarray:
    """Anchors of ``SAMPLE_HITS`` segments in the sample, sorted; of more than ``held`` the most frequent."""
    some = docs.where(uniform(F.lit(1), F.col("doc")) < sample_share(docs.count()))
    none = np.empty(0, dtype=np.uint64)
    seen = _segment_rows(some, window, gram, none).groupBy("anchor")
    often = seen.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SAMPLE_HITS)
    most = often.orderBy(F.desc("n"), "anchor").limit(held).select("anchor").toArrow()
    return np.sort(most.column("anchor").to_numpy().view(np.uint64))


def _shared_segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc, at, settled``: segments whose anchor other documents have, too.

    Settled ones are whole copies of an earlier document's segment. The others have to be
    compared window by window. First occurrences without a variant are left out: nothing
    of them goes, and nothing else can equal their windows.
    """
    frequent = frequent_anchors(docs, window, gram)
    every = _segment_rows(docs, window, gram, frequent)
    rare = every.where("not often").drop("often")
    same, near = Window.partitionBy("anchor", "content"), Window.partitionBy("anchor")
    met = (
        rare.withColumn("owner", F.min("doc").over(same))
        .withColumn("low", F.min("doc").over(near))
        .withColumn("high", F.max("doc").over(near))
        .withColumn("variants", F.min("content").over(near) < F.max("content").over(near))
        .where("low < high and (owner < doc or variants)")
    )
    shared = met.select("doc", "at", (F.col("owner") < F.col("doc")).alias("settled"))
    if len(frequent):
        # Combined in the tasks that cut them, then joined to what was written.
        hot = materialize(every.where("often").drop("often"), "frequent-segments")
        owners = materialize(hot.groupBy("anchor", "content").agg(F.min("doc").alias("owner")), "owners")
        met = hot.join(owners, ["anchor", "content"])
        shared = shared.union(met.select("doc", "at", (F.col("owner") < F.col("doc")).alias("settled")))
    return materialize(shared, "shared-segments")


def _fields(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed, for the shuffles that carry them; other columns stay."""
    others = [c for c in docs.columns if c != "text"]

    def compress(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [packer.compress(t.encode("utf-8")) for t in batch.column("text").to_pylist()]
            columns = [*(batch.column(c) for c in others), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "packed"])

    return docs.mapInArrow(compress, f"{_fields(docs, others)}, packed binary")


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _owned_windows(docs: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """``doc, at``: single windows of unsettled segments that an earlier document has."""
    pending = shared.where("not settled").groupBy("doc").agg(F.collect_list("at").alias("ats"))

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            columns = (batch.column(c).to_pylist() for c in ("doc", "packed", "ats"))
            for doc, packed, ats in zip(*columns):
                hashes = word_hashes(_unpack(packed).split())
                at = np.array(sorted(set(ats)), dtype=np.int64)
                first, count = at >> COUNT_BITS, at & ((1 << COUNT_BITS) - 1)
                # Starts that fit around the anchors, each word count to the left.
                start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                pair = [Rolling(hashes, i).stretch(start, start + window).view(np.int64) for i in (0, 1)]
                parts.append([*pair, np.full(len(start), doc), start])
            if parts:
                whole = [pa.array(np.concatenate(c)) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(whole, names=["a", "b", "doc", "start"])

    rows = _packed(docs).join(pending, "doc").select("doc", "packed", "ats")
    windows = materialize(rows.mapInArrow(extend, "a bigint, b bigint, doc bigint, start bigint"), "windows")
    owners = windows.groupBy("a", "b").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
    # Written, so that the join has an exchange on either side and can split a window.
    owners = materialize(owners.where("owner < last").drop("last"), "owners")
    owned = windows.join(owners, ["a", "b"]).where("owner < doc")
    return owned.select("doc", (F.shiftleft("start", COUNT_BITS) + 1).alias("at"))


def _without(text: bytes, gone: np.ndarray) -> str:
    """The text less some words, and less the white space before each of them."""
    kept, last = [], 0
    for word, drop in zip(WORD.finditer(text), gone.tolist()):
        if not drop:
            kept.append(text[last : word.end()])
        last = word.end()
    kept.append(text[last:])
    return b"".join(kept).decode("utf-8")


def dedup_substrings(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept_text`` and ``carry`` of every row of ``docs``.

    A word goes if a window of ``window`` words covers it that also starts in a document
    with a smaller id. ``spans`` are the maximal repeats as word numbers, end exclusive;
    ``kept_text`` keeps the white space between the words that stay. Windows are judged on
    the input.

    Null and empty texts have no words. Rows with a null id are returned unchanged and
    own nothing. Rows that repeat an id are one document and never repeats of each other;
    a word number that goes in one of them goes in all. An empty table gives no rows;
    other columns are ignored.
    """
    ship_package(docs.sparkSession)
    carried = [f"carried_{i}" for i in range(len(carry))]
    picked = pick(docs, id_col, text_col, *carry).toDF("doc", "text", *carried)
    rows = picked.withColumn("doc", F.col("doc").cast("long")).withColumn("text", whole_text())
    known = rows.select("doc", "text").where("doc is not null")
    shared = _shared_segments(known, window, gram)
    settled = shared.where("settled").select("doc", "at")
    gone = settled.union(_owned_windows(known, shared, window))
    per_doc = gone.groupBy("doc").agg(F.collect_list("at").alias("ats"))

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("packed", "ats"))
            for packed, ats in zip(*columns):
                text = _unpack(packed)
                n = len(text.split())
                # +1 where a removed stretch begins, -1 where one ends.
                edges = np.zeros(n + 1, dtype=np.int64)
                at = np.array(ats or [], dtype=np.int64)
                first = at >> COUNT_BITS
                last = np.minimum(first + (at & ((1 << COUNT_BITS) - 1)) + window - 1, n)
                first = np.minimum(first, n)
                np.add.at(edges, first, 1)
                np.add.at(edges, last, -1)
                gone_words = np.cumsum(edges[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.r_[False, gone_words, False].astype(np.int8)))
                removed = int(gone_words.sum())
                kept = _without(text, gone_words) if removed else text.decode("utf-8")
                out.append((n, removed, turns.reshape(-1, 2).tolist(), kept))
            n_words, n_removed, spans, kept_text = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array(kept_text, pa.string()),
                    *(batch.column(c) for c in carried),
                ],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_text", *carried],
            )

    joined = _packed(rows).join(per_doc, "doc", "left").select("doc", "packed", "ats", *carried)
    fields = "doc_id bigint, n_words bigint, n_removed bigint, spans array<array<bigint>>, kept_text string"
    result = joined.mapInArrow(remove, ", ".join([fields, _fields(rows, carried)] if carried else [fields]))
    return result.toDF("doc_id", "n_words", "n_removed", "spans", "kept_text", *carry)
