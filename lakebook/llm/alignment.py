"""Token alignment of two vocabularies, over distinct texts.

Equal texts are brought together by their full text, tokenised by both vocabularies and
aligned once. Where a token of either ends at the same byte, a group ends; a token of one
and a token of the other are linked where their bytes overlap. Every distinct stretch
between two neighbouring token ends belongs to exactly one linked pair, so the links of a
text are as many as its distinct ends.

How many documents hold an id pair is counted in three steps: per text (times its copies),
per chunk of texts inside the task, and over all chunks. The counts go back the same way,
to chunks instead of texts, so what is shuffled is the distinct pairs of a chunk and not
all links. Ids of documents meet the measures of their text by its SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import pick, ship_package, whole_text
from .tokens import byte_bpe

# Links of a chunk: from so many on the next text begins a new one.
CHUNK_LINKS = 1_000_000
# The two ids of a pair share one number.
ID_BITS = 32
# What separates words in pieces.
SPACE_MARK = "▁"


class Pieces:
    """Ids of a sentence-piece vocabulary, and the bytes each piece stands for."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled = [
            bytes([int(model.id_to_piece(i)[3:5], 16)])
            if model.is_byte(i)
            else model.id_to_piece(i).replace(SPACE_MARK, " ").encode("utf-8")
            for i in range(model.get_piece_size())
        ]

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), dtype=np.int64)


@dataclass(frozen=True)
class Alignment:
    """Ids of both sides, their groups, and the two ids of every link."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    linked_a: np.ndarray
    linked_b: np.ndarray
    groups: int

    def pairs(self) -> np.ndarray:
        return (self.a[self.linked_a] << ID_BITS) | self.b[self.linked_b]


def align(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Both sides cut the same bytes; ``ends`` are the byte offsets after each token."""
    # Two sorted runs, which a stable sort merges.
    both = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    cut = both[np.flatnonzero(np.diff(both, prepend=-1))]
    linked_a, linked_b = np.searchsorted(ends_a, cut), np.searchsorted(ends_b, cut)
    common = cut[(ends_a[linked_a] == cut) & (ends_b[linked_b] == cut)]
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    return Alignment(a, b, group_a, group_b, linked_a, linked_b, len(common))


class Aligner:
    """Two vocabularies and how their tokens are written in a list of groups."""

    def __init__(self, path_a: str, path_b: str):
        self.left, self.right = byte_bpe(path_a, special=False), Pieces(path_b)
        tables = self.left.spelled, self.right.spelled
        self.lengths = [np.fromiter(map(len, table), dtype=np.int64, count=len(table)) for table in tables]
        # Each token with what follows it: inside a group, and at the end of its side.
        self.written: list[bytes] = []
        for table, end in zip(tables, (b"|", b";")):
            for i in range(len(table)):
                self.written += [b"%d," % i, b"%d%s" % (i, end)]

    def of(self, text: str) -> Alignment | None:
        """None for an empty text and where either side does not spell out space + text."""
        if not text:
            return None
        raw = f" {text}".encode("utf-8", "surrogatepass")
        a, b = self.left.ids(f" {text}").astype(np.int64), self.right.ids(text)
        for ids, table in ((a, self.left.spelled), (b, self.right.spelled)):
            if b"".join(map(table.__getitem__, ids.tolist())) != raw:
                return None
        return align(a, b, np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b]))

    def groups(self, one: Alignment) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: decimal ids of each group in order."""
        order = np.argsort(np.concatenate([2 * one.group_a, 2 * one.group_b + 1]), kind="stable")
        last = [np.diff(g, append=one.groups) > 0 for g in (one.group_a, one.group_b)]
        shift = len(self.left.spelled)
        codes = np.concatenate([2 * one.a + last[0], 2 * (one.b + shift) + last[1]])[order]
        return b"".join(map(self.written.__getitem__, codes.tolist()))[:-1]


@lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


MEASURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


def _chunks(texts: DataFrame, path_a: str, path_b: str, chunk_links: int, with_groups: bool) -> DataFrame:
    """Rows of aligned texts (``key`` set) and of the distinct pairs of a chunk (``pair`` set).

    A text has its measures and, as ``codes``, for each link the place (``slot``) of its
    pair among those of the chunk. A pair has the number of documents of the chunk with it.
    """
    listed = "groups string" if with_groups else "groups_sha256 string"
    fields = f"chunk bigint, key string, {MEASURES}, {listed}, codes binary, pair bigint, slot int, docs bigint"
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]

    def flush(chunk: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        pairs, codes = np.unique(np.concatenate([h[-1] for h in held]), return_inverse=True)
        docs = np.zeros(len(pairs), dtype=np.int64)
        packer, packed, at = zstandard.ZstdCompressor(level=1), [], 0
        for _, copies, *_, own in held:
            part = codes[at : at + len(own)].astype(np.int32)
            at += len(own)
            docs[np.unique(part)] += copies
            packed.append(packer.compress(part.tobytes()))
        n, m = len(held), len(pairs)
        key, _, n_a, n_b, n_groups, n_links, shown, _ = zip(*held)
        text = [[chunk] * n, key, n_a, n_b, n_groups, n_links, shown, packed]
        columns = [pa.array(c, k) for c, k in zip(text, kinds)]
        columns += [pa.nulls(n, k) for k in kinds[len(text) :]]
        yield pa.RecordBatch.from_arrays(columns, names=names)
        columns = [pa.array(np.full(m, chunk)), *(pa.nulls(m, k) for k in kinds[1 : len(text)])]
        columns += [pa.array(pairs), pa.array(np.arange(m, dtype=np.int32)), pa.array(docs)]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        chunk, held, links = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for key, text, copies in zip(*(batch.column(c) for c in ("key", "text", "copies"))):
                one = aligner.of(text.as_py())
                if one is None:
                    continue
                shown = aligner.groups(one)
                shown = shown.decode() if with_groups else hashlib.sha256(shown).hexdigest()
                own = one.pairs()
                held.append((key.as_py(), copies.as_py(), len(one.a), len(one.b), one.groups, len(own), shown, own))
                links += len(own)
                if links >= chunk_links:
                    yield from flush(chunk, held)
                    chunk, held, links = chunk + 1, [], 0
        if held:
            yield from flush(chunk, held)

    return texts.select("key", "text", "copies").mapInArrow(work, fields)


@dataclass(frozen=True)
class Aligned:
    """What aligning a corpus gives.

    ``texts``: ``key`` (SHA-256 of the text), measures, and the groups or their digest.
    ``pairs``: ``a, b, docs, best``: documents in which both ids are linked, and whether no
    other partner of ``a`` has more.
    """

    texts: DataFrame
    pairs: DataFrame


def align_texts(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    chunk_links: int = CHUNK_LINKS,
    with_groups: bool = False,
    text_col: str = "text",
) -> Aligned:
    """Align every distinct text that is not empty; texts without tokens are left out."""
    ship_package(docs.sparkSession)
    rows = pick(docs, text_col).toDF("text").withColumn("text", whole_text()).where("text <> ''")
    # By the full text: combined in the tasks that read, then shuffled.
    once = rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    once = once.withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    made = materialize(_chunks(once, path_a, path_b, chunk_links, with_groups), "aligned-chunks")
    held = made.where("pair is not null").select("chunk", "pair", "slot", "docs")
    totals = materialize(held.groupBy("pair").agg(F.sum("docs").alias("docs")), "pair-counts")
    a = F.shiftright("pair", ID_BITS)
    # At most one row for each id of the first vocabulary.
    most = totals.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    marked = totals.withColumn("a", a).join(F.broadcast(most), "a")
    counted = materialize(marked.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pairs")
    back = held.drop("docs").join(counted, "pair").select(F.col("chunk").alias("part"), "slot", "docs", "best")
    shown = "groups" if with_groups else "groups_sha256"
    texts = made.where("key is not null").select("chunk", "key", *_names(), shown, "codes")

    def measure(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        slot, docs = pairs.column("slot").to_numpy(), pairs.column("docs").to_numpy()
        count, best = np.zeros(len(slot), dtype=np.int64), np.zeros(len(slot), dtype=bool)
        count[slot] = docs
        best[slot] = pairs.column("best").to_numpy()
        unpack, n_best, total = zstandard.ZstdDecompressor(), [], []
        for packed in texts.column("codes"):
            codes = np.frombuffer(unpack.decompress(packed.as_py()), dtype=np.int32)
            n_best.append(int(best[codes].sum()))
            total.append(int(count[codes].sum()))
        kept = texts.drop_columns(["chunk", "codes"])
        kept = kept.append_column("n_best", pa.array(n_best, pa.int64()))
        return kept.append_column("count_sum", pa.array(total, pa.int64()))

    fields = f"key string, {MEASURES}, {shown} string, n_best bigint, count_sum bigint"
    measured = texts.groupBy("chunk").cogroup(back.groupBy("part")).applyInArrow(measure, fields)
    low = F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1))
    pairs = counted.select(a.cast("int").alias("a"), low.cast("int").alias("b"), "docs", "best")
    return Aligned(materialize(measured, "aligned-texts"), pairs)


def _names() -> list[str]:
    return [f.split()[0] for f in MEASURES.split(", ")]


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    chunk_links: int = CHUNK_LINKS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    The first vocabulary (a byte-level BPE file) encodes space + text, the second (a sentence
    piece model) the text, to which it adds the space itself; strings of special tokens are
    plain text. Null and empty texts, and those whose tokens don't spell out space + text
    on both sides, have no tokens: all numbers are 0 and the digest is ''. Copies count
    each as a document. Repeated rows and rows without an id are measured like any other;
    an empty table gives no rows; other columns are ignored.
    """
    aligned = align_texts(docs, path_a, path_b, chunk_links, text_col=text_col)
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", whole_text())
    keyed = rows.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("key"))
    numbers = [*_names(), "n_best", "count_sum"]
    return keyed.join(aligned.texts, "key", "left").select(
        "doc_id",
        *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
