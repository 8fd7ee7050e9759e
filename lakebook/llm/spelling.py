"""Spelling variants over an index of variable-length grams.

Grams that many words have are frequent; the dictionary holds every gram of the least
length and every gram that continues a frequent one. A word is decomposed from left to
right: at each place the gram is continued while it is frequent, and a gram inside an
earlier one is dropped. So common beginnings get long grams and no list of a gram that is
not frequent has more than the threshold's words.

One edit leaves most grams of a word in place. For each word the bound on the affected
grams is the worst edit's: the grams around it, and those after it that a longer gram
across the edit might swallow, which needs a frequent gram with the same ending. Two words
one edit apart share all but so many, hence lists are merged for only (bound + 1) of the
rarest grams of a word. As the rest of the word holds no other edit, a shared gram comes
with the whole left part or the whole right part of the word, and that makes the list.

A list is merged in one task; a long one by what its words leave after one deletion, so the
work grows with its words and not their pairs. Words none of whose grams must survive an
edit, and lists above ``LIST`` words, are spread by what they leave after one deletion,
which is exact and has small groups (all words one insertion from a given string).
Candidates of every way are verified.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import pick, ship_package, whole_text

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_CHARS = 7
LEAST_COUNT = 2
# One code point goes from the occurrences whose digest this divides.
SPOILED = 31
# A form occurs at least so many times as often.
TIMES = 10
# Least and greatest length of a gram.
GRAM = (2, 4)
# A gram is frequent above so many places, more where the frequent ones would exceed GRAMS.
FREQUENT = 1_000
GRAMS = 200_000
# Words of a list that one task merges, and of one that are compared with each other.
LIST, COMPARED = 4_096, 16
# Words a task decomposes.
TASK_WORDS = 50_000
# Distinct words a task counts before it hands them on.
BATCH_WORDS = 100_000


def spoiled(doc_id: object, run: str, every: int = SPOILED) -> str:
    """The run, or what is left of it, in one document."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words_of(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the words and how often they occur."""
    ship_package(docs.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                doc_id = doc_id.as_py()
                # bytes.lower() changes A-Z only.
                runs = RUN.findall(text.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                own: dict[str, int] = {}
                for run in runs:
                    own[run] = own.get(run, 0) + 1
                for run, n in own.items():
                    word = spoiled(doc_id, run) if len(run) >= least_chars else ""
                    if len(word) >= least_chars:
                        seen[word] = seen.get(word, 0) + n
                if len(seen) > BATCH_WORDS:
                    yield flush()
                    seen.clear()
        yield flush()

    counts = docs.mapInArrow(count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def frequent_grams(
    words: DataFrame, gram: tuple[int, int] = GRAM, frequent: int = FREQUENT, limit: int = GRAMS
) -> dict[str, int]:
    """The grams that are continued, and their numbers of places; at most ``limit``.

    A gram above a share 1/limit of all places is one of at most ``limit``.
    """
    least, most = gram
    starts = F.sequence(F.lit(1), F.length("word"))

    def cut(size: int) -> Column:
        whole = F.filter(starts, lambda i: i <= F.length("word") - (size - 1))
        return F.transform(whole, lambda i: F.substr(F.col("word"), i, F.lit(size)))

    places = words.select(F.explode(F.concat(*map(cut, range(least, most)))).alias("gram"))
    counts = materialize(places.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least_n = max(frequent, -(-total // limit))
    return dict(counts.where(F.col("n") > least_n).toLocalIterator())


@dataclass(frozen=True)
class GramIndex:
    """The frequent grams, and every ending of one."""

    frequent: dict[str, int]
    endings: frozenset[str]
    least: int
    most: int

    @classmethod
    def of(cls, frequent: dict[str, int], gram: tuple[int, int] = GRAM) -> GramIndex:
        endings = frozenset(g[i:] for g in frequent for i in range(len(g)))
        return cls(frequent, endings, *gram)

    def decompose(self, word: str) -> list[tuple[int, int]]:
        """Start and end (exclusive) of the word's grams, none inside another."""
        out, reach, size = [], 0, len(word)
        for start in range(size - self.least + 1):
            end = start + self.least
            while end < size and end - start < self.most and word[start:end] in self.frequent:
                end += 1
            if end > reach:
                out.append((start, end))
                reach = end
        return out

    def affected(self, word: str, grams: list[tuple[int, int]]) -> int:
        """The most grams of ``word`` that one edit can take away.

        The lookup of a gram reads only the gram, so one before the edit stays. One after
        it is found again, too, but may lie inside a gram across the edit: that one has at
        most ``most`` letters and, up to its last letter, is frequent.
        """
        size, worst = len(word), 0
        for gap in range(size + 1):
            # In place of the letter at ``gap`` (or without it), and before that letter.
            for after, reach in ((gap + 1, gap + self.most), (gap, gap - 1 + self.most)):
                if after > size:
                    continue
                lost = 0
                for start, end in grams:
                    if start < after and end > gap:
                        # Around the edit; a gram from the gap on is not around an insertion.
                        lost += 1
                    elif start >= after and end <= reach and word[after : end - 1] in self.endings:
                        lost += 1
                    elif end == size == gap and end - start < self.most and word[start:end] in self.frequent:
                        # Ended with the word, and would be continued by a letter put there.
                        lost += 1
                worst = max(worst, lost)
        return worst

    def rarest(self, word: str) -> tuple[list[tuple[int, int]], bool]:
        """The grams whose lists the word enters, and whether one of them must survive."""
        grams = self.decompose(word)
        bound = self.affected(word, grams)
        # Any order of the grams' letters will do, as long as it is the same for all words.
        grams.sort(key=lambda g: (self.frequent.get(word[g[0] : g[1]], 0), g[0] - g[1], word[g[0] : g[1]], g[0]))
        return grams[: bound + 1], bound < len(grams)


def list_keys(word: str, grams: list[tuple[int, int]]) -> list[str]:
    """Lists of a word: the left part up to a gram's end, the right part from its start."""
    left = [f"<{word[:end]}" for _, end in grams]
    return left + [f">{word[start:]}" for start, _ in grams]


def one_edit(a: str, b: str) -> bool:
    """Whether one code point put in, left out or replaced makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _shared_edge(words: list[str]) -> int:
    """How many letters at the beginning all of the words share."""
    low, high = min(words), max(words)
    at = 0
    while at < len(low) and low[at] == high[at]:
        at += 1
    return at


def near_in(members: list[str]) -> Iterator[tuple[str, str]]:
    """Every two distinct members one edit apart, the first one first."""
    if len(members) <= COMPARED:
        groups: Iterable[list[str]] = [members]
    else:
        # What all share has no part in an edit. Words one edit apart leave the same after a
        # deletion from one of them or from both.
        at = _shared_edge(members)
        back = _shared_edge([m[at:][::-1] for m in members])
        met: dict[str, list[str]] = {}
        for m in members:
            core = m[at : len(m) - back]
            for left in {core, *(core[:i] + core[i + 1 :] for i in range(len(core)))}:
                met.setdefault(left, []).append(m)
        groups = met.values()
    found = set()
    for group in groups:
        for i, a in enumerate(group):
            found.update((a, b) if a < b else (b, a) for b in group[i + 1 :] if one_edit(a, b))
    yield from found


def _digest(key: str) -> int:
    """64 bits of a list's key; a chance meeting costs a comparison, as all are verified."""
    return xxhash.xxh64_intdigest(key.encode("utf-8")) - (1 << 63)


def _lists(words: DataFrame, index: GramIndex) -> DataFrame:
    """``key, word``: the lists of every word; ``key`` is null for words that need the other way."""
    held = words.sparkSession.sparkContext.broadcast(index)

    def enter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            keys: list[int | None] = []
            owner: list[int] = []
            for row, word in enumerate(batch.column("word").to_pylist()):
                grams, filtered = index.rarest(word)
                own = list({_digest(k) for k in list_keys(word, grams)})
                if not filtered:
                    own.append(None)
                keys += own
                owner += [row] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column("word").take(pa.array(owner, pa.int32()))],
                names=["key", "word"],
            )

    return words.select("word").mapInArrow(enter, "key bigint, word string")


def _pairs_of(lists: DataFrame) -> DataFrame:
    """``word, near`` of the words one edit apart in a list (``members``), the first one first."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pair for members in batch.column("members").to_pylist() for pair in near_in(members)]
            word, near = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.string()), pa.array(near, pa.string())], names=["word", "near"]
            )

    return lists.select("members").mapInArrow(merge, "word string, near string")


def _grouped(keyed: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Lists of ``LIST`` members at most, as arrays; and the rows of the larger ones."""
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(keyed.join(materialize(sizes, f"{name}-sizes"), "key"), name)
    small = shared.where(F.col("size") <= LIST).groupBy("key").agg(F.collect_list("word").alias("members"))
    return small, shared.where(F.col("size") > LIST).select("key", "word")


def _after_one_deletion(rest: DataFrame) -> DataFrame:
    """Lists (``members``) of the words of one ``key`` that meet after at most one deletion.

    A list has the words one insertion away from one string, and the string itself: at most
    letters x places, whatever the corpus.
    """

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[int] = []
            owner: list[int] = []
            for row, (key, word) in enumerate(zip(batch.column("key").to_pylist(), batch.column("word").to_pylist())):
                left = {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}
                keys += [_digest(f"{key}:{x}") for x in left]
                owner += [row] * len(left)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column("word").take(pa.array(owner, pa.int32()))],
                names=["key", "word"],
            )

    met = rest.mapInArrow(spread, "key bigint, word string").groupBy("key")
    return met.agg(F.collect_list("word").alias("members")).where(F.size("members") > 1)


def near_words(
    words: DataFrame, gram: tuple[int, int] = GRAM, frequent: int = FREQUENT
) -> DataFrame:
    """``word, near``: every two distinct words one edit apart, both ways, once.

    ``words`` has distinct, non-empty words.
    """
    ship_package(words.sparkSession)
    index = GramIndex.of(frequent_grams(words, gram, frequent), gram)
    # Decomposing takes long for its few bytes.
    tasks = max(1, -(-words.count() // TASK_WORDS))
    lists = materialize(_lists(words.repartition(tasks), index), "gram-lists")
    small, large = _grouped(lists.where("key is not null"), "shared-lists")
    rest = lists.where("key is null").select(F.lit(0).cast("long").alias("key"), "word")
    lists = small.select("members").union(_after_one_deletion(large.union(rest)).select("members"))
    found = materialize(_pairs_of(lists).distinct(), "near-words")
    return found.union(found.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` by following ``form`` to its end; each round doubles the steps.

    Forms occur ten times as often as their words, so no chain is longer than the digits
    of the largest count.
    """
    step = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(
            step.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots"
        )
        if not moved.where("next is not null").limit(1).count():
            return moved.select("word", "root")
        step = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    A word is a run of Latin letters, lower-cased in A-Z, with one code point missing in the
    documents its digest picks; it has at least ``least_chars`` code points and occurs at
    least ``least_count`` times. Its form is the near word (one edit away) that occurs most
    often, of equals the first in code-point order, if at least ``times`` as often as the
    word. ``root`` ends the chain of forms.

    Null and empty texts have no words. A row without an id counts with an empty id.
    Repeated rows count each. An empty table gives no rows; other columns are ignored.
    """
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", whole_text())
    words = materialize(words_of(rows, least_chars, least_count), "words")
    near = near_words(words)
    counted = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # Of equals the first in byte order of UTF-8, which is that of code points.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    judged = words.join(counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best), "word", "left")
    has = -F.col("best.less") >= times * F.col("n")
    judged = materialize(
        judged.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best.near")).alias("form"),
            F.when(has, -F.col("best.less")).alias("form_n"),
        ),
        "judged-words",
    )
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
