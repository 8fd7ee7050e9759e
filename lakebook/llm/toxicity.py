"""Toxicity by gradient-boosted trees over dense features, calibrated isotonically.

Features of a text: densities of a fixed and of a learned lexicon, second-person words near
hits, capitals, punctuation and obfuscated spellings. All is fitted on a bounded sample of
labelled rows: each half gets its features from a lexicon learned on the other half, most
rows train the trees, the rest the calibration; texts are scored with the lexicon of all.
Scoring reads every text once and shuffles nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import pick, ship_package, uniform, whole_text

# Labelled rows used to fit, at most.
SAMPLE = 20_000
# Share of the sample kept for the calibration.
TUNED = 0.2
THRESHOLD = 0.7
# Learned terms: at most so many, each in so many toxic documents, and with a logarithm of
# odds (toxic to other documents) of at least so much. Beginnings have these lengths.
TERMS = 400
TERM_SUPPORT = 4
TERM_ODDS = 1.2
PREFIXES = tuple(range(4, 10))
BATCH_TERMS = 100_000
# Words of a hit's surroundings in which a second-person word counts.
NEAR = 5
# Weight of the trees' own probability, which orders texts of one calibrated step.
SLOPE = 0.02
# Words a task remembers.
CACHE_WORDS = 100_000

INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb fool loser losers trash scum pathetic worthless "
    "disgusting clown ugly filthy imbecile vermin garbage hate shut kill crap bastard jerk "
    "dumm dummkopf trottel versager abschaum dreck ekelhaft wertlos hässlich depp "
    "imbécile crétin abruti minable ordure raclure dégoûtant débile ridicule bouffon "
    "idiota imbécil estúpido tonto basura escoria patético inútil asqueroso payaso".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes "
    "vous votre vos tú ti contigo usted ustedes vosotros su sus".split()
)
EDGE = "\"'`.,;:!?()[]{}<>|*#$%&-_/\\…«»“”‘’„¡¿~^=+"
LEET = str.maketrans("013457@$!", "oieastasi")
INNER = re.compile(r"[^\W\d_][\d@$!*._\-]+[^\W\d_]|[^\W\d_]*[@$013457][^\W\d_]+", re.UNICODE)
SEPARATORS = re.compile(r"[*._\-~]")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
REPEATED = re.compile(r"[!?]{2,}")
CAPITALS = bytes(range(65, 91))
LETTERS = CAPITALS + bytes(range(97, 123))

FEATURES = (
    "insults",
    "learned",
    "learned_weight",
    "strongest",
    "hits",
    "distinct_hits",
    "addressed",
    "second_person",
    "capitals",
    "shouted",
    "exclaimed",
    "asked",
    "repeated_marks",
    "obfuscated",
    "disguised",
    "log_words",
    "mean_chars",
)
INSULT, LEARNED, SECOND, ODD, DISGUISED = 1, 2, 4, 8, 16
# The weight of a word stands above these bits, in steps.
KIND_BITS, STEPS = 5, 16


@dataclass(frozen=True)
class Lexicon:
    """Learned terms (``=word`` or ``^beginning``) and their weights."""

    terms: tuple[tuple[str, float], ...] = ()


class Kinds(dict):
    """What a lower-case word counts as, remembered."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.terms = dict(lexicon.terms)

    def weight(self, word: str) -> float:
        """Of the strongest term that fits; 0 if none does."""
        get = self.terms.get
        return max(get(f"={word}", 0.0), *(get(f"^{word[:n]}", 0.0) for n in PREFIXES if len(word) >= n), 0.0)

    def __missing__(self, raw: str) -> int:
        word = raw.strip(EDGE)
        weight = self.weight(word)
        kind = (word in INSULTS) * INSULT | (weight > 0) * LEARNED
        kind |= (word in SECOND_PERSON) * SECOND
        if INNER.fullmatch(word) or SEPARATORS.search(word) or word.translate(LEET) != word:
            plain = SEPARATORS.sub("", word.translate(LEET))
            letters = any(c.isalpha() for c in word)
            kind |= ODD * (letters and INNER.search(word) is not None)
            if not kind & (INSULT | LEARNED) and letters and plain in INSULTS:
                kind |= DISGUISED
        kind |= round(weight * STEPS) << KIND_BITS
        self[raw] = kind
        return kind


def features(text: str, kinds: Kinds) -> list[float]:
    """The values of ``FEATURES``; all 0 for a text without words."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    if len(kinds) > CACHE_WORDS:
        kinds.clear()
    kind = np.fromiter(map(kinds.__getitem__, words), dtype=np.int32, count=n)
    weights = (kind >> KIND_BITS) / STEPS
    hit = (kind & (INSULT | LEARNED | DISGUISED)) > 0
    places, persons = np.flatnonzero(hit), np.flatnonzero(kind & SECOND)
    addressed = 0
    if len(places) and len(persons):
        lo = np.searchsorted(persons, places - NEAR)
        addressed = int((np.searchsorted(persons, places + NEAR, side="right") > lo).sum())
    raw = text.encode("utf-8", "surrogatepass")
    letters = len(raw) - len(raw.translate(None, LETTERS))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    learned = int(((kind & LEARNED) > 0).sum())
    per = 100.0 / n
    return [
        per * int(((kind & INSULT) > 0).sum()),
        per * learned,
        per * float(weights.sum()),
        float(weights.max()),
        math.log1p(len(places)),
        math.log1p(len({words[i] for i in places.tolist()})),
        per * addressed,
        per * len(persons),
        capitals / max(letters, 1),
        per * len(SHOUTED.findall(text)),
        per * text.count("!"),
        per * text.count("?"),
        per * len(REPEATED.findall(text)),
        per * int(((kind & ODD) > 0).sum()),
        per * int(((kind & DISGUISED) > 0).sum()),
        math.log1p(n),
        len(text) / n,
    ]


def with_features(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``rows`` with ``text`` replaced by its features, as doubles."""
    others = [c for c in rows.columns if c != "text"]
    ship_package(rows.sparkSession)

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Kinds(lexicon)  # goes with the task
        for batch in batches:
            values = [features(text.as_py(), kinds) for text in batch.column("text")]
            table = np.array(values, dtype=np.float64).reshape(-1, len(FEATURES))
            columns = [batch.column(c) for c in others] + [pa.array(c) for c in table.T.copy()]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *FEATURES])

    kept = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in others]
    return rows.mapInArrow(extract, ", ".join(kept + [f"{f} double" for f in FEATURES]))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``half, part, toxic, text`` of at most ``sample`` labelled documents outside the held-out fold."""
    marks = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null")
    marks = marks.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    order = uniform(F.lit(7), F.col("doc_id"))
    chosen = marks.where(~held_out(F.col("doc_id"))).withColumn("u", order).orderBy("u").limit(sample)
    part = uniform(F.lit(11), F.col("doc_id"))
    half = F.pmod(F.xxhash64(F.lit(13), F.col("doc_id")), F.lit(2)).cast("int")
    # At most ``sample`` rows of four numbers.
    ids = F.broadcast(chosen.select("doc_id", "toxic", part.alias("part"), half.alias("half")))
    return materialize(docs.join(ids, "doc_id").select("half", "part", "toxic", "text"), "labelled")


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words and word beginnings that mark the toxic texts of ``rows`` (``toxic, text``)."""
    ship_package(rows.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(seen: dict[str, list[int]]) -> pa.RecordBatch:
            both = np.array(list(seen.values()), dtype=np.int64).reshape(-1, 2)
            arrays = [pa.array(seen.keys(), pa.string()), pa.array(both[:, 0]), pa.array(both[:, 1])]
            return pa.RecordBatch.from_arrays(arrays, names=["term", "clean", "bad"])

        seen: dict[str, list[int]] = {}
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                words = {w.strip(EDGE) for w in set(text.lower().split())}
                terms = {f"={w}" for w in words}
                terms |= {f"^{w[:n]}" for w in words for n in PREFIXES if len(w) >= n}
                for term in terms:
                    seen.setdefault(term, [0, 0])[toxic] += 1
                if len(seen) > BATCH_TERMS:
                    yield flush(seen)
                    seen = {}
        yield flush(seen)

    terms = rows.select("toxic", "text").mapInArrow(count, "term string, clean bigint, bad bigint")
    totals = terms.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    sizes = dict(rows.groupBy("toxic").count().collect())
    base = math.log((sizes.get(1, 0) + 1) / (sizes.get(0, 0) + 1))
    odds = F.log((F.col("bad") + 0.5) / (F.col("clean") + 2.0)) - base
    best = (
        totals.withColumn("odds", odds)
        .where((F.col("bad") >= TERM_SUPPORT) & (F.col("odds") >= TERM_ODDS) & (F.length("term") > 2))
        .orderBy(F.desc(F.col("bad") * F.col("odds")), "term")
        .limit(TERMS)
        .select("term", "odds")
    )
    return Lexicon(tuple((r[0], r[1]) for r in best.collect()))


def _probability(column: str) -> Column:
    return F.get(vector_to_array(column), F.lit(1))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the columns ``carry`` of every row.

    Labels count outside the held-out fold only; a null label or id is none, and of
    several labels of one id the highest holds. With no label of either kind to learn from,
    every score is the smoothed share of toxic rows. Null and empty texts have no words and
    are scored by features of zero. Repeated rows and null ids are scored like any other;
    an empty table gives no rows; other columns are ignored, as are ``lang`` and ``source``.
    """
    carried = [f"carried_{i}" for i in range(len(carry))]
    rows = pick(docs, id_col, text_col, *carry).toDF("doc_id", "text", *carried)
    rows = rows.withColumn("text", whole_text())
    known = labelled_sample(rows.select("doc_id", "text"), labels, sample)
    halves = [known.where(F.col("half") == h) for h in (0, 1)]
    crossed = [with_features(halves[h], learn_lexicon(halves[1 - h])) for h in (0, 1)]
    # As many partitions as keep the few rows together.
    fitted = materialize(crossed[0].union(crossed[1]).coalesce(4), "fit-features")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    train = assembler.transform(fitted.where(F.col("part") >= TUNED))
    tuned = assembler.transform(fitted.where(F.col("part") < TUNED))
    lexicon = learn_lexicon(known)
    scored = assembler.transform(with_features(rows, lexicon))
    kinds = dict(train.groupBy("toxic").count().collect())
    if len(kinds) < 2:
        share = (kinds.get(1, 0) + 1.0) / (sum(kinds.values()) + 2.0)
        score = F.lit(share)
    else:
        trees = GBTClassifier(
            labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.3, seed=5, checkpointInterval=-1
        ).fit(train)
        scored = trees.transform(scored).withColumn("p", _probability("probability"))
        score = F.col("p")
        check = trees.transform(tuned).withColumn("p", _probability("probability"))
        if check.select("toxic").distinct().count() == 2:
            steps = IsotonicRegression(featuresCol="p", labelCol="toxic", predictionCol="calibrated")
            scored = steps.fit(check.select("p", F.col("toxic").cast("double").alias("toxic"))).transform(scored)
            score = (1 - SLOPE) * F.col("calibrated") + SLOPE * F.col("p")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"),
        *(F.col(c).alias(name) for c, name in zip(carried, carry)),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
