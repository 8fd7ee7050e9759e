"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders, so a question whose parameters were
changed keeps its template. Windows of the template are matched by hash against those of
the benchmark. A second stream of windows, of the plain lower-cased words, has no names: it
finds what was copied in other capitals, where names can't be told. Each stream is judged
on its own. Matches of one document and item whose alignments differ by a few words are put
together, as words may have been put in or left out; the values behind the placeholders must then map consistently (one value of the
item always to the same value of the document), which tells a re-parameterised question
from a text that only has its form.

Only DataFrame functions. Each stream hashes its windows in the task that reads the text and
hash-joins them with the benchmark's, which are broadcast where their written size allows;
only matches go on. The values behind the placeholders are built for texts with a match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import SPACE, pick, whole_text

WINDOW = 8
# Items of fewer words identify nothing; windows need as many words besides placeholders.
LEAST_WORDS = 4
COVERAGE = 0.5
# Fixed list of measuring units that may follow a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec min h hr hrs day days "
    "week weeks month months year years ms kb mb gb tb hz khz mhz ghz w kw kwh v a pa bar k "
    "mph kmh usd eur dollars euros cents percent degrees meters metres kilometers miles feet "
    "inches grams kilograms pounds liters litres hours minutes seconds"
).split()
# Streams of windows and whether names are placeholders in them.
STREAMS = {"named": True, "plain": False}
# Items without a usable window are one window of all their words as they are.
WHOLE = "whole"
# Words that start a sentence with a capital and are no names; any other word may be one.
STARTERS = (
    "a all also although an and any are as at be because before both but by can compute could "
    "determine did do does each every finally find first for from given had has have he her his "
    "how however i if in is it its let many may might must next no nor not now of on or our "
    "shall she should since so some solve suppose than that the their then there therefore these "
    "they this those though thus to until was we well were what when where which while who whom "
    "whose why will with would yes you your after during"
).split()
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
# Digests of the benchmark in one file. Were there a file for each shuffle partition, their
# footers could make up most of the table's size, by which Spark decides to broadcast it.
DIGESTS = 1_000_000
# Alignments of one leak differ by at most so many words, or a quarter of the item's windows.
DRIFT = 8
# Marks while the punctuation goes: before names, for separators inside numbers, between
# words of one placeholder, after words with punctuation, before units.
_NAME, _POINT, _JOIN, _BREAK, _UNIT = MARKS = "\x01\x02\x03\x04\x05"


@dataclass(frozen=True)
class Step:
    """One replacement. Texts that ``gate`` rules out are the same afterwards."""

    gate: Callable[[Column], Column] | None
    apply: Callable[[Column], Column]


def _has(mark: str) -> Callable[[Column], Column]:
    return lambda text: F.contains(text, F.lit(mark))


def _digits(text: Column) -> Column:
    return text.rlike("[0-9]")


def _replace(pattern: str, by: str) -> Callable[[Column], Column]:
    return lambda text: F.regexp_replace(text, pattern, by)


PUNCTUATION = Step(None, _replace(rf"[^\p{{L}}\p{{N}}{SPACE}{MARKS}]+", ""))


def _marked(names: bool) -> list[Step]:
    """Steps to a text without punctuation whose names, numbers and units carry marks."""
    number, gap = rf"\d[\d{_POINT}]*", f"[{SPACE}{_BREAK}]"
    units = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    # A capital after a small letter or comma: inside a sentence, so a name. Elsewhere it is
    # one too, unless the word is a usual first one. What is around a passage has no say.
    inside = r"(?<=[\p{Ll},;][ ])"
    usual = rf"(?!(?i:{'|'.join(STARTERS)})(?![\p{{L}}\p{{N}}]))"
    anywhere = rf"(?<![^{SPACE}\"“‘«„(\[¿¡]){usual}"
    steps = [
        Step(lambda text: text.rlike(f"[{MARKS}]"), _replace(f"[{MARKS}]+", "")),
        Step(None, _replace(rf"(?=\p{{Lu}}\p{{L}})(?:{inside}|{anywhere})", _NAME)) if names else None,
        Step(_digits, _replace(r"(?<=\d)[.,:](?=\d)", _POINT)),
        Step(None, _replace(rf"[.,;:!?)]+(?=[{SPACE}])", _BREAK)) if names else None,
        PUNCTUATION,
        Step(_digits, _replace(rf"(?<![\p{{L}}\p{{N}}])({number}){gap}*((?i:{units}))(?![\p{{L}}\p{{N}}])", f"$1 {_UNIT}$2")),
        # Numbers are neighbours whatever stands between them, names only without punctuation.
        Step(_digits, _replace(rf"(?<![\p{{L}}\p{{N}}])({number}){gap}+(?={number}(?![\p{{L}}\p{{N}}]))", f"$1{_JOIN}")),
        Step(_has(_NAME), _replace(rf"({_NAME}\p{{L}}+)[{SPACE}]+(?={_NAME})", f"$1{_JOIN}")) if names else None,
    ]
    return [step for step in steps if step]


def _template(names: bool) -> list[Step]:
    """Steps from a marked text to its template."""
    # Possessive groups: the others take a stack frame for each word of a run, and a table of
    # names or numbers has thousands.
    number = rf"\d[\d{_POINT}]*"
    steps = [
        Step(_digits, _replace(rf"(?<![\p{{L}}\p{{N}}]){number}(?:{_JOIN}{number})*+", NUMBER)),
        Step(_has(_UNIT), _replace(rf"{_UNIT}\p{{L}}+", UNIT)),
        Step(_has(_NAME), _replace(rf"{_NAME}\p{{L}}+(?:{_JOIN}{_NAME}\p{{L}}+)*+", NAME)) if names else None,
        Step(lambda text: text.rlike(f"[{MARKS}]"), _replace(f"[{MARKS}]+", "")),
        Step(None, F.lower),
    ]
    return [step for step in steps if step]


def _values(marked: Column) -> Column:
    return F.lower(F.translate(marked, _POINT + _JOIN + _NAME + _BREAK + _UNIT, "." + _JOIN))


def canonical(text: Column, names: bool = True) -> tuple[Column, Column]:
    """The template of a text and, word for word beside it, its lower-cased values.

    Neighbouring names and neighbouring numbers are one placeholder, whose value has all of
    them. A unit is a word of its own also where it is written to its number. Without
    ``names`` the template is the same whatever the capitals.
    """
    marked = reduce(lambda t, step: step.apply(t), _marked(names), text)
    return reduce(lambda t, step: step.apply(t), _template(names), marked), _values(marked)


def _gated(rows: DataFrame, column: str, steps: list[Step], digits: str | None = None) -> DataFrame:
    """The steps, each only where its gate is open: a projection each, so none is repeated.

    ``digits`` names a column that has said already whether the text has any.
    """
    for step in steps:
        done = step.apply(F.col(column))
        if step.gate is not None:
            known = digits is not None and step.gate is _digits
            open_ = F.col(digits) if known else step.gate(F.col(column))
            done = F.when(open_, done).otherwise(F.col(column))
        rows = rows.withColumn(column, done)
    return rows


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def _templates(rows: DataFrame, whole: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``keep`` and, for each stream, words of its template and of the values beside them.

    The ``whole`` stream has the values in both places.
    """
    columns = ["id", *keep]
    for stream, names in STREAMS.items():
        template, values = canonical(F.col("text"), names)
        columns += [_words(template).alias(f"{stream}_template"), _words(values).alias(f"{stream}_slots")]
    if whole:
        words = _words(F.translate(canonical(F.col("text"), names=False)[1], _JOIN, " "))
        columns += [words.alias(f"{WHOLE}_template"), words.alias(f"{WHOLE}_slots")]
    return rows.select(*columns)


def _digest(stream: str, window: Column) -> Column:
    return F.xxhash64(window, F.lit(stream))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``stream, h, width, item, at, literal, template, slots`` of every usable window.

    An item shorter than a window is one window of its own length. An item that has no
    usable window in any stream is one of all its words; ``h`` and ``width`` are then those
    of its first words, at most ``window``.
    """
    cut = _templates(items, whole=True)
    parts = []
    for stream in STREAMS:
        one = cut.select("id", F.col(f"{stream}_template").alias("template"), F.col(f"{stream}_slots").alias("slots"))
        width = F.least(F.lit(window), F.size("template")).alias("width")
        starts = one.where(F.size("template") >= LEAST_WORDS).select("*", width)
        at = F.explode(F.sequence(F.lit(1), F.size("template") - F.col("width") + 1)).alias("at")
        spans = starts.select("*", at).select(
            F.col("id").alias("item"),
            "width",
            "at",
            F.slice("template", F.col("at"), F.col("width")).alias("template"),
            F.slice("slots", F.col("at"), F.col("width")).alias("slots"),
        )
        free = F.col("width") - F.size(F.filter("template", lambda w: w.startswith("<")))
        parts.append(
            spans.withColumn("free", free)
            .where(F.col("free") >= LEAST_WORDS)
            .select(
                F.lit(stream).alias("stream"),
                _digest(stream, F.col("template")).alias("h"),
                "width",
                "item",
                "at",
                (F.col("free") == F.col("width")).alias("literal"),
                "template",
                "slots",
            )
        )
    usable = reduce(DataFrame.union, parts)
    words = F.col(f"{WHOLE}_template")
    width = F.least(F.lit(window), F.size(words))
    rest = cut.where(F.size(words) >= LEAST_WORDS).join(
        usable.select(F.col("item").alias("id")).distinct(), "id", "left_anti"
    )
    whole = rest.select(
        F.lit(WHOLE).alias("stream"),
        _digest(WHOLE, F.slice(words, F.lit(1), width)).alias("h"),
        width.alias("width"),
        F.col("id").alias("item"),
        F.lit(1).alias("at"),
        F.lit(True).alias("literal"),
        words.alias("template"),
        words.alias("slots"),
    )
    return usable.union(whole)


def _plain(text: Column) -> Column:
    """The template without names, every step done."""
    return reduce(lambda t, step: step.apply(t), [*_marked(False), *_template(False)], text)


def _stream_words(rows: DataFrame, streams: list[str]) -> DataFrame:
    """``id, key, stream, words`` for each row and stream: the words of the stream's windows.

    Steps that two streams have in common are done once; the whole stream comes alone.
    """
    # No step before the placeholders makes a digit or takes one away, so one look at the text does.
    rows = rows.withColumn("digits", _digits(F.col("text"))).withColumn("words", F.col("text"))
    named = "named" in streams
    marked = _marked(named)
    shared = marked.index(PUNCTUATION) + 1
    rows = _gated(rows, "words", marked[:shared], "digits")
    texts = {}
    if named and "plain" in streams:
        # Without digits all that differs by now are the marks.
        unmarked = F.lower(_replace(f"[{MARKS}]+", "")(F.col("words")))
        rows = rows.withColumn("plain", F.when(F.col("digits"), _plain(F.col("text"))).otherwise(unmarked))
        texts["plain"] = F.col("plain")
    rows = _gated(rows, "words", marked[shared:], "digits")
    if streams == [WHOLE]:
        texts[WHOLE] = F.translate(_values(F.col("words")), _JOIN, " ")
    else:
        rows = _gated(rows, "words", _template(named), "digits")
        texts["named" if named else "plain"] = F.col("words")
    each = F.array(*(F.struct(F.lit(s).alias("stream"), _words(texts[s]).alias("words")) for s in streams))
    return rows.select("id", "key", F.explode_outer(each).alias("one")).select("id", "key", "one.stream", "one.words")


def _windows(docs: DataFrame, widths: dict[str, list[int]]) -> DataFrame:
    """``id, key, stream, width, h, pos`` of all windows of some streams, by their widths."""
    # No filter on the array, also not the one Spark infers for a plain explode: it would be
    # pushed below the steps and repeat them.
    every = sorted({w for of in widths.values() for w in of})
    some = F.size("words") >= every[0]
    pos = F.when(some, F.sequence(F.lit(1), F.size("words") - (every[0] - 1)))
    rows = _stream_words(docs, sorted(widths)).select("id", "key", "stream", "words", F.explode_outer(pos).alias("pos"))

    def digest(width: int) -> Column:
        # Word by word: generated code, and no copy of the window.
        return F.xxhash64(*(F.get("words", F.col("pos") + k - 1) for k in range(width)), F.col("stream"))

    if len(every) == 1:
        return rows.select("id", "key", "stream", F.lit(every[0]).alias("width"), digest(every[0]).alias("h"), "pos")
    each = F.explode(F.array(*(F.struct(F.lit(w).alias("width"), digest(w).alias("h")) for w in every)))
    return rows.select("id", "key", "stream", "pos", each.alias("one")).select("id", "key", "stream", "one.width", "one.h", "pos")


def _matches(docs: DataFrame, known: DataFrame, kinds: list[tuple[str, int]], longest: int) -> DataFrame:
    """``doc, stream, h, width, pos, words, values, before`` of windows in ``known``.

    ``before`` counts the words before a window, each of a placeholder's for itself.
    ``kinds`` are the streams and widths of the benchmark's windows, whose digests are
    ``known``. ``words`` of the whole stream go on to ``longest``.
    """
    docs = docs.withColumn("key", F.xxhash64("text"))
    used = sorted({s for s, _ in kinds})
    widths = {s: sorted(w for t, w in kinds if t == s) for s in used}
    # Streams that share steps and widths go through the text together.
    together: list[dict[str, list[int]]] = []
    for stream in used:
        beside = next((d for d in together if WHOLE not in (stream, *d) and widths[stream] in d.values()), None)
        if beside is None:
            together.append({stream: widths[stream]})
        else:
            beside[stream] = widths[stream]
    hits = reduce(DataFrame.union, [_windows(docs, d).join(known, ["stream", "width", "h"]) for d in together])
    hits = materialize(hits.select("id", "key", "stream", "width", "h", "pos"), "template-hits")
    # The windows of one text; their templates are built again, now with the values.
    per_doc = hits.groupBy("id", "key").agg(F.collect_list(F.struct("h", "stream", "width", "pos")).alias("found"))
    matched = docs.join(per_doc, ["id", "key"]).select("id", "text", "found")
    found = _templates(matched, whole=WHOLE in used, keep=("found",))

    def length(stream: str, x: Column) -> Column:
        return F.lit(longest) if stream == WHOLE else x["width"]

    def of_stream(kind: str, x: Column) -> Column:
        taken = [F.when(x["stream"] == s, F.slice(f"{s}_{kind}", x["pos"], length(s, x))) for s in used]
        return F.coalesce(*taken)

    def before(x: Column) -> Column:
        start = x["pos"] - 1
        text = [
            F.when(x["stream"] == s, F.array_join(F.slice(f"{s}_slots", F.lit(1), start), " ")) for s in used
        ]
        return start + F.size(F.split(F.coalesce(*text), _JOIN)) - 1

    # Only the few words of the matches go on.
    shown = F.transform(
        "found",
        lambda x: F.struct(
            x["stream"].alias("stream"),
            x["h"].alias("h"),
            x["width"].alias("width"),
            x["pos"].alias("pos"),
            of_stream("template", x).alias("words"),
            of_stream("slots", x).alias("values"),
            before(x).alias("before"),
        ),
    )
    # A filter on the arrays, also the one Spark infers for a plain explode, would be pushed
    # below the templates and build them anew for every window.
    rows = found.select(F.col("id").alias("doc"), F.explode_outer(shown).alias("m"))
    return rows.where("m is not null").select("doc", "m.*")


def _pairs(matches: Column) -> Column:
    """The distinct slots of matches, with both values."""
    return F.array_distinct(F.flatten(F.transform(matches, lambda m: m["pairs"])))


def _kinds(pairs: Column) -> Column:
    """How many values of the item stand in the slots; as many as pairs if these are consistent."""
    return F.size(F.array_distinct(F.transform(pairs, lambda p: F.struct(p["kind"], p["theirs"]))))


def _joined(done: Column, more: Column) -> Column:
    """``done`` with the matches of windows it has not, if all slots are then consistent."""
    new = F.filter(more, lambda m: ~F.exists(done, lambda d: d["at"] == m["at"]))
    both = F.concat(done, new)
    return F.when(_kinds(_pairs(both)) == F.size(_pairs(both)), both).otherwise(done)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, coverage, n_windows, start_word, n_slots, verbatim``: the leaks.

    One row for each document and item that it leaks, with the best place (of equal ones the
    first). An item leaks if at least ``coverage`` of its windows in a stream match on
    alignments of one band and their slots are consistent, or if windows without slots reach
    it alone. ``start_word`` counts the document's words without punctuation, from 0; a unit
    is a word.

    An item without a usable window (eight words of which four are free, or all of a shorter
    item) leaks if all its words and numbers stand there in a row; with other numbers it is
    not found. Where all is in capitals, names can't be told: other names are not found there.
    Null and empty texts, items under four words and rows with a null id match nothing.
    Of repeated rows, each pair is reported once. Either table may be empty. Other columns
    are ignored.
    """
    rows = pick(docs, id_col, text_col).toDF("id", "text").withColumn("text", whole_text())
    bench = pick(items, "item_id", "text").toDF("id", "text").withColumn("text", whole_text())
    usable = materialize(benchmark_windows(bench.where("id is not null"), window), "benchmark")
    sizes = usable.groupBy("item", "stream").agg(F.countDistinct("at").alias("n_windows"))
    files = 1 + usable.count() // DIGESTS
    known = materialize(usable.select("stream", "width", "h").distinct().coalesce(files), "benchmark-digests")
    kinds = [tuple(r) for r in known.select("stream", "width").distinct().collect()]
    longest = usable.where(F.col("stream") == WHOLE).agg(F.max(F.size("template"))).first()[0]
    rows = rows.where("id is not null")
    # Without a usable item nothing matches.
    found = materialize(
        _matches(rows if kinds else rows.limit(0), known, kinds or [("plain", window)], longest or 0),
        "template-matches",
    )
    # The digest finds; the words confirm.
    theirs = usable.select("stream", "h", "width", "item", "at", "literal", F.col("template").alias("theirs"), "slots")
    same = F.slice("words", F.lit(1), F.size("theirs")) == F.col("theirs")
    paired = found.join(theirs, ["stream", "h", "width"]).where(same).drop("words")
    paired = paired.withColumnRenamed("theirs", "words")
    slots = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 1),
            lambda i: F.when(
                F.get(F.col("words"), i).startswith("<"),
                F.struct(
                    F.get(F.col("words"), i).alias("kind"),
                    F.get(F.col("slots"), i).alias("theirs"),
                    F.get(F.col("values"), i).alias("ours"),
                ),
            ),
        ),
        lambda s: s.isNotNull(),
    )
    aligned = (
        paired.select(
            "doc",
            "item",
            "stream",
            (F.col("pos") - F.col("at")).alias("diagonal"),
            F.struct("at", "before", "literal", slots.alias("pairs")).alias("match"),
        )
        .groupBy("doc", "item", "stream", "diagonal")
        .agg(F.collect_set("match").alias("matches"))
        .join(sizes, ["item", "stream"])
    )
    # Bands are two drifts wide and begin at every drift: alignments that differ by no more
    # than that share one.
    drift = F.greatest(F.lit(DRIFT), F.floor(F.col("n_windows") / 4))
    band = F.floor(F.col("diagonal") / drift)
    bands = (
        aligned.withColumn("band", F.explode(F.array(band, band - 1)))
        .groupBy("doc", "item", "stream", "n_windows", "band")
        .agg(
            F.sort_array(
                F.collect_list(F.struct((-F.size("matches")).alias("fewer"), "diagonal", "matches"))
            ).alias("found")
        )
        .withColumn("all", F.flatten("found.matches"))
    )
    # The alignments of a band by the number of their matches: each adds the windows that
    # are missing so far, if their slots agree with those taken.
    taken = F.aggregate(
        "found", F.filter("all", lambda m: F.lit(False)), lambda done, one: _joined(done, one["matches"])
    )

    def places(matches: Column) -> Column:
        return F.size(F.array_distinct(F.transform(matches, lambda m: m["at"]))) / F.col("n_windows")

    counted = bands.withColumn("taken", taken).withColumn("coverage", places(F.col("taken")))
    plain = F.filter("all", lambda m: m["literal"])
    shown = F.when(F.col("coverage") >= coverage, F.col("taken")).otherwise(F.col("all"))
    leaks = (
        counted.withColumn("plain", places(plain))
        .where((F.col("coverage") >= coverage) | (F.col("plain") >= coverage))
        .withColumn("shown", shown)
        .withColumn("pairs", _pairs(F.col("shown")))
        .select(
            "doc",
            "item",
            F.greatest("coverage", "plain").alias("coverage"),
            "n_windows",
            F.array_min(F.transform("shown", lambda m: F.struct(m["at"].alias("at"), m["before"].alias("before"))))["before"].alias("start_word"),
            _kinds(F.col("pairs")).cast("int").alias("n_slots"),
            F.forall("pairs", lambda p: p["theirs"] == p["ours"]).alias("verbatim"),
        )
    )
    best = F.struct("coverage", (-F.col("start_word")).alias("early"), "start_word", "n_slots", "verbatim", "n_windows")
    return (
        leaks.groupBy("doc", "item")
        .agg(F.max(best).alias("best"))
        .select(
            F.col("doc").alias("doc_id"),
            F.col("item").alias("item_id"),
            "best.coverage",
            "best.n_windows",
            "best.start_word",
            "best.n_slots",
            "best.verbatim",
        )
    )
