"""Quality rules: a threshold table compiled into one projection.

Each rule bounds one metric of the text. The metrics are column expressions, the table is
turned into one boolean expression, and a document is read once; nothing is shuffled.
Only DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, pick, whole_text

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    "the of and to in is a that it for on with as was at by be this are from or an have not "
    "der die das und ist von zu den mit im auf für ein eine nicht dem des sich "
    "le la les de et un une du que qui dans est pour par sur au en avec "
    "el los las y se del una con por para su al lo como más".split()
)


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie between the bounds, both inclusive; None is open."""

    metric: str
    least: float | None = None
    most: float | None = None


# Ratios of the whole text. Letters of a word, symbols for each word, words that are stop
# words, lines that repeat, capital letters among letters.
RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_word_ratio", 0.05, None),
    Rule("dup_line_ratio", None, 0.3),
    Rule("capital_ratio", None, 0.4),
)
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20


def metrics() -> dict[str, Column]:
    """Ratios over the counted columns; 0 where there is nothing to divide by."""

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    c = F.col
    return {
        "mean_word_chars": ratio(c("word_chars"), c("n_words")),
        "symbols_per_word": ratio(c("n_symbols"), c("n_words")),
        "stop_word_ratio": ratio(c("n_stop_words"), c("n_words")),
        "dup_line_ratio": ratio(c("n_dup_lines"), c("n_lines")),
        "capital_ratio": ratio(c("n_capitals"), c("n_letters")),
    }


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """True if no rule is broken."""
    known = metrics()
    tests = [F.lit(True)]
    for rule in rules:
        value = known[rule.metric]
        if rule.least is not None:
            tests.append(value >= rule.least)
        if rule.most is not None:
            tests.append(value <= rule.most)
    return reduce(lambda a, b: a & b, tests)


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word, symbol, line and repetition counts of every text.

    Repeated windows are looked for by comparing a text's windows with their distinct
    set. Only texts in which the two differ are sorted, to see which words are covered.
    """
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("text", whole_text())
    words = rows.withColumn("words", F.array_remove(F.split("text", f"[{SPACE}]+"), ""))
    size = F.size("words")
    windows = words.withColumn("n_words", size.cast("long")).withColumn(
        "windows",
        F.when(
            size >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), size - (WINDOW - 1)),
                lambda i: F.array_join(F.slice("words", i, WINDOW), " "),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))

    def without(chars: str) -> Column:
        return F.length("text") - F.length(F.translate("text", chars, ""))

    letters = F.length("text") - F.length(F.regexp_replace("text", r"\p{L}", ""))
    capitals = F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}", ""))
    stop = F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    counted = windows.select(
        "doc_id",
        "n_words",
        (F.length("text") - without(" \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.size(stop).cast("long").alias("n_stop_words"),
        letters.cast("long").alias("n_letters"),
        capitals.cast("long").alias("n_capitals"),
        F.when(
            repeats,
            F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
        ).alias("ranked"),
    )

    def repeated(j: Column) -> Column:
        here = F.get(F.col("ranked"), j)["w"]
        before, after = F.get(F.col("ranked"), j - 1)["w"], F.get(F.col("ranked"), j + 1)["w"]
        return F.coalesce(here == before, F.lit(False)) | F.coalesce(here == after, F.lit(False))

    # Starts of repeated windows, in order of the text.
    starts = F.sort_array(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.size("ranked") - 1), repeated),
            lambda j: F.get(F.col("ranked"), j)["i"],
        )
    )
    found = counted.withColumn("starts", F.when(F.col("ranked").isNotNull(), starts)).drop("ranked")
    # A window covers five words, or those up to the next repeated window.
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size("starts") - 1),
        F.lit(0).cast("long"),
        lambda n, j: n
        + F.coalesce(
            F.least(F.lit(WINDOW), F.get(F.col("starts"), j + 1) - F.get(F.col("starts"), j)),
            F.lit(WINDOW),
        ),
    )
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("starts").isNotNull(), covered)
        .otherwise(F.lit(0).cast("long"))
        .alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_stop_words",
        "n_letters",
        "n_capitals",
    )


def quality_verdict(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The counts of every document with ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base. Repeated rows and null ids are
    judged like any other row; an empty table gives no rows; other columns are ignored.
    """
    base = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        text_counts(docs, id_col, text_col)
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
    )
