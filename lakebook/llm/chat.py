"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and
only its text is trainable. A conversation that does not end with an assistant turn gets
one more example without a trainable part, so that no turn is lost.

Only DataFrame functions. A conversation is grouped once; the examples stay in the task
that grouped it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, whole_text


@dataclass(frozen=True)
class Template:
    """Control strings around a turn: ``turn role text_mark text end``.

    Inside texts and roles a backslash is doubled, and one is put after the first
    character of every control string, the template's own or a foreign one. Removing a
    backslash before any character therefore restores the text.
    """

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    foreign: tuple[str, ...] = (
        "<s>",
        "</s>",
        "[INST]",
        "[/INST]",
        "<<SYS>>",
        "<</SYS>>",
        "<|im_start|>",
        "<|im_end|>",
        "<|endoftext|>",
    )

    def controls(self) -> tuple[str, ...]:
        return (self.turn, self.text, self.end, *self.foreign)

    def escape(self, text: Column) -> Column:
        starts = "|".join(map(re.escape, self.controls()))
        doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return F.regexp_replace(doubled, f"(?s)(?={starts})(.)", "$1\\\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def head(self, role: Column) -> Column:
        return F.concat(F.lit(self.turn), self.escape(role), F.lit(self.text))

    def turns(self, formatted: Column) -> Column:
        """The turns of a formatted text, as (role, text), unescaped."""
        pieces = F.split(formatted, re.escape(self.end))

        def parse(piece: Column) -> Column:
            both = F.split(F.substr(piece, F.lit(len(self.turn) + 1)), re.escape(self.text))
            return F.struct(
                self.unescape(F.get(both, F.lit(0))).alias("role"),
                self.unescape(F.get(both, F.lit(1))).alias("text"),
            )

        return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), parse)


def prefix_target_examples(
    turns: DataFrame, template: Template = Template(), target_role: str = "assistant"
) -> DataFrame:
    """``conv_id, lone, example, n_context, is_last, text, loss_start, loss_end``.

    ``example`` counts from 0 in a conversation, ``n_context`` are the turns before the
    last one shown. ``loss_start`` and ``loss_end`` bound the trainable characters of
    ``text`` (code points, end exclusive); both are null in the example that only keeps
    the turns after the last reply.

    Turns are ordered by number; a null number comes first, equal numbers are ordered by
    role, then text, and repeated rows stay. Null texts and roles are empty. Each row with a
    null ``conv_id`` is a conversation of its own, told apart by ``lone`` (null for the
    others). An empty table gives no examples; other columns are ignored.
    """
    lone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    rows = pick(turns, "conv_id", "turn", "role", "text").select(
        "conv_id", lone.alias("lone"), "turn", whole_text("role").alias("role"), whole_text().alias("text")
    )
    grouped = rows.groupBy("conv_id", "lone").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    formatted = grouped.select(
        "conv_id",
        "lone",
        F.transform(
            "turns",
            lambda t: F.struct(
                (t["role"] == target_role).alias("target"),
                template.head(t["role"]).alias("head"),
                template.escape(t["text"]).alias("body"),
            ),
        ).alias("turns"),
    )
    rendered = formatted.select(
        "conv_id",
        "lone",
        "turns",
        F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(template.end))).alias("parts"),
    )
    # Positions of the last turn of each example.
    shown = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: F.get(F.col("turns"), i)["target"] | (i == F.size("turns") - 1),
    )
    examples = rendered.select("conv_id", "lone", "turns", "parts", F.posexplode(shown).alias("example", "at"))
    text = F.array_join(F.slice("parts", F.lit(1), F.col("at") + 1), "")
    last = F.get(F.col("turns"), F.col("at"))
    length = F.length("text")
    return (
        examples.select(
            "conv_id",
        "lone",
            "example",
            F.col("at").alias("n_context"),
            (F.col("at") == F.size("turns") - 1).alias("is_last"),
            text.alias("text"),
            last["target"].alias("target"),
            F.length(last["body"]).alias("body_chars"),
        )
        .withColumn("loss_end", F.when(F.col("target"), length - len(template.end)))
        .select(
            "conv_id",
        "lone",
            "example",
            "n_context",
            "is_last",
            "text",
            (F.col("loss_end") - F.col("body_chars")).alias("loss_start"),
            "loss_end",
        )
    )


def read_back(examples: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation, parsed from its formatted examples.

    Conversations without an id have a row each.
    """
    target = F.substr(
        F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")
    )
    parsed = examples.select(
        "conv_id",
        "lone",
        "example",
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("loss_end").isNotNull(), template.unescape(target)).alias("reply"),
        F.when(F.col("is_last"), F.col("text")).alias("whole"),
    )
    replies = F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply"))))
    grouped = parsed.groupBy("conv_id", "lone").agg(
        F.sum("chars").alias("formatted_chars"),
        F.max("whole").alias("whole"),
        F.array_join(F.transform(replies, lambda r: r["reply"]), "").alias("loss"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    turns = grouped.withColumn("turns", template.turns(F.col("whole")))
    text = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
