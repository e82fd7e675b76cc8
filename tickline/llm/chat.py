"""Preference formatting of chat conversations.

Given the turns of a chosen and a rejected conversation per pair, find the
longest common prefix of turns (same role and same text), render it once as
the prompt, and render what is left of either side as its completion.  A
completion comes with the spans of characters to learn from: the assistant's
texts with their end mark, not the headers and not other roles' turns.

A conversation becomes one row (its text is one string in the end); pairs are
spread by pair id.  Only DataFrame functions are used.

Defined results: a null role is rendered as ``unknown`` and a null text as
empty, and nulls equal each other; turns are ordered by (turn, role, text), a
null turn first; equal conversations give empty completions; a pair with one
side only is not returned; a null pair id is no pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import numbered

START, END = "<|im_start|>", "<|im_end|>"
TURN = "struct<turn:long,role:string,text:string>"


def _shown(t: Column) -> Column:
    return F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _shown), "")


def learn_spans(turns: Column) -> Column:
    """Spans [start, end) in ``render(turns)`` of the assistant's words and end
    marks, as array<struct<start,end>>."""
    head = lambda t: F.length(t["role"]) + (len(START) + 1)     # noqa: E731
    start = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, t):
        begin = acc["at"] + head(t)
        end = begin + F.length(t["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """How many leading turns have the same role and text."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    first = F.array_position(same, False)
    return F.when(first == 0, n).otherwise((first - 1).cast("int"))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """From rows (pair_id, side 'chosen' or 'rejected', turn, role, text):
    pair_id, n_prompt_turns, prompt, chosen, chosen_spans, rejected,
    rejected_spans."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    both = (turns.where(F.col("pair_id").isNotNull()).groupBy("pair_id")
                 .agg(*(F.sort_array(F.collect_list(F.when(F.col("side") == s, turn))).alias(s) for s in ("chosen", "rejected"))))
    both = both.where((F.size("chosen") > 0) & (F.size("rejected") > 0)).withColumn("n_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    n = F.col("n_prompt_turns")
    left = {s: F.slice(F.col(s), n + 1, F.greatest(F.size(s) - n, F.lit(0))) for s in ("chosen", "rejected")}
    return both.select("pair_id", "n_prompt_turns", render(F.slice(F.col("chosen"), 1, n)).alias("prompt"),
                       render(left["chosen"]).alias("chosen"), learn_spans(left["chosen"]).alias("chosen_spans"),
                       render(left["rejected"]).alias("rejected"), learn_spans(left["rejected"]).alias("rejected_spans"))


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Pairs made from plain conversations, for ``preference_pairs``: the
    chosen side is the conversation, the rejected side has another one's last
    answer in place of its own.  Conversations with an answer are numbered by
    conv_id and swap answers two by two; with an odd number the last one takes
    the first one's.  A conversation without an answer (or with the only one
    there is) is the same on both sides.  Every non-null conv_id gives a pair; an
    answer is the assistant's turn with the largest number, of equal ones the
    greatest text."""
    own = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null")
    answer = F.struct(F.col("turn"), F.coalesce("text", F.lit("")).alias("text"))
    last = own.where("role = 'assistant' and turn is not null").groupBy("conv_id").agg(F.max(answer).alias("a"))
    last, n = numbered(last.select("conv_id", F.col("a.turn").alias("last_turn"), F.col("a.text").alias("answer")), "conv_id")
    twin = F.col("number").bitwiseXOR(F.lit(1).cast("long"))
    mine = last.select("conv_id", "last_turn", F.when(twin < n, twin).otherwise(0).alias("twin"))
    other = last.select(F.col("number").alias("twin"), F.col("answer").alias("other_text"))
    rows = own.join(mine.join(other, "twin"), "conv_id", "left")
    swapped = (F.col("turn") == F.col("last_turn")) & (F.col("role") == "assistant")
    sides = F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("shown")),
                    F.struct(F.lit("rejected").alias("side"), F.when(swapped, F.col("other_text")).otherwise(F.col("text")).alias("shown")))
    return rows.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("s")).select("pair_id", "s.side", "turn", "role", F.col("s.shown").alias("text"))


def spans_text(spans: Column) -> Column:
    """Spans as ``start-end`` parts, for reports."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
