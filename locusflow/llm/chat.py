"""Preference formatting of chosen and rejected conversations (operator 7).  DataFrame functions only.

The longest common prefix of turns is rendered once, as the prompt.  What each conversation has after it becomes a
completion, with the stretches that a model should learn: the texts of the assistant's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values of the rendering.
OPEN, CLOSE, LEARNED_ROLE = "<|im_start|>", "<|im_end|>", "assistant"


def conversations(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, one row.

    Turns are sorted by number, then role and text, so repeated rows and ties have one order; null numbers come
    first, null roles and texts count as empty.  Rows without a conversation are left out.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    one = F.struct(F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text"))
    named = turns.filter(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id"))
    sorted_turns = F.sort_array(F.collect_list(one))
    return named.agg(F.transform(sorted_turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _plain(text: Column) -> Column:
    """Text without the marks of the rendering: their ``<|`` is parted by a space."""
    return F.replace(text, F.lit("<|im_"), F.lit("<| im_"))


def _pieces(turns: Column) -> Column:
    """Head, body and tail of each turn as rendered."""
    return F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(OPEN), _plain(t["role"]), F.lit("\n")).alias("head"), _plain(t["text"]).alias("body"),
            F.lit(f"{CLOSE}\n").alias("tail"), (t["role"] == LEARNED_ROLE).alias("learn"),
        ),
    )


def render(turns: Column) -> Column:
    """The turns as one text."""
    return F.concat_ws("", F.transform(_pieces(turns), lambda p: F.concat(p["head"], p["body"], p["tail"])))


def learned(turns: Column) -> Column:
    """``start, end`` (code points, end exclusive) in the rendered text of what the assistant's turns add: body and tail."""
    size = lambda p: F.char_length(p["head"]) + F.char_length(p["body"]) + F.char_length(p["tail"])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        span = F.struct((state["at"] + F.char_length(p["head"])).alias("start"), (state["at"] + size(p)).alias("end"))
        return F.struct((state["at"] + size(p)).alias("at"), F.when(p["learn"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(_pieces(turns), start, step, lambda s: s["spans"])


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that two arrays of turns share."""
    apart = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(apart > 0, apart - 1).otherwise(F.size(a)).cast("int")


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each row of ``pairs`` (``chosen_id, rejected_id``): the prompt, both completions and their learned stretches.


    Columns: ``chosen_id, rejected_id, prefix_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``; masks are
    arrays of ``(start, end)``.  A conversation that is a prefix of the other has an empty completion and mask; a pair
    without a common turn has an empty prompt.  Pairs with an id that ``turns`` does not hold are left out; repeated
    pairs repeat.  Both joins are on conversation ids, one row each.  Other columns are ignored.
    """
    whole = conversations(turns)
    chosen = whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("__a"))
    rejected = whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("__b"))
    both = pairs.select("chosen_id", "rejected_id").join(chosen, "chosen_id").join(rejected, "rejected_id")
    return _formatted(both)


def format_swapped(turns: DataFrame, taker: Column) -> DataFrame:
    """Each conversation as chosen, and as rejected the same with its last assistant's turn taken from another one.

    ``taker`` is the id, made of ``conv_id``, of the conversation that gets the reply of ``conv_id``.  Of several replies
    for one the greatest text is taken; without any the reply is empty.  Columns are those of ``format_preferences``;
    ``rejected_id`` is the giver, null without one.  The last turn is the last in the order of ``conversations``.
    Conversations without an assistant's turn are left out.  Turns are grouped for the
    conversations and again for the replies; only replies travel on, to their takers.
    """
    back = F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == LEARNED_ROLE), True)
    whole = conversations(turns).withColumn("at", (F.size("turns") - back + 1).cast("int")).filter(F.col("at") <= F.size("turns"))
    replies = whole.select(taker.alias("chosen_id"), F.element_at("turns", F.col("at"))["text"].alias("reply"), F.col("conv_id").alias("giver"))
    given = replies.groupBy("chosen_id").agg(F.max(F.struct("reply", "giver")).alias("given"))
    both = whole.withColumnRenamed("conv_id", "chosen_id").join(given, "chosen_id", "left")
    reply = F.coalesce("given.reply", F.lit(""))
    swapped = F.transform("turns", lambda t, i: F.struct(t["role"].alias("role"), F.when(i + 1 == F.col("at"), reply).otherwise(t["text"]).alias("text")))
    return _formatted(both.select("chosen_id", F.col("given.giver").alias("rejected_id"), F.col("turns").alias("__a"), swapped.alias("__b")))


def _formatted(both: DataFrame) -> DataFrame:
    """Prompt, completions and masks of ``chosen_id, rejected_id`` and the turns of each (``__a, __b``)."""
    both = both.withColumn("prefix_turns", common_prefix(F.col("__a"), F.col("__b")))
    rest = lambda c: F.slice(c, F.col("prefix_turns") + 1, F.greatest(F.size(c), F.lit(0)))
    return both.select(
        "chosen_id", "rejected_id", "prefix_turns", render(F.slice("__a", F.lit(1), F.col("prefix_turns"))).alias("prompt"),
        render(rest("__a")).alias("chosen"), render(rest("__b")).alias("rejected"),
        learned(rest("__a")).alias("chosen_mask"), learned(rest("__b")).alias("rejected_mask"),
    )
