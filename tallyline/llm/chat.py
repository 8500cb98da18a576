"""Preference pairs for chat models: one prompt, and a chosen and a rejected completion.

A pair is two conversations. The longest run of turns that both begin with is the prompt and is
rendered once; the rest of either is a completion, in which only what the assistant says is trained
on. A rendered turn is a row, with its place in the text of its part and the span of the loss mask,
so a conversation of any length is spread over tasks; the text of a part is its rows in order.

Turns are compared one by one under (pair, turn), not as whole conversations, and places are running
sums over blocks of turns. Only DataFrame functions are used.

Rows with a NULL pair or turn cannot be placed and are left out. A NULL text or role is empty. Of
several rows for one turn, as repeated rows are, the least by role and text stands. Conversations
that do not differ are all prompt; a pair of which one side is missing has no prompt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored
from tallyline.operators.scans import number_block, running_totals

# The frame of a turn, and the role that is trained on.
BEGIN, HEAD, END = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED = "assistant"

PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"


def _turns(side: DataFrame, name: str) -> DataFrame:
    said = F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return (
        side.dropna(subset=["pair_id", "turn"])
        .groupBy("pair_id", F.col("turn").cast("long").alias("turn"))
        .agg(F.min(said).alias("said"))
        .select("pair_id", "turn", F.lit(name).alias("part"), "said.role", "said.text")
    )


def first_difference(turns: DataFrame) -> DataFrame:
    """(pair_id, split): the first turn that only one side has or that the sides say differently."""
    digest = F.sha2(F.to_json(F.struct("role", "text")), 256)
    same = (F.count(F.lit(1)) == 2) & (F.min("_digest") == F.max("_digest"))
    return (
        turns.withColumn("_digest", digest)
        .groupBy("pair_id", "turn")
        .agg(same.alias("_same"))
        .groupBy("pair_id")
        .agg(F.min(F.when(~F.col("_same"), F.col("turn"))).alias("split"))
    )


def preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rendered turns of all pairs, from two tables (pair_id, turn, role, text).

    (pair_id, part, turn, role, rendered, start, length, mask_start, mask_length): places are in
    characters of the text of the part, prompts and completions each counted from 0; the mask span is
    empty but for turns of the assistant in completions.
    """
    turns = stored(
        _turns(chosen, CHOSEN).unionByName(_turns(rejected, REJECTED)), "turns"
    )
    split = stored(first_difference(turns), "split", narrow=True)
    shared = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    placed = turns.join(split, "pair_id").filter(~shared | (F.col("part") == CHOSEN))
    head = F.concat(F.lit(BEGIN), F.col("role"), F.lit(HEAD))
    trained = ~shared & (F.col("role") == TRAINED)
    body = F.length("text") + len(END)
    rendered = placed.select(
        F.struct("pair_id", F.when(shared, PROMPT).otherwise(F.col("part")).alias("part")).alias("_of"),
        "turn",
        "role",
        F.concat(head, "text", F.lit(END)).alias("rendered"),
        (F.length(head) + body).cast("long").alias("length"),
        F.when(trained, F.length(head)).cast("long").alias("_skip"),
        F.when(trained, body).otherwise(0).cast("long").alias("mask_length"),
    )
    ended = running_totals(
        rendered, {"_end": F.col("length")}, ["turn"], number_block("turn"), key="_of"
    )
    start = F.col("_end") - F.col("length")
    return ended.select(
        "_of.pair_id",
        "_of.part",
        "turn",
        "role",
        "rendered",
        start.alias("start"),
        "length",
        (start + F.col("_skip")).alias("mask_start"),
        "mask_length",
    )
