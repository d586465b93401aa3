"""Multi-party perspective rotation of dialogues.

For each participant of a conversation the dialogue is rendered with that speaker as the assistant, the
others as named users and system turns as they are; only the assistant's words (and their end mark) are
to be learnt, given as spans of character offsets.

A conversation is rendered in blocks of consecutive turns (`block_turns`), one row each, and the offsets
run on through its blocks; an ordinary conversation is one block. Where turns are null or repeat, a block may have more
rows; beyond twice block_turns it is cut into pieces of block_turns rows. So no task holds more of a conversation than that, and one with a
third of all turns is spread out: lengths are summed per piece first, and only these sums (one row per piece and
speaker) are run through in order. What was cut is whole again when the pieces of a conversation and speaker are
joined in the order of block and piece; start and mask count from the start of the whole.

Defined cases: a null text is rendered empty; a null role is the speaker `unknown`; turns are ordered by
turn (null first), then role, then text; repeated rows are rendered each; a conversation of system turns
alone has no participant and so no row; a null conv_id is a conversation; `<|` in a text or role is written `<\\|`, so
that no text forges a turn; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.assign import numbered
from .common import own, saved


@dataclass(frozen=True)
class Template:
    """What is written around a turn. {name} in `user` stands for the speaker's name."""

    assistant: str = "<|assistant|>\n"
    user: str = "<|user name={name}|>\n"
    system: str = "<|system|>\n"
    end: str = "<|end|>\n"
    system_role: str = "system"
    nameless: str = "unknown"


def _head(role: Column, speaker: Column, t: Template) -> Column:
    before, _, after = t.user.partition("{name}")
    named = F.concat(F.lit(before), role, F.lit(after))
    return F.when(role == t.system_role, F.lit(t.system)).when(role == speaker, F.lit(t.assistant)).otherwise(named)


def rotate(df: DataFrame, template: Template = Template(), block_turns: int = 64, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, speaker, block, piece, first_turn, n_turns, n_masked, start, rendered, mask): one row for each participant and piece.

    block is turn div block_turns (-1 without a turn), piece counts from 0 in it; start is the piece's offset in the speaker's whole rendering, and mask
    has `from:to` pairs in it, comma-joined, to be learnt (to exclusive).
    """
    t = template
    turns = own(df, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("<\\|"))
    turns = turns.withColumns({"role": F.replace(safe(F.coalesce(F.col("role").cast("string"), F.lit(t.nameless))), F.lit("|>"), F.lit("|\\>")), "text": safe(F.coalesce("text", F.lit(""))), "block": F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-1).cast("long"))})
    turns = turns.withColumn("piece", F.lit(0).cast("long"))
    over = saved(turns.groupBy(F.col("conv").alias("oc"), F.col("block").alias("ob")).count().filter(F.col("count") > 2 * block_turns), "oversized")
    if over.limit(1).count():
        same = F.col("conv").eqNullSafe(F.col("oc")) & (F.col("block") == F.col("ob"))
        large = turns.join(over, same, "left_semi").withColumns({"key": F.struct("conv", "block"), "order": F.struct("turn", "role", "text")})
        large = numbered(large, "key", "order", "nth", most_rows=100_000).withColumn("piece", F.floor((F.col("nth") - 1) / block_turns))
        turns = turns.join(over, same, "left_anti").unionByName(large.drop("key", "order", "nth"))
    # One row per conversation, block and piece: its turns in order.
    blocks = turns.groupBy("conv", "block", "piece").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    people = turns.filter(F.col("role") != t.system_role).select("conv", F.col("role").alias("speaker")).distinct()
    rows = blocks.join(people.withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of"))).drop("of")
    parts = F.transform("turns", lambda x: F.struct(_head(x["role"], F.col("speaker"), t).alias("head"), F.concat(x["text"], F.lit(t.end)).alias("body"), (x["role"] == F.col("speaker")).alias("own")))
    rows = rows.withColumn("parts", parts)
    rows = rows.withColumn("rendered", F.array_join(F.transform("parts", lambda x: F.concat(x["head"], x["body"])), ""))
    rows = saved(rows, "rendered")
    # Only lengths are run through in order; the texts stay where they are until their start is joined on.
    order = Window.partitionBy("c", "s").orderBy("b", "p").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.select(F.col("conv").alias("c"), F.col("speaker").alias("s"), F.col("block").alias("b"), F.col("piece").alias("p"), F.length("rendered").alias("n"))
    starts = starts.withColumn("start", F.coalesce(F.sum("n").over(order), F.lit(0)).cast("long"))
    rows = rows.join(starts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("speaker") == F.col("s")) & (F.col("block") == F.col("b")) & (F.col("piece") == F.col("p")))
    walked = F.aggregate(
        "parts",
        F.struct(F.col("start").alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["head"]) + F.length(x["body"])).alias("at"),
            F.when(x["own"], F.array_append(acc["spans"], F.concat_ws(":", acc["at"] + F.length(x["head"]), acc["at"] + F.length(x["head"]) + F.length(x["body"])))).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    rows = rows.withColumn("spans", walked["spans"])
    return rows.select(
        F.col("conv").alias(conv_col), "speaker", "block", "piece", F.col("turns")[0]["turn"].alias("first_turn"), F.size("turns").cast("long").alias("n_turns"),
        F.size("spans").cast("long").alias("n_masked"), "start", "rendered", F.array_join("spans", ",").alias("mask"),
    )
