"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant
and all others as named users; the mask holds the spans of the assistant's words and end marks.

A rendering comes in blocks of ``BLOCK`` consecutive turn numbers, so no task gathers a whole
conversation; the blocks' texts in order of (block, part) are the dialogue, mask spans are code
points of the block's text. A turn number with more than ``SHARED`` rows (a null turn number is one
too) stands in parts of its own, after its block, dealt by a hash.

Rows: a null role is the participant "unknown", a null text is empty, null turns come last, a null
conv_id is a conversation. Turns with equal numbers are ordered by role, then text. Rows that are
equal in all four columns are one turn; ``n_rows`` counts them all. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK, SHARED = 64, 64

# fixed values: the marks of the format
START, END = "<|im_start|>", "<|im_end|>"


def turns(conversations: DataFrame) -> DataFrame:
    """Distinct turns with their block and part."""
    rows = (conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n_rows")))
    crowded = (rows.groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARED))
    rows = rows.join(crowded, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
    part = F.when(F.col("n").isNotNull(), F.struct(F.col("turn").alias("turn"), F.pmod(F.xxhash64("role", "text"), F.ceil(F.col("n") / SHARED)).alias("deal")))
    return rows.select("conv_id", "turn", "role", "text", "n_rows", F.floor(F.col("turn") / BLOCK).alias("block"), part.alias("part"))


def _rendered(messages: Column, speaker: Column) -> Column:
    """struct(text, mask) of the ordered messages."""
    def add(acc, m):
        own = m.role == speaker
        head = F.when(own, F.lit(f"{START}assistant\n")).otherwise(F.concat(F.lit(f"{START}user name="), m.role, F.lit("\n")))
        begin = acc.at + F.char_length(head)
        end = begin + F.char_length(m.text) + len(END)
        return F.struct((end + 1).alias("at"),
                        F.when(own, F.concat(acc.mask, F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc.mask).alias("mask"))

    pieces = F.transform(messages, lambda m: F.concat(
        F.when(m.role == speaker, F.lit(f"{START}assistant\n")).otherwise(F.concat(F.lit(f"{START}user name="), m.role, F.lit("\n"))),
        m.text, F.lit(END + "\n")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))
    return F.struct(F.array_join(pieces, "").alias("text"), F.aggregate(messages, start, add, lambda a: a.mask).alias("mask"))


def perspectives(conversations: DataFrame) -> DataFrame:
    """conv_id, speaker, block, part, n_turns, n_rows, text and mask (array of start, end)."""
    rows = turns(conversations)
    speakers = rows.select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    seen = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))
    message = F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "text", "n_rows")
    blocks = seen.groupBy("conv_id", "speaker", "block", "part").agg(F.sort_array(F.collect_list(message)).alias("messages"))
    blocks = blocks.withColumn("r", _rendered(F.col("messages"), F.col("speaker")))
    return blocks.select("conv_id", "speaker", "block", "part", F.size("messages").alias("n_turns"),
                         F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + m.n_rows).alias("n_rows"), "r.text", "r.mask")
