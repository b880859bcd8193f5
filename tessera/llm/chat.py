"""Chat formatting with the perspective rotated over the participants.

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant and the others as named users. The mask tells which
characters are the assistant's own words: what a model is trained on from that
perspective.

Scale. A conversation is rendered in parts of ``part_turns`` consecutive turn
numbers, and a part of more than ``PIECE_TURNS`` turns (equal or null numbers) in
pieces, so a long one is many rows and no task holds it whole; parts and
pieces of one perspective, in order, are the whole rendering. Turns are numbered
in two levels: a range-partitioned sort, places inside a range partition, and
the counts of the partitions before it. Turns are then grouped by
(conversation, part, piece), a bounded key, and meet their participants by one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col, small, staged

PIECE_TURNS = 1024
START, END = "<|im_start|>", "<|im_end|>\n"


def _header(role: Column, perspective: Column, narrator: str) -> Column:
    name = F.when(role == perspective, "assistant").when(role == narrator, narrator).otherwise(
        F.concat(F.lit("user name="), role))
    return F.concat(F.lit(START), name, F.lit("\n"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", narrator: str = "system", part_turns: int = 64) -> DataFrame:
    """One row per conversation, participant, part and piece: ``conv_id,
    perspective, part, piece, n_turns, text, mask``; ``mask`` holds ``start:end`` of the
    assistant's words in code points, comma-joined.

    Turns go by number, then role, then text; null numbers come first, in part
    0. The ``narrator`` is no participant: its turns are rendered as they are
    for everyone, and a conversation of the narrator alone gives no row. A null
    role is the participant ``unknown``; a null text is empty; a null
    conversation id is one conversation; repeated rows are turns of their own.
    Other columns are ignored.
    """
    rows = turns.select(col(conv_col).alias("conv_id"), col(turn_col).cast("long").alias("turn"),
                        F.coalesce(col(role_col), F.lit("unknown")).alias("role"),
                        F.coalesce(col(text_col), F.lit("")).alias("said"))
    part = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(0)).cast("long")
    order = [F.col("turn").asc_nulls_first(), "role", "said", "rid"]
    rows = staged(rows.withColumn("part", part).withColumn("rid", F.monotonically_increasing_id()).repartitionByRange(
        "conv_id", "part", *order).withColumn("pid", F.spark_partition_id()), "turns")
    # turns of a part in the range partitions before
    counts = rows.groupBy("conv_id", "part", "pid").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id", "part").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter("before > 0").select(
        F.col("conv_id").alias("c"), F.col("part").alias("q"), F.col("pid").alias("p"), "before")
    inside = Window.partitionBy("conv_id", "part", "pid").orderBy(*order)
    placed = rows.withColumn("inside", F.row_number().over(inside) - 1).join(
        small(staged(counts, "turn-offsets")), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("q")) & (
            F.col("pid") == F.col("p")), "left")
    placed = placed.withColumn("place", F.coalesce("before", F.lit(0)) + F.col("inside"))
    parts = placed.groupBy("conv_id", "part", F.floor(F.col("place") / PIECE_TURNS).cast("long").alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "said"))).alias("turns"))
    who = rows.filter(F.col("role") != narrator).select(F.col("conv_id").alias("conv"), F.col("role").alias("perspective")).distinct()
    seen = parts.join(who, F.col("conv_id").eqNullSafe(F.col("conv")))
    pieces = F.transform("turns", lambda t: F.struct(
        _header(t["role"], F.col("perspective"), narrator).alias("head"), t["said"].alias("said"),
        (t["role"] == F.col("perspective")).alias("own")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("mask"))

    def step(state, p):
        start = state["at"] + F.length(p["head"])
        end = start + F.length(p["said"])
        span = F.concat_ws(":", start, end)
        return F.struct((end + len(END)).alias("at"),
                        F.when(p["own"], F.array_append(state["mask"], span)).otherwise(state["mask"]).alias("mask"))

    seen = seen.withColumn("pieces", pieces)
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["said"], F.lit(END))), "")
    return seen.select("conv_id", "perspective", "part", "piece", F.size("turns").cast("long").alias("n_turns"), text.alias("text"),
                       F.array_join(F.aggregate("pieces", begin, step, lambda s: s["mask"]), ",").alias("mask"))
