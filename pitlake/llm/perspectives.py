"""Dialogues of several parties, seen once by each: that speaker is the assistant, the others named users.

DataFrame functions alone. A dialogue is rendered in parts of consecutive turn numbers, so that one
with a large share of all turns is spread over many tasks; the parts of a perspective, in order of
`part`, are the whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>\n"  # fixed values: marks of the chat markup language
PART_TURNS = 256
UNNAMED = "unknown"


def rotate(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """A row for each dialogue, participant and part: conv_id, perspective, part, n_turns, n_masked, text, mask.

    text: every turn as BEGIN + "assistant" + newline, or BEGIN + "user name=" + speaker + newline, then the
    turn's text and END. mask: (start, length) in characters of what the assistant is to learn, which is
    its own turns' text and END mark, in order. A participant's row exists for each part, spoken in or not.

    Turns stand by number, speaker, text. A null speaker is "unknown"; a null text is empty; null turn
    numbers come first, in part -1 (numbers below 0 are in parts below that); repeated rows are repeated
    turns. A null conv_id is a dialogue of its own. Text is taken as it is: marks inside it aren't
    escaped, the masks tell them apart. Extra columns are ignored; an empty table gives an empty one.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(UNNAMED)).alias("speaker"),
        F.coalesce(F.col("text"), F.lit("")).alias("said"),
    )
    number = F.floor(F.col("turn") / part_turns)
    part = F.when(F.col("turn").isNull(), F.lit(-1)).otherwise(F.when(number < 0, number - 1).otherwise(number)).cast("long")
    parts = turns.groupBy("conv_id", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "speaker", "said"))).alias("turns")
    )
    participants = turns.select("conv_id", F.col("speaker").alias("perspective")).distinct()
    same = F.col("p.conv_id").eqNullSafe(F.col("w.conv_id"))
    seen = parts.alias("p").join(participants.alias("w"), same).select("p.conv_id", "w.perspective", "p.part", "p.turns")

    def own(turn: Column) -> Column:
        return turn["speaker"] == F.col("perspective")

    def head(turn: Column) -> Column:
        name = F.when(own(turn), F.lit("assistant")).otherwise(F.concat(F.lit("user name="), turn["speaker"]))
        return F.concat(F.lit(BEGIN), name, F.lit("\n"))

    pieces = F.transform(
        "turns",
        lambda turn: F.struct(
            own(turn).alias("own"),
            F.length(head(turn)).cast("long").alias("before"),
            (F.length(turn["said"]) + len(END)).cast("long").alias("learnt"),
            F.concat(head(turn), turn["said"], F.lit(END)).alias("rendered"),
        ),
    )
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start: bigint, length: bigint>>)").alias("mask")),
        lambda state, piece: F.struct(
            (state["at"] + piece["before"] + piece["learnt"]).alias("at"),
            F.when(
                piece["own"],
                F.concat(state["mask"], F.array(F.struct((state["at"] + piece["before"]).alias("start"), piece["learnt"].alias("length")))),
            ).otherwise(state["mask"]).alias("mask"),
        ),
        lambda state: state["mask"],
    )
    return seen.withColumn("pieces", pieces).select(
        "conv_id",
        "perspective",
        "part",
        F.size("pieces").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda piece: piece["own"])).cast("long").alias("n_masked"),
        F.array_join(F.transform("pieces", lambda piece: piece["rendered"]), "").alias("text"),
        spans.alias("mask"),
    )
