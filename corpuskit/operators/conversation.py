"""Turns of a conversation: context, question-answer pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions.text import history_line, is_blank
from corpuskit.operators import scan


def with_history(turns: DataFrame) -> DataFrame:
    """Each turn with all earlier turns of its conversation as one text.

    The result of a turn is the whole conversation before it, so a conversation has to
    fit in a row - which bounds the group - and the output grows with its square.
    """
    earlier = (
        Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    )
    lines = F.collect_list(history_line(F.col("role"), F.col("text"))).over(earlier)
    return turns.withColumn("history", F.array_join(lines, "\n"))


def with_offsets(turns: DataFrame) -> DataFrame:
    """Each turn with its line of the transcript and where that line starts and ends, in characters.

    All lines of a conversation in order, joined by newlines, are its transcript, and a turn's
    history is the transcript's first ``start - 1`` characters (none for the first turn). So the
    history of every turn costs one number instead of a text, and the output is as long as the
    input. Offsets are running sums over ranges of turns: a conversation may have any number.
    A turn without text has no line. (conv_id, turn) identifies a turn. An action.
    """
    said = turns.withColumn("line", history_line(F.col("role"), F.col("text")))
    size = F.coalesce(F.char_length("line") + 1, F.lit(0)).cast("bigint")
    ranged = scan.in_ranges(said.select("conv_id", "turn", size.alias("_size")), ["conv_id"], ["turn"])
    sums = scan.running(ranged, {"_upto": ("sum", F.col("_size"))})
    start, end = F.col("_upto") - F.col("_size"), F.col("_upto") - F.least("_size", F.lit(1))
    return said.join(sums.select("conv_id", "turn", start.alias("start"), end.alias("end")), ["conv_id", "turn"])


def user_requests(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, text, history)``: what is sent with a user's turn, for these turns only.

    The earlier lines of a conversation are gathered once, in the row of its last user turn's
    transcript, and each request takes its part of it: a conversation has to fit in a row, and the
    texts grow with the number of its user turns. For long ones use :func:`with_offsets`. An action.
    """
    lines = with_offsets(turns)
    asked = lines.filter(F.col("role") == "user")
    last = asked.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    needed = lines.join(last, "conv_id").filter(F.col("turn") < F.col("_last"))
    gathered = needed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "line"))).alias("l"))
    transcripts = gathered.select("conv_id", F.array_join("l.line", "\n").alias("_transcript"))
    history = F.substring(F.coalesce("_transcript", F.lit("")), F.lit(1), F.greatest(F.col("start") - 1, F.lit(0)).cast("int"))
    return asked.join(transcripts, "conv_id", "left").select("conv_id", "turn", "text", history.alias("history"))


def question_answer_pairs(turns: DataFrame) -> DataFrame:
    """User turns with the assistant turn right after. Turn numbers are consecutive, so
    this is a join on conversation and number: no conversation gathers in one task."""
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(answered, ["conv_id", "turn"])


def accepted_input(turns: DataFrame, text: str = "text") -> DataFrame:
    """Turns that say something: blank input is rejected."""
    return turns.filter(~is_blank(F.col(text)))
