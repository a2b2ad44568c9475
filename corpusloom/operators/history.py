"""Chat history as a table of ``(conv_id, turn, role, text)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ranking import numbered_rows

USER, ASSISTANT = "user", "assistant"


def next_turns(history: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    return history.groupBy(conv).agg((F.max(turn) + 1).alias("next_turn"))


def turn_pairs(answered: DataFrame, first: Column, conv: str = "conv_id") -> DataFrame:
    """The user's turn, numbered ``first``, and the assistant's of each ``question, answer``."""
    pair = F.array(
        F.struct(first.cast("bigint").alias("turn"), F.lit(USER).alias("role"), F.col("question").alias("text")),
        F.struct((first + 1).cast("bigint").alias("turn"), F.lit(ASSISTANT).alias("role"), F.col("answer").alias("text")),
    )
    return answered.select(conv, F.explode(pair).alias("_turn")).select(conv, "_turn.turn", "_turn.role", "_turn.text")


def new_turns(history: DataFrame, answered: DataFrame, conv: str = "conv_id", seq: str = "seq") -> DataFrame:
    """The turns to append: for every row of ``answered (conv, seq, question, answer)`` the user's
    turn and the assistant's, numbered on from the conversation's last turn in order of ``seq``."""
    placed = numbered_rows(answered, [conv], seq, "_place").join(next_turns(history, conv), conv, "left")
    return turn_pairs(placed, F.coalesce(F.col("next_turn"), F.lit(0)) + (F.col("_place") - 1) * 2, conv)


def replay(history: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """History in order, by a range-partitioned sort."""
    return history.orderBy(conv, turn)


def replay_buckets(history: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The turns of each conversation together and in order, with their ``place`` from 1, from a table
    bucketed by conversation. The ranking asks for a conversation's rows in one task, which the
    buckets give already, so nothing is shuffled; over other tables it is right too, with a shuffle."""
    return history.withColumn("place", F.row_number().over(Window.partitionBy(conv).orderBy(turn)))
