"""Questions that arrive over time, answered from a static index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.vectors import Embedder
from corpusloom.operators.history import turn_pairs
from corpusloom.operators.ranking import numbered_rows
from corpusloom.plans.retrieval import fetch_context, find_matches, generate_answers
from corpusloom.streaming.numbering import TURNS_PER_QUESTION, keyed_state, reserve_turns

FIRST = -(1 << 60)  # stands for a null seq
TURNS_SCHEMA = "conv_id bigint, turn bigint, role string, text string, batch bigint"


def answer_batch(
    questions: DataFrame,
    index: DataFrame,
    item_keys: list[str],
    make_generator: Callable[[], Callable[[str], str]],
    embed: Embedder | None = None,
    **options,
) -> DataFrame:
    """Answers of ``questions (conv_id, seq, query)``, as ``conv_id, seq, question, answer``."""
    keys = ["conv_id", "seq"]
    matches = find_matches(questions, index, keys, item_keys, embed=embed, **options)
    answered = generate_answers(fetch_context(questions, matches, keys), make_generator)
    return answered.select(*keys, F.col("query").alias("question"), "answer")


def stream_answers(
    questions: DataFrame,
    index: DataFrame,
    item_keys: list[str],
    history: DataFrame,
    out: str,
    checkpoint: str,
    make_generator: Callable[[], Callable[[str], str]],
    embed: Embedder | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Answer a stream of ``(conv_id, seq, query)`` and append both turns under ``out``.

    Turn numbers are keyed state: they go on from ``history`` and from every batch before without
    any of it being read again, also after a restart from ``checkpoint``. Questions of one batch are
    numbered in order of ``seq`` (null first, equal ones in any order); a question without conv_id
    belongs to no conversation and is not answered. Each micro-batch overwrites a folder of its own, which makes a
    batch that is run again after a failure replace its turns and not repeat them. ``trigger`` is
    passed on to Spark, as ``{"processingTime": "10 seconds"}`` for questions that keep coming;
    without it the stream ends once it has answered what is there.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        # The batch is read several times below; a source need not be asked again for it.
        batch.persist()
        try:
            placed = numbered_rows(batch.withColumn("seq", F.coalesce("seq", F.lit(FIRST))), ["conv_id"], "seq", "_place")
            turn = F.col("first_turn") + (F.col("_place") - 1) * TURNS_PER_QUESTION
            # The turn number identifies a question from here on.
            numbered = placed.select("conv_id", turn.alias("seq"), "query")
            answered = answer_batch(numbered, index, item_keys, make_generator, embed, **options)
            turn_pairs(answered, F.col("seq")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        finally:
            batch.unpersist()

    spark = questions.sparkSession
    with keyed_state(spark):
        writer = reserve_turns(questions, history).writeStream.outputMode("append").foreachBatch(answer)
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_answers(spark, out: str) -> DataFrame:
    return spark.read.schema(TURNS_SCHEMA).parquet(out).drop("batch")
