"""Turn numbers of a stream of questions, kept as state per conversation."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from corpusloom.operators.history import next_turns

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = {
    PROVIDER_KEY: PROVIDER,
    # An executor holds a store for each of its partitions, which share so much memory outside the heap.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
}
TURNS_PER_QUESTION = 2


class TurnNumbers(StatefulProcessor):
    """Reserves turn numbers: the state of a conversation is its next free number.

    Rows go through one by one as they come, each with the number that was free when the batch began, so a
    conversation with any number of questions in a batch takes no memory. Their places within the batch are
    found afterwards, without state. Most conversations have a few rows, for which a data frame each costs
    more than all else.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next_turn", StructType([StructField("turn", LongType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.next.get()
        free = 0 if known is None else known[0]
        taken = 0
        for row in rows:
            taken += 1
            yield Row(conv_id=row["conv_id"], seq=row["seq"], query=row["query"], first_turn=free)
        self.next.update((free + TURNS_PER_QUESTION * taken,))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        # There is one row for a conversation.
        self.next.update((int(initialState["next_turn"]),))

    def close(self) -> None:
        pass


def reserve_turns(questions: DataFrame, history: DataFrame) -> DataFrame:
    """The stream ``(conv_id, seq, query)`` with ``first_turn``, the lowest turn number that this
    batch may use in the conversation.

    ``history`` is read once, when the stream starts for the first time; later batches and restarts
    find the numbers in the state store, so the cost of a batch does not grow with what came before.
    """
    rows = questions.where("conv_id is not null").select("conv_id", "seq", "query")
    known = next_turns(history.where("conv_id is not null and turn is not null")).select("conv_id", F.col("next_turn").cast("bigint").alias("next_turn"))
    return rows.groupBy("conv_id").transformWithState(
        statefulProcessor=TurnNumbers(),
        outputStructType=StructType([*rows.schema.fields, StructField("first_turn", LongType())]),
        outputMode="Append",
        timeMode="None",
        initialState=known.groupBy("conv_id"),
    )


@contextmanager
def keyed_state(spark: SparkSession):
    """A stream started within keeps its state in the store that keyed state needs."""
    before = {key: spark.conf.get(key, None) for key in STORE}
    for key, value in STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
