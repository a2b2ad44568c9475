import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import Row

from corpusloom.catalog.tables import arriving
from corpusloom.plans.indexing import index_objects
from corpusloom.sinks.index import WRITERS_KEY, write_index
from corpusloom.streaming.answers import answer_batch, read_answers, stream_answers
from corpusloom.streaming.numbering import TurnNumbers

cloudpickle.register_pickle_by_value(sys.modules[__name__])
KEYS = ["doc_id", "chunk_ix"]
QUESTIONS = "conv_id long, seq long, query string"


def echo():
    return lambda prompt: prompt.upper()


def test_stream_equals_batch(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"topic{i} " * 5) for i in range(10)], "doc_id long, text string")
    index = index_objects(docs, ["doc_id"])
    history = spark.createDataFrame([(1, 0, "system", "s")], "conv_id long, turn long, role string, text string")
    first = [(1, 0, "topic1"), (2, 0, "topic2"), (1, 1, "  ")]
    second = [(1, 0, "topic3")]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        asked = spark.readStream.schema(QUESTIONS).option("maxFilesPerTrigger", 1).json(source)
        stream_answers(asked, index, KEYS, history, out, checkpoint, echo).awaitTermination()
        return sorted(tuple(r) for r in read_answers(spark, out).select("conv_id", "turn", "role", "text").collect())

    spark.createDataFrame(first, QUESTIONS).coalesce(1).write.json(source)
    got = run()
    batch = {(r["conv_id"], r["seq"]): r["answer"] for r in answer_batch(spark.createDataFrame(first, QUESTIONS), index, KEYS, echo).collect()}
    assert "TOPIC1" in batch[1, 0] and batch[1, 1] is None
    expected = [
        (1, 1, "user", "topic1"),
        (1, 2, "assistant", batch[1, 0]),
        (1, 3, "user", "  "),
        (1, 4, "assistant", None),
        (2, 0, "user", "topic2"),
        (2, 1, "assistant", batch[2, 0]),
    ]
    assert got == expected

    # A later run takes up only what is new, and numbers on from the turns already written.
    spark.createDataFrame(second, QUESTIONS).coalesce(1).write.mode("append").json(source)
    later = run()
    assert later[: len([r for r in expected if r[0] == 1])] == [r for r in expected if r[0] == 1]
    assert [r[:3] for r in later if r not in expected] == [(1, 5, "user"), (1, 6, "assistant")]
    assert run() == later


def test_state_is_kept_by_conversation(spark, tmp_path):
    """Batches with nulls, ties and a busy conversation; earlier answers are never read again."""
    docs = spark.createDataFrame([(i, f"topic{i} " * 5) for i in range(4)], "doc_id long, text string")
    index = index_objects(docs, ["doc_id"])
    history = spark.createDataFrame([(1, 6, "user", "x"), (1, None, "user", "y"), (None, 3, "user", "z")], "conv_id long, turn long, role string, text string")
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    waves = [
        [(5, i, "topic1") for i in range(300)] + [(1, None, "topic2"), (1, 4, "topic3"), (None, 0, "topic0")],
        [(1, 0, "topic1"), (7, 3, "topic1"), (7, 3, "topic1")],
        [(5, 9, None), (1, -3, "topic2")],
    ]

    def run():
        asked = spark.readStream.schema(QUESTIONS).option("maxFilesPerTrigger", 1).json(source)
        query = stream_answers(asked, index, KEYS, history, out, checkpoint, echo)
        query.awaitTermination()
        return query

    for wave in waves[:2]:
        spark.createDataFrame(wave, QUESTIONS).coalesce(1).write.mode("append").json(source)
    run()
    # The answers of earlier batches are out of reach: numbers come from the state alone.
    kept = read_answers(spark, out).collect()
    (tmp_path / "out").rename(tmp_path / "moved")
    spark.createDataFrame(waves[2], QUESTIONS).coalesce(1).write.mode("append").json(source)
    query = run()
    last = read_answers(spark, out).collect()
    turns = sorted((r.conv_id, r.turn, r.role) for r in [*kept, *last])
    pairs = lambda conv, first, n: [(conv, first + i, "assistant" if i % 2 else "user") for i in range(2 * n)]
    assert turns == sorted(pairs(1, 7, 4) + pairs(5, 0, 301) + pairs(7, 0, 2))
    assert {r.text for r in last if r.turn == 601} == {None} and [r.text for r in kept if (r.conv_id, r.turn) == (1, 7)] == ["topic2"]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3


def test_tables_of_files_and_of_folders_arrive(spark, tmp_path):
    """A table that is a folder of files is streamed like one that is a single file."""
    rows = spark.createDataFrame([(i, 0, "user", f"t{i}") for i in range(6)], "conv_id long, turn long, role string, text string")
    rows.repartition(3).write.parquet(str(tmp_path / "folder/conversations.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "made"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "made").glob("*.parquet")).rename(tmp_path / "file/conversations.parquet")
    for kind in ("file", "folder"):
        stream = arriving(spark, str(tmp_path / kind), "conversations").writeStream.format("memory").queryName(f"arrived_{kind}")
        stream.trigger(availableNow=True).start().awaitTermination()
        assert spark.table(f"arrived_{kind}").count() == 6


def test_turn_numbers_take_rows_as_they_come():
    """Each row goes on before the next is taken, and the state is written once."""
    numbers, taken, states = TurnNumbers(), [], []

    class Value:
        def get(self):
            return (7,)

        def update(self, value):
            states.append(value)

    numbers.next = Value()
    rows = (taken.append(i) or Row(conv_id=1, seq=i, query=str(i)) for i in range(3))
    out = numbers.handleInputRows((1,), rows, None)
    assert next(out) == Row(conv_id=1, seq=0, query="0", first_turn=7) and taken == [0] and not states
    assert [r.first_turn for r in out] == [7, 7] and states == [(13,)]
    numbers.handleInitialState((1,), Row(conv_id=1, next_turn=4), None)
    assert states[-1] == (4,)


def test_index_is_written_without_a_sort(spark, tmp_path):
    """Shards are written side by side whatever the session says, and its setting is left as it was."""
    docs = spark.createDataFrame([(i, f"topic{i} word " * 30) for i in range(40)], "doc_id long, text string")
    before = spark.conf.get(WRITERS_KEY)
    seen = []
    spark.conf.set(WRITERS_KEY, "0")
    try:
        objects = index_objects(docs, ["doc_id"])
        plain = type(objects.write).parquet

        def parquet(self, path, *args, **options):
            seen.append(spark.conf.get(WRITERS_KEY))
            return plain(self, path, *args, **options)

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(type(objects.write), "parquet", parquet)
            write_index(objects, str(tmp_path / "index"))
        assert seen == ["16"] and spark.conf.get(WRITERS_KEY) == "0"
    finally:
        spark.conf.set(WRITERS_KEY, before)
    read = spark.read.parquet(str(tmp_path / "index"))
    assert sorted(map(tuple, read.select("doc_id", "chunk_ix", "shard").collect())) == sorted(map(tuple, objects.select("doc_id", "chunk_ix", "shard").collect()))
