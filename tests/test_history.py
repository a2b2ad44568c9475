import random
from pathlib import Path

from pyspark.sql import functions as F

from corpusloom.operators.history import new_turns, next_turns, replay_buckets
from corpusloom.sinks.history import append_bucketed, compact_history, history_table

TURNS = "conv_id long, turn long, role string, text string"


def test_bucketed_history(spark, tmp_path):
    rng = random.Random(2)
    rows = [(c, t, "user", f"{c}/{t}") for c in range(40) for t in range(rng.randrange(1, 30))] + [(7, t, "user", "busy") for t in range(100, 2000)] + [(None, 0, "user", "x")]
    rng.shuffle(rows)
    path, target = str(tmp_path / "first"), str(tmp_path / "second")
    for part in (rows[:900], rows[900:1000], rows[1000:]):
        append_bucketed(spark.createDataFrame(part, TURNS).repartition(3).withColumn("more", F.lit(1)), path, 4)
    files = lambda folder: [p for p in Path(folder).rglob("*.parquet")]
    assert len(files(path)) <= 12
    compact_history(spark, path, target, 4)
    assert len(files(target)) == 4
    stored = spark.table(history_table(spark, target, 4))
    assert sorted((tuple(r) for r in stored.collect()), key=str) == sorted(rows, key=str)

    # Neither a replay nor the next turns move a row.
    for result in (replay_buckets(stored), next_turns(stored)):
        assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
    replayed = [(r.conv_id, r.turn) for r in replay_buckets(stored).collect()]
    for conv in {c for c, *_ in rows}:
        mine = [t for c, t in replayed if c == conv]
        assert mine == sorted(mine)
        at = [i for i, (c, _) in enumerate(replayed) if c == conv]
        assert at == list(range(at[0], at[0] + len(at)))
    last = {r.conv_id: r.next_turn for r in next_turns(stored).collect()}
    assert last[7] == 2000 and last[None] == 1

    # A compacted history is appended to like any other.
    answered = spark.createDataFrame([(7, 1, "q", "a")], "conv_id long, seq long, question string, answer string")
    append_bucketed(new_turns(stored, answered), target, 4)
    again = spark.table(history_table(spark, target, 4))
    assert [r.turn for r in again.where("conv_id = 7 and turn >= 2000").orderBy("turn").collect()] == [2000, 2001]


def test_no_history(spark, tmp_path):
    path = str(tmp_path / "none")
    append_bucketed(spark.createDataFrame([], TURNS), path, 4)
    assert spark.table(history_table(spark, path, 4)).count() == 0
