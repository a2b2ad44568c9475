import random

from pyspark.sql import functions as F

from corpusloom.operators.history import new_turns, replay
from corpusloom.operators.ranking import numbered_rows, top_per_group


def test_top_per_group_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(50)}", rng.randrange(20), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(13)
    for n, salts in [(1, 64), (5, 3), (2000, 2)]:
        got = top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], n, rank="place", salts=salts).collect()
        expected = []
        for g in {r[0] for r in rows}:
            mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:n]
            expected += [(*r, place) for place, r in enumerate(mine, 1)]
        assert sorted(tuple(r) for r in got) == sorted(expected)


def test_numbered_rows_across_blocks(spark):
    rng = random.Random(2)
    rows = [("hot", s) for s in rng.sample(range(-500, 5000), 700)] + [("b", s) for s in rng.sample(range(100), 40)]
    df = spark.createDataFrame(rows, "g string, s long").repartition(5)
    got = sorted(tuple(r) for r in numbered_rows(df, ["g"], "s", "n", block=64).select("g", "s", "n").collect())
    expected = []
    for g in ("hot", "b"):
        expected += [(g, s, n) for n, s in enumerate(sorted(s for h, s in rows if h == g), 1)]
    assert got == sorted(expected)


def test_new_turns(spark):
    history = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u")], "conv_id long, turn long, role string, text string")
    asked = [(1, 9, "b?", "b!"), (1, 4, "a?", "a!"), (2, 0, "c?", None)]
    answered = spark.createDataFrame(asked, "conv_id long, seq long, question string, answer string")
    turns = new_turns(history, answered)
    assert [tuple(r) for r in replay(history.unionByName(turns)).collect()] == [
        (1, 0, "system", "s"),
        (1, 1, "user", "u"),
        (1, 2, "user", "a?"),
        (1, 3, "assistant", "a!"),
        (1, 4, "user", "b?"),
        (1, 5, "assistant", "b!"),
        (2, 0, "user", "c?"),
        (2, 1, "assistant", None),
    ]
