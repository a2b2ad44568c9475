import random

from pyspark.sql import functions as F

from corpusloom.operators.sections import (
    SECTION_TYPE,
    assemble_content,
    drop_ignored,
    explode_section_lines,
    keep_sections,
    page_lines,
)
from corpusloom.plans.jobs import page_lines_by_row

EXAMPLE = [(1, "History"), (2, " See Also "), (3, "Deep"), (2, "Work"), (1, "References"), (2, "Sub"), (1, "End")]
SCHEMA = "page_id long, ord long, level int, title string, text string"


def kept_by_walk(sections):
    """Positions left by walking the outline as a tree."""
    skip, kept = None, []
    for i, (level, title) in enumerate(sections):
        if skip is not None and level > skip:
            continue
        skip = level if title.strip().lower() in {"see also", "references"} else None
        if skip is None:
            kept.append(i)
    return kept


def random_page(rng, n):
    return [(rng.randrange(1, 6), rng.choice(["See also", "REFERENCES ", "a", "b", "c", "d", "e"])) for _ in range(n)]


def test_example(spark):
    rows = [(1, i, level, title, "") for i, (level, title) in enumerate(EXAMPLE)]
    kept = keep_sections(spark.createDataFrame(rows, SCHEMA)).orderBy("ord").collect()
    assert [r["title"] for r in kept] == ["History", "Work", "End"]


def test_rows_and_arrays_agree_with_the_tree(spark):
    rng = random.Random(3)
    pages = {p: random_page(rng, n) for p, n in enumerate([0, 1, 5, 40, 3, 300])}
    rows = [(p, i, level, title, "") for p, sections in pages.items() for i, (level, title) in enumerate(sections)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = sorted((p, i) for p, sections in pages.items() for i in kept_by_walk(sections))
    for block in (4096, 64, 7, 1):
        assert sorted((r["page_id"], r["ord"]) for r in keep_sections(df, block=block).collect()) == expected
    arrays = spark.createDataFrame(
        [(p, [(level, title, str(i)) for i, (level, title) in enumerate(s)]) for p, s in pages.items()], f"p long, s {SECTION_TYPE}"
    )
    got = arrays.select("p", F.explode(drop_ignored(F.col("s"))).alias("x")).select("p", "x.text").collect()
    assert sorted((p, int(i)) for p, i in got) == expected


def test_deep_outlines(spark):
    """Thousands of levels, ignored sections that span many blocks, and sections without a level."""
    rng = random.Random(9)
    down = [(i, "See also" if i == 2500 else "x") for i in range(1, 3001)]
    up = [(i, "notes" if i in (1500, 900) else "y") for i in range(3000, 0, -1)]
    wild = [(rng.randrange(1, 3000), rng.choice(["See also", "a", "b", "c"])) for _ in range(2000)]
    pages = {0: down + up, 1: wild, 2: [(1, "references")] + [(2, "z")] * 3000 + [(1, "back")]}
    rows = [(p, i, level, title, "") for p, sections in pages.items() for i, (level, title) in enumerate(sections)]
    df = spark.createDataFrame([*rows, (2, 3005, None, "no level", ""), (2, 3006, 9, None, "")], SCHEMA).repartition(6)
    expected = []
    for p, sections in pages.items():
        skip = None
        for i, (level, title) in enumerate(sections):
            if skip is None or level <= skip:
                skip = level if title in {"See also", "references", "notes"} else None
                if skip is None:
                    expected.append((p, i))
    assert len(expected) > 1000
    kept = keep_sections(df, block=128)
    assert kept.columns == df.columns
    assert sorted((r.page_id, r.ord) for r in kept.collect()) == sorted([*expected, (2, 3005), (2, 3006)])
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    small = keep_sections(df.where("level < 3"), block=128)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan.splitlines()) <= len(small.splitlines()) + 5


def test_no_sections(spark):
    assert keep_sections(spark.createDataFrame([], SCHEMA)).collect() == []


def test_page_lines(spark):
    rows = [
        ("T", "One. Two!", [(1, "A", "x. y"), (2, "notes", "gone"), (3, "Deep", "gone"), (1, "", "z"), (1, "B", ""), (1, None, None)]),
        ("T", "", None),
        ("T", None, []),
    ]
    df = spark.createDataFrame(rows, f"t string, s string, x {SECTION_TYPE}")
    got = [r[0] for r in df.select(page_lines(F.col("t"), F.col("s"), F.col("x"))).collect()]
    assert got == [["T", "One.", "Two!", "A", "x.", "y", "z", "B"], ["T"], ["T"]]


def test_content_of_rows_equals_content_of_arrays(spark):
    rng = random.Random(4)
    pages = [(p, f"Title {p}", f"Lead {p}. More." if p % 2 else None) for p in range(6)]
    trees = {p: [(level, title, f"text {i}. end") for i, (level, title) in enumerate(random_page(rng, 30))] for p in range(6)}
    sections = spark.createDataFrame([(p, i, *s) for p, tree in trees.items() for i, s in enumerate(tree)], SCHEMA)
    page_rows = spark.createDataFrame(pages, "page_id long, title string, summary string")
    by_row = {r["page_id"]: r["content"] for r in assemble_content(page_lines_by_row(page_rows, sections), block=8).collect()}
    arrays = spark.createDataFrame([(*page, trees[page[0]]) for page in pages], f"p long, t string, s string, x {SECTION_TYPE}")
    lines = arrays.select("p", page_lines(F.col("t"), F.col("s"), F.col("x")).alias("lines")).collect()
    assert by_row == {r["p"]: "\n".join(r["lines"]) for r in lines}


def test_exploded_lines(spark):
    df = spark.createDataFrame([(1, 0, 1, "A", "x. y"), (1, 1, 1, "", None)], SCHEMA)
    assert [tuple(r) for r in explode_section_lines(df).collect()] == [(1, 0, 0, "A"), (1, 0, 1, "x."), (1, 0, 2, "y")]
