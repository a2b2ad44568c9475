"""Sectioned pages as lines of text.

Two forms of a page tree are taken. A page landed as one row holds its sections as an array in
reading order and is flattened within the row. Sections landed as rows of their own are handled by
windows over blocks of a page, so that no page has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import IGNORED_SECTIONS, is_ignored_section, split_sentences

SECTION_TYPE = "array<struct<level:int,title:string,text:string>>"
NO_LINES = "array<string>"


def _lines(text: Column) -> Column:
    return F.coalesce(split_sentences(text), F.array().cast(NO_LINES))


def _title_line(title: Column) -> Column:
    return F.when(F.length(title) > 0, F.array(title)).otherwise(F.array().cast(NO_LINES))


def section_lines(title: Column, text: Column) -> Column:
    """A section's own lines: its title where there is one, then its sentences."""
    return F.concat(_title_line(title), _lines(text))


def drop_ignored(sections: Column, ignore: tuple[str, ...] = IGNORED_SECTIONS) -> Column:
    """The sections of one page, in reading order, without ignored ones and what lies below them."""

    def step(state: Column, section: Column) -> Column:
        outside = state["skip"].isNull() | (section["level"] <= state["skip"])
        ignored = outside & is_ignored_section(section["title"], ignore)
        return F.struct(
            F.when(ignored, section["level"]).when(~outside, state["skip"]).alias("skip"),
            F.when(outside & ~ignored, F.concat(state["kept"], F.array(section))).otherwise(state["kept"]).alias("kept"),
        )

    start = F.struct(F.lit(None).cast("int").alias("skip"), F.array().cast(SECTION_TYPE).alias("kept"))
    sections = F.coalesce(sections.cast(SECTION_TYPE), F.array().cast(SECTION_TYPE))
    return F.aggregate(sections, start, step)["kept"]


def page_lines(title: Column, summary: Column, sections: Column, ignore: tuple[str, ...] = IGNORED_SECTIONS) -> Column:
    """Lines of a page held in one row: title, summary sentences, then the sections' lines."""
    body = F.flatten(F.transform(drop_ignored(sections, ignore), lambda s: section_lines(s["title"], s["text"])))
    return F.concat(F.array(title), _lines(summary), body)


def page_content(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def _walk(levels: list, ignored: list, skip: int | None) -> tuple[list[bool], int | None]:
    """Which sections stay, and the level of the ignored section that the walk ends within, if any.

    A section without a level stays and changes nothing."""
    kept = []
    for level, drop in zip(levels, ignored):
        if level is None:
            kept.append(True)
        elif skip is not None and level > skip:
            kept.append(False)
        else:
            skip = level if drop else None
            kept.append(not drop)
    return kept, skip


def _summary(rows: pa.Array) -> pa.Array:
    """What walking a block does to the state it starts with, as ``leaves, ends``.

    A walk that starts within an ignored section of level s goes on at the first section of level s
    or above, and from there does not depend on s. Those are the block's running minima: ``leaves``
    are their levels, ``ends`` the states that the walk from each of them ends with. Without a skip
    the walk goes on at the first section. Summaries compose, so blocks are walked apart.
    """
    leaves, ends = [], []
    for block in rows.to_pylist():
        known = [(r["level"], r["ignored"]) for r in block if r["level"] is not None]
        lows = list(accumulate((level for level, _ in known), min))
        minima = [i for i, (level, _) in enumerate(known) if not i or level < lows[i - 1]]
        # From the last section to the first: the state after a walk that goes on at section i.
        after: list[int | None] = [None] * len(known)
        right: list[int] = []
        for i in range(len(known) - 1, -1, -1):
            level, drop = known[i]
            # The top of the stack is the next section at this level or above.
            while right and known[right[-1]][0] > level:
                right.pop()
            if not drop:
                after[i] = after[i + 1] if i + 1 < len(known) else None
            else:
                after[i] = after[right[-1]] if right else level
            right.append(i)
        leaves.append([known[i][0] for i in minima])
        ends.append([after[i] for i in minima])
    kind = pa.list_(pa.int64())
    return pa.StructArray.from_arrays([pa.array(leaves, kind), pa.array(ends, kind)], names=["leaves", "ends"])


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, each with the state its walk starts with."""
    page, skip, first = None, None, True
    for batch in batches:
        starts = []
        for key, leaves, ends in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if first or key != page:
                page, skip, first = key, None, False
            starts.append(skip)
            at = 0 if skip is None else next((i for i, level in enumerate(leaves) if level <= skip), None)
            if at is not None and leaves:
                skip = ends[at]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts, pa.int64())], names=[*batch.schema.names[:2], "_start"])


def keep_sections(
    sections: DataFrame,
    page: str = "page_id",
    seq: str = "ord",
    level: str = "level",
    title: str = "title",
    ignore: tuple[str, ...] = IGNORED_SECTIONS,
    block: int = 4096,
) -> DataFrame:
    """The section rows left after dropping ignored sections with their subtrees.

    The walk of a page is cut into blocks of ``seq``. Each block is first summed up as a function
    from the state it starts with to the one it ends with; these are carried through the blocks of a
    page, and then every block is walked from its own start. So a page may span any number of tasks,
    an outline may have any depth, and the rows with their texts are shuffled once. Sections without
    a level stay.
    """
    marked = sections.select(
        "*", F.floor(F.col(seq) / block).alias("_block"), is_ignored_section(F.col(title), ignore).alias("_ignored"), F.col(level).cast("long").alias("_level")
    )
    entry = F.struct(F.col(seq).alias("seq"), F.col("_level").alias("level"), F.coalesce("_ignored", F.lit(False)).alias("ignored"))
    blocks = marked.groupBy(page, "_block").agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    summed = blocks.select(page, "_block", F.arrow_udf(_summary, "leaves array<long>, ends array<long>")(F.col("_rows")).alias("_s"))
    in_order = summed.select(page, "_block", "_s.leaves", "_s.ends").repartition(page).sortWithinPartitions(page, "_block")
    key = sections.schema[page].dataType.simpleString()
    starts = in_order.mapInArrow(_carry, f"`{page}` {key}, _block long, _start long").where("_start is not null")
    # A start travels as a row ahead of its block's sections.
    rows = marked.withColumn("_start", F.lit(None).cast("long")).unionByName(starts, allowMissingColumns=True)
    dealt = rows.repartition(page, "_block").sortWithinPartitions(page, "_block", F.col("_start").isNull(), seq)
    columns = sections.columns

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, skip = None, None
        for batch in batches:
            keys = list(zip(batch.column(page).to_pylist(), batch.column("_block").to_pylist()))
            levels, ignored, starts = (batch.column(c).to_pylist() for c in ("_level", "_ignored", "_start"))
            kept, a = [], 0
            while a < len(keys):
                b = a
                while b < len(keys) and keys[b] == keys[a]:
                    b += 1
                if at != (keys[a],):
                    at, skip = (keys[a],), None
                if starts[a] is not None:
                    skip, a = starts[a], a + 1
                    kept.append(False)
                stay, skip = _walk(levels[a:b], ignored[a:b], skip)
                kept += stay
                a = b
            yield batch.filter(pa.array(kept, pa.bool_())).select(columns)

    return dealt.mapInArrow(walk, sections.schema)


def explode_section_lines(
    sections: DataFrame, page: str = "page_id", seq: str = "ord", title: str = "title", text: str = "text"
) -> DataFrame:
    """One row per line of each section: ``page``, ``seq``, ``line_ix``, ``line``."""
    return sections.select(page, seq, F.posexplode(section_lines(F.col(title), F.col(text))).alias("line_ix", "line"))


def assemble_content(lines: DataFrame, page: str = "page_id", seq: str = "ord", block: int = 4096) -> DataFrame:
    """The text of each page from its lines, joined in order.

    Lines are first joined within blocks of ``seq``, so that the last step orders a few strings per
    page. Its result is one string per page, which must fit a row.
    """
    parts = (
        lines.withColumn("_block", F.floor(F.col(seq) / block))
        .groupBy(page, "_block")
        .agg(F.array_sort(F.collect_list(F.struct(seq, "line_ix", "line"))).alias("_lines"))
        .select(page, "_block", F.array_join(F.transform("_lines", lambda x: x["line"]), "\n").alias("_part"))
    )
    whole = parts.groupBy(page).agg(F.array_sort(F.collect_list(F.struct("_block", "_part"))).alias("_parts"))
    return whole.select(page, F.array_join(F.transform("_parts", lambda x: x["_part"]), "\n").alias("content"))
