"""Writers of the curation and extraction steps."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import topic_file_stem, topic_folder
from corpusloom.sources.articles import FILE_SUFFIX, RANKED_FILE_SUFFIX, store_of


def write_ranked_lists(articles: DataFrame, path: str) -> None:
    """Ranked articles as JSON lines, one folder per topic, in the order of their ``place``, which is
    written with them. Null page ids are kept."""
    ordered = articles.repartition("topic").sortWithinPartitions("topic", "place")
    _write_topics(ordered.select("topic", "title", "pageid", "views", "place"), path)


def write_failed_pages(failed: DataFrame, path: str) -> None:
    _write_topics(failed.select("topic", "original_title", "error"), path)


def _write_topics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("topic").option("ignoreNullFields", False).json(path)


def write_article_texts(texts: DataFrame, path: str) -> None:
    """Article texts ``(topic, safe_title, content)`` as a table with one folder per topic."""
    texts.write.mode("overwrite").partitionBy("topic").parquet(path)


def write_article_files(texts: DataFrame, path: str, content: str = "content", per_file: int = 1) -> None:
    """Text files in a folder per topic, one per article or of ``per_file`` articles each, for
    readers that need files. ``write_article_texts`` has no such number of files."""
    files = texts.select("topic", F.col(content).alias("value"))
    files.write.mode("overwrite").partitionBy("topic").option("maxRecordsPerFile", per_file).text(path)


def write_ranked_arrays(articles: DataFrame, path: str) -> None:
    """Ranked articles as one JSON array per topic, in a file ``<topic>_articles.json`` under ``path``, in
    the order of their ``place``. A list is as long as the curation keeps articles, so it fits a row."""
    entry = F.struct("place", F.struct("title", "pageid", "views").alias("entry"))
    lists = articles.groupBy("topic").agg(F.sort_array(F.collect_list(entry)).alias("list"))
    text = F.to_json(F.transform("list", lambda e: e["entry"]), {"ignoreNullFields": "false"})
    name = F.concat(topic_file_stem(F.col("topic")), F.lit(RANKED_FILE_SUFFIX.removesuffix(".json")))
    write_named_files(lists.select(F.lit("").alias("topic"), name.alias("safe_title"), text.alias("content")), path, suffix=".json")


def write_named_files(texts: DataFrame, root: str, content: str = "content", suffix: str = FILE_SUFFIX) -> None:
    """One file ``<root>/<folder>/<safe title>.txt`` per article of ``topic, safe_title, content``, as
    UTF-8; the folder is the topic without spaces. Binary content is written as it is.

    Tasks write the files on any store that pyarrow knows: each to a name of its own first, which is
    then moved, so a task that runs again, or twice, leaves one whole file. Equal names overwrite
    each other; ``safe_articles`` settles which article stays.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        made = set()
        for batch in batches:
            for folder, name, data in zip(*(c.to_pylist() for c in batch.columns)):
                place = f"{base.rstrip('/')}/{folder}".rstrip("/")
                if folder not in made:
                    store.create_dir(place, recursive=True)
                    made.add(folder)
                draft = f"{place}/{name}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(draft, compression=None) as file:
                    file.write(data)
                store.move(draft, f"{place}/{name}{suffix}")
            yield batch.select(["folder"])

    data = F.coalesce(F.col(content).cast("binary"), F.lit(b"")).alias("data")
    rows = texts.select(topic_folder(F.col("topic")).alias("folder"), "safe_title", data)
    rows.mapInArrow(write, "folder string").write.format("noop").mode("overwrite").save()
