"""Article text files and ranked article lists."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANKED_SCHEMA = "title string, pageid bigint, views bigint"
FILE_SUFFIX = ".txt"
BATCH_BYTES = 16 << 20
RANKED_FILE_SUFFIX = "_articles.json"


def read_article_files(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """Every ``<root>/<folder>/*.txt`` as one row: ``topic`` (the folder), ``file_name``, ``text``, ``error``.

    Tasks list the folders and their files, and then read the files, dealt evenly by a hash of their
    path into ``tasks`` (four per core by default); the driver sees none of it. Names that begin with
    a dot or an underscore and files of no bytes are files like any other. ``root`` is a folder on
    any store that pyarrow knows and every executor can reach.

    A file that cannot be read or is not valid UTF-8 has empty text, and ``error`` says why; else
    that is null. All line ends are ``\\n``. A root that does not exist is an error.
    """
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(root,)], "path string").mapInArrow(_list(FileType.Directory), "topic string, path string")
    listed = folders.repartition(tasks, "path").mapInArrow(_list(None, FILE_SUFFIX, root), "path string, topic string, file_name string")
    dealt = listed.repartition(tasks, F.xxhash64("path"))
    kind = "topic string, file_name string, text string, error string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(root)
        names = [f.split()[0] for f in kind.split(", ")]
        rows, size = [], 0
        for batch in batches:
            for path, topic, name in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append((topic, name, *_text(store, path)))
                size += len(rows[-1][2])
                if size > BATCH_BYTES:
                    yield _batch(rows, names)
                    rows, size = [], 0
        yield _batch(rows, names)

    return dealt.mapInArrow(read, kind)


def store_of(root: str) -> tuple[FileSystem, str]:
    """The store that holds a folder, and the folder's path in it."""
    return FileSystem.from_uri(re.sub("^file:/+", "file:///", root))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.string()) for i, n in enumerate(names)})


def _list(wanted: FileType | None, suffix: str = "", root: str = ""):
    """Lists the folders that come in, one by one: names of what is wanted with their paths."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, topic in zip(batch.column("path").to_pylist(), batch.column("topic").to_pylist() if wanted is None else [None] * len(batch)):
                store, folder = store_of(path) if wanted is not None else (store_of(root)[0], path)
                found = [e for e in store.get_file_info(FileSelector(folder)) if (wanted is None or e.type == wanted) and e.base_name.endswith(suffix)]
                if wanted is None:
                    yield _batch([(e.path, topic, e.base_name) for e in found], ["path", "topic", "file_name"])
                else:
                    yield _batch([(e.base_name, e.path) for e in found], ["topic", "path"])

    return entries


def _text(store: FileSystem, path: str) -> tuple[str, str | None]:
    try:
        with store.open_input_stream(path, compression=None) as file:
            text = file.read().decode("utf-8")
    except (OSError, UnicodeDecodeError) as e:
        return "", f"{type(e).__name__}: {e}"
    return text.replace("\r\n", "\n").replace("\r", "\n"), None


def read_article_texts(spark: SparkSession, path: str) -> DataFrame:
    """Article texts as ``write_article_texts`` stores them: ``topic, file_name, text``."""
    texts = spark.read.schema("safe_title string, content string, topic string").parquet(path)
    return texts.select("topic", F.concat("safe_title", F.lit(".txt")).alias("file_name"), F.col("content").alias("text"))


def read_ranked_lists(spark: SparkSession, path: str) -> DataFrame:
    """Ranked articles as this library writes them, all topics at once."""
    return spark.read.schema(RANKED_SCHEMA + ", place int, topic string").json(path)


def read_ranked_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Ranked articles held as one JSON array per file named ``<topic>_articles.json``; ``place`` is
    the place in the array, from 1."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("_file"))
    stem = F.substring(F.col("_file"), F.lit(1), F.length("_file") - len(RANKED_FILE_SUFFIX))
    entries = F.from_json("value", f"array<struct<{RANKED_SCHEMA.replace(' ', ':').replace(',:', ',')}>>")
    return (
        files.where(F.endswith("_file", F.lit(RANKED_FILE_SUFFIX)))
        .select(F.replace(stem, F.lit("_"), F.lit(" ")).alias("topic"), F.posexplode(entries).alias("_at", "_entry"))
        .select("topic", (F.col("_at") + 1).alias("place"), "_entry.*")
    )
