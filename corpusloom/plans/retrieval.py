"""Questions to contexts, prompts and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.prompts import build_prompt
from corpusloom.functions.vectors import Embedder, hashed_counts
from corpusloom.operators.nearest import nearest_by_shard

# --- fixed values -------------------------------------------------------------------------------
MATCHES_PER_SHARD = 1
MATCHES = 1
DEFAULT_RESULT_LIMIT = 20
# ------------------------------------------------------------------------------------------------


def find_matches(
    questions: DataFrame,
    index: DataFrame,
    question_keys: list[str],
    item_keys: list[str],
    question: str = "query",
    embed: Embedder | None = None,
    shard_k: int = MATCHES_PER_SHARD,
    k: int = MATCHES,
    **options,
) -> DataFrame:
    """The best chunks per question with their text, best of every shard first, then overall.

    One pass over the index: the winners carry their text with them.
    """
    embed = embed or hashed_counts()
    asked = questions.select(*question_keys, embed(F.col(question)).alias("vector"))
    options.setdefault("dim", getattr(embed, "dim", None))
    options = {"asked_keys": question_keys, "item_keys": item_keys, "carry": ["context"], **options}
    return nearest_by_shard(asked, index, shard_k, k, **options).withColumnRenamed("context", "rag_text")


def fetch_context(questions: DataFrame, matches: DataFrame, question_keys: list[str], question: str = "query") -> DataFrame:
    """Every question with its ``context`` array, ``certainty`` and ``distance`` of the best match,
    and ``prompt``. A question without a match keeps a null context."""
    # At most k matches per question are gathered.
    contexts = matches.groupBy(*question_keys).agg(
        F.array_sort(F.collect_list(F.struct("match_rank", "rag_text"))).alias("_ranked"),
        F.max("certainty").alias("certainty"),
        F.min("distance").alias("distance"),
    )
    answered = questions.join(contexts, question_keys, "left")
    return (
        answered.withColumn("context", F.transform("_ranked", lambda m: m["rag_text"]))
        .withColumn("prompt", build_prompt(F.col("context"), F.col(question)))
        .drop("_ranked")
    )


def ask(index: DataFrame, item_keys: list[str], question: str, **options) -> dict:
    """Context of a single question: ``rag_text`` (a list), ``certainty`` and ``distance``; all of
    them None where nothing matches."""
    asked = index.sparkSession.createDataFrame([(0, question)], "qid long, query string")
    row = fetch_context(asked, find_matches(asked, index, ["qid"], item_keys, **options), ["qid"]).first()
    return {"rag_text": row["context"], "certainty": row["certainty"], "distance": row["distance"]}


def generate_answers(
    prompts: DataFrame, make_generator: Callable[[], Callable[[str], str]], prompt: str = "prompt", answer: str = "answer"
) -> DataFrame:
    """Answers of a user's text generator, built once per Python worker. A generator may yield
    pieces, which are joined; a null prompt has a null answer."""

    def complete(generate, text):
        if text is None:
            return None
        reply = generate(text)
        return reply if isinstance(reply, str) else "".join(reply)

    @F.pandas_udf("string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        generate = make_generator()
        for series in texts:
            yield series.map(lambda text: complete(generate, text))

    return prompts.withColumn(answer, run(F.col(prompt)))
