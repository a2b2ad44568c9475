"""Retrieval, prompts, answers and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import sql
from corpusloom.catalog.tables import arriving, documents, questions, table
from corpusloom.operators.history import new_turns, next_turns, replay, replay_buckets
from corpusloom.plans.indexing import index_objects
from corpusloom.plans.retrieval import ask, fetch_context, find_matches, generate_answers
from corpusloom.session import work_folder
from corpusloom.sinks.history import append_bucketed, append_history, compact_history, history_table
from corpusloom.sinks.index import write_index
from corpusloom.sources.index import read_index
from corpusloom.streaming.answers import read_answers, stream_answers as run_stream

ASKED = ["conv_id", "seq"]
HELD = ["doc_id", "chunk_ix"]


def _matches(spark, sf_dir):
    index = index_objects(documents(spark, sf_dir), ["doc_id"])
    return find_matches(questions(spark, sf_dir), index, ASKED, HELD)


def retrieve_context(spark, sf_dir):
    """The best chunk for every user turn."""
    return _matches(spark, sf_dir).select(
        *ASKED,
        "doc_id",
        F.col("chunk_ix").cast("bigint").alias("chunk_ix"),
        "rag_text",
        F.round("distance", 6).alias("distance"),
        F.round("certainty", 6).alias("certainty"),
    )


def asked_once(spark, sf_dir):
    """Two questions asked one by one: the first user turn, and one that nothing can match."""
    index = index_objects(documents(spark, sf_dir), ["doc_id"])
    first = questions(spark, sf_dir).orderBy(*ASKED).first()["query"]
    answers = [(question, ask(index, HELD, question)) for question in (first, " ")]
    rows = [(question, *(answer[c] for c in ("rag_text", "certainty", "distance"))) for question, answer in answers]
    found = spark.createDataFrame(rows, "question string, rag_text array<string>, certainty double, distance double")
    return found.select("question", F.array_join("rag_text", "\n\n").alias("context"), F.round("certainty", 6).alias("certainty"), F.round("distance", 6).alias("distance"))


def _prompts(spark, sf_dir):
    return fetch_context(questions(spark, sf_dir), _matches(spark, sf_dir), ASKED)


def build_prompt(spark, sf_dir):
    """Every user turn with its context and prompt."""
    return _prompts(spark, sf_dir).select(
        *ASKED,
        F.array_join("context", "\n\n").alias("context"),
        F.round("distance", 6).alias("distance"),
        F.round("certainty", 6).alias("certainty"),
        "prompt",
    )


def _measuring_generator():
    """Stand-in for a user's text generator: answers with the prompt's length, in pieces."""

    def generate(prompt):
        yield str(len(prompt))
        yield " characters"

    return generate


def generated_answers(spark, sf_dir):
    return generate_answers(_prompts(spark, sf_dir), _measuring_generator).select(*ASKED, "answer")


def _asked_again(spark, sf_dir):
    asked = questions(spark, sf_dir)
    return asked.select(*ASKED, F.col("query").alias("question"), F.concat(F.lit("Re: "), "query").alias("answer"))


def append_turns(spark, sf_dir):
    """Every user turn asked once more at the end of its conversation."""
    return new_turns(table(spark, sf_dir, "conversations"), _asked_again(spark, sf_dir))


def replay_history(spark, sf_dir):
    """Stored history with appended turns, in order."""
    past = table(spark, sf_dir, "conversations")
    path = work_folder(spark, "history")
    append_history(past, path)
    append_history(append_turns(spark, sf_dir), path)
    return replay(spark.read.parquet(path))


def replay_bucketed(spark, sf_dir):
    """History and appended turns from a bucketed table after its compaction, each with the place it
    is replayed at in its conversation, and with the conversation's next free turn."""
    folder = work_folder(spark, "history")
    past = table(spark, sf_dir, "conversations")
    append_bucketed(past, f"{folder}/first", HISTORY_BUCKETS)
    append_bucketed(append_turns(spark, sf_dir), f"{folder}/first", HISTORY_BUCKETS)
    compact_history(spark, f"{folder}/first", f"{folder}/second", HISTORY_BUCKETS)
    stored = spark.table(history_table(spark, f"{folder}/second", HISTORY_BUCKETS))
    return replay_buckets(stored).withColumn("place", F.col("place").cast("bigint")).join(next_turns(stored), "conv_id")


HISTORY_BUCKETS = 8


def _user_turns(turns):
    return turns.where("role = 'user'").select("conv_id", F.col("turn").alias("seq"), F.col("text").alias("query"))


def _stored_index(spark, sf_dir, folder):
    write_index(index_objects(documents(spark, sf_dir), ["doc_id"]), f"{folder}/index")
    return read_index(spark, f"{folder}/index")


def stream_answers(spark, sf_dir):
    """User turns read as a stream and answered from a stored index."""
    folder, past = work_folder(spark, "stream"), table(spark, sf_dir, "conversations")
    index = _stored_index(spark, sf_dir, folder)
    run_stream(_user_turns(arriving(spark, sf_dir, "conversations")), index, HELD, past, f"{folder}/answers", f"{folder}/checkpoint", _measuring_generator).awaitTermination()
    return read_answers(spark, f"{folder}/answers")


WAVES, TURNS_PER_WAVE = 3, 3


def stream_restarted(spark, sf_dir):
    """User turns that arrive in waves: the stream ends after the first and is started again for the
    others, one micro-batch each. Turn numbers go on across batches and the restart."""
    folder, past = work_folder(spark, "stream"), table(spark, sf_dir, "conversations")
    index = _stored_index(spark, sf_dir, folder)
    wave = F.least(F.floor(F.col("turn") / TURNS_PER_WAVE), F.lit(WAVES - 1))

    def arrive(number):
        # One file is one micro-batch here.
        past.where(wave == number).coalesce(1).write.mode("append").parquet(f"{folder}/asked")

    def run():
        waves = spark.readStream.schema(past.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/asked")
        run_stream(_user_turns(waves), index, HELD, past, f"{folder}/answers", f"{folder}/checkpoint", _measuring_generator).awaitTermination()

    arrive(0)
    run()
    for number in range(1, WAVES):
        arrive(number)
    run()
    return read_answers(spark, f"{folder}/answers")


def unmatched_questions(spark, sf_dir):
    """Every user turn, and once more without its letters: what nothing matches has a null context."""
    asked = questions(spark, sf_dir)
    asked = asked.withColumn("silent", F.explode(F.array(F.lit(False), F.lit(True))))
    asked = asked.withColumn("query", F.when(F.col("silent"), F.regexp_replace("query", r"[^ \t\n\r]", "")).otherwise(F.col("query")))
    keys = [*ASKED, "silent"]
    index = index_objects(documents(spark, sf_dir), ["doc_id"])
    found = fetch_context(asked, find_matches(asked, index, keys, HELD), keys)
    return found.select(*keys, F.array_join("context", "\n\n").alias("context"), F.round("certainty", 6).alias("certainty"), "prompt")


QUERIES = {
    "retrieve_context": retrieve_context,
    "build_prompt": build_prompt,
    "generated_answers": generated_answers,
    "append_turns": append_turns,
    "replay_history": replay_history,
    "replay_bucketed": replay_bucketed,
    "stream_answers": stream_answers,
    "stream_restarted": stream_restarted,
    "unmatched_questions": unmatched_questions,
    "asked_once": asked_once,
}


def _appended(answered: str) -> str:
    """New turns for a table expression ``(conv_id, seq, question, answer)``."""
    return f"""
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY seq) - 1 AS place FROM {answered}),
next AS (SELECT conv_id, max(turn) + 1 AS next_turn FROM conversations GROUP BY conv_id),
appended AS (
  SELECT conv_id, (next_turn + 2 * place)::BIGINT AS turn, 'user' AS role, question AS text FROM placed JOIN next USING (conv_id)
  UNION ALL
  SELECT conv_id, (next_turn + 2 * place + 1)::BIGINT, 'assistant', answer FROM placed JOIN next USING (conv_id))"""


_AGAIN = _appended("(SELECT conv_id, turn AS seq, text AS question, 'Re: ' || text AS answer FROM conversations WHERE role = 'user')")
_ANSWERED = "(SELECT conv_id, seq, query AS question, length(prompt) || ' characters' AS answer FROM prompts)"
_STREAMED = f"WITH {sql.MATCHES}, {_appended(_ANSWERED)} SELECT conv_id, turn, role, text FROM appended"

ORACLE = {
    "retrieve_context": f"""
        WITH {sql.MATCHES}
        SELECT conv_id, seq, doc_id, chunk_ix, rag_text, round(distance, 6) AS distance, round(certainty, 6) AS certainty FROM matches""",
    "build_prompt": f"""
        WITH {sql.MATCHES}
        SELECT conv_id, seq, rag_text AS context, round(distance, 6) AS distance, round(certainty, 6) AS certainty, prompt FROM prompts""",
    "generated_answers": f"WITH {sql.MATCHES} SELECT conv_id, seq, length(prompt) || ' characters' AS answer FROM prompts",
    "append_turns": f"WITH {_AGAIN} SELECT conv_id, turn, role, text FROM appended",
    "replay_history": f"""
        WITH {_AGAIN} SELECT conv_id, turn, role, text FROM appended UNION ALL SELECT conv_id, turn, role, text FROM conversations""",
    "replay_bucketed": f"""
        WITH {_AGAIN}, a AS (SELECT conv_id, turn, role, text FROM appended UNION ALL SELECT conv_id, turn, role, text FROM conversations)
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place, max(turn) OVER (PARTITION BY conv_id) + 1 AS next_turn FROM a""",
    "stream_answers": _STREAMED,
    "stream_restarted": _STREAMED,
    "asked_once": f"""
        WITH {sql.MATCHES}
        (SELECT query AS question, rag_text AS context, round(certainty, 6) AS certainty, round(distance, 6) AS distance FROM prompts ORDER BY conv_id, seq LIMIT 1)
        UNION ALL SELECT ' ', NULL, NULL, NULL""",
    "unmatched_questions": f"""
        WITH {sql.MATCHES}
        SELECT conv_id, seq, false AS silent, rag_text AS context, round(certainty, 6) AS certainty, prompt FROM prompts
        UNION ALL
        SELECT conv_id, turn, true, NULL, NULL, NULL FROM conversations WHERE role = 'user'""",
}
