"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.llm.bpe import Tokenizer, encode_documents
from corpusloom.llm.collocations import collocations
from corpusloom.llm.counts import scan_separators, write_token_files
from corpusloom.llm.language import predict_languages
from corpusloom.llm.leaks import benchmark_matches
from corpusloom.llm.licenses import find_licenses
from corpusloom.llm.lines import line_report
from corpusloom.llm.near import near_duplicates
from corpusloom.llm.oracle import ORACLE
from corpusloom.llm.secrets import KINDS, find_secrets, joined
from corpusloom.llm.shuffle import shuffled
from corpusloom.llm.store import table
from corpusloom.llm.topk import top_k
from corpusloom.llm.turns import prefix_trie
from corpusloom.llm.warc import archived_pages
from corpusloom.session import work_folder

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
END_OF_DOCUMENT = 50256  # free in the rank file


def public_ranks() -> tuple[str, str]:
    """Path of the public rank file, and the pattern that cuts text before the merges."""
    import public_tokenizers

    return public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN


def op1_top_k(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where("vec_id % 20 = 0"), 20)


def op2_language_id(spark, sf_dir):
    return predict_languages(table(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    """Token counts of all documents, from token files written without an index."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = docs.withColumn("ids", Tokenizer(spark, *public_ranks()).encoder()(F.col("text")))
    files, written = write_token_files(encoded, END_OF_DOCUMENT)
    found = scan_separators(files, END_OF_DOCUMENT)
    return found.join(written, ["file", "doc_no"], "left").select("doc_id", "file", "doc_no", "start", "n_tokens", "closed")


def op4_shards(spark, sf_dir):
    rows = shuffled(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_benchmark_matches(spark, sf_dir):
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_secrets(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[of_kind(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op7_byte_bpe(spark, sf_dir):
    encoded = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), *public_ranks())
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_licenses(spark, sf_dir):
    return find_licenses(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark, sf_dir):
    return line_report(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_warc(spark, sf_dir):
    """Pages written to whole-file gzip archives, normalised, and read by the offset index."""
    return archived_pages(table(spark, sf_dir, "pages"), work_folder(spark, "archives"), work_folder(spark, "records"))


def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("ref")


def pipeline(spark, sf_dir):
    """The stages of corpus_pipeline.py, which stands at the top of the repository."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_shards": op4_shards,
    "op5_benchmark_matches": op5_benchmark_matches,
    "op6_secrets": op6_secrets,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_licenses": op8_licenses,
    "op9_line_dedup": op9_line_dedup,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_warc": op11_warc,
    "op12_collocations": op12_collocations,
    "op13_conversation_trie": op13_conversation_trie,
    "pipeline": pipeline,
}

__all__ = ["ORACLE", "QUERIES"]
