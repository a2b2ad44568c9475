"""Chunking, sentences, names, dates and page lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog import sql
from corpusloom.catalog.tables import as_of, daily_views, documents, hits, known_pages, page_parts, paragraph_sections, table
from corpusloom.functions.dates import last_month_range
from corpusloom.functions.text import clean_file_name, comparable, split_sentences, topic_file_stem, topic_folder, url_title
from corpusloom.functions.views import views_of_json
from corpusloom.operators.chunking import chunk_counts, chunk_documents, empty_documents, refused_chunks, tokenizer_hooks
from corpusloom.operators.sections import explode_section_lines, keep_sections, page_content, page_lines
from corpusloom.plans.curate import curate
from corpusloom.plans.extract import page_texts, safe_articles
from corpusloom.session import work_folder
from corpusloom.sinks.articles import write_article_files, write_article_texts, write_named_files
from corpusloom.sources.articles import read_article_files
from corpusloom.sources.landed import daily_views_of_json


def chunk_documents_64(spark, sf_dir):
    return chunk_documents(documents(spark, sf_dir), ["doc_id"], size=64).withColumn("chunk_ix", F.col("chunk_ix").cast("bigint"))


def chunk_documents_128(spark, sf_dir):
    return chunk_documents(documents(spark, sf_dir), ["doc_id"]).withColumn("chunk_ix", F.col("chunk_ix").cast("bigint"))


def chunk_counts_64(spark, sf_dir):
    counts = chunk_counts(documents(spark, sf_dir), ["doc_id"], size=64)
    return counts.select("doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens"), F.col("n_chunks").cast("bigint").alias("n_chunks"))


def limited_chunks(spark, sf_dir):
    """Windows of the size asked for, cut down to the longest that a tokenizer takes."""
    chunks = chunk_documents(documents(spark, sf_dir), ["doc_id"], size=100_000, overlap=20, limit=256)
    return chunks.withColumn("chunk_ix", F.col("chunk_ix").cast("bigint"))


def documents_without_chunks(spark, sf_dir):
    """Documents of white space only, as every ninth is made here."""
    blank = F.when(F.col("doc_id") % 9 == 0, F.regexp_replace("text", r"\S", " ")).otherwise(F.col("text"))
    return empty_documents(documents(spark, sf_dir).withColumn("text", blank), ["doc_id"])


class CharacterTokenizer:
    """Stand-in for a user's subword tokenizer, one token per character, that fails on some texts
    and on some windows."""

    def encode(self, text):
        if "ß" in text:
            raise ValueError("unknown letter")
        return [ord(c) for c in text]

    def decode(self, ids):
        if ord("ç") in ids:
            raise KeyError(ord("ç"))
        return "".join(map(chr, ids))


def _subwords():
    tokenize, detokenize = tokenizer_hooks(CharacterTokenizer)
    return dict(size=512, overlap=64, tokenize=tokenize, detokenize=detokenize)


def subword_chunks(spark, sf_dir):
    chunks = chunk_documents(documents(spark, sf_dir), ["doc_id"], **_subwords())
    return chunks.withColumn("chunk_ix", F.col("chunk_ix").cast("bigint"))


def refused_subwords(spark, sf_dir):
    """Texts and windows that the tokenizer failed on, with what it raised."""
    refused = refused_chunks(documents(spark, sf_dir), ["doc_id"], **_subwords())
    return refused.withColumn("chunk_ix", F.col("chunk_ix").cast("bigint"))


def split_sentences_all(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(split_sentences(F.col("text"))).alias("sentence_ix", "sentence")).withColumn(
        "sentence_ix", F.col("sentence_ix").cast("bigint")
    )


def safe_titles(spark, sf_dir):
    title = page_parts(spark, sf_dir).select("page_id", "url", "title")
    return title.select(
        "page_id",
        clean_file_name(F.col("url")).alias("file_name"),
        topic_file_stem(F.col("title")).alias("file_stem"),
        topic_folder(F.col("title")).alias("folder"),
        url_title(F.col("title")).alias("url_title"),
        comparable(F.col("title")).alias("comparable"),
    )


def month_ranges(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("as_of")).distinct()
    start, end = last_month_range(F.to_date("as_of", "yyyyMMdd"))
    return days.select("as_of", start.alias("start_date"), end.alias("end_date"))


def _view_payloads(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    field = F.when(F.col("event_type") == "error", '"other"').otherwise('"views"')
    item = F.replace("props", F.lit('"k"'), field)
    payload = F.when(F.col("event_type") == "click", F.lit("{}")).otherwise(F.concat(F.lit('{"items": ['), item, F.lit(", "), item, F.lit("]}")))
    return events.select("user_id", "event_id", payload.alias("payload"))


def json_views(spark, sf_dir):
    """Views in the JSON responses per user."""
    rows = _view_payloads(spark, sf_dir).select("user_id", views_of_json(F.col("payload")).alias("views"))
    return rows.groupBy("user_id").agg(F.sum("views").alias("views"))


def json_view_rows(spark, sf_dir):
    """The same responses as rows, one per day entry."""
    return daily_views_of_json(_view_payloads(spark, sf_dir), "payload", "event_id").select("event_id", "views")


def page_lines_all(spark, sf_dir):
    pages = page_parts(spark, sf_dir)
    lines = page_lines(F.col("title"), F.col("summary"), F.col("sections"))
    return pages.select("page_id", F.posexplode(lines).alias("line_ix", "line")).withColumn("line_ix", F.col("line_ix").cast("bigint"))


def page_content_all(spark, sf_dir):
    return page_texts(page_parts(spark, sf_dir), F.col("title"), F.col("summary"), F.col("sections"), "page_id").select("page_id", "content")


def section_lines(spark, sf_dir):
    kept = keep_sections(paragraph_sections(spark, sf_dir))
    return explode_section_lines(kept).withColumn("line_ix", F.col("line_ix").cast("bigint"))


def article_texts(spark, sf_dir):
    """A text per article of the curated lists, by topic and safe title, written as a table and read
    back. Parts share names, so titles clash, and the last of a list stays."""
    articles = curate(hits(spark, sf_dir), known_pages(spark, sf_dir), daily_views(spark, sf_dir), as_of())[0]
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pageid"), "p_name", "p_brand", "p_retailprice")
    content = F.concat_ws("\n", "p_name", "p_brand", F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
    texts = articles.join(part, "pageid").select("topic", "place", F.col("p_name").alias("title"), content.alias("content"))
    path = work_folder(spark, "article-texts")
    write_article_texts(safe_articles(texts), path)
    return spark.read.schema("safe_title string, content string, topic string").parquet(path)


def read_text_files(spark, sf_dir):
    """Documents written as text files into a folder per source, and read as article files: how
    much text each source's files hold."""
    path = work_folder(spark, "article-files")
    texts = documents(spark, sf_dir, "source").select(F.col("source").alias("topic"), F.col("text").alias("content"))
    write_article_files(texts, path, per_file=1000)
    files = read_article_files(spark, path).withColumn("source", F.replace("topic", F.lit("topic="), F.lit("")))
    size = F.length("text").cast("bigint")
    ends = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return files.groupBy("source").agg(F.sum(size).alias("chars"), F.sum(ends).cast("bigint").alias("line_ends"))


def article_files(spark, sf_dir):
    """Documents written as named files and read as articles: names with dots, underscores, accents
    and percent signs, files of no bytes, of other line ends and of bytes that are no UTF-8."""
    path = work_folder(spark, "named-files")
    docs = documents(spark, sf_dir, "source")
    kind, number = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    name = F.element_at(F.array(*[F.lit(x) for x in ODD_NAMES]), (F.col("doc_id") % len(ODD_NAMES) + 1).cast("int"))
    data = F.when(kind == 1, F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"))).when(kind == 3, F.lit(b""))
    data = data.when(kind == 2, F.encode(F.replace("text", F.lit("\n"), F.lit("\r\n")), "UTF-8")).otherwise(F.encode("text", "UTF-8"))
    folder = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit(". "), "source")).otherwise(F.col("source"))
    write_named_files(docs.select(folder.alias("topic"), F.concat(name, number).alias("safe_title"), data.alias("content")), path)
    return read_article_files(spark, path).select("topic", "file_name", "text", F.col("error").isNotNull().alias("refused"))


ODD_NAMES = (".NET ", "_private ", "çok é%20 ", "plain ")

QUERIES = {
    "article_files": article_files,
    "chunk_documents": chunk_documents_64,
    "chunk_documents_default_size": chunk_documents_128,
    "chunk_counts": chunk_counts_64,
    "limited_chunks": limited_chunks,
    "documents_without_chunks": documents_without_chunks,
    "subword_chunks": subword_chunks,
    "refused_subwords": refused_subwords,
    "split_sentences": split_sentences_all,
    "safe_titles": safe_titles,
    "month_ranges": month_ranges,
    "json_views": json_views,
    "json_view_rows": json_view_rows,
    "page_lines": page_lines_all,
    "page_content": page_content_all,
    "section_lines": section_lines,
    "article_texts": article_texts,
    "read_text_files": read_text_files,
}

_PAGE_SECTIONS = f"""
paragraphs AS (
  SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
    list_transform(string_split(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>'), lambda p: regexp_replace(p, '<[^>]*>', '', 'g')) AS ps
  FROM pages),
placed AS (SELECT page_id, unnest(range(0, len(ps) - 2)) AS ord, ps FROM paragraphs WHERE len(ps) > 2),
sections AS (
  SELECT page_id, ord, (ord % 3 + 1) AS level, ps[ord + 3] AS text,
    CASE WHEN ord % 4 = 2 THEN ' See Also ' WHEN ord % 3 = 0 THEN '' ELSE 'Part ' || ord END AS title
  FROM placed),
{sql.dropped('sections')},
page_line_lists AS (
  SELECT page_id, -2 AS ord, [title] AS lines FROM paragraphs
  UNION ALL SELECT page_id, -1, {sql.sentences('ps[2]')} FROM paragraphs
  UNION ALL SELECT page_id, ord, list_concat(CASE WHEN title <> '' THEN [title] ELSE [] END, {sql.sentences('text')}) FROM kept),
page_line_rows AS (
  SELECT page_id, ord, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM page_line_lists),
page_contents AS (SELECT page_id, string_agg(line, chr(10) ORDER BY ord, pos) AS content FROM page_line_rows GROUP BY page_id)"""

_SUBWORDS = """
        WITH windows AS (
          SELECT doc_id, i AS chunk_ix, substr(text, i * 448 + 1, 512) AS chunk
          FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(greatest(length(text) - 512, 0) / 448.0) AS BIGINT) + 1)) AS i
                FROM documents WHERE length(text) > 0 AND NOT contains(text, 'ß')))"""

ORACLE = {
    "article_files": """
        SELECT replace(CASE WHEN doc_id % 7 = 0 THEN '. ' ELSE '' END || source, ' ', '') AS topic,
          ['.NET ', '_private ', 'çok é%20 ', 'plain '][doc_id % 4 + 1] || doc_id || '.txt' AS file_name,
          CASE WHEN doc_id % 5 IN (1, 3) THEN '' ELSE replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) END AS text,
          doc_id % 5 = 1 AS refused
        FROM documents""",
    "chunk_documents": f"WITH {sql.chunks()} SELECT doc_id, chunk_ix, chunk FROM chunks",
    "chunk_documents_default_size": f"WITH {sql.chunks(128)} SELECT doc_id, chunk_ix, chunk FROM chunks",
    "chunk_counts": f"""
        WITH t AS (SELECT doc_id, len({sql.words('text')})::BIGINT AS n_tokens FROM documents)
        SELECT doc_id, n_tokens, CASE WHEN n_tokens = 0 THEN 0 ELSE CAST(ceil(greatest(n_tokens - 64, 0) / 44.0) AS BIGINT) + 1 END AS n_chunks FROM t""",
    "limited_chunks": f"WITH {sql.chunks(256)} SELECT doc_id, chunk_ix, chunk FROM chunks",
    "documents_without_chunks": f"SELECT doc_id FROM documents WHERE doc_id % 9 = 0 OR len({sql.words('text')}) = 0",
    "subword_chunks": f"{_SUBWORDS} SELECT * FROM windows WHERE NOT contains(chunk, 'ç')",
    "refused_subwords": f"""{_SUBWORDS}
        SELECT doc_id, chunk_ix, 'KeyError: 231' AS error FROM windows WHERE contains(chunk, 'ç')
        UNION ALL SELECT doc_id, NULL, 'ValueError: unknown letter' FROM documents WHERE contains(text, 'ß')""",
    "split_sentences": f"""
        WITH s AS (SELECT doc_id, {sql.sentences('text')} AS ss FROM documents)
        SELECT doc_id, unnest(range(0, len(ss))) AS sentence_ix, unnest(ss) AS sentence FROM s""",
    "safe_titles": f"""
        WITH t AS (SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages)
        SELECT page_id, translate(url, '\\/*?:"<>|', '') AS file_name, replace(title, ' ', '_') AS file_stem, replace(title, ' ', '') AS folder,
          replace(title, ' ', '_') AS url_title, lower({sql.strip('title')}) AS comparable FROM t""",
    "month_ranges": """
        SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS as_of, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y%m%d') AS start_date,
          strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y%m%d') AS end_date FROM orders""",
    "json_views": """
        SELECT user_id, sum(CASE WHEN event_type IN ('error', 'click') THEN 0 ELSE 2 * CAST(props ->> '$.k' AS BIGINT) END)::BIGINT AS views
        FROM events GROUP BY user_id""",
    "json_view_rows": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(props ->> '$.k' AS BIGINT) END AS views
        FROM events, range(2) WHERE event_type <> 'click'""",
    "page_lines": f"""
        WITH {_PAGE_SECTIONS}
        SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY ord, pos) - 1 AS line_ix, line FROM page_line_rows""",
    "page_content": f"WITH {_PAGE_SECTIONS} SELECT page_id, content FROM page_contents",
    "section_lines": f"""
        WITH lines AS (
          SELECT doc_id AS page_id, unnest(range(0, len(string_split(text, chr(10))))) AS ord, unnest(string_split(text, chr(10))) AS text FROM documents),
        sections AS (
          SELECT page_id, ord, length(text) % 4 + 1 AS level, text,
            CASE len({sql.words('text')}) % 7 WHEN 3 THEN ' See Also ' WHEN 5 THEN 'REFERENCES' WHEN 1 THEN '' ELSE 'Part ' || ord END AS title
          FROM lines),
        {sql.dropped('sections')},
        listed AS (SELECT page_id, ord, list_concat(CASE WHEN title <> '' THEN [title] ELSE [] END, {sql.sentences('text')}) AS ls FROM kept)
        SELECT page_id, ord, unnest(range(0, len(ls))) AS line_ix, unnest(ls) AS line FROM listed""",
    "article_texts": f"""
        WITH {sql.RESOLVED}
        SELECT topic, translate(p_name, '\\/*?:"<>|', '') AS safe_title,
          p_name || chr(10) || p_brand || chr(10) || p_retailprice::DECIMAL(12, 2)::VARCHAR AS content
        FROM articles JOIN part ON p_partkey = pageid
        QUALIFY row_number() OVER (PARTITION BY topic, safe_title ORDER BY place DESC) = 1""",
    "read_text_files": """
        SELECT source, sum(length(text) + 1)::BIGINT AS chars, sum(length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS line_ends
        FROM documents GROUP BY source""",
}
