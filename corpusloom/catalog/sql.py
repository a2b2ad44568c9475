"""Pieces of SQL shared by the queries' SQL twins."""

# --- fixed values -------------------------------------------------------------------------------
# White space as an RE2 class.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# ------------------------------------------------------------------------------------------------


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}+'), lambda x: x <> '')"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sentences(text: str) -> str:
    return (
        f"list_filter(string_split(regexp_replace({strip(text)}, '([.!?]){SPACE}+', '\\1' || chr(1), 'g'), chr(1)), "
        "lambda x: x <> '')"
    )


def chunks(size: int = 64, overlap: int = 20, source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTEs ``toks (key, w)`` and ``chunks (key, chunk_ix, chunk)``."""
    step = size - overlap
    return f"""
toks AS (SELECT {key}, {words(text)} AS w FROM {source}),
chunks AS (
  SELECT {key}, i AS chunk_ix, array_to_string(w[i * {step} + 1 : i * {step} + {size}], ' ') AS chunk
  FROM (SELECT {key}, w, unnest(range(0, CAST(ceil(greatest(len(w) - {size}, 0) / {step}.0) AS BIGINT) + 1)) AS i
        FROM toks WHERE len(w) > 0))"""


def bucket(word: str, dim: int = 256) -> str:
    return f"('0x' || substr(md5({word}), 1, 8))::BIGINT % {dim}"


def counts(name: str, source: str, keys: str, text: str) -> str:
    """CTE ``name (keys, b, c)`` of word counts per hash bucket, and ``name_norm (keys, n)``."""
    return f"""
{name} AS (
  SELECT {keys}, {bucket('w')} AS b, count(*) AS c
  FROM (SELECT {keys}, unnest({words(f'lower({text})')}) AS w FROM {source}) GROUP BY ALL),
{name}_norm AS (SELECT {keys}, sum(c * c)::BIGINT AS n FROM {name} GROUP BY ALL)"""


def shard(keys: str, shards: int = 5) -> str:
    return f"(('0x' || substr(md5(concat_ws('/', {keys})), 1, 8))::BIGINT % {shards})::INTEGER"


# The best chunk per user turn: best of every shard first, then overall.
MATCHES = f"""
{chunks()},
questions AS (SELECT conv_id, turn AS seq, text AS query FROM conversations WHERE role = 'user'),
{counts('asked', 'questions', 'conv_id, seq', 'query')},
{counts('held', 'chunks', 'doc_id, chunk_ix', 'chunk')},
dots AS (
  SELECT conv_id, seq, doc_id, chunk_ix, sum(asked.c * held.c)::BIGINT AS dot
  FROM asked JOIN held USING (b) GROUP BY ALL),
scores AS (
  SELECT conv_id, seq, doc_id, chunk_ix, {shard('doc_id, chunk_ix')} AS shard, round(dot / sqrt((asked_norm.n * held_norm.n)::DOUBLE), 12) AS score
  FROM dots JOIN asked_norm USING (conv_id, seq) JOIN held_norm USING (doc_id, chunk_ix)),
by_shard AS (
  SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY conv_id, seq, shard ORDER BY score DESC, doc_id, chunk_ix) <= 1),
best AS (
  SELECT * FROM by_shard
  QUALIFY row_number() OVER (PARTITION BY conv_id, seq ORDER BY score DESC, doc_id, chunk_ix) <= 1),
matches AS (
  SELECT conv_id, seq, doc_id, chunk_ix, chunk AS rag_text, 1 - score AS distance, 1 - (1 - score) / 2 AS certainty
  FROM best JOIN chunks USING (doc_id, chunk_ix)),
prompts AS (
  SELECT conv_id, seq, query, rag_text, certainty, distance,
    -- Fixed value: the prompt's text.
    'You are an AI assistant. Use the following context to answer the question.' || chr(10) || chr(10) ||
    'Context:' || chr(10) || rag_text || chr(10) || chr(10) ||
    'Question:' || chr(10) || query || chr(10) || chr(10) || 'Answer:' AS prompt
  FROM questions LEFT JOIN matches USING (conv_id, seq))"""

PART_TITLE = "concat_ws(' ', p_name, p_type, p_size::VARCHAR)"
CANONICAL = "upper(substr(title, 1, 1)) || substr(title, 2)"

# Search hits capped per topic, with page, error and views of June 1998.
RESOLVED = f"""
titled AS (SELECT p_partkey, p_type, p_size, {PART_TITLE} AS title FROM part),
capped AS (
  SELECT p_type AS topic, p_partkey AS rank, title, p_partkey AS pageid FROM titled
  QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) <= 1000),
known AS (
  SELECT DISTINCT title, CASE WHEN p_size >= 11 THEN {CANONICAL} END AS canonical, CASE WHEN p_size <= 5 THEN 'timed out' END AS error
  FROM titled WHERE p_size <= 5 OR p_size >= 11),
viewed AS (
  SELECT {CANONICAL} AS canonical, sum(l_quantity)::BIGINT AS views FROM lineitem JOIN titled ON l_partkey = p_partkey
  WHERE l_shipdate >= DATE '1998-06-01' AND l_shipdate < DATE '1998-07-01' GROUP BY ALL),
resolved AS (
  SELECT topic, rank, title, pageid, canonical, coalesce(views, 0)::BIGINT AS views, error
  FROM capped LEFT JOIN known USING (title) LEFT JOIN viewed USING (canonical)),
articles AS (
  SELECT topic, rank, canonical AS title, pageid, views, row_number() OVER (PARTITION BY topic ORDER BY views DESC, rank)::INTEGER AS place
  FROM resolved WHERE canonical IS NOT NULL QUALIFY place <= 500)"""

# Documents that hold every word of a benchmark item.
SEARCH = f"""
wanted AS (SELECT DISTINCT item_id AS topic, unnest({words('lower(text)')}) AS term FROM benchmark),
asked_terms AS (SELECT topic, count(*) AS terms FROM wanted GROUP BY ALL),
held AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest({words('lower(text)')}) AS term FROM documents) GROUP BY ALL),
found AS (
  SELECT topic, doc_id, sum(c)::BIGINT AS hits, count(*) AS terms FROM held JOIN wanted USING (term) GROUP BY ALL),
hits AS (
  SELECT topic, doc_id, hits, row_number() OVER (PARTITION BY topic ORDER BY hits DESC, doc_id) AS rank
  FROM found JOIN asked_terms USING (topic, terms) QUALIFY rank <= 1000)"""


def dropped(source: str) -> str:
    """CTE ``kept``: rows of ``source (page_id, ord, level, title, ...)`` outside ignored subtrees."""
    # The titles of the sections that are left out.
    return f"""
judged AS (
  SELECT *, lower({strip('title')}) IN ('see also', 'references', 'further reading', 'external links', 'notes', 'citations', 'bibliography') AS ignored
  FROM {source}),
kept AS (
  SELECT * FROM judged i WHERE NOT i.ignored AND NOT EXISTS (
    SELECT 1 FROM judged j WHERE j.page_id = i.page_id AND j.ord < i.ord AND j.ignored AND j.level < i.level
      AND NOT EXISTS (SELECT 1 FROM judged m WHERE m.page_id = i.page_id AND m.ord > j.ord AND m.ord < i.ord AND m.level <= j.level)))"""
