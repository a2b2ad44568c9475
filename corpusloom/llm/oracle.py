"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from corpusloom.llm.licenses import ANCHOR, COPYRIGHT, KNOWN, SPELLINGS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    # The flags of the patterns are given apart.
    text = f"lower(regexp_replace({column}, {_quoted('(?im)' + COPYRIGHT.removeprefix('(?im)'))}, '', 'g'))"
    for pattern, spelling in SPELLINGS:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(spelling)}, 'g')"
    return rf"trim(regexp_replace({text}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte."""
    codes = f"list_transform(range(1, len({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: xor(c >> 8, crc_table[1 + (xor(c, b) & 255)])), 4294967295)"


_ROWS = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)

ORACLE = {
    "op1_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
          WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op8_licenses": f"""
        WITH known AS (SELECT DISTINCT license, sha256({_canonical('text')}) AS digest FROM (VALUES {_ROWS}) AS t(license, text)),
        lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents WHERE regexp_matches(text, {_quoted(ANCHOR)})),
        units AS (
          SELECT doc_id, -1 AS line_no, text AS unit FROM lines
          UNION ALL
          SELECT doc_id, i::INTEGER AS line_no, parts[i + 1] AS unit FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM lines WHERE len(parts) > 1))
        SELECT doc_id, line_no::INTEGER AS line_no, license FROM units JOIN known ON sha256({_canonical('unit')}) = digest
        WHERE regexp_matches(unit, {_quoted(ANCHOR)})""",
    # Twenty bits of the digest are five hexadecimal digits and four of base32.
    "op11_warc": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS payload, row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id) AS nth,
                 min(page_id) OVER (PARTITION BY coalesce(html, '')) AS lowest
          FROM pages)
        SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 1 + ((('0x' || substr(sha1(payload), 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
               CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN lowest END AS refers_to
        FROM p""",
    "op12_collocations": rf"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
        starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
        grams AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS m FROM starts),
        f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
        cuts AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m >= 2),
        scored AS (
          SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
          FROM cuts c JOIN totals USING (lang)
          JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
          JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        kept AS (
          SELECT * FROM lowest s WHERE NOT EXISTS (
            SELECT 1 FROM f g WHERE g.lang = s.lang AND g.m > s.m AND 100 * g.f >= 100 * s.a AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ')))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM kept QUALIFY rank <= 2000""",
    "op13_conversation_trie": rf"""
        WITH tables AS (SELECT {_CRC_TABLE} AS crc_table),
        own AS (
          SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS turns
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        heads AS (SELECT conv_id, turns, {_crc32('conv_id::VARCHAR')} % 4 AS h FROM own, tables),
        built AS (
          SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) AS turns
          FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
        paths AS (SELECT conv_id, len(turns) AS l, d, turns[1:d] AS path FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)),
        nodes AS (
          SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, path[1:d - 1] AS up,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (l = d), '')) AS ends_sha256,
                 (count(*) - 1) * coalesce(len(list_filter(string_split_regex(path[d].x, '[\x20\x09-\x0D]+'), lambda w: w <> '')), 0) AS saved
          FROM paths GROUP BY path, d),
        counted AS (
          SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.up = n.path) AS n_children FROM nodes n),
        below AS (
          SELECT x.path, CAST(sum(y.saved) AS BIGINT) AS saved_tokens, count(*) FILTER (y.n_children = 0) AS n_leaves
          FROM counted x JOIN counted y ON y.depth >= x.depth AND y.path[1:x.depth] = x.path GROUP BY x.path)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
        FROM counted n JOIN below b ON b.path = n.path LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.up""",
}
