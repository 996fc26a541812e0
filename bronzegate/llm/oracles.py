"""DuckDB SQL for the corpus queries that SQL can express."""

_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM parts
), keyed AS (
  SELECT *, translate(trim(line, {_STRIP}), {_UP}, {_LOW}) AS k FROM lines
), held AS (
  SELECT k, min(doc_id) AS lo FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT doc_id, pos, line, coalesce(doc_id > lo, false) AS gone FROM keyed LEFT JOIN held USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

URL_FILTER = f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS mark FROM pages
), cut AS (
  SELECT page_id, CASE WHEN mark > 0 THEN substr(u, mark + 3) ELSE '' END AS rest FROM parts
), named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_UP}, {_LOW}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fit AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM named JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
), canon AS (
  SELECT *, regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '([.]html)?/*$', '') AS c FROM named
), listed AS (
  SELECT DISTINCT c FROM canon WHERE regexp_matches(host, '(^|[.-])(casino|pills|spam|adult)([.-]|$)')
)
SELECT canon.page_id, host, path, rule, coalesce(v, CASE WHEN listed.c IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM canon LEFT JOIN fit USING (page_id) LEFT JOIN listed ON canon.c = listed.c
"""

_VALID = "label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

EMBEDDING_DEDUP = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
  FROM embeddings WHERE {_VALID}
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), low AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
), degree AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low.y, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low.y, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON low.x = vec_id LEFT JOIN degree ON degree.x = vec_id
"""

LEXICAL_SEARCH = f"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_LOW}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_LOW}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), wanted AS (
  SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * total.docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, total WHERE term IN (SELECT term FROM wanted) GROUP BY term, total.docs
), impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * total.docs) // total.words))) AS impact
  FROM tfs JOIN weights USING (term) JOIN lengths USING (doc_id), total
), scored AS (
  SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY ALL HAVING sum(times * impact) > 0
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored QUALIFY rank <= 20
"""

CHAT_FORMAT = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### : </turn>') + 1 + length(text) + length(regexp_replace(text, '[^#<\\\\]', '', 'g')) +
           CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role) ELSE 1 + length(base64(encode(role))) END)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""



def _step(way: str, cost: str, edit: str) -> str:
    """A way is its cost in nine digits and its edits, so the least string is the cheapest, then ASCII-least way."""
    return f"(lpad((left({way}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({way}, 10) || '{edit}')"


def _kept(way: str, initial: str) -> str:
    return f"CASE WHEN ini = '{initial}' AND may THEN {_step(way, 'extra', 'K')} END"


def _reroled(way: str) -> str:
    return f"CASE WHEN may THEN {_step(way, '2 + extra', 'R')} END"


_CLOSED = f"""SELECT conv_id, i, z, s, least(u, {_step('z', '2', 'I')}, {_step('s', '2', 'I')}, {_step('a', '2', 'I')}) AS u, a FROM ways"""

CONVERSATION_REPAIR = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
           lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)) AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), hashed AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
              lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS way FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
         CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE way WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE way <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS ini FROM damaged
), numbered_same AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM placed
), faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM numbered_same
), judged AS (
  SELECT *, fault NOT IN ('blank', 'duplicate') AS may, (fault = 'truncated')::BIGINT AS extra,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS two FROM faults
), ways AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' AS z, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM conversations
  UNION ALL
  SELECT w.conv_id, r.i, {_step('z', '3', 'D')}, least({_step('s', '3', 'D')}, {_kept('z', 's')}),
         least({_step('u', '3', 'D')}, {_kept('least(z, s, a)', 'u')}, {_reroled('least(z, s, a)')}),
         least({_step('a', '3', 'D')}, {_kept('u', 'a')}, {_reroled('u')})
  FROM (SELECT conv_id, i, z, s, u, least(a, {_step('u', '2', 'I')}) AS a FROM ({_CLOSED})) w
  JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
), ended AS (
  SELECT conv_id, least(z, a, {_step('u', '2', 'I')}) AS way FROM ({_CLOSED}) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), edits AS (
  SELECT conv_id, unnest(string_split(substr(way, 10), '')) AS e, generate_subscripts(string_split(substr(way, 10), ''), 1) AS j
  FROM ended WHERE length(way) > 9
), numbered AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS p FROM edits
  WINDOW w AS (PARTITION BY conv_id ORDER BY j)
), made AS (
  SELECT n.conv_id, j, p, e, r.role, coalesce(CASE WHEN e <> 'I' THEN r.text END, '') AS text,
         max(CASE WHEN p = 1 AND e = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS s
  FROM numbered n LEFT JOIN judged r ON r.conv_id IS NOT DISTINCT FROM n.conv_id AND r.i = n.i
  WHERE e <> 'D'
), said AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (p - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS lines
  FROM made GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, left(way, 9)::BIGINT AS cost,
       substr(way, 10) AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

SUBSTRING_DEDUP = f"""
WITH w AS (
  SELECT doc_id, {_WORDS} AS ws FROM documents
), places AS (
  SELECT doc_id, ws, unnest(range(len(ws) - 49)) AS i FROM w WHERE len(ws) >= 50
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i + 1 : i + 50], ' ') AS t FROM places
), firsts AS (
  SELECT t, min(doc_id) AS lo FROM windows GROUP BY t
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM windows JOIN firsts USING (t) WHERE doc_id > lo
), each AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w
), kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY e.pos) AS text
  FROM each e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos GROUP BY e.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

MINHASH_DEDUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_LOW}), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(len(ws) - 2), lambda i: array_to_string(ws[i + 1 : i + 3], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), low AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(low.y, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(low.y, w.doc_id)) AS kept
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN low ON low.x = w.doc_id
"""

ORACLES = {
    "op8_substring_dedup": SUBSTRING_DEDUP,
    "op10_minhash_dedup": MINHASH_DEDUP,
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op12_chat_format": CHAT_FORMAT,
    "op13_lexical_search": LEXICAL_SEARCH,
    "op3_embedding_dedup": EMBEDDING_DEDUP,
    "op2_line_dedup": LINE_DEDUP,
    "op5_url_filter": URL_FILTER,
}
