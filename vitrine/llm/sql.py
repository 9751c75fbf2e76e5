"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from vitrine.llm.chat import Template

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = """
WITH texts AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
bytes AS (
  SELECT doc_id, p, hex(b[p + 1:p + 1]) AS byte, CASE WHEN p + 50 <= n THEN b[p + 1:p + 50] END AS string
  FROM texts, LATERAL (SELECT unnest(range(0, n)) AS p)),
firsts AS (SELECT string, min(doc_id) AS low FROM bytes WHERE string IS NOT NULL GROUP BY string HAVING count(*) > 1),
starts AS (
  SELECT b.doc_id, p, byte, CASE WHEN low < b.doc_id THEN p END AS start
  FROM bytes b LEFT JOIN firsts f ON f.string = b.string),
marked AS (
  SELECT doc_id, p, byte,
         coalesce(p - max(start) OVER (PARTITION BY doc_id ORDER BY p) < 50, false) AS gone FROM starts),
edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM marked),
judged AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
         string_agg(byte, '' ORDER BY p) FILTER (NOT gone) AS kept
  FROM edges GROUP BY doc_id)
SELECT t.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts t LEFT JOIN judged USING (doc_id)
"""

OP2 = f"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS size,
         array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS words
  FROM item_words, LATERAL (SELECT unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS i) WHERE len(words) > 0),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
found AS (
  SELECT d.doc_id, d.i, d.size, w.item
  FROM (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS words
        FROM doc_words, (SELECT DISTINCT size FROM windows),
             LATERAL (SELECT unnest(range(1, len(words) - size + 2)) AS i)) d
  JOIN windows w ON w.size = d.size AND w.words = d.words),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM found, LATERAL (SELECT unnest(range(i, i + size)) AS p) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits
  FROM pages),
digests AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, array_to_string([
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * CAST(bits[5 * g + 1] AS INT) + 8 * CAST(bits[5 * g + 2] AS INT)
           + 4 * CAST(bits[5 * g + 3] AS INT) + 2 * CAST(bits[5 * g + 4] AS INT) + CAST(bits[5 * g + 5] AS INT) AS INT), 1) FOR g IN range(0, 32)], '')
           AS payload_digest FROM payloads),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM digests)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

OP8 = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
places AS (
  SELECT doc_id, i, words[i] AS word, CASE WHEN i + 49 <= len(words) THEN array_to_string(words[i:i + 49], ' ') END AS string
  FROM texts, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS i)),
firsts AS (SELECT string, min(doc_id) AS low FROM places WHERE string IS NOT NULL GROUP BY string HAVING count(*) > 1),
starts AS (
  SELECT p.doc_id, i, word, CASE WHEN low < p.doc_id THEN i END AS start
  FROM places p LEFT JOIN firsts f ON f.string = p.string),
marked AS (
  SELECT doc_id, i, word, coalesce(i - max(start) OVER (PARTITION BY doc_id ORDER BY i) < 50, false) AS gone FROM starts),
judged AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN judged USING (doc_id)
"""


def _escaped_length(column: str) -> str:
    """Length of a text when a backslash has been put into every control string and before every backslash."""
    counts = [f"(length({column}) - length(replace({column}, '{mark}', ''))) // {len(mark)}"
              for mark in ["\\", *Template().controls()]]
    return " + ".join([f"length({column})", *counts])


_T = Template()
_ANSWER_MARKS, _TURN_MARKS = len(_T.answer_open + _T.answer_close), len(_T.turn_open + _T.turn_role + _T.turn_close)
OP11 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
grouped AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = '{_T.trained}'), '') AS answers,
         sum({_escaped_length("text")} + CASE WHEN role = '{_T.trained}' THEN {_ANSWER_MARKS}
             ELSE {_TURN_MARKS} + {_escaped_length("role")} END) AS n
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(answers) AS BIGINT) AS loss_chars,
       sha256(answers) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM grouped
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
split AS MATERIALIZED (
  SELECT r, vec_id, label, p, list_transform(v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})],
         lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM kept, range({parts}) AS parts(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM split WHERE r <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
  SELECT r, p, min_by(e, (far, e)) AS e, min(far) AS far FROM (
    SELECT s.r, s.p, b.e, list_sum(list_transform(list_zip(s.x, b.x), lambda y: (y[1] - y[2]) * (y[1] - y[2]))) AS far
    FROM split s JOIN book{i} b USING (p)) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""
sums{i} AS MATERIALIZED (
  SELECT p, e, k, sum(x[k]) AS s, count(*) AS n
  FROM split JOIN near{i} USING (r, p), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS k) GROUP BY p, e, k),
book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(y, x) AS x FROM book{i} LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS y FROM sums{i} GROUP BY p, e) USING (p, e))""")
    last = f"near{rounds}"
    return "WITH" + ",".join(steps) + f""",
coded AS (
  SELECT vec_id, label, code, error FROM kept JOIN (
    SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error
    FROM {last} GROUP BY r) USING (r)),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS d FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
FROM coded, digest
"""


OP12 = _vector_codes()
