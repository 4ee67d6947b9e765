"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_COSINE = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
components AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT c.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM components c LEFT JOIN degree d USING (vec_id)
"""

_WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
coded AS (
  SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((16 * (strpos('0123456789abcdef', substr(h, (5 * i // 4)::INT + 1, 1)) - 1)
          + strpos('0123456789abcdef', substr(h, (5 * i // 4)::INT + 2, 1)) - 1)
         >> (3 - (5 * i) % 4)::INT) & 31)::INT, 1)), '') AS payload_digest FROM p),
top AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS largest FROM coded)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM top
"""

_RULES = """
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM w WHERE len(words) >= 8),
windows AS (SELECT doc_id, p, array_to_string(words[p:p + 7], ' ') AS x FROM places),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM again) GROUP BY doc_id),
lines AS (
  SELECT doc_id, sum(n - 1) AS n_dup_lines FROM (
    SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, w.source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS fails FROM judged GROUP BY source),
moments AS (
  SELECT avg(fails / n) AS m, var_samp(fails / n) AS v, avg(1.0::DOUBLE / n) AS chance, sum(n) AS total FROM hosts),
spread AS (SELECT *, v - m * (1 - m) * chance AS beyond FROM moments),
prior AS (
  SELECT m, CASE WHEN v IS NULL THEN 1 WHEN beyond <= 0 THEN total
    WHEN m * (1 - m) / beyond > 1 THEN m * (1 - m) / beyond - 1 ELSE 1 END AS s FROM spread),
verdicts AS (SELECT source, (fails + m * s) / (n + s) <= 0.5 AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_kept AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""

_CHAT = """
WITH said AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations
              WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL),
reply AS (SELECT conv_id, turn, max(text) AS text FROM said
          WHERE (conv_id, turn) IN (SELECT conv_id, max(turn) FROM said GROUP BY conv_id) GROUP BY conv_id, turn),
other AS (SELECT conv_id, turn, text, lead(text, 1, '') OVER (ORDER BY conv_id) AS swapped FROM reply),
chosen AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
rejected AS (SELECT DISTINCT * FROM (
  SELECT * FROM chosen c WHERE NOT EXISTS (
    SELECT 1 FROM reply r WHERE r.conv_id = c.conv_id AND r.turn = c.turn AND c.role = 'assistant' AND r.text = c.text)
  UNION ALL SELECT conv_id, turn, 'assistant', swapped FROM other)),
differs AS (
  (SELECT * FROM chosen EXCEPT SELECT * FROM rejected) UNION ALL (SELECT * FROM rejected EXCEPT SELECT * FROM chosen)),
first_turn AS (SELECT conv_id, min(turn) AS first FROM differs GROUP BY conv_id),
sides AS (
  SELECT 'prompt' AS part, c.* FROM chosen c LEFT JOIN first_turn f USING (conv_id) WHERE f.first IS NULL OR c.turn < f.first
  UNION ALL SELECT 'chosen', c.* FROM chosen c JOIN first_turn f USING (conv_id) WHERE c.turn >= f.first
  UNION ALL SELECT 'rejected', c.* FROM rejected c JOIN first_turn f USING (conv_id) WHERE c.turn >= f.first),
rendered AS (
  SELECT conv_id AS pair_id, part, turn, role, '<|' || role || '|>' || chr(10) AS head,
    replace(text, '<|', '<\\|') || chr(10) || '<|end|>' || chr(10) AS body FROM sides)
SELECT pair_id, part, turn, role, head || body AS rendered,
  CASE WHEN role = 'assistant' AND part <> 'prompt' THEN length(head) END::INT AS mask_start,
  CASE WHEN role = 'assistant' AND part <> 'prompt' THEN length(head) + length(body) END::INT AS mask_end
FROM rendered
"""

_FIM = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
    CASE WHEN n = 0 OR regexp_matches(text, '<[PSM]>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
         WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
cuts AS (
  SELECT *, substr(text, 1, least(c1, c2)) AS prefix, substr(text, least(c1, c2) + 1, abs(c1 - c2)) AS middle,
    substr(text, greatest(c1, c2) + 1) AS suffix FROM k),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM cuts),
parts AS (
  SELECT *, CASE form
    WHEN 'psm' THEN regexp_extract(output, '(?s)^<P>(.*)<S>(.*)<M>(.*)$', ['a', 'c', 'b'])
    WHEN 'spm' THEN regexp_extract(output, '(?s)^<S>(.*)<P>(.*)<M>(.*)$', ['c', 'a', 'b']) END AS x FROM made)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN abs(c1 - c2) END AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output ELSE x['a'] || x['b'] || x['c'] END) AS restored_sha256
FROM parts
"""

ORACLE_SQL: dict[str, str] = {
    "op2_embedding_groups": _COSINE,
    "op5_warc": _WARC,
    "op7_host_rules": _RULES,
    "op9_chat_preferences": _CHAT,
    "op12_fill_in_middle": _FIM,
}
