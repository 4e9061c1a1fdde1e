"""SQL for the operators that SQL can express."""

from __future__ import annotations

#: 40 bits of the digest at a time, five bits a digit.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((('0x' || substr(h, {1 + 10 * part}, 10))::BIGINT >> {35 - 5 * digit}) & 31) AS INTEGER) + 1, 1)"
    for part in range(4) for digit in range(8)
)

WARC_CAPTURES = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT *, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, strlen(payload) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f"""

EMBEDDING_NEAR_DUPLICATES = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND list_aggregate(embedding, 'count') = len(embedding)
    AND isfinite(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))
    AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.93),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1) USING (vec_id)
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY 1) ON a = e.vec_id"""

# crc32 by bits: every byte is followed by seven zeros, each step shifts once. The search
# keeps (cost, edits) for each state and compares them as structs.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
           lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS copies(copy)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY n) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
facts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv),
convs AS (
  SELECT h.conv, any_value(h.conv_id) AS conv_id, (SELECT count(*) FROM faulty f WHERE f.conv = h.conv) AS rows
  FROM hashed h GROUP BY h.conv),
search AS (
  SELECT conv, 0 AS n, {'c': 0, 's': ''} AS p0, {'c': 99999999, 's': ''} AS p1, {'c': 99999999, 's': ''} AS p2,
         {'c': 99999999, 's': ''} AS p3 FROM convs
  UNION ALL
  SELECT conv, n, {'c': q0.c + 2, 's': q0.s || 'D'},
         list_min([{'c': q1.c + 2, 's': q1.s || 'D'}, {'c': q0.c + stay + (CASE initial WHEN 's' THEN 0 ELSE 99999999 END), 's': q0.s || 'K'}]),
         list_min([{'c': q2.c + 2, 's': q2.s || 'D'}, {'c': q0.c + stay + say_u, 's': q0.s || edit_u},
                   {'c': q1.c + stay + say_u, 's': q1.s || edit_u}, {'c': q3.c + stay + say_u, 's': q3.s || edit_u}]),
         list_min([{'c': q3.c + 2, 's': q3.s || 'D'}, {'c': q2.c + stay + say_a, 's': q2.s || edit_a}])
  FROM (
    SELECT *, list_min([p3, {'c': q2.c + 5, 's': q2.s || 'I'}]) AS q3
    FROM (
      SELECT s.conv, f.n, s.p0 AS q0, s.p1 AS q1, s.p3, f.initial,
             list_min([s.p2, {'c': s.p0.c + 5, 's': s.p0.s || 'I'}, {'c': s.p1.c + 5, 's': s.p1.s || 'I'},
                       {'c': s.p3.c + 5, 's': s.p3.s || 'I'}]) AS q2,
             CASE f.fault WHEN 'truncated' THEN 5 WHEN '' THEN 0 ELSE 99999999 END AS stay,
             CASE f.initial WHEN 'u' THEN 0 ELSE 1 END AS say_u, CASE f.initial WHEN 'u' THEN 'K' ELSE 'R' END AS edit_u,
             CASE f.initial WHEN 'a' THEN 0 ELSE 1 END AS say_a, CASE f.initial WHEN 'a' THEN 'K' ELSE 'R' END AS edit_a
      FROM search s JOIN faulty f ON f.conv = s.conv AND f.n = s.n + 1))),
found AS (
  SELECT s.conv, list_min([p0, p3, {'c': p2.c + 5, 's': p2.s || 'I'}, {'c': p1.c + 10, 's': p1.s || 'II'}]) AS best
  FROM search s JOIN convs c ON c.conv = s.conv AND s.n = c.rows),
edits AS (
  SELECT conv, i, best.s[i] AS edit,
         len(replace(best.s[:i], 'I', '')) AS n, len(replace(best.s[:i], 'D', '')) AS place
  FROM found, range(1, len(best.s) + 1) AS places(i)),
said AS (
  SELECT e.conv, e.i, e.edit, e.place, f.role, CASE e.edit WHEN 'I' THEN '' ELSE f.text END AS text,
         max(e.place = 1 AND e.edit = 'K' AND f.initial = 's') OVER (PARTITION BY e.conv) AS system
  FROM edits e LEFT JOIN faulty f ON f.conv = e.conv AND f.n = e.n WHERE e.edit <> 'D'),
repaired AS (
  SELECT conv, string_agg(
           (CASE WHEN edit = 'K' THEN role WHEN (place - system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END)
           || ':' || text, chr(10) ORDER BY i) AS whole
  FROM said GROUP BY conv)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.s AS audit,
       sha256(coalesce(whole, '')) AS repaired_sha256
FROM convs c JOIN found USING (conv) LEFT JOIN facts USING (conv) LEFT JOIN repaired USING (conv)
"""
