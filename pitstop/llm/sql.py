"""DuckDB statements that give the rows of the queries SQL can express."""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT source, source_size, CAST(2 AS DOUBLE) * source_size AS cap,
             CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                  WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS w FROM s),
l AS (SELECT *, cap / w AS ratio,
             (CAST(1.5 AS DOUBLE) * (SELECT sum(source_size) FROM s)
               - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / ((SELECT sum(w) FROM n)
               - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM n),
f AS (SELECT level FROM l WHERE ratio > level ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN ratio > level THEN w * (SELECT level FROM f) ELSE cap END AS target FROM l),
b AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget,
             CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT p.doc_id, CAST(p.size AS BIGINT) AS size, b.source_size, b.target,
       CAST(b.epochs * p.size + greatest(0, least(p.size, b.budget - b.epochs * b.source_size - p.before)) AS BIGINT) AS taken,
       p.source
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""

HOST_QUALITY = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM
        (SELECT doc_id, i, unnest([0, 1, 2]) AS j
         FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS c FROM g) WHERE c > 1)
      GROUP BY doc_id),
n AS (SELECT doc_id, sum(c - 1) AS n FROM
        (SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
         WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line)
      GROUP BY doc_id),
f AS (SELECT d.doc_id, d.source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN r ON d.doc_id = r.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS f1,
             sum(CAST(word_chars < 2 * n_words OR word_chars > 12 * n_words AS INT)) AS f2,
             sum(CAST(10 * n_symbols > 3 * n_words AS INT)) AS f3,
             sum(CAST(20 * n_dup_lines > n_words AS INT)) AS f4 FROM b GROUP BY source),
l AS (SELECT source, n, 'a' AS rule, CAST(f1 AS DOUBLE) AS f FROM h UNION ALL SELECT source, n, 'b', f2 FROM h
      UNION ALL SELECT source, n, 'c', f3 FROM h UNION ALL SELECT source, n, 'd', f4 FROM h),
m AS (SELECT rule, sum(f) / sum(n) AS p, sum(f * f / n) / sum(n) AS ff, count(*) / sum(n) AS hn FROM l GROUP BY rule),
q AS (SELECT rule, p, greatest(0.0, p * (1 - p) / greatest(ff - p * p - p * (1 - p) * hn, 1e-12) - 1) AS k FROM m),
v AS (SELECT source, bool_or((f + p * k) / (n + k) > least(0.9, greatest(0.5, p + 4 * sqrt(p * (1 - p) / (k + 1))))) AS host_failed
      FROM l JOIN q USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept, host_failed
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""

WARC = r"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN m.first IS NULL OR m.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN m.first <> p.page_id THEN m.first END AS refers_to
FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest
"""

# A row at a time: the best way into each state of the automaton, with at most two turns inserted behind a row.
REPAIR = r"""
WITH RECURSIVE
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                 lambda r, i: xor(r >> 1, 3988292384::BIGINT * (r & 1))))) % 20 AS fault
      FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS time
      FROM k WHERE fault <> 0),
n AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, left(role, 1) AS sign, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS sign_before, i > 1 AS follows,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM n),
counts AS (SELECT conv_id, max(i) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                  count(*) FILTER (fault = 'truncated') AS truncated,
                  count(*) FILTER (follows AND sign_before || sign NOT IN ('su', 'ua', 'au')) AS illegal
           FROM f GROUP BY conv_id),
edits AS (
  SELECT conv_id, i, '' AS gives, 3 AS cost, 'D' AS letter, NULL AS piece FROM f
  UNION ALL SELECT conv_id, i, sign, CAST(fault = 'truncated' AS INT), 'K', role || ':' || text FROM f WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, i, r.sign, 2 + CAST(fault = 'truncated' AS INT), 'R', r.role || ':' || text
            FROM f, (VALUES ('u', 'user'), ('a', 'assistant')) AS r(sign, role) WHERE fault NOT IN ('blank', 'duplicate')),
steps(state, gives, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2),
                                     (0, '', 0), (1, '', 1), (2, '', 2), (3, '', 3)),
inserts(state, next, cost, letters, piece) AS (VALUES
  (0, 0, 0, '', NULL), (1, 1, 0, '', NULL), (2, 2, 0, '', NULL), (3, 3, 0, '', NULL),
  (0, 2, 2, 'I', 'user:'), (1, 2, 2, 'I', 'user:'), (3, 2, 2, 'I', 'user:'), (2, 3, 2, 'I', 'assistant:'),
  (0, 3, 4, 'II', 'user:' || chr(10) || 'assistant:'), (1, 3, 4, 'II', 'user:' || chr(10) || 'assistant:'),
  (3, 3, 4, 'II', 'user:' || chr(10) || 'assistant:'), (2, 2, 4, 'II', 'assistant:' || chr(10) || 'user:')),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, next AS state, cost, letters AS audit, piece AS text
  FROM (SELECT DISTINCT conv_id FROM f), inserts WHERE state = 0
  UNION ALL
  SELECT conv_id, i, state, CAST(min(key[:9]) AS INT), substr(min(key), 10), arg_min(text, key) FROM (
    SELECT b.conv_id, e.i, x.next AS state, printf('%09d', b.cost + e.cost + x.cost) || b.audit || e.letter || x.letters AS key,
           nullif(concat_ws(chr(10), b.text, e.piece, x.piece), '') AS text
    FROM best b JOIN edits e ON b.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = b.i + 1
    JOIN steps s ON s.state = b.state AND s.gives = e.gives JOIN inserts x ON x.state = s.next)
  GROUP BY conv_id, i, state),
goal AS (SELECT b.conv_id, min(printf('%09d', cost) || audit) AS key, arg_min(coalesce(b.text, ''), printf('%09d', cost) || audit) AS text
         FROM best b JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.rows
         WHERE b.state IN (0, 3) GROUP BY b.conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(key[:9], '0') AS BIGINT) AS cost, coalesce(substr(key, 10), '') AS audit,
       sha256(coalesce(goal.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN goal ON o.conv_id IS NOT DISTINCT FROM goal.conv_id
"""
