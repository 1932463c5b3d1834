"""DuckDB statements for the queries that SQL can express, by plain definition."""

from __future__ import annotations

# Components: every row takes the smallest label among its links until nothing changes.
REACH = """reach(id, other) AS (
  SELECT id, id FROM nodes UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other)"""

NGRAM_JOIN = f"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(
    list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a
  JOIN sizes q ON q.doc_id = b WHERE 5 * c >= 4 * (p.n + q.n - c)),
nodes AS (SELECT DISTINCT a AS id FROM links),
{REACH},
classes AS (SELECT id, min(other) AS class_id FROM reach GROUP BY id),
counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n, 0) AS n_links,
  coalesce(class_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN classes c ON c.id = doc_id LEFT JOIN counts k ON k.id = doc_id"""

WARC = """WITH rows AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
last AS (SELECT payload_digest AS d, max(page_id) AS response FROM rows
  WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to
FROM rows LEFT JOIN last ON d = payload_digest"""

EMBEDDINGS = f"""WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
nodes AS (SELECT DISTINCT a AS id FROM links),
{REACH},
classes AS (SELECT id, min(other) AS c FROM reach GROUP BY id),
counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id,
  coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN classes k ON k.id = vec_id LEFT JOIN counts m ON m.id = vec_id"""

SUFFIXES = """WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
starts AS (SELECT doc_id, p, md5(substring(x, 2 * p + 1, 200)) AS s
  FROM (SELECT doc_id, x, unnest(range(len(x) // 2 - 99)) AS p FROM texts)),
repeated AS MATERIALIZED (SELECT doc_id, p FROM (SELECT doc_id, p,
    row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM starts) WHERE k > 1),
bytes AS (SELECT t.doc_id, t.i, substring(t.x, 2 * t.i + 1, 2) AS h, r.p
  FROM (SELECT doc_id, x, unnest(range(len(x) // 2)) AS i FROM texts
    WHERE doc_id IN (SELECT doc_id FROM repeated)) t
  LEFT JOIN repeated r ON r.doc_id = t.doc_id AND r.p = t.i),
marked AS (SELECT doc_id, i, h, max(p) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM bytes),
edges AS (SELECT *, lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM marked),
sums AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS n_removed,
    count(*) FILTER (WHERE gone AND NOT before) AS n_spans,
    string_agg(h, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM edges GROUP BY doc_id)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN x ELSE coalesce(kept, '') END)) AS kept_sha256
FROM texts LEFT JOIN sums USING (doc_id)"""

# The unsigned CRC-32 of a text's bytes, for texts ``s`` of ``source``: the remainder goes byte by byte
# through the table of the fixed polynomial 0xEDB88320, which is made bit by bit.
CRC = """crc_bits AS (SELECT b, list_reduce(range(8),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS v
  FROM (SELECT unnest(range(256)) AS b)),
crc_table AS (SELECT list(v ORDER BY b) AS v FROM crc_bits),
crc AS MATERIALIZED (SELECT s, xor(list_reduce(
    list_transform(range(len(x) // 2), lambda i: ('0x' || substring(x, 2 * i + 1, 2))::BIGINT),
    lambda c, y: xor(c >> 8, v[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM (SELECT s, hex(encode(s)) AS x FROM (SELECT DISTINCT s FROM source)), crc_table)"""

SPELLING = rf"""WITH RECURSIVE runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(
    unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS MATERIALIZED (SELECT d || ':' || run AS s, run, count(*) AS n FROM runs
  WHERE length(run) >= 6 GROUP BY 1, 2),
source AS (SELECT s FROM counted),
{CRC},
damaged AS (SELECT n, CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run))
    || substring(run, h % length(run) + 2) ELSE run END AS word FROM counted JOIN crc USING (s)),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 6
  GROUP BY word HAVING sum(n) >= 5),
shorter AS MATERIALIZED (SELECT word, i, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM shorter a JOIN shorter b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT w.word, s.word FROM words w JOIN shorter s ON s.rest = w.word
  UNION SELECT s.word, w.word FROM words w JOIN shorter s ON s.rest = w.word),
best AS (SELECT a AS word, count(*) AS n_near, max(n) AS m, arg_min(b, (-n, b)) AS b
  FROM near JOIN words ON word = b GROUP BY a),
named AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN m >= 5 * n THEN b END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)),
follow(word, root) AS (SELECT word, word FROM named UNION ALL
  SELECT f.word, x.form FROM follow f JOIN named x ON x.word = f.root WHERE x.form IS NOT NULL)
SELECT word, x.form, root, x.n, x.n_near, x.form_n
FROM named x JOIN follow USING (word) JOIN named y ON y.word = root AND y.form IS NULL"""

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. Each row is met by up to two
# inserted turns and one edit; of the ways to a state the cheapest stays, of those the first in ASCII order.
CONVERSATIONS = rf"""WITH RECURSIVE told AS (SELECT conv_id, turn,
    coalesce(conv_id::VARCHAR, ' ') AS c, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
source AS (SELECT s FROM told),
{CRC},
damaged AS (SELECT c, turn, CASE h % 20 WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE h % 20 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM told JOIN crc USING (s)),
placed AS (SELECT *, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS k FROM damaged),
seen AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY c, role, text ORDER BY k) > 1 AS again,
    regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') AS open,
    lag(initial) OVER (PARTITION BY c ORDER BY k) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed),
turns AS MATERIALIZED (SELECT *, again AND NOT blank AS duplicate,
    open AND NOT again AND NOT blank AS truncated FROM seen),
sums AS (SELECT c, max(k) AS rows, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
    count_if(truncated) AS truncated, count_if(illegal) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM turns GROUP BY c),
inserts(before, price, state, letters, added) AS (VALUES
  (0, 0, 0, '', NULL), (1, 0, 1, '', NULL), (2, 0, 2, '', NULL), (3, 0, 3, '', NULL),
  (0, 3, 2, 'I', 'user:'), (1, 3, 2, 'I', 'user:'), (2, 3, 3, 'I', 'assistant:'),
  (3, 3, 2, 'I', 'user:'), (0, 6, 3, 'II', 'user:' || chr(10) || 'assistant:'),
  (1, 6, 3, 'II', 'user:' || chr(10) || 'assistant:'),
  (2, 6, 2, 'II', 'assistant:' || chr(10) || 'user:'),
  (3, 6, 3, 'II', 'user:' || chr(10) || 'assistant:')),
edits(state, letter, fee, initial, after, new) AS (VALUES
  (0, 'D', 4, NULL, 0, NULL), (1, 'D', 4, NULL, 1, NULL), (2, 'D', 4, NULL, 2, NULL),
  (3, 'D', 4, NULL, 3, NULL), (0, 'K', 0, 's', 1, NULL), (0, 'K', 0, 'u', 2, NULL),
  (1, 'K', 0, 'u', 2, NULL), (2, 'K', 0, 'a', 3, NULL), (3, 'K', 0, 'u', 2, NULL),
  (0, 'R', 3, NULL, 2, 'user'), (1, 'R', 3, NULL, 2, 'user'), (2, 'R', 3, NULL, 3, 'assistant'),
  (3, 'R', 3, NULL, 2, 'user')),
walk(c, k, state, cost, audit, lines) AS (
  SELECT c, 0::BIGINT, 0, 0::BIGINT, '', NULL::VARCHAR FROM sums
  UNION ALL SELECT c, k, after, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY c, after ORDER BY cost, audit) AS place FROM (
      SELECT w.c, t.k, e.after, w.audit || i.letters || e.letter AS audit,
        w.cost + i.price + e.fee + CASE WHEN t.truncated AND e.letter <> 'D' THEN 3 ELSE 0 END AS cost,
        CASE WHEN e.letter = 'D' AND i.added IS NULL THEN w.lines ELSE concat_ws(chr(10), w.lines,
          i.added, CASE e.letter WHEN 'K' THEN t.role || ':' || t.text
                                 WHEN 'R' THEN e.new || ':' || t.text END) END AS lines
      FROM walk w JOIN turns t ON t.c = w.c AND t.k = w.k + 1
        JOIN inserts i ON i.before = w.state JOIN edits e ON e.state = i.state
      WHERE (e.letter = 'D' OR NOT (t.blank OR t.duplicate))
        AND (e.initial IS NULL OR e.initial = t.initial))) WHERE place = 1),
finished AS (SELECT c, w.cost + i.price AS cost, w.audit || i.letters AS audit,
    CASE WHEN i.added IS NULL THEN w.lines ELSE concat_ws(chr(10), w.lines, i.added) END AS lines,
    row_number() OVER (PARTITION BY c ORDER BY w.cost + i.price, w.audit || i.letters) AS place
  FROM walk w JOIN sums USING (c) JOIN inserts i ON i.before = w.state
  WHERE w.k = sums.rows AND i.state IN (0, 3))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM told) LEFT JOIN sums USING (c)
  LEFT JOIN (FROM finished WHERE place = 1) USING (c)"""

STATEMENTS = {
    "op5_ngram_join": NGRAM_JOIN,
    "op6_warc": WARC,
    "op7_embedding_dedup": EMBEDDINGS,
    "op8_suffix_dedup": SUFFIXES,
    "op12_spelling_variants": SPELLING,
    "op13_conversation_repair": CONVERSATIONS,
}
