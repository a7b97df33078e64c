"""SQL twins for DuckDB of the operators that SQL can say."""

from __future__ import annotations

from lakeworks.llm.secret_scan import report_sql

# fixed values: words lie between blanks, tabs and line or page breaks; only A-Z are put in lower case
WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_SUBSTRINGS = """
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT doc_id, i, md5(b[i:i + 199]) AS s
  FROM (SELECT doc_id, b, unnest(range(1, n - 198)) AS i FROM docs WHERE n >= 200)
),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS c FROM windows) WHERE c > 1),
started AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, (i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + 200)::INT AS fresh FROM again)
),
gone AS (SELECT doc_id, run, min(i) AS lo, max(i) + 199 AS hi FROM started GROUP BY ALL),
gaps AS (
  SELECT doc_id, lo AS pos, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) + 1 AS a, lo - 1 AS z FROM gone
  UNION ALL
  SELECT doc_id, n + 1 AS pos, coalesce(last_hi, 0) + 1, n FROM docs LEFT JOIN (SELECT doc_id, max(hi) AS last_hi FROM gone GROUP BY doc_id) USING (doc_id)
),
kept AS (
  SELECT doc_id, coalesce(string_agg(CASE WHEN z >= a THEN hex(b[a:z]) ELSE '' END, '' ORDER BY pos), '') AS h
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
),
spans AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo + 1)::BIGINT AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {WORDS.format(text=LOWER)} AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reached r JOIN edges e ON e.x = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

EARLIER_WINDOWS = f"""
WITH docs AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)
),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM windows) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM later),
listed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM listed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

# DuckDB has no crc32: the table of the reflected polynomial 0xEDB88320, then one lookup a byte of an ASCII text
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], repeat([0], 8)),
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table"""
CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda d: ascii(d)::BIGINT)),
  lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8)))"""

PERIODIC_RUNS = f"""
WITH crc_tables AS ({CRC_TABLE}),
docs AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w, {CRC.format(text="doc_id::VARCHAR")} AS h FROM documents, crc_tables),
sized AS (SELECT doc_id, w, len(w)::BIGINT AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM docs),
starts AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM sized),
rebuilt AS (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) END AS p FROM starts),
words AS (
  SELECT doc_id, n, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM rebuilt)
),
again AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
  WHERE 4 * (y.i - x.i) <= x.n
),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM again)
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id)"""

PREFIX_TRIE = f"""
WITH crc_tables AS ({CRC_TABLE}),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT c, {CRC.format(text="c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c FROM turns), crc_tables),
heads AS (SELECT convs.c, pos, r, t FROM convs JOIN turns ON turns.c = convs.c - convs.c % 5 AND pos <= h),
head_sizes AS (SELECT c, count(*) AS k FROM heads GROUP BY c),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT c, pos - h + coalesce(k, 0), r, t FROM turns JOIN convs USING (c) LEFT JOIN head_sizes USING (c) WHERE pos > h
),
walks AS (
  SELECT c, pos AS depth, strlen(t) AS size,
    sha256(string_agg(strlen(r) || ':' || r || strlen(t) || ':' || t, '' ORDER BY pos) OVER (PARTITION BY c ORDER BY pos)) AS node
  FROM rebuilt
),
members AS (SELECT c, depth, size, node FROM walks UNION ALL SELECT c, 0, 0, '' FROM convs),
linked AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY depth) AS above, lead(node) OVER (PARTITION BY c ORDER BY depth) IS NULL AS ends FROM members),
nodes AS (
  SELECT depth, node, any_value(above) AS above, min(c) AS least, count(*) AS n, any_value(size) AS size,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY depth, node
),
kids AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
worth AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_children IS NULL)::INT AS leaf, (n - 1) * size AS saved FROM nodes LEFT JOIN kids USING (depth, node)),
below AS (
  SELECT m.depth, m.node, sum(w.leaf) AS n_leaves, sum(w.saved) AS saved_tokens
  FROM members m JOIN worth w ON w.least = m.c AND w.depth >= m.depth GROUP BY ALL
)
SELECT w.least AS conv_id, w.depth, p.least AS parent_conv_id, w.n AS n_convs, w.n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM worth w JOIN below USING (depth, node) LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.node = w.above"""

ORACLES = {
    "op1_exact_substrings": EXACT_SUBSTRINGS,
    "op3_minhash": NEAR_DUPLICATES,
    "op5_secret_scan": report_sql(),
    "op10_substring_dedup": EARLIER_WINDOWS,
    "op11_periodic_runs": PERIODIC_RUNS,
    "op13_prefix_trie": PREFIX_TRIE,
}
