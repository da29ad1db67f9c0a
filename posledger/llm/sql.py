"""DuckDB statements that give the rows of the queries SQL can express."""

from posledger.llm import quality_rules as rules

EXACT_DEDUP_SQL = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM folded WINDOW same AS (PARTITION BY body)
"""

_quote = lambda pattern: "'" + pattern.replace("'", "''") + "'"
_words = lambda text: f"len(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+'))"
_chars = lambda text: f"length(regexp_replace({text}, '[\\x20\\x09-\\x0D]', '', 'g'))"
_symbols = lambda text: f"len(regexp_extract_all({text}, {_quote('[' + rules.SYMBOLS + ']')}))"

QUALITY_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
line AS (
  SELECT r, l, {_words('l')} AS w, {_chars('l')} AS c
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)),
line_rules AS (
  SELECT r, l, c,
    (w < {rules.LONG_LINE} AND NOT regexp_matches(l, {_quote(rules.SENTENCE_END)}))
    OR {_symbols('l')} * 10 > c
    OR len(regexp_extract_all(l, {_quote(rules.SEPARATOR)})) >= 2
    OR (w <= {rules.STOCK_WORDS} AND regexp_matches(lower(l), {_quote(rules.STOCK_PHRASE)})) AS fails
  FROM line WHERE c > 0),
by_line AS (
  SELECT r, count(*) - count(DISTINCT l) AS dups, coalesce(sum(c) FILTER (fails), 0) AS lost
  FROM line_rules GROUP BY r),
word AS (
  SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i
  FROM (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d)),
gram AS (
  SELECT r, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM word WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM gram WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
counts AS (
  SELECT doc_id, {_words('text')} AS n_words, {_chars('text')} AS word_chars, {_symbols('text')} AS n_symbols,
         coalesce(dups, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN by_line USING (r) LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost <= {rules.MAX_LOSS} * word_chars AS kept
FROM judged
"""

#: SHA-1 in base 32: the hex digits as bits, the bits in fives as letters.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS newest FROM p),
bits AS (
  SELECT *, array_to_string(list_transform(string_split(sha1(payload), ''), lambda d: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', d) - 3, 4)), '') AS b
  FROM marked)
SELECT page_id, strlen(payload) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(b[5 * i + 1] AS INTEGER) + 8 * CAST(b[5 * i + 2] AS INTEGER) + 4 * CAST(b[5 * i + 3] AS INTEGER)
    + 2 * CAST(b[5 * i + 4] AS INTEGER) + CAST(b[5 * i + 5] AS INTEGER) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM bits
"""

FILTER_AUDIT_SQL = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
c AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
f AS (
  SELECT doc_id, part,
    CAST(len(ws) < 200 AS INTEGER)
    + 2 * CAST(100 * len(list_distinct(ws)) < 50 * len(ws) AS INTEGER)
    + 4 * CAST(100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) AS INTEGER)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(first < doc_id, false) AS INTEGER) AS mask
  FROM c),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
n AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
bits AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
steps AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order,
    unnest([1, 2, 3, 4, 5]) AS step, unnest([a.bit, b.bit, c.bit, d.bit, e.bit]) AS bit,
    unnest([0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, a.bit + b.bit + c.bit + d.bit]) AS before
  FROM bits a JOIN bits b ON b.f <> a.f JOIN bits c ON c.f NOT IN (a.f, b.f)
  JOIN bits d ON d.f NOT IN (a.f, b.f, c.f) JOIN bits e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
r AS (
  SELECT part, filter_order, step, bit, n, good, toxic, mask = bit AS alone,
    mask & bit > 0 AS fails, mask & before > 0 AS gone FROM n, steps),
t AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
    coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0) AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM t
"""

#: Levels are unrolled by a recursive step that halves every tree; the CRC-32 of the decimal digits is folded bit by bit.
_leaf = lambda chars: "sha256(" + " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", chars, "text")) + ")"
_crc_bit = lambda c: f"xor({c} >> 1, 3988292384 * ({c} & 1))"
_crc = ("xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda x: CAST(ascii(x) AS BIGINT))), lambda c, x: list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]), "
        f"lambda a, z: {_crc_bit('a')} + z)), 4294967295)")
MERKLE_SQL = f"""
WITH RECURSIVE
d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf('n_chars')} AS leaf,
    CASE WHEN {_crc} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS claimed
  FROM documents),
ranks AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nr,
    row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS r FROM d),
tree_nodes AS (
  SELECT tree, 0 AS level, nr, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM ranks
  UNION ALL
  SELECT tree, level + 1, nr // 2, sha256(string_agg(digest, '' ORDER BY nr)), (n + 1) // 2
  FROM tree_nodes WHERE n > 1 GROUP BY tree, level, nr // 2, n),
tops AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS nr FROM tree_nodes WHERE n = 1),
top_nodes AS (
  SELECT 0 AS level, nr, subroot AS digest, count(*) OVER () AS n FROM tops
  UNION ALL
  SELECT level + 1, nr // 2, sha256(string_agg(digest, '' ORDER BY nr)), (n + 1) // 2
  FROM top_nodes WHERE n > 1 GROUP BY level, nr // 2, n),
nodes AS (
  SELECT tree, level, nr, digest, n FROM tree_nodes
  UNION ALL SELECT '', level, nr, digest, n FROM top_nodes),
-- up: a document's own node on each level, in its tree and then among the subroots
up AS (
  SELECT r, doc_id, tree AS home, tree, 0 AS level, nr, claimed AS folded, '' AS proof FROM ranks
  UNION ALL
  SELECT u.r, u.doc_id, u.home,
    CASE WHEN x.n = 1 THEN '' ELSE u.tree END, CASE WHEN x.n = 1 THEN 0 ELSE u.level + 1 END,
    CASE WHEN x.n = 1 THEN t.nr ELSE u.nr // 2 END,
    CASE WHEN x.n = 1 THEN u.folded
         ELSE sha256(CASE WHEN s.nr < u.nr THEN s.digest ELSE '' END || u.folded || CASE WHEN s.nr > u.nr THEN s.digest ELSE '' END) END,
    u.proof || coalesce(s.digest, '')
  FROM up u JOIN nodes x ON x.tree = u.tree AND x.level = u.level AND x.nr = u.nr
  LEFT JOIN nodes s ON s.tree = u.tree AND s.level = u.level AND s.nr = xor(u.nr, 1)
  JOIN tops t ON t.tree = u.home
  WHERE x.n > 1 OR u.tree <> ''),
ends AS (SELECT u.* FROM up u JOIN nodes x ON x.tree = '' AND u.tree = '' AND x.level = u.level AND x.nr = u.nr AND x.n = 1)
SELECT e.doc_id, k.leaf, t.subroot, root.digest AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
  e.folded = root.digest AS verified
FROM ends e JOIN ranks k ON k.r = e.r
JOIN tops t ON t.tree = e.home, (SELECT digest FROM top_nodes WHERE n = 1) root
"""
