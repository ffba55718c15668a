"""The same results in SQL, where SQL can express them."""

from __future__ import annotations

from aferir.llm import quality_rules as rules

GRID = ", ".join(f"('{rule}', {cutoff})" for rule, cutoffs in rules.CUTOFFS.items() for cutoff in cutoffs)
TESTS = sum(map(len, rules.CUTOFFS.values()))
RATES = " UNION ALL ".join(f"SELECT doc_id, stratum, '{rule}' AS rule, {rule} AS rate FROM rated" for rule in rules.CUTOFFS)
LOG_TERM = (
    "lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)"
    f" + i * ln({rules.RISK}) + (n - i) * ln(1 - {rules.RISK})"
)

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS ls FROM d),
windows AS (
  SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM w, unnest(range(1, len(ws) - 1)) AS t(i)),
repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM repeated, (VALUES (0), (1), (2)) AS v(j) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^{rules.SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines, length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS n_upper
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
rated AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         coalesce(n_symbols / nullif(n_words, 0), 0) AS symbol_rate,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_rate,
         coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_rate,
         coalesce(n_upper / nullif(word_chars, 0), 0) AS upper_rate,
         abs(coalesce(word_chars / nullif(n_words, 0), 0) - {rules.USUAL_WORD_LENGTH}) AS word_length_gap
  FROM m),
rates AS ({RATES}),
good AS (
  SELECT doc_id FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1)
  ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT {rules.SAMPLE}),
holdout AS (
  SELECT rates.* FROM rates JOIN good USING (doc_id) JOIN rated USING (doc_id) WHERE NOT base_failed),
counts AS (
  SELECT stratum, rule, cutoff, count(*) AS n, count(*) FILTER (WHERE rate > cutoff) AS k
  FROM holdout JOIN (VALUES {GRID}) AS g(rule, cutoff) USING (rule) GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k >= n * {rules.RISK} THEN 1.0
                 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp({LOG_TERM}))) END
            <= {rules.LEVEL} / ((SELECT count(DISTINCT stratum) FROM counts) * {TESTS}) AS safe FROM counts),
cuts AS (SELECT stratum, rule, min(cutoff) AS cut FROM tested WHERE safe GROUP BY ALL),
bad AS (SELECT DISTINCT doc_id FROM rates JOIN cuts USING (stratum, rule) WHERE rate > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM rated
"""

# Five hexadecimal digits are twenty bits, which are four signs of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FIVE_DIGITS = "CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT)"
SIGNS = " || ".join(f"substr('{BASE32}', CAST(({FIVE_DIGITS} >> {shift}) & 31 AS BIGINT) + 1, 1)" for shift in (15, 10, 5, 0))

ARCHIVES = f"""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: {SIGNS}), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

# CRC-32 of a decimal number, bit by bit.
CODES = "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
BITS = "list_reduce([xor(crc, code), 1, 2, 3, 4, 5, 6, 7, 8], lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))"
CRC32 = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {CODES}), lambda crc, code: {BITS}), 4294967295)"

TRIE = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations),
c AS (SELECT conv_id, {CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
whole AS (
  SELECT c.conv_id, 0 AS own, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1 AS own, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
turns AS (
  SELECT conv_id, role, text, CAST(row_number() OVER w AS BIGINT) AS depth,
         md5(CAST(list({{'r': role, 't': text}}) OVER (w ROWS UNBOUNDED PRECEDING) AS VARCHAR)) AS node
  FROM whole WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)),
path AS (
  SELECT *, lag(node, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
         depth = max(depth) OVER (PARTITION BY conv_id) AS last,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM turns
  UNION ALL
  SELECT conv_id, '', '', 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM turns), 0 FROM c),
nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, CAST(count(*) AS BIGINT) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM path GROUP BY node, depth),
children AS (SELECT parent AS node, CAST(count(*) AS BIGINT) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (
  SELECT DISTINCT up.node, down.node AS inner_node
  FROM path AS up JOIN path AS down ON up.conv_id = down.conv_id AND up.depth <= down.depth),
sums AS (
  SELECT below.node, CAST(count(*) FILTER (children.node IS NULL) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM below JOIN nodes ON nodes.node = inner_node LEFT JOIN children ON children.node = inner_node GROUP BY below.node)
SELECT nodes.conv_id, nodes.depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums ON sums.node = nodes.node LEFT JOIN children ON children.node = nodes.node
LEFT JOIN nodes AS up ON up.node = nodes.parent
"""

ORACLES: dict[str, str] = {"op6_risk_rules": QUALITY, "op12_warc_zstd": ARCHIVES, "op13_prefix_trie": TRIE}
