"""DuckDB SQL for the registered queries that SQL can express."""

_WORDS = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS size FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
  FROM d GROUP BY source),
c AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM s),
-- Sources by how soon they reach their limit; level: words per weight if all before are at their limit.
o AS (
  SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0.0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0.0)) AS level, cap / w AS ratio, row_number() OVER (ORDER BY cap / w, source) AS k
  FROM c WINDOW before AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT level FROM o WHERE w * level <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(w * (SELECT level FROM l), cap) AS target FROM c),
r AS (
  SELECT d.doc_id, d.source, d.size, t.source_size::BIGINT AS source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size * 16777216.0::DOUBLE)::BIGINT ELSE 0 END AS rate,
         ('0x' || substr(md5('0:' || coalesce('s' || d.source, 'n')), 1, 6))::BIGINT AS u,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
m AS (SELECT *, ((u + rate * k) >> 24) - ((u + rate * (k - 1)) >> 24) AS copies FROM r)
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken, source, copies::BIGINT AS copies FROM m
"""

_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM benchmark),
i AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
g AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
n AS (SELECT DISTINCT n FROM i),
x AS (
  SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, n WHERE len(w) >= n)),
h AS (SELECT x.r, x.p, x.n, g.item_id FROM x JOIN g USING (n, gram)),
c AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r),
l AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN l USING (r)
"""

ORACLE = {"op1_mixing": OP1, "op5_decontamination": OP5}

OP10 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
x AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
n AS (SELECT unnest([3, 5, 6, 7, 8, 9, 10]) AS n),
g AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, n WHERE len(w) >= n)),
h AS (SELECT r, n, p, count(*) OVER (PARTITION BY r, n, gram) AS times, row_number() OVER (PARTITION BY r, n, gram ORDER BY p) AS k FROM g),
-- Words inside three-word windows found twice, and inside longer windows found before.
c AS (SELECT DISTINCT r, n, unnest(range(p, p + n)) AS p FROM h WHERE CASE WHEN n = 3 THEN times > 1 ELSE k > 1 END),
s AS (SELECT r, n, count(*) AS words, sum(len(word)) AS chars FROM c JOIN x USING (r, p) GROUP BY r, n),
l AS (SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY p) AS k
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS line, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS p FROM d)),
e AS (SELECT r, count(*) AS n_dup_lines, sum(len(array_to_string(regexp_extract_all(line, '{_WORDS}'), ''))) AS chars
      FROM l WHERE k > 1 AND regexp_matches(line, '{_WORDS}') GROUP BY r),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(e.n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce((SELECT words FROM s WHERE s.r = d.r AND n = 3), 0)::BIGINT AS n_repeat_words, coalesce(e.chars, 0)::BIGINT AS dup_line_chars,
         {", ".join(f"coalesce((SELECT chars FROM s WHERE s.r = d.r AND n = {n}), 0)::BIGINT AS dup_{n}gram_chars" for n in range(5, 11))}
  FROM d LEFT JOIN e USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= 20 * word_chars AND {
    " AND ".join(f"100 * dup_{n}gram_chars <= {limit} * word_chars" for n, limit in ((5, 15), (6, 14), (7, 13), (8, 12), (9, 11), (10, 10)))} AS kept
FROM b
"""

ORACLE["op10_quality"] = OP10

# The hash draws and the cut by regular expression; a marked text stays plain.
_UNIT = "[A-Za-z]+|[^A-Za-z]"

OP12 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
n AS (SELECT *, len(u) AS n, {", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))} FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN len(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN len(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

OP13 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM k WHERE rank <= 5
"""

# crc32 of the decimal id, bit by bit over its bytes.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, zero: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT)"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# g: group (null first); the subroots make one more tree, whose group is t.
OP11 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('s' || lang, 'n') AS g, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents),
e AS MATERIALIZED (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
low AS (
  SELECT g, 0 AS level, pos, n, leaf AS node FROM e
  UNION ALL
  SELECT g, any_value(level) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY g, pos // 8),
tops AS (SELECT g, node, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 't' AS g, 0 AS level, pos, n, node FROM tops
  UNION ALL
  SELECT 't', any_value(level) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY pos // 8),
-- A leaf's way up its group, then up the tree of subroots.
up AS (
  SELECT r, g, 0 AS level, pos, n, coalesce(tampered, leaf) AS node, '' AS proof FROM e
  UNION ALL
  SELECT r, any_value(up.g), any_value(up.level) + 1, any_value(up.pos) // 8, (any_value(up.n) + 7) // 8,
         sha256(string_agg(CASE WHEN l.pos = up.pos THEN up.node ELSE l.node END, '' ORDER BY l.pos)),
         any_value(up.proof) || coalesce(string_agg(l.node, '' ORDER BY l.pos) FILTER (l.pos <> up.pos), '')
  FROM up JOIN low l ON l.g = up.g AND l.level = up.level AND l.pos // 8 = up.pos // 8 WHERE up.n > 1 GROUP BY r),
over_groups AS (
  SELECT r, 0 AS level, t.pos, t.n, up.node, proof FROM up JOIN tops t ON t.g = up.g WHERE up.n = 1
  UNION ALL
  SELECT r, any_value(o.level) + 1, any_value(o.pos) // 8, (any_value(o.n) + 7) // 8,
         sha256(string_agg(CASE WHEN h.pos = o.pos THEN o.node ELSE h.node END, '' ORDER BY h.pos)),
         any_value(o.proof) || coalesce(string_agg(h.node, '' ORDER BY h.pos) FILTER (h.pos <> o.pos), '')
  FROM over_groups o JOIN high h ON h.level = o.level AND h.pos // 8 = o.pos // 8 WHERE o.n > 1 GROUP BY r)
SELECT doc_id, leaf, t.node AS subroot, (SELECT node FROM high WHERE n = 1) AS root, sha256(o.proof) AS proof_sha256,
       o.node AS folded_root, o.node = (SELECT node FROM high WHERE n = 1) AS verified
FROM e JOIN tops t ON t.g = e.g JOIN over_groups o ON o.r = e.r AND o.n = 1
"""

ORACLE |= {"op11_merkle_manifest": OP11, "op12_fill_in_middle": OP12, "op13_exact_top_k": OP13}
