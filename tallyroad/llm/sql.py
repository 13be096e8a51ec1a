"""SQL of operators that SQL can express, for DuckDB."""

# Bytes are folded into the id's checksum one by one; levels, and the way up
# from a leaf, are recursive.
OP11_MERKLE = """
WITH RECURSIVE bytes AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_prepend(CAST(i AS UBIGINT), CAST(range(8) AS UBIGINT[])),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), docs AS (
    SELECT doc_id, source, text,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS start,
           list_reduce(
               list_prepend(CAST(4294967295 AS UBIGINT), list_transform(
                   string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
               lambda a, b: xor(a >> 8, crc[CAST(xor(a, b) & 255 AS BIGINT) + 1])) AS turned
    FROM documents, bytes
), texts AS (
    SELECT *, replace(text, chr(10), '') AS cut, coalesce(turned % 2 = 1, false) AS tampered FROM docs
), leaves AS (
    SELECT *, sha256(start || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(start || CASE WHEN tampered THEN coalesce(strlen(cut) || ':' || cut, '-')
                                ELSE coalesce(strlen(text) || ':' || text, '-') END) AS shown
    FROM texts
), placed AS (
    SELECT doc_id, source, leaf, shown, row_number() OVER () AS row,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS n
    FROM leaves
), nodes AS (
    SELECT source, 0 AS level, pos, n, leaf AS node FROM placed
    UNION ALL
    SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3, n
), subroots AS (
    SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), top AS (
    SELECT 0 AS level, pos, n, node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM top WHERE n > 1 GROUP BY level, pos // 3, n
), runs AS (
    SELECT source, level, pos // 3 AS run, list(node ORDER BY pos) AS parts
    FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3
), top_runs AS (
    SELECT level, pos // 3 AS run, list(node ORDER BY pos) AS parts
    FROM top WHERE n > 1 GROUP BY level, pos // 3
), climbed AS (
    SELECT row, source, 0 AS level, pos, shown AS node, '' AS proof FROM placed
    UNION ALL
    SELECT c.row, c.source, c.level + 1, c.pos // 3,
           sha256(array_to_string(parts[1 : c.pos % 3], '') || c.node || array_to_string(parts[c.pos % 3 + 2 :], '')),
           proof || array_to_string(parts[1 : c.pos % 3], '') || array_to_string(parts[c.pos % 3 + 2 :], '')
    FROM climbed c JOIN runs r
      ON r.source IS NOT DISTINCT FROM c.source AND r.level = c.level AND r.run = c.pos // 3
), at_subroot AS (
    SELECT row, source, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM climbed GROUP BY row, source
), climbed_on AS (
    SELECT a.row, 0 AS level, s.pos, a.node, a.proof
    FROM at_subroot a JOIN subroots s ON s.source IS NOT DISTINCT FROM a.source
    UNION ALL
    SELECT c.row, c.level + 1, c.pos // 3,
           sha256(array_to_string(parts[1 : c.pos % 3], '') || c.node || array_to_string(parts[c.pos % 3 + 2 :], '')),
           proof || array_to_string(parts[1 : c.pos % 3], '') || array_to_string(parts[c.pos % 3 + 2 :], '')
    FROM climbed_on c JOIN top_runs r ON r.level = c.level AND r.run = c.pos // 3
), at_root AS (
    SELECT row, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM climbed_on GROUP BY row
)
SELECT p.doc_id, p.leaf, s.node AS subroot, t.node AS root, sha256(a.proof) AS proof_sha256,
       a.node AS folded_root, a.node = t.node AS verified
FROM placed p
JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
JOIN at_root a ON a.row = p.row
JOIN top t ON t.n = 1
"""

# A node is the digest of its turns; pairs of a node and one below it come from
# the conversations that pass through both.
OP13_TRIE = """
WITH bytes AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_prepend(CAST(i AS UBIGINT), CAST(range(8) AS UBIGINT[])),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT conv_id, md5(strlen(role) || ':' || role || text) AS token, length(text) AS chars,
           row_number() OVER (PARTITION BY conv_id
                              ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) - 1 AS place
    FROM turns
), heads AS (
    SELECT conv_id, conv_id - conv_id % 100 AS anchor,
           xor(list_reduce(
               list_prepend(CAST(4294967295 AS UBIGINT), list_transform(
                   string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
               lambda a, b: xor(a >> 8, crc[CAST(xor(a, b) & 255 AS BIGINT) + 1])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), bytes
), sequences AS (
    SELECT h.conv_id, 0 AS part, p.place, p.token, p.chars
    FROM heads h JOIN placed p ON p.conv_id = h.anchor AND p.place < h.h
    UNION ALL
    SELECT h.conv_id, 1, p.place, p.token, p.chars
    FROM heads h JOIN placed p ON p.conv_id = h.conv_id AND p.place >= h.h
), paths AS (
    SELECT conv_id, chars,
           row_number() OVER w AS depth,
           md5(string_agg(token, '') OVER w) AS node
    FROM sequences WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM heads
), steps AS (
    SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
           depth = max(depth) OVER (PARTITION BY conv_id) AS ends
    FROM paths
), nodes AS (
    SELECT node, any_value(depth) AS depth, any_value(chars) AS chars, any_value(parent) AS parent,
           min(conv_id) AS conv_id, count(*) AS n,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends
    FROM steps GROUP BY node
), families AS (
    SELECT parent AS node, count(*) AS children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
    SELECT DISTINCT a.node, b.node AS lower
    FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), subtrees AS (
    SELECT b.node, CAST(count(*) FILTER (f.children IS NULL) AS BIGINT) AS leaves,
           CAST(sum((l.n - 1) * l.chars) AS BIGINT) AS saved
    FROM below b JOIN nodes l ON l.node = b.lower LEFT JOIN families f ON f.node = b.lower
    GROUP BY b.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(f.children, 0) AS n_children,
       s.leaves AS n_leaves, s.saved AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN subtrees s ON s.node = n.node
LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN families f ON f.node = n.node
"""
