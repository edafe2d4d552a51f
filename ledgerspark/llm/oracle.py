"""DuckDB SQL twins of the queries that SQL can express."""

#: trees level by level; crc32 by its table, as the engine has none
MERKLE = """
WITH RECURSIVE
crc(i, v, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc WHERE k < 8
),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
rows AS (
    SELECT *, xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])
        ), 4294967295) % 7 = 0 AS tampered,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS tail
    FROM documents, crc_table
),
leaves AS (
    SELECT doc_id, lang, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx,
        count(*) OVER (PARTITION BY lang) AS m,
        sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
        sha256(head || coalesce(strlen((n_chars + tampered::INT)::VARCHAR) || ':' || (n_chars + tampered::INT), '-')
            || tail) AS given
    FROM rows
),
tree(g, level, idx, m, h) AS (
    SELECT g, 0, idx, m, leaf FROM leaves
    UNION ALL
    SELECT g, level + 1, idx // 2, (m + 1) // 2, sha256(h || coalesce(other, ''))
    FROM (SELECT *, lead(h) OVER (PARTITION BY g, level ORDER BY idx) AS other FROM tree WHERE m > 1)
    WHERE idx % 2 = 0
),
subroots AS (SELECT g, level AS depth, h AS subroot FROM tree WHERE m = 1),
top(level, idx, m, h) AS (
    SELECT 0, g - 1, (SELECT count(*) FROM subroots), subroot FROM subroots
    UNION ALL
    SELECT level + 1, idx // 2, (m + 1) // 2, sha256(h || coalesce(other, ''))
    FROM (SELECT *, lead(h) OVER (PARTITION BY level ORDER BY idx) AS other FROM top WHERE m > 1)
    WHERE idx % 2 = 0
),
paths AS (
    SELECT l.g, l.idx, s.level, (l.idx >> s.level::BIGINT) & 1 AS is_right, coalesce(o.h, '') AS other
    FROM leaves l
    JOIN (SELECT DISTINCT g, level FROM tree WHERE m > 1) s ON s.g = l.g
    LEFT JOIN tree o ON o.g = l.g AND o.level = s.level AND o.idx = xor(l.idx >> s.level::BIGINT, 1)
    UNION ALL
    SELECT l.g, l.idx, d.depth + s.level, ((l.g - 1) >> s.level::BIGINT) & 1, coalesce(o.h, '')
    FROM leaves l
    JOIN subroots d ON d.g = l.g
    JOIN (SELECT DISTINCT level FROM top WHERE m > 1) s ON true
    LEFT JOIN top o ON o.level = s.level AND o.idx = xor((l.g - 1) >> s.level::BIGINT, 1)
),
proofs AS (SELECT g, idx, string_agg(other, '' ORDER BY level) AS siblings FROM paths GROUP BY g, idx),
folds(g, idx, level, h) AS (
    SELECT g, idx, 0, given FROM leaves
    UNION ALL
    SELECT f.g, f.idx, f.level + 1, sha256(CASE WHEN p.is_right = 1 THEN p.other || f.h ELSE f.h || p.other END)
    FROM folds f JOIN paths p ON p.g = f.g AND p.idx = f.idx AND p.level = f.level
),
folded AS (SELECT g, idx, arg_max(h, level) AS folded_root FROM folds GROUP BY g, idx)
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
    f.folded_root, f.folded_root = r.h AS verified
FROM leaves l
JOIN subroots s ON s.g = l.g
JOIN (SELECT h FROM top WHERE m = 1) r ON true
LEFT JOIN proofs p ON p.g = l.g AND p.idx = l.idx
JOIN folded f ON f.g = l.g AND f.idx = l.idx
"""

ORACLE: dict[str, str] = {"op11_merkle_manifest": MERKLE}
