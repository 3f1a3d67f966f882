"""The Merkle manifest in the SQL of DuckDB, for comparison."""

from __future__ import annotations

from .merkle import ARITY, FIELDS


def _leaf(fields) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


#: crc32 of the decimal id: eight shifts of each byte make the table, then a byte at a time.
_TABLE = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, x: xor(c >> 1, (c & 1) * 3988292384)))"
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def oracle() -> str:
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE crc AS (SELECT {_TABLE} AS t),
    d AS (SELECT row_number() OVER () row, doc_id, lang, {_leaf(FIELDS)} leaf, CASE WHEN {_CRC} % 3 = 0 THEN {_leaf([*FIELDS[:4], lowered])} END tampered FROM documents, crc),
    p AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 place, count(*) OVER (PARTITION BY lang) n FROM d),
    low AS (SELECT 0 level, tree, place i, n, leaf digest FROM p
      UNION ALL SELECT level + 1, tree, i // {ARITY}, (max(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY level, tree, i // {ARITY}),
    subroots AS (SELECT tree, max(level) depth, arg_max(digest, level) subroot FROM low GROUP BY tree),
    high AS (SELECT 0 level, tree i, count(*) OVER () n, subroot digest FROM subroots
      UNION ALL SELECT level + 1, i // {ARITY}, (max(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // {ARITY}),
    roots AS (SELECT max(level) height, arg_max(digest, level) root FROM high),
    steps AS (SELECT p.row, l.level AS step, coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < l.i), '') a, coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > l.i), '') b
      FROM p JOIN low l ON l.tree = p.tree AND l.n > 1 AND l.i = p.place // CAST(pow({ARITY}, l.level) AS BIGINT) JOIN low s ON s.tree = l.tree AND s.level = l.level AND s.i // {ARITY} = l.i // {ARITY} GROUP BY p.row, l.level
      UNION ALL SELECT p.row, depth + h.level, coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < h.i), ''), coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > h.i), '')
      FROM p JOIN subroots USING (tree) JOIN high h ON h.n > 1 AND h.i = p.tree // CAST(pow({ARITY}, h.level) AS BIGINT) JOIN high s ON s.level = h.level AND s.i // {ARITY} = h.i // {ARITY} GROUP BY p.row, depth, h.level),
    proofs AS (SELECT row, string_agg(a || b, '' ORDER BY step) siblings FROM steps GROUP BY row),
    folded AS (SELECT row, 0 step, coalesce(tampered, leaf) digest FROM p UNION ALL SELECT f.row, f.step + 1, sha256(a || digest || b) FROM folded f JOIN steps s ON s.row = f.row AND s.step = f.step),
    ends AS (SELECT row, arg_max(digest, step) folded_root FROM folded GROUP BY row)
    SELECT p.doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) proof_sha256, folded_root, folded_root = root verified
    FROM p JOIN subroots USING (tree) JOIN ends USING (row) LEFT JOIN proofs USING (row), roots"""
