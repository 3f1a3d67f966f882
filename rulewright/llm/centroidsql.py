"""Centroid clustering in the SQL of DuckDB, for comparison: Lloyd's rounds written out one after the other."""

from __future__ import annotations

from .centroids import CENTROIDS, DIMENSIONS, ROUNDS, SCALE, SEED


def oracle() -> str:
    d = DIMENSIONS
    apart = f"list_sum([(q.v[i] - c.v[i]) * (q.v[i] - c.v[i]) for i in range(1, {d} + 1)])"
    parts = [
        f"""WITH q AS MATERIALIZED (SELECT row_number() OVER () row, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] v FROM embeddings
          WHERE len(embedding) = {d} AND list_bool_and([x IS NOT NULL AND coalesce(isfinite(x), false) for x in embedding]))""",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) k, v FROM (SELECT sha256('{SEED}:' || vec_id) h, v FROM q ORDER BY h NULLS LAST, v LIMIT {CENTROIDS}))",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT row, vec_id, v, k, d FROM (SELECT q.row, q.vec_id, q.v, c.k, CAST({apart} AS BIGINT) d FROM q, c{r} c) QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1)")
        if r < ROUNDS:
            parts.append(f"s{r} AS (SELECT k, i, CAST(sum(v[i]) AS BIGINT) s, count(*) n FROM a{r}, range(1, {d} + 1) t(i) GROUP BY k, i)")
            parts.append(f"m{r} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) v FROM s{r} GROUP BY k)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) v FROM c{r} c LEFT JOIN m{r} m USING (k))")
    last = ROUNDS
    return ", ".join(parts) + f""" SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
      sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{last} a JOIN c{last} c USING (k)"""
