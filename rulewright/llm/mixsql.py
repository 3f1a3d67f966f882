"""The mix of sources in the SQL of DuckDB, for comparison."""

from __future__ import annotations

from .mixing import MOST, WEIGHTS


def oracle() -> str:
    weight = f"CAST([{', '.join(map(str, WEIGHTS))}][CAST(r % {len(WEIGHTS)} AS INTEGER) + 1] AS BIGINT)"
    return rf"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) size,
      substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))), 1, 15) k FROM documents),
    g AS (SELECT source, CAST(sum(size) AS BIGINT) size FROM d GROUP BY source),
    n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 r FROM g),
    w AS (SELECT *, {weight} weight FROM n),
    c AS (SELECT *, coalesce(sum({MOST} * size) OVER p, 0) caps, coalesce(sum(weight) OVER p, 0) weights FROM w
      WINDOW p AS (ORDER BY CAST({MOST} * size AS DOUBLE) / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT max(CAST((SELECT sum(size) FROM g) - caps AS DOUBLE) / CAST((SELECT sum(weight) FROM w) - weights AS DOUBLE)) level FROM c),
    t AS (SELECT source, size source_size, least(CAST({MOST} * size AS DOUBLE), level * CAST(weight AS DOUBLE)) target FROM w, l),
    b AS (SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), {MOST} * source_size) budget FROM t),
    a AS (SELECT d.doc_id, d.source, d.size, source_size, target, budget, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END laps,
      coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) so_far FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
    SELECT doc_id, source, size, source_size, target, budget, CAST(laps * size + greatest(0, least(budget - laps * source_size - so_far, size)) AS BIGINT) taken FROM a"""
