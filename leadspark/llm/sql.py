"""SQL for the pN_ queries that SQL can express; run by DuckDB on the same tables."""

from __future__ import annotations

_PHONE = "regexp_replace(phone_e164, '\\s+', '', 'g')"

ORACLE: dict[str, str] = {
    "p5_found": rf"""
WITH RECURSIVE keyed AS (
  SELECT source_row_id AS id, 'p' || {_PHONE} AS k FROM cleaned_enriched
  WHERE regexp_matches({_PHONE}, '^\+[0-9]{{8,15}}$')
    AND NOT regexp_matches({_PHONE}, '^\+[0-9]{{0,3}}(0{{8,}}|1{{8,}}|2{{8,}}|3{{8,}}|4{{8,}}|5{{8,}}|6{{8,}}|7{{8,}}|8{{8,}}|9{{8,}})$')
  UNION ALL
  SELECT source_row_id, 'd' || lower(trim(website_domain)) FROM cleaned_enriched
  WHERE regexp_matches(lower(trim(website_domain)), '^[^\s.@/]+(\.[^\s.@/]+)+$')
    AND lower(trim(website_domain)) NOT IN (SELECT lower(trim(domain)) FROM shared_domains)
),
edges AS (
  SELECT min(id) OVER (PARTITION BY k) AS a, id AS b FROM keyed
  UNION ALL
  SELECT source_row_id_a, source_row_id_b FROM match_pairs WHERE verdict = 'match' AND source_row_id_a <> source_row_id_b
),
both_ways AS (SELECT DISTINCT a, b FROM edges WHERE a <> b UNION SELECT DISTINCT b, a FROM edges WHERE a <> b),
reach AS (
  SELECT a AS id, b AS other FROM both_ways
  UNION
  SELECT r.id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
)
SELECT id AS source_row_id, least(id, min(other)) AS group_id FROM reach GROUP BY id
""",
}
