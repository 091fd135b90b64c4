"""DuckDB oracle fragments: the stand-in mappings of ``sources.standins`` written
independently in SQL over the raw tables, used by the oracle statements."""

from __future__ import annotations

AS_OF_DAY = "2024-01-15"

# events played as the traffic archive (plus the raw ts)
TRAFFIC = """
traffic AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS date_time,
         CAST(user_id AS VARCHAR) AS denomination,
         value AS avg_speed,
         CAST(NULL AS INTEGER) AS travel_time,
         CASE WHEN k IS NULL OR value IS NULL THEN NULL
              WHEN value < k THEN 'congested' ELSE 'freeFlow' END AS traffic_status,
         event_type AS hierarchie,
         CAST(NULL AS VARCHAR) AS hierarchie_dv,
         k AS max_speed,
         event_id AS seq,
         strftime(ts, '%Y-%m-%d') AS date_partition,
         ts
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

# embedding pairs as line points; label % 3: 0 -> null line, 1 -> empty line
SHAPES = """
shapes AS (
  SELECT vec_id, ((label % 3) + 3) % 3 AS kind, CAST(len(embedding) // 2 AS BIGINT) AS n, embedding
  FROM embeddings
),
shape_points AS (
  SELECT vec_id, CAST(i AS INTEGER) AS point_order,
         CAST(embedding[2 * i + 2] AS DOUBLE) AS latitude,
         CAST(embedding[2 * i + 1] AS DOUBLE) AS longitude
  FROM (SELECT vec_id, embedding, unnest(range(n)) AS i FROM shapes WHERE kind = 2)
)"""

# posexplode_outer of every archive row's line
POINTS = """
points AS (
  SELECT t.date_time, t.denomination, t.traffic_status, p.point_order, p.latitude, p.longitude,
         t.hierarchie, t.seq, t.ts
  FROM traffic t LEFT JOIN shape_points p ON p.vec_id = t.seq
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
