"""Queries of the general problems: proximity and snapshot differences, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.operators.proximity import containing_regions, near_pairs, region_cover
from atlasmill.operators.snapshot_diff import snapshot_changes
from atlasmill.session import materialize
from atlasmill.tables import current_rows, table

NEAR_M = 75.0


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pharmacies within 75 m of each other, and the districts around each. The current positions are written once and read thrice."""
    now = current_rows(table(spark, sf_dir, "riyadh_pharmacies"), table(spark, sf_dir, "snapshots"), ["lat", "lon"])
    now = materialize(now.select("id", "lat", "lon"), "p3")
    near = near_pairs(now, "id", "lat", "lon", NEAR_M).select(F.lit("near").alias("relation"), "key_a", "key_b")
    cover = region_cover(table(spark, sf_dir, "districts"), "district_id", "boundary")
    inside = containing_regions(now, "id", "lat", "lon", cover)
    return near.unionByName(inside.select(F.lit("in").alias("relation"), F.col("key").alias("key_a"), F.col("region").alias("key_b")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_changes(table(spark, sf_dir, "riyadh_pharmacies"), table(spark, sf_dir, "snapshots"), "address")


def queries() -> dict:
    return {"p3_found": p3_found, "p4_found": p4_found}


CURRENT_SQL = """
cur AS (
  SELECT * FROM (
    SELECT p.*, row_number() OVER (PARTITION BY p.id ORDER BY p.harvested_at DESC NULLS LAST, p.row_id DESC) AS rn
    FROM riyadh_pharmacies p
    JOIN (SELECT source, max(snapshot_no) AS snapshot_no FROM snapshots WHERE delivered GROUP BY source) s
      ON p.source = s.source AND p.snapshot_no = s.snapshot_no
    WHERE p.id IS NOT NULL) WHERE rn = 1)"""

_P3_SQL = f"""
WITH {CURRENT_SQL},
pts AS (SELECT id, lat, lon, CAST(floor(lat / 0.001) AS BIGINT) AS cy, CAST(floor(lon / 0.001) AS BIGINT) AS cx FROM cur
        WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0)),
probe AS (SELECT p.*, p.cy + dy.d AS ny, p.cx + dx.d AS nx FROM pts p,
          (SELECT unnest([-1, 0, 1]) AS d) dy, (SELECT unnest([-1, 0, 1]) AS d) dx),
near AS (
  SELECT a.id AS key_a, b.id AS key_b FROM probe a JOIN pts b ON a.ny = b.cy AND a.nx = b.cx AND a.id < b.id
  WHERE 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
        + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2)))) <= 75),
geo AS (SELECT district_id, CASE WHEN json_extract_string(boundary, '$.type') = 'Polygon'
               THEN [CAST(json_extract(boundary, '$.coordinates') AS DOUBLE[][][])]
               ELSE CAST(json_extract(boundary, '$.coordinates') AS DOUBLE[][][][]) END AS parts FROM districts),
part AS (SELECT district_id, unnest(parts) AS rings, generate_subscripts(parts, 1) AS part_no FROM geo),
ring AS (SELECT district_id, part_no, unnest(rings) AS pts FROM part),
edge AS (SELECT district_id, part_no, pts[i][1] AS x1, pts[i][2] AS y1, pts[i + 1][1] AS x2, pts[i + 1][2] AS y2
         FROM (SELECT *, unnest(range(1, len(pts))) AS i FROM ring)),
box AS (SELECT district_id, part_no, min(x1) AS x0, max(x1) AS x9, min(y1) AS y0, max(y1) AS y9 FROM edge GROUP BY ALL),
inside AS (
  SELECT DISTINCT p.id, e.district_id
  FROM pts p JOIN box b ON p.lon BETWEEN b.x0 AND b.x9 AND p.lat BETWEEN b.y0 AND b.y9
  JOIN edge e ON e.district_id = b.district_id AND e.part_no = b.part_no
   AND (e.y1 > p.lat) <> (e.y2 > p.lat) AND p.lon < e.x1 + (p.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
  GROUP BY p.id, e.district_id, e.part_no HAVING count(*) % 2 = 1)
SELECT 'near' AS relation, key_a, key_b FROM near
UNION ALL SELECT 'in' AS relation, id AS key_a, district_id AS key_b FROM inside
"""

_P4_SQL = """
WITH steps AS (
  SELECT source, snapshot_no, row_number() OVER (PARTITION BY source ORDER BY snapshot_no) AS pos,
         lead(snapshot_no) OVER (PARTITION BY source ORDER BY snapshot_no) AS next_no
  FROM (SELECT DISTINCT source, snapshot_no FROM snapshots WHERE delivered)),
kept AS (
  SELECT id, source, snapshot_no, pos, next_no,
         lower(translate(regexp_replace(nfc_normalize(coalesce(address, '')), '[\\s\\p{Z}\\p{C}]', '', 'g'),
                         '０１２３４５６７８９', '0123456789')) AS v
  FROM (SELECT p.*, s.pos, s.next_no, row_number() OVER (PARTITION BY p.id, p.source, p.snapshot_no
                     ORDER BY p.harvested_at DESC NULLS LAST, p.row_id DESC) AS rn
        FROM riyadh_pharmacies p JOIN steps s ON p.source = s.source AND p.snapshot_no = s.snapshot_no WHERE p.id IS NOT NULL)
  WHERE rn = 1)
SELECT b.snapshot_no, b.id, 'added' AS change_kind FROM kept b
WHERE b.pos > 1 AND NOT EXISTS (SELECT 1 FROM kept a WHERE a.id = b.id AND a.source = b.source AND a.pos = b.pos - 1)
UNION ALL
SELECT a.next_no AS snapshot_no, a.id, 'removed' AS change_kind FROM kept a
WHERE a.next_no IS NOT NULL AND NOT EXISTS (SELECT 1 FROM kept b WHERE b.id = a.id AND b.source = a.source AND b.pos = a.pos + 1)
UNION ALL
SELECT b.snapshot_no, b.id, 'changed' AS change_kind FROM kept a JOIN kept b
  ON a.id = b.id AND a.source = b.source AND b.pos = a.pos + 1 WHERE a.v <> b.v
"""


def sql() -> dict[str, str]:
    return {"p3_found": _P3_SQL, "p4_found": _P4_SQL}
