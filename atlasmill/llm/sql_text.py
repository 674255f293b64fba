"""SQL of those queries that SQL can express on whole tables."""

_CUR = """
cur AS (
  SELECT * FROM (
    SELECT p.*, row_number() OVER (PARTITION BY p.id ORDER BY p.harvested_at DESC NULLS LAST, p.row_id DESC) AS rn
    FROM riyadh_pharmacies p
    JOIN (SELECT source, max(snapshot_no) AS snapshot_no FROM snapshots WHERE delivered GROUP BY source) s
      ON p.source = s.source AND p.snapshot_no = s.snapshot_no
    WHERE p.id IS NOT NULL) WHERE rn = 1)"""

_BARE = "lower(regexp_replace(nfc_normalize(coalesce({0}, '')), '[\\s\\p{{Z}}\\p{{C}}]', '', 'g'))"
_NONE = """('', '-', '.', '?', 'n/a', 'null', 'unknown', 'tbd', 'pharmacy', 'askinstore', 'seewebsite', '--:-----:--',
 'غيرمعروف', 'غيرمحدد', 'لايوجد', 'بدوناسم', 'اسمتجريبي', 'صيدلية')"""

_P5 = f"""
WITH {_CUR},
vals AS (
  SELECT 'name_ar' AS field_name, source, id, harvested_at, name_ar AS v FROM cur
  UNION ALL SELECT 'name_ar', source, id, harvested_at, name_ar FROM riyadh_pharmacies_alt
  UNION ALL SELECT 'hours', source, id, harvested_at, hours FROM riyadh_pharmacies_alt),
good AS (
  SELECT DISTINCT g.entity_id, field_name, g.source_key, v.source, max(harvested_at) OVER (PARTITION BY g.entity_id, field_name, g.source_key) AS at
  FROM vals v JOIN merge_groups g ON g.source_key = v.source || ':' || v.id
  WHERE {_BARE.format('v.v')} NOT IN {_NONE}
    AND CASE WHEN field_name = 'hours' THEN regexp_matches(v.v, '[0-9٠-٩]')
             ELSE regexp_matches(nfc_normalize(v.v), '[\\x{{0621}}-\\x{{064A}}\\x{{06A9}}\\x{{06CC}}\\x{{FE80}}-\\x{{FEFC}}]') END),
w AS (SELECT good.*, coalesce(s.reliability_weight, 0.5) AS weight FROM good LEFT JOIN sources s ON s.name = good.source)
SELECT entity_id, field_name, source_key FROM w a
WHERE NOT EXISTS (SELECT 1 FROM w b WHERE b.entity_id = a.entity_id AND b.field_name = a.field_name AND b.source_key <> a.source_key
                  AND NOT (a.weight > b.weight AND a.at > b.at))
"""

SQL: dict[str, str] = {"p5_found": _P5}
