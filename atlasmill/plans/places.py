"""Queries of the place pipeline's own operators over the test tables, with their SQL. Every query reads its tables whole."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.functions.enrich import enrich_col
from atlasmill.functions.names import arabic_key_col, clean_name_col, has_script_col, name_key_col, phone_digits
from atlasmill.operators import areas, history, lookups, reports, robots, snapshots
from atlasmill.operators.canonical import admitted_sources, canonicalize, route
from atlasmill.operators.components import connected_components
from atlasmill.operators.conflate import conflate
from atlasmill.operators.merge import content_id, merge_clusters
from atlasmill.operators.proximity import near_pairs
from atlasmill.plans.general import CURRENT_SQL
from atlasmill.session import materialize, release, shared_dir
from atlasmill.sinks import layer
from atlasmill.sources.records import parse_payload
from atlasmill.sources.registry import checked
from atlasmill.sources.taxonomy import taxonomy, taxonomy_rows
from atlasmill.streaming.snapshot_state import judged_stream
from atlasmill.tables import current_rows, delivered, small, table

BOX = (46.60, 24.60, 46.70, 24.65)
#: An area of two parts, the first with a hole (lon/lat).
AREA = {
    "type": "MultiPolygon",
    "coordinates": [
        [[[46.60, 24.60], [46.64, 24.60], [46.645, 24.62], [46.60, 24.625], [46.60, 24.60]], [[46.61, 24.605], [46.62, 24.605], [46.62, 24.615], [46.61, 24.615], [46.61, 24.605]]],
        [[[46.65, 24.61], [46.68, 24.605], [46.67, 24.635], [46.65, 24.61]]],
    ],
}
COLUMNS = ["source", "lat", "lon", "name_en", "name_ar", "category", "phone", "address", "harvested_at"]


def _now(spark: SparkSession, d: str, columns: list[str] = COLUMNS) -> DataFrame:
    return current_rows(table(spark, d, "riyadh_pharmacies"), table(spark, d, "snapshots"), columns)


def _routed(spark: SparkSession, d: str) -> DataFrame:
    rows = _now(spark, d).withColumn("harvested_at", F.date_format("harvested_at", "yyyy-MM-dd'T'HH:mm:ss"))
    return route(rows, taxonomy(spark), ["pharmacy"])


def _canonical(spark: SparkSession, d: str) -> DataFrame:
    return canonicalize(_routed(spark, d).filter("status = 'accepted'"), table(spark, d, "sources"))


def _merged(spark: SparkSession, d: str) -> DataFrame:
    """Canonical rows merged by an earlier run's groups; rows of no group stand alone."""
    groups = table(spark, d, "merge_groups").groupBy("source_key").agg(F.min("entity_id").alias("entity"))
    rows = _canonical(spark, d).join(groups.hint("merge"), "source_key", "left")
    return merge_clusters(rows.withColumn("cluster", F.coalesce("entity", "source_key")))


def registry_faults(spark: SparkSession, d: str) -> DataFrame:
    return checked(table(spark, d, "sources")).select("name", F.concat_ws("; ", "faults").alias("faults"))


def licence_gate(spark: SparkSession, d: str) -> DataFrame:
    uses = ("internal", "commercial", "redistribute")
    parts = [admitted_sources(table(spark, d, "sources"), u, BOX).select("name", F.lit(u).alias("declared_use"), "refused") for u in uses]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def licence_report(spark: SparkSession, d: str) -> DataFrame:
    r = reports.licence_report(table(spark, d, "sources"))
    return r.select("source", "endpoint_or_path", F.concat_ws(",", "allowed_use").alias("allowed_use"), "redistribution", "reliability_weight")


def routing(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d).groupBy("source", "status", "reason").agg(F.count("*").alias("n"))


def canonical(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d).select("source_key", "lat", "lon", "name_en", "phone", "confidence", "geometry_method", F.size("provenance").alias("n_provenance"))


def contributors(spark: SparkSession, d: str) -> DataFrame:
    return reports.contributors(_routed(spark, d).filter("status = 'accepted'"), table(spark, d, "sources")).select("source", "license", "records")


def run_counters(spark: SparkSession, d: str) -> DataFrame:
    return reports.run_counters(_routed(spark, d), _merged(spark, d))


def area_box(spark: SparkSession, d: str) -> DataFrame:
    w, s, e, n = BOX
    return _now(spark, d, ["lat", "lon"]).filter(areas.inside(areas.box_area(s, w, n, e), F.col("lat"), F.col("lon"))).select("id")


def area_polygon(spark: SparkSession, d: str) -> DataFrame:
    return _now(spark, d, ["lat", "lon"]).filter(areas.inside(areas.polygon_area(AREA), F.col("lat"), F.col("lon"))).select("id")


def candidate_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(_canonical(spark, d).select("source_key", "lat", "lon", phone_digits(F.col("phone")).alias("digits")), "candidates")
    p = near_pairs(rows, "source_key", "lat", "lon", 75.0)
    own = rows.select("source_key", "digits")
    p = p.join(own.select(F.col("source_key").alias("key_a"), F.col("digits").alias("da")).hint("merge"), "key_a")
    p = p.join(own.select(F.col("source_key").alias("key_b"), F.col("digits").alias("db")).hint("merge"), "key_b")
    return p.select("key_a", "key_b", F.round("distance_m", 3).alias("distance_m"), ((F.col("da") == F.col("db")) & (F.col("da") != "")).alias("same_phone"))


def near_components(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(_now(spark, d, ["lat", "lon"]).select("id", "lat", "lon"), "points")
    return connected_components(near_pairs(rows, "id", "lat", "lon", 40.0), "key_a", "key_b")


def conflation_decisions(spark: SparkSession, d: str) -> DataFrame:
    return conflate(_canonical(spark, d))[1]


def conflated_places(spark: SparkSession, d: str) -> DataFrame:
    m = merge_clusters(conflate(_canonical(spark, d))[0])
    return m.select("stable_id", F.concat_ws("|", "source_keys").alias("source_keys"), "name_en", "name_ar", "phone", "language_complete")


def merged_places(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).select(
        "stable_id", F.size("source_keys").alias("n_keys"), "lat", "lon", "name_en", F.col("provenance")["name_en"].alias("name_en_by"), "name_ar", F.col("provenance")["name_ar"].alias("name_ar_by"),
        "phone", F.col("provenance")["phone"].alias("phone_by"), "address", "harvested_at", "confidence", "language_complete", F.concat_ws(",", "licenses").alias("licenses"),
    )


def provenance_sidecar(spark: SparkSession, d: str) -> DataFrame:
    """Which record every field of every merged place came from, one row a field."""
    return _merged(spark, d).select("stable_id", F.explode("provenance").alias("field", "source_key"))


def _by_phone(spark: SparkSession, d: str) -> DataFrame:
    """Members of earlier groups (of both tables), grouped anew by phone; a member of several rows counts under its smallest number."""
    key = F.concat_ws(":", "source", "id").alias("source_key")
    parts = [t.filter("id is not null").select(key, phone_digits(F.col("phone")).alias("digits")) for t in (_now(spark, d, ["source", "phone"]), table(spark, d, "riyadh_pharmacies_alt"))]
    rows = parts[0].unionByName(parts[1]).filter("digits <> ''").groupBy("source_key").agg(F.min("digits").alias("digits"))
    return rows.join(table(spark, d, "merge_groups").select("source_key").distinct().hint("merge"), "source_key")


def _members(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Earlier groups and groups by phone, each as stable_id and source_keys."""
    old = table(spark, d, "merge_groups").groupBy(F.col("entity_id").alias("stable_id")).agg(F.collect_set("source_key").alias("source_keys"))
    new = _by_phone(spark, d).groupBy(F.col("digits").alias("stable_id")).agg(F.collect_set("source_key").alias("source_keys"))
    return old, new


def key_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return history.overlaps(*_members(spark, d))


def kept_ids(spark: SparkSession, d: str) -> DataFrame:
    old, new = _members(spark, d)
    return history.assign_ids(old, new.select(content_id(F.col("source_keys")).alias("stable_id"), "source_keys"))


def merge_quality(spark: SparkSession, d: str) -> DataFrame:
    gold = reports.pairs_within(table(spark, d, "merge_groups"), "entity_id", "source_key")
    return reports.group_quality(_by_phone(spark, d), "digits", "source_key", gold)


def unlabelled_keys(spark: SparkSession, d: str) -> DataFrame:
    """Current keys that no earlier group names."""
    return reports.unlabelled(_now(spark, d, ["source"]).select(F.concat_ws(":", "source", "id").alias("source_key")), table(spark, d, "merge_groups"))


def _deliveries(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    """The rows that count of every delivered snapshot, with pos, the place of the delivery among its source's (from 0), and the last pos."""
    sent = delivered(table(spark, d, "snapshots")).select("source", "snapshot_no", "pos")
    w = Window.partitionBy("pos", "id").orderBy(F.col("harvested_at").desc_nulls_last(), F.col("row_id").desc())
    rows = table(spark, d, "riyadh_pharmacies").filter("id is not null").join(small(sent), ["source", "snapshot_no"])
    rows = rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    rows = rows.select("pos", F.col("id").alias("stable_id"), "name_en", "name_ar", "category", "phone", "address", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.concat_ws(":", "source", "id").alias("geometry_provenance"), "harvested_at")
    return materialize(rows, "deliveries"), sent.agg(F.max("pos")).first()[0] or 0


def _at(rows: DataFrame, pos: int) -> DataFrame:
    return rows.filter(F.col("pos") == pos).drop("pos")


def field_changes(spark: SparkSession, d: str) -> DataFrame:
    """Field-level changes between all consecutive deliveries."""
    rows, last = _deliveries(spark, d)
    steps = [history.change_set(_at(rows, i), _at(rows, i + 1)).withColumn("delivery", F.lit(i + 1)) for i in range(last)]
    out = reduce(DataFrame.unionByName, steps) if steps else history.change_set(_at(rows, 0), _at(rows, 0)).withColumn("delivery", F.lit(0)).limit(0)
    return out.select("delivery", "stable_id", "change", F.concat_ws(",", "changed_fields").alias("changed_fields"))


def _layer(rows: DataFrame, last: int) -> DataFrame:
    """The layer after the deliveries 0 to `last`, one after another."""
    done = None
    for i in range(last + 1):
        before, done = done, materialize(layer.upsert_layer(done, _at(rows, i)), "layer")
        release(before)
    return done


def layer_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows, last = _deliveries(spark, d)
    return _layer(rows, last).select("id", "stable_id", "is_active", "phone")


def layer_check(spark: SparkSession, d: str) -> DataFrame:
    """The layer before the last delivery held against that delivery."""
    rows, last = _deliveries(spark, d)
    return layer.verify_layer(_at(rows, last), _layer(rows, max(0, last - 1)))


def layer_columns(spark: SparkSession, d: str) -> DataFrame:
    return layer.value_counts(_now(spark, d).select("id", "name_en", "name_ar", "phone", "address", "lat"))


def layer_rows(spark: SparkSession, d: str) -> DataFrame:
    return layer.published_rows(_merged(spark, d)).select("stable_id", "longitude", "primary_source", "primary_source_id", "source_keys", "name_en_generated", "geometry_confidence", "provenance_phone")


def layer_geojson(spark: SparkSession, d: str) -> DataFrame:
    return layer.geojson_features(_merged(spark, d))


def bilingual_names(spark: SparkSession, d: str) -> DataFrame:
    rows = _now(spark, d, ["name_en", "name_ar"])
    return rows.select("id", F.coalesce(has_script_col(F.col("name_en"), "en"), F.lit(False)).alias("english"), F.coalesce(has_script_col(F.col("name_ar"), "ar"), F.lit(False)).alias("arabic"))


def bilingual_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.bilingual_counts(_merged(spark, d))


def name_forms(spark: SparkSession, d: str) -> DataFrame:
    rows = _now(spark, d, ["name_en", "name_ar"])
    return rows.select("id", clean_name_col("name_en").alias("clean_en"), arabic_key_col("name_ar").alias("key_ar"), name_key_col("name_en").alias("name_key"))


def enriched_names(spark: SparkSession, d: str) -> DataFrame:
    rows = _now(spark, d, ["source", "name_en", "name_ar", "category"])
    e = rows.select("id", enrich_col("name_en", "name_ar", "category", F.concat_ws(":", "source", "id")).alias("e"))
    return e.select("id", "e.name_en", "e.name_ar", "e.name_en_generated", "e.name_ar_generated", "e.name_ar_confidence", "e.review_reason")


def phone_keys(spark: SparkSession, d: str) -> DataFrame:
    return _now(spark, d, ["phone"]).select("id", phone_digits(F.col("phone")).alias("digits"))


def tag_lookup(spark: SparkSession, d: str) -> DataFrame:
    tags = lookups.tag_categories(taxonomy(spark)).withColumnRenamed("category", "leaf")
    rows = _now(spark, d, ["category"]).withColumn("tag", F.concat(F.lit("amenity="), F.lower(F.trim("category"))))
    return rows.join(small(tags), "tag", "left").groupBy("category", "leaf").agg(F.count("*").alias("n"))


def taxonomy_coverage(spark: SparkSession, d: str) -> DataFrame:
    return reports.crosswalk_coverage(taxonomy(spark))


def geocoded(spark: SparkSession, d: str) -> DataFrame:
    """Rows of any snapshot without a position, filled from the addresses of all rows that have one."""
    known = table(spark, d, "riyadh_pharmacies").filter("lat between 24 and 26 and lon between 46 and 48 and trim(address) <> ''")
    catalog = known.groupBy(lookups.lookup_key(F.col("address")).alias("address")).agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.lit(0.9).alias("confidence"))
    rows = table(spark, d, "riyadh_pharmacies").select("row_id", "lat", "lon", "address")
    return lookups.geocode(rows, catalog).filter("geometry_derived").select("row_id", "lat", "lon", "geometry_confidence")


def place_lookup(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "districts").select("district_id", "name_en", "name_ar")
    wanted = places.select(F.upper("name_en").alias("name")).unionByName(table(spark, d, "region").select(F.col("r_name").alias("name")))
    return lookups.resolve_places(places, wanted.filter("name is not null"), ["name_en", "name_ar"])


def snapshot_freshness(spark: SparkSession, d: str) -> DataFrame:
    now, at = F.to_timestamp(F.lit("2026-04-05 00:00:00")), F.col("taken_at").cast("timestamp")
    limit, mode = F.lit(35 * 86400.0), F.when(F.col("snapshot_no") == 2, "pinned").otherwise("live")
    rows = table(spark, d, "snapshots")
    return rows.select("source", "snapshot_no", snapshots.freshness(at, mode, limit, now).alias("state"), snapshots.age_error(at, mode, limit, F.lit("strict"), now).alias("error"))


def _descriptors(spark: SparkSession, d: str) -> DataFrame:
    """A descriptor of every listed snapshot: source, endpoint, query_hash, timestamp (null where it was not delivered), dataset_hash."""
    held = snapshots.dataset_hash(table(spark, d, "riyadh_pharmacies"), ["source", "snapshot_no"], ["id", "name_en", "name_ar", "phone", "address", "lat", "lon"])
    rows = table(spark, d, "snapshots").join(small(held), ["source", "snapshot_no"], "left")
    return rows.select("source", "snapshot_no", F.lit("feed").alias("endpoint"), F.col("source").alias("query_hash"), F.when(F.col("delivered"), F.col("taken_at")).alias("timestamp"), "dataset_hash")


def snapshot_order(spark: SparkSession, d: str) -> DataFrame:
    """Each snapshot against the one before it."""
    now = F.struct("source", "endpoint", "query_hash", "timestamp", "dataset_hash")
    seen = _descriptors(spark, d).withColumn("now", now).withColumn("before", F.lag("now").over(Window.partitionBy("source").orderBy("snapshot_no")))
    return seen.select("source", "snapshot_no", snapshots.compare("now", "before").alias("decision"))


def snapshot_store(spark: SparkSession, d: str) -> DataFrame:
    """The store of last accepted descriptors after all snapshots, decided and accepted number by number."""
    rows = materialize(_descriptors(spark, d), "descriptors")
    store = rows.drop("snapshot_no").limit(0)
    for (no,) in sorted(map(tuple, table(spark, d, "snapshots").select("snapshot_no").distinct().collect())):
        before, store = store, materialize(snapshots.accept(store, snapshots.decide(rows.filter(F.col("snapshot_no") == no).drop("snapshot_no"), store)), "store")
        release(before)
    return store.select("source", F.col("timestamp").cast("string").alias("accepted_at"))


def review_scores(spark: SparkSession, d: str) -> DataFrame:
    """Names of the register as a review corpus, rated by whether the second table's names hold them; repeated and unknown ratings are faults."""
    corpus = table(spark, d, "name_register").select(F.col("name_id").cast("string").alias("id"), "name_en")
    seen = table(spark, d, "riyadh_pharmacies_alt").select("name_en").distinct()
    ratings = corpus.join(seen.withColumn("met", F.lit(True)).hint("merge"), "name_en", "left").select("id", F.when(F.col("met"), "ACCEPTED").otherwise("REJECTED").alias("rating"))
    return reports.review_score(corpus, ratings).withColumn("acceptance", F.round("acceptance", 6))


def generated_merges(spark: SparkSession, d: str) -> DataFrame:
    """Places merged from enriched rows: whose name wins where one side is generated, with its method and provenance."""
    rows = _canonical(spark, d)
    made = rows.select("source_key", enrich_col("name_en", "name_ar", "category", F.col("source_key")).alias("e"))
    names = [f for f in made.schema["e"].dataType.names if f in rows.columns or f.startswith(("name_", "provenance_name_"))]
    rows = rows.drop(*names).join(made.select("source_key", *(F.col(f"e.{n}").alias(n) for n in names)).hint("merge"), "source_key")
    groups = table(spark, d, "merge_groups").groupBy("source_key").agg(F.min("entity_id").alias("entity"))
    merged = merge_clusters(rows.join(groups.hint("merge"), "source_key", "left").withColumn("cluster", F.coalesce("entity", "source_key")))
    return merged.select("stable_id", "name_en", "name_ar", F.coalesce("name_en_generated", F.lit(False)).alias("name_en_generated"), F.coalesce("name_ar_generated", F.lit(False)).alias("name_ar_generated"), "name_ar_method")


def snapshot_stream(spark: SparkSession, d: str) -> DataFrame:
    """The order rule on a stream of descriptors (all files of the snapshots table, one scope per source), written to a table in the shared folder."""
    schema = "source string, snapshot_no int, taken_at timestamp, delivered boolean"
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{d}/snapshots.parquet")
    at = F.when(F.col("delivered"), F.col("taken_at")).alias("timestamp")
    flat = rows.select(F.col("source").alias("query_hash"), at, F.col("snapshot_no").cast("string").alias("dataset_hash"))
    out = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    judged = judged_stream(flat)
    judged.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(judged.schema).parquet(f"{out}/rows").select("query_hash", "dataset_hash", "decision")


def row_hashes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "districts")
    return rows.select("district_id", snapshots.row_hash(rows, ["district_id", "name_en", "name_ar", "postcode"]).alias("digest"))


def dataset_hashes(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.dataset_hash(table(spark, d, "riyadh_pharmacies"), ["source", "snapshot_no"], ["id", "name_en", "name_ar", "phone", "address", "lat", "lon"])


def robots_rules(spark: SparkSession, d: str) -> DataFrame:
    lines = ["User-agent: *", "Disallow: /size/1", "Allow: /size/12/", "Disallow: /*.json$", "", "User-agent: other", "Disallow: /"]
    url = F.concat(F.lit("https://shop.test/size/"), F.col("p_size").cast("string"), F.lit("/"), F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 3 == 0, ".json").when(F.col("p_partkey") % 3 == 1, ".json?x=1").otherwise(""))
    return robots.allowed(table(spark, d, "part").select("p_partkey", url.alias("url")), "url", lines, "surveyor/1.0").select("p_partkey", "allowed")


def payload_records(spark: SparkSession, d: str) -> DataFrame:
    """Current rows written as map elements (nodes, and ways with a centre) and read back by the payload parser."""
    rows = _now(spark, d, ["row_id", "lat", "lon", "name_en", "name_ar", "phone"]).filter("lat is not null and lon is not null")
    tags = F.map_filter(F.create_map(F.lit("amenity"), F.lit("pharmacy"), F.lit("name:en"), "name_en", F.lit("name"), "name_ar", F.lit("phone"), "phone"), lambda k, v: v.isNotNull())
    way = F.col("row_id") % 2 == 0
    element = F.struct(
        F.when(way, "way").otherwise("node").alias("type"), F.col("row_id").alias("id"), F.when(~way, F.col("lat")).alias("lat"), F.when(~way, F.col("lon")).alias("lon"),
        F.when(way, F.struct("lat", "lon")).alias("center"), F.lit(1).alias("version"), F.lit(None).cast("string").alias("timestamp"), tags.alias("tags"),
    )
    stamp = F.struct(F.lit("2026-04-01T00:00:00Z").alias("timestamp_osm_base"))
    payload = rows.select(stamp.alias("osm3s"), F.lit(None).cast("string").alias("remark"), F.lit(None).cast("string").alias("error"), F.array(element).alias("elements"))
    got = parse_payload(payload, taxonomy(spark), ["pharmacy", "clinic"], "map", allow_centers=True)
    return got.select("id", "lat", "lon", "category", "name_en", "name_ar", "geometry_method", "geometry_confidence", "phone")


QUERIES = (
    registry_faults, licence_gate, licence_report, routing, canonical, contributors, run_counters, area_box, area_polygon, candidate_pairs, near_components, conflation_decisions,
    conflated_places, merged_places, provenance_sidecar, key_overlaps, kept_ids, merge_quality, unlabelled_keys, field_changes, layer_upsert, layer_check, layer_columns, layer_rows, layer_geojson, bilingual_names,
    bilingual_counts, name_forms, enriched_names, phone_keys, tag_lookup, taxonomy_coverage, geocoded, place_lookup, snapshot_freshness, snapshot_order, snapshot_store, snapshot_stream, review_scores, generated_merges, row_hashes,
    dataset_hashes, robots_rules, payload_records,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


# SQL -----------------------------------------------------------------------------------------------------------------------------------------

_LEAVES = "('pharmacy'), ('clinic'), ('hospital'), ('school')"
_ROUTED = f"""{CURRENT_SQL},
routed AS (
  SELECT *, CASE WHEN category IS NULL OR category NOT IN ('pharmacy', 'clinic', 'hospital', 'school') THEN 'unmapped category ' || coalesce(category, 'null')
    WHEN category = 'pharmacy' AND NOT coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, FALSE) THEN 'no usable coordinates' END AS reason FROM cur),
stated AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'review' WHEN category <> 'pharmacy' THEN 'dropped' ELSE 'accepted' END AS status FROM routed)"""
_CANON = f"""{_ROUTED},
canon AS (
  SELECT c.source || ':' || c.id AS source_key, c.source, c.lat, c.lon, c.name_en, c.name_ar, c.category, c.phone, c.address,
    strftime(c.harvested_at, '%Y-%m-%dT%H:%M:%S') AS harvested_at, coalesce(s.reliability_weight, 0.5) AS confidence, s.license, s.attribution, s.kind
  FROM stated c JOIN sources s ON s.name = c.source WHERE c.status = 'accepted')"""
_FIRST = "first({0} ORDER BY confidence DESC, source_key) FILTER (WHERE {1} IS NOT NULL)"
_MERGED = f"""{_CANON},
keyed AS (SELECT c.*, coalesce(g.entity, c.source_key) AS cluster FROM canon c
          LEFT JOIN (SELECT source_key, min(entity_id) AS entity FROM merge_groups GROUP BY 1) g USING (source_key)),
merged AS (
  SELECT list(source_key ORDER BY source_key) AS keys, count(*) AS n_keys, first(lat ORDER BY confidence DESC, source_key) AS lat, first(lon ORDER BY confidence DESC, source_key) AS lon,
    {", ".join(f"{_FIRST.format(c, c)} AS {c}, {_FIRST.format('source_key', c)} AS {c}_by" for c in ("name_en", "name_ar", "phone", "address"))},
    max(harvested_at) AS harvested_at, max(confidence) AS confidence, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
    first(source_key ORDER BY confidence DESC, source_key) AS category_by, first(confidence ORDER BY confidence DESC, source_key) AS best
  FROM keyed GROUP BY cluster),
ided AS (SELECT *, sha256(array_to_string(keys, '|'))[:20] AS stable_id FROM merged)"""
_DIGITS = "regexp_replace(coalesce({0}, ''), '[^\\p{{Nd}}]', '', 'g')"
_BYPHONE = f"""{CURRENT_SQL},
both_tables AS (SELECT source || ':' || id AS source_key, {_DIGITS.format("phone")} AS digits FROM cur
         UNION ALL SELECT source || ':' || id, {_DIGITS.format("phone")} FROM riyadh_pharmacies_alt WHERE id IS NOT NULL),
mine AS (SELECT source_key, min(digits) AS digits FROM both_tables WHERE digits <> '' AND source_key IN (SELECT source_key FROM merge_groups) GROUP BY 1)"""
_DELIVERIES = """
sent AS (SELECT source, snapshot_no, row_number() OVER (PARTITION BY source ORDER BY snapshot_no) - 1 AS pos FROM (SELECT DISTINCT source, snapshot_no FROM snapshots WHERE delivered)),
rows_of AS (SELECT * FROM (SELECT p.*, s.pos, row_number() OVER (PARTITION BY s.pos, p.id ORDER BY p.harvested_at DESC NULLS LAST, p.row_id DESC) AS rn
            FROM riyadh_pharmacies p JOIN sent s USING (source, snapshot_no) WHERE p.id IS NOT NULL) WHERE rn = 1),
last AS (SELECT max(pos) AS pos FROM sent)"""
_NUMBERED = """
entry AS (SELECT id AS stable_id, min(pos) AS pos FROM rows_of WHERE pos <= {0} GROUP BY 1),
ids AS (SELECT stable_id, row_number() OVER (ORDER BY pos, stable_id) AS id FROM entry)"""
_EDGES = ", ".join(
    f"({p}, {r}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for p, rings in enumerate(AREA["coordinates"]) for r, ring in enumerate(rings) for a, b in zip(ring, ring[1:])
)
_POINTS = "pts AS (SELECT id, lat, lon FROM cur WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0))"


def _near_sql(points: str, key: str, metres: float) -> str:
    return f"""
grid AS (SELECT {key} AS k, lat, lon, CAST(floor(lat / 0.001) AS BIGINT) AS cy, CAST(floor(lon / 0.001) AS BIGINT) AS cx FROM {points}),
probe AS (SELECT g.*, g.cy + dy.d AS ny, g.cx + dx.d AS nx FROM grid g, (SELECT unnest([-1, 0, 1]) AS d) dy, (SELECT unnest([-1, 0, 1]) AS d) dx),
near AS (SELECT * FROM (
  SELECT a.k AS key_a, b.k AS key_b, 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2)))) AS distance_m
  FROM probe a JOIN grid b ON a.ny = b.cy AND a.nx = b.cx AND a.k < b.k) WHERE distance_m <= {metres})"""


_CROSSWALK = ", ".join(
    f"('{key}', '{p}', {repr(v) if v else 'NULL'})" for key, _, *lists in taxonomy_rows() for p, vs in zip(("osm_tags", "google_types", "wikidata_classes"), lists) for v in (vs or [None])
)
_CHANGED = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{t}' END" for c, t in (("address", "address"), ("category", "category"), ("lat", "latitude"), ("lon", "longitude"), ("name_ar", "name_ar"), ("name_en", "name_en"), ("phone", "phone")))

SQL = {
    "registry_faults": """
SELECT name, array_to_string(list_filter([
  CASE WHEN coalesce(license, '') = '' THEN 'missing license' END, CASE WHEN coalesce(attribution, '') = '' THEN 'missing attribution' END,
  CASE WHEN coalesce(auth_mode, '') = '' THEN 'missing auth_mode' END, CASE WHEN coalesce(freshness, '') = '' THEN 'missing freshness' END,
  CASE WHEN coalesce(len(allowed_uses), 0) = 0 THEN 'missing allowed_uses' END,
  CASE WHEN NOT coalesce(rate_limit_per_second > 0, FALSE) THEN 'rate_limit_per_second must be positive' END,
  CASE WHEN NOT coalesce(reliability_weight BETWEEN 0 AND 1, FALSE) THEN 'reliability_weight must be between 0 and 1' END,
  CASE WHEN commercial_use IS NULL THEN 'missing commercial_use' END,
  CASE WHEN coverage_bbox IS NOT NULL AND NOT coalesce(len(coverage_bbox) = 4 AND coverage_bbox[1] <= coverage_bbox[3] AND coverage_bbox[2] <= coverage_bbox[4], FALSE) THEN 'coverage_bbox must be ordered W, S, E, N' END,
  CASE WHEN coalesce(CASE WHEN kind = 'fixture' THEN path ELSE endpoint END, '') = '' THEN 'missing path or endpoint' END,
  CASE WHEN auth_mode <> 'none' THEN 'auth_mode must be none' END], lambda x: x IS NOT NULL), '; ') AS faults FROM sources""",
    "licence_gate": f"""
SELECT name, declared_use, coalesce(
  CASE WHEN declared_use <> 'internal' AND NOT coalesce(commercial_use, FALSE) THEN 'commercial use is not licensed for ' || declared_use
       WHEN NOT coalesce(list_contains(allowed_uses, declared_use), FALSE) THEN declared_use || ' is not among the allowed uses' END,
  CASE WHEN coverage_bbox IS NOT NULL AND NOT (coverage_bbox[1] <= {BOX[0]} AND coverage_bbox[2] <= {BOX[1]} AND coverage_bbox[3] >= {BOX[2]} AND coverage_bbox[4] >= {BOX[3]})
       THEN 'the area is not wholly covered' END) AS refused
FROM sources, (SELECT unnest(['internal', 'commercial', 'redistribute']) AS declared_use)""",
    "licence_report": """
SELECT name AS source, coalesce(nullif(endpoint, ''), path) AS endpoint_or_path, array_to_string(list_sort(allowed_uses), ',') AS allowed_use,
  list_contains(allowed_uses, 'redistribute') AS redistribution, reliability_weight FROM sources""",
    "routing": f"WITH {_ROUTED} SELECT source, status, reason, count(*) AS n FROM stated GROUP BY ALL",
    "canonical": f"""WITH {_CANON}
SELECT source_key, lat, lon, name_en, phone, confidence, CASE WHEN kind = 'fixture' THEN 'fixture_synthetic' ELSE 'source_point' END AS geometry_method,
  CAST(1 + (name_en IS NOT NULL)::INT + (name_ar IS NOT NULL)::INT + (phone IS NOT NULL)::INT + (address IS NOT NULL)::INT AS INT) AS n_provenance FROM canon""",
    "contributors": f"WITH {_CANON} SELECT source, license, count(*) AS records FROM canon GROUP BY ALL",
    "run_counters": f"""WITH {_MERGED}
SELECT (SELECT count(*) FROM stated) AS records, (SELECT count(*) FROM stated WHERE status = 'accepted') AS accepted, (SELECT count(*) FROM stated WHERE status = 'review') AS review,
  (SELECT count(*) FROM stated WHERE status = 'dropped') AS dropped, count(*) AS places, count(*) FILTER (WHERE n_keys > 1) AS merged_places,
  count(*) FILTER (WHERE coalesce(name_en, '') <> '' AND coalesce(name_ar, '') <> '') AS bilingual_places, 0 AS generated_names FROM ided""",
    "area_box": f"WITH {CURRENT_SQL} SELECT id FROM cur WHERE lat BETWEEN {BOX[1]} AND {BOX[3]} AND lon BETWEEN {BOX[0]} AND {BOX[2]}",
    "area_polygon": f"""WITH {CURRENT_SQL}, edges(p, r, x1, y1, x2, y2) AS (VALUES {_EDGES}),
hits AS (SELECT c.id, e.p, e.r, count(*) AS n FROM cur c JOIN edges e ON (e.y1 > c.lat) <> (e.y2 > c.lat) AND c.lon < (e.x2 - e.x1) * (c.lat - e.y1) / (e.y2 - e.y1) + e.x1 GROUP BY ALL)
SELECT DISTINCT id FROM hits h WHERE r = 0 AND n % 2 = 1 AND NOT EXISTS (SELECT 1 FROM hits o WHERE o.id = h.id AND o.p = h.p AND o.r > 0 AND o.n % 2 = 1)""",
    "candidate_pairs": f"""WITH {_CANON}, pts AS (SELECT * FROM canon WHERE NOT (lat = 0 AND lon = 0)), {_near_sql("pts", "source_key", 75)}
SELECT key_a, key_b, round(distance_m, 3) AS distance_m, {_DIGITS.format("x.phone")} = {_DIGITS.format("y.phone")} AND {_DIGITS.format("x.phone")} <> '' AS same_phone
FROM near JOIN canon x ON x.source_key = key_a JOIN canon y ON y.source_key = key_b""",
    "near_components": f"""WITH RECURSIVE {CURRENT_SQL}, {_POINTS}, {_near_sql("pts", "id", 40)},
both_ways AS (SELECT key_a AS a, key_b AS b FROM near UNION ALL SELECT key_b, key_a FROM near),
reach(node, root) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.node)
SELECT node, min(root) AS component FROM reach GROUP BY node""",
    "merged_places": f"""WITH {_MERGED} SELECT stable_id, CAST(n_keys AS INT) AS n_keys, lat, lon, name_en, name_en_by, name_ar, name_ar_by, phone, phone_by, address, harvested_at, confidence,
  coalesce(name_en, '') <> '' AND coalesce(name_ar, '') <> '' AS language_complete, licenses FROM ided""",
    "provenance_sidecar": f"WITH {_MERGED} " + " UNION ALL ".join(f"SELECT stable_id, '{c}' AS field, {c}_by AS source_key FROM ided WHERE {c}_by IS NOT NULL" for c in ("category", "name_en", "name_ar", "phone", "address")),
    "key_overlaps": f"""WITH {_BYPHONE}
SELECT g.entity_id AS old_id, m.digits AS new_id, count(DISTINCT m.source_key) AS overlap FROM mine m JOIN merge_groups g USING (source_key) GROUP BY ALL""",
    "merge_quality": f"""WITH {_BYPHONE},
pred AS (SELECT DISTINCT x.source_key AS a, y.source_key AS b FROM mine x JOIN mine y ON x.digits = y.digits AND x.source_key < y.source_key),
gold AS (SELECT DISTINCT x.source_key AS a, y.source_key AS b FROM merge_groups x JOIN merge_groups y ON x.entity_id = y.entity_id AND x.source_key < y.source_key),
n AS (SELECT count(*) FILTER (WHERE p.a IS NOT NULL AND g.a IS NOT NULL) AS true_pairs, count(*) FILTER (WHERE g.a IS NULL) AS false_pairs, count(*) FILTER (WHERE p.a IS NULL) AS missed_pairs
      FROM pred p FULL JOIN gold g ON p.a = g.a AND p.b = g.b),
q AS (SELECT *, true_pairs / (true_pairs + false_pairs) AS p, true_pairs / (true_pairs + missed_pairs) AS r FROM n)
SELECT true_pairs, false_pairs, missed_pairs, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM q""",
    "field_changes": f"""WITH {_DELIVERIES}, steps AS (SELECT unnest(range(1, (SELECT pos + 1 FROM last))) AS delivery),
j AS (SELECT coalesce(o.delivery, n.delivery) AS delivery, coalesce(o.id, n.id) AS stable_id, o.id AS oid, n.id AS nid, array_to_string(list_filter([{_CHANGED},
  CASE WHEN o.source || ':' || o.id IS DISTINCT FROM n.source || ':' || n.id THEN 'geometry_provenance' END], lambda x: x IS NOT NULL), ',') AS f
  FROM (SELECT r.*, s.delivery FROM rows_of r JOIN steps s ON r.pos = s.delivery - 1) o FULL JOIN (SELECT r.*, s.delivery FROM rows_of r JOIN steps s ON r.pos = s.delivery) n ON o.id = n.id AND o.delivery = n.delivery)
SELECT CAST(delivery AS INT) AS delivery, stable_id, CASE WHEN oid IS NULL THEN 'added' WHEN nid IS NULL THEN 'removed' WHEN f <> '' THEN 'updated' ELSE 'unchanged' END AS change,
  CASE WHEN oid IS NULL OR nid IS NULL THEN '' ELSE f END AS changed_fields FROM j""",
    "layer_upsert": f"""WITH {_DELIVERIES}, {_NUMBERED.format("(SELECT pos FROM last)")},
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS nth FROM rows_of) WHERE nth = 1)
SELECT i.id, i.stable_id, n.pos = (SELECT pos FROM last) AS is_active, n.phone FROM ids i JOIN newest n ON n.id = i.stable_id""",
    "layer_check": f"""WITH {_DELIVERIES},
n AS (SELECT * FROM rows_of WHERE pos = (SELECT pos FROM last)), o AS (SELECT * FROM rows_of WHERE pos = (SELECT greatest(0, pos - 1) FROM last))
SELECT count(*) FILTER (WHERE n.lon IS NOT NULL) AS expected, count(*) FILTER (WHERE o.lon IS NOT NULL) AS published, count(*) FILTER (WHERE o.lon IS NULL) AS missing,
  count(*) FILTER (WHERE n.lon IS NULL) AS surplus, count(*) FILTER (WHERE abs(n.lon - o.lon) > 1e-8 OR abs(n.lat - o.lat) > 1e-8) AS moved,
  count(*) FILTER (WHERE o.lon IS NOT NULL AND coalesce(o.source || ':' || o.id, '') = '') AS without_provenance
FROM n FULL JOIN o ON o.id = n.id""",
    "layer_columns": f"""WITH {CURRENT_SQL} SELECT count(*) AS id, {", ".join(f"count(*) FILTER (WHERE trim({c}) NOT IN ('', '[]', '{{}}')) AS {c}" for c in ("name_en", "name_ar", "phone", "address"))}, count(lat) AS lat FROM cur""",
    "layer_rows": f"""WITH {_MERGED} SELECT stable_id, lon AS longitude, split_part(keys[1], ':', 1) AS primary_source, regexp_replace(keys[1], '^[^:]*:', '') AS primary_source_id,
  CAST(to_json(keys) AS VARCHAR) AS source_keys, FALSE AS name_en_generated, confidence AS geometry_confidence, phone_by AS provenance_phone FROM ided""",
    "bilingual_names": f"""WITH {CURRENT_SQL} SELECT id, coalesce(regexp_matches(name_en, '\\p{{Latin}}'), FALSE) AS english, coalesce(regexp_matches(name_ar, '[\\x{{0621}}-\\x{{064A}}\\x{{066E}}-\\x{{06D3}}\\x{{FE70}}-\\x{{FEFC}}]'), FALSE) AS arabic FROM cur""",
    "bilingual_counts": f"""WITH {_MERGED}, v AS (SELECT coalesce(regexp_matches(name_en, '\\p{{Latin}}'), FALSE)
    AND coalesce(regexp_matches(name_ar, '[\\x{{0621}}-\\x{{064A}}\\x{{066E}}-\\x{{06D3}}\\x{{FE70}}-\\x{{FEFC}}]'), FALSE) AS ok FROM ided)
SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS valid_bilingual, count(*) FILTER (WHERE ok) AS authoritative, count(*) FILTER (WHERE ok) / count(*) AS authoritative_fraction FROM v""",
    "taxonomy_coverage": f"""WITH leaf(id, provider, tag) AS (VALUES {_CROSSWALK}),
n AS (SELECT provider, count(DISTINCT id) AS leaves, count(DISTINCT tag) AS tags, count(DISTINCT CASE WHEN tag IS NOT NULL THEN id END) AS mapped FROM leaf GROUP BY 1),
twice AS (SELECT provider, count(*) AS c FROM (SELECT provider, tag FROM leaf WHERE tag IS NOT NULL GROUP BY ALL HAVING count(DISTINCT id) > 1) GROUP BY 1)
SELECT provider, tags AS mapping_count, mapped AS mapped_leaf_count, round(mapped / leaves, 4) AS leaf_coverage, coalesce(c, 0) AS ambiguous_count FROM n LEFT JOIN twice USING (provider)""",
    "phone_keys": f"WITH {CURRENT_SQL} SELECT id, {_DIGITS.format('phone')} AS digits FROM cur",
    "tag_lookup": f"""WITH {CURRENT_SQL}, leaf(id) AS (VALUES {_LEAVES}) SELECT category, leaf.id AS leaf, count(*) AS n FROM cur LEFT JOIN leaf ON leaf.id = lower(trim(category)) GROUP BY ALL""",
    "geocoded": """
WITH cat AS (SELECT lower(trim(address)) AS k, min(lat) AS lat, min(lon) AS lon FROM riyadh_pharmacies WHERE lat BETWEEN 24 AND 26 AND lon BETWEEN 46 AND 48 AND trim(address) <> '' GROUP BY 1)
SELECT c.row_id, k.lat, k.lon, 0.5 AS geometry_confidence FROM riyadh_pharmacies c JOIN cat k ON k.k = lower(trim(c.address)) WHERE c.lat IS NULL OR c.lon IS NULL""",
    "place_lookup": """
WITH names AS (SELECT DISTINCT district_id AS key, lower(trim(n)) AS n FROM (SELECT district_id, name_en AS n FROM districts UNION ALL SELECT district_id, name_ar FROM districts) WHERE n IS NOT NULL),
wanted AS (SELECT upper(name_en) AS name FROM districts WHERE name_en IS NOT NULL UNION SELECT r_name FROM region),
m AS (SELECT w.name, count(key) AS matches, min(key) AS key FROM wanted w LEFT JOIN names ON names.n = lower(trim(w.name)) GROUP BY 1)
SELECT name, CASE WHEN matches = 1 THEN 'completed' ELSE 'needs_input' END AS status, matches, CASE WHEN matches = 1 THEN key END AS key FROM m""",
    "snapshot_freshness": """
WITH a AS (SELECT source, snapshot_no, date_diff('second', CAST(taken_at AS TIMESTAMP), TIMESTAMP '2026-04-05 00:00:00') AS age, taken_at FROM snapshots)
SELECT source, snapshot_no, CASE WHEN taken_at IS NULL THEN 'UNKNOWN' WHEN snapshot_no = 2 THEN 'HISTORICAL' WHEN age < -300 THEN 'UNKNOWN' WHEN age > 3024000 THEN 'STALE' ELSE 'CURRENT' END AS state,
  CASE WHEN snapshot_no = 2 THEN NULL WHEN taken_at IS NULL THEN 'missing timestamp' WHEN age < -300 THEN 'timestamp in the future' WHEN age > 3024000 THEN 'stale' END AS error FROM a""",
    "snapshot_order": """
WITH r AS (SELECT source, snapshot_no, CASE WHEN delivered THEN taken_at END AS t FROM snapshots),
b AS (SELECT *, lag(t) OVER w AS p, lag(snapshot_no) OVER w AS pn FROM r WINDOW w AS (PARTITION BY source ORDER BY snapshot_no))
SELECT source, snapshot_no, CASE WHEN pn IS NULL OR p IS NULL THEN CASE WHEN t IS NULL THEN 'UNVERIFIED_TIMESTAMP' ELSE 'NEWER_SNAPSHOT' END
  WHEN t IS NULL THEN 'ERROR missing timestamp' WHEN t < p THEN 'ERROR older' WHEN t = p THEN 'EQUAL_SNAPSHOT' ELSE 'NEWER_SNAPSHOT' END AS decision FROM b""",
    "row_hashes": """
SELECT district_id, sha256(coalesce(district_id, chr(1)) || chr(31) || coalesce(name_en, chr(1)) || chr(31) || coalesce(name_ar, chr(1)) || chr(31) || coalesce(postcode, chr(1))) AS digest FROM districts""",
    "unlabelled_keys": f"WITH {CURRENT_SQL} SELECT DISTINCT source || ':' || id AS source_key FROM cur WHERE source || ':' || id NOT IN (SELECT source_key FROM merge_groups)",
    "snapshot_store": """
WITH t AS (SELECT source, snapshot_no, taken_at, max(taken_at) OVER (PARTITION BY source ORDER BY snapshot_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM snapshots WHERE delivered)
SELECT source, strftime(max(taken_at), '%Y-%m-%d %H:%M:%S') AS accepted_at FROM t WHERE before IS NULL OR taken_at >= before GROUP BY 1""",
    "snapshot_stream": """
SELECT source AS query_hash, CAST(snapshot_no AS VARCHAR) AS dataset_hash, CASE WHEN NOT delivered OR taken_at IS NULL THEN
    CASE WHEN max(CASE WHEN delivered THEN taken_at END) OVER (PARTITION BY source) IS NULL THEN 'UNVERIFIED_TIMESTAMP' ELSE 'ERROR missing timestamp' END
  ELSE 'NEWER_SNAPSHOT' END AS decision FROM snapshots""",
    "review_scores": """
WITH r AS (SELECT n.name_id, n.name_en IN (SELECT name_en FROM riyadh_pharmacies_alt WHERE name_en IS NOT NULL) AS met FROM name_register n)
SELECT count(*) AS reviewed, count(*) FILTER (WHERE met) AS accepted, count(*) FILTER (WHERE met IS NOT TRUE) AS rejected, count(*) AS total, 0 AS faults,
  round(count(*) FILTER (WHERE met) / count(*), 6) AS acceptance, count(*) >= 100 AS complete FROM r""",
    "dataset_hashes": """
WITH h AS (SELECT source, snapshot_no, sha256(concat_ws(chr(31), coalesce(id, chr(1)), coalesce(name_en, chr(1)), coalesce(name_ar, chr(1)), coalesce(phone, chr(1)), coalesce(address, chr(1)),
    coalesce(CAST(lat AS VARCHAR), chr(1)), coalesce(CAST(lon AS VARCHAR), chr(1)))) AS x FROM riyadh_pharmacies),
n AS (SELECT source, snapshot_no, count(*) AS n, sum(CAST('0x' || x[1:15] AS HUGEINT)) AS a, sum(CAST('0x' || x[16:30] AS HUGEINT)) AS b, sum(CAST('0x' || x[31:45] AS HUGEINT)) AS c, sum(CAST('0x' || x[46:60] AS HUGEINT)) AS d FROM h GROUP BY ALL)
SELECT source, snapshot_no, sha256(concat_ws('|', CAST(n AS VARCHAR), CAST(a AS VARCHAR), CAST(b AS VARCHAR), CAST(c AS VARCHAR), CAST(d AS VARCHAR))) AS dataset_hash FROM n""",
    "robots_rules": """
WITH u AS (SELECT p_partkey, '/size/' || p_size || '/' || p_partkey || CASE p_partkey % 3 WHEN 0 THEN '.json' WHEN 1 THEN '.json?x=1' ELSE '' END AS path FROM part)
SELECT p_partkey, CASE WHEN starts_with(path, '/size/12/') THEN TRUE WHEN starts_with(path, '/size/1') THEN FALSE WHEN path LIKE '%.json' THEN FALSE ELSE TRUE END AS allowed FROM u""",
}


def sql() -> dict[str, str]:
    return SQL
