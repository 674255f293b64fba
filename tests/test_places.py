import hashlib
import json

import pytest
from pyspark.sql import functions as F

from atlasmill.functions.enrich import enrich, generate
from atlasmill.functions.names import arabic_key, clean_name, has_script, name_key, phone_digits, resolve_tags
from atlasmill.operators import areas, history, lookups, reports, robots, snapshots
from atlasmill.operators.canonical import admitted_sources, canonicalize, route
from atlasmill.operators.components import connected_components
from atlasmill.operators.conflate import conflate, with_ordinals
from atlasmill.operators.merge import merge_clusters
from atlasmill.sinks import layer
from atlasmill.sources.records import PAYLOAD, parse_payload, read_catalog, read_places, read_records
from atlasmill.sources.registry import checked, load_registry
from atlasmill.sources.taxonomy import taxonomy
from atlasmill.streaming.snapshot_state import judged_stream

SOURCES = "name string, kind string, reliability_weight double, attribution string, license string"
FIELDS = ["source", "id", "lat", "lon", "name_en", "name_ar", "category", "phone", "address", "hours"]
RAW = "source string, id string, lat double, lon double, name_en string, name_ar string, category string, phone string, address string, hours string"


def canon(spark, rows):
    src = spark.createDataFrame([(f"s{i}", "fixture", 0.9 - i / 10, f"A{i}", f"L{i}") for i in range(5)], SOURCES)
    return canonicalize(spark.createDataFrame([tuple({"category": "pharmacy", **r}.get(f) for f in FIELDS) for r in rows], RAW), src)


def at(source, id, north=0.0, **more):
    return {"source": source, "id": id, "lat": 24.7 + north / 111_195, "lon": 46.7, "name_en": "Nakheel Pharmacy", **more}


def run(spark, rows, version=3):
    clustered, log = conflate(canon(spark, rows), version)
    sets = {}
    for r in clustered.select("cluster", "source_key").collect():
        sets.setdefault(r["cluster"], []).append(r["source_key"])
    return sorted(map(sorted, sets.values())), {(r["left"], r["right"]): (r["decision"], r["reason"]) for r in log.collect()}


def test_conflation_cases(spark):
    same = [at("s0", "1"), at("s1", "2", 10)]
    assert len(run(spark, same)[0]) == 1
    assert len(run(spark, [at("s0", "1", phone="+966 1"), at("s1", "2", 10, phone="٩٦٦٢")])[0]) == 2
    assert len(run(spark, [at("s0", "1", phone="+966 1"), at("s1", "2", 10, phone="9662")], 2)[0]) == 1
    assert len(run(spark, [at("s0", "1"), at("s1", "2", 80)])[0]) == 2
    got, log = run(spark, [at("s0", "1"), at("s1", "2", 5, category="clinic")])
    assert len(got) == 2 and [*log.values()] == [("REJECT", "category_mismatch")]
    got, log = run(spark, [at("s0", "1"), at("s0", "2", 20)])
    assert len(got) == 2 and [*log.values()] == [("REJECT", "same_source_branch_guard")]
    assert len(run(spark, [at("s0", "1"), at("s0", "2", 20)], 1)[0]) == 1
    bridge = [at("s0", "1", 0, phone="1111111"), at("s1", "2", 5), at("s2", "3", 10, phone="2222222")]
    assert len(run(spark, bridge)[0]) == 2
    arabic = [at("s0", "1", name_en=None, name_ar="صيدلية النخيل"), at("s1", "2", 2, name_en="Nkhl", name_ar=None)]
    assert len(run(spark, arabic)[0]) == 1
    assert run(spark, [])[0] == [] and len(run(spark, [at("s0", "1"), at("s0", "1")])[0]) == 2
    with pytest.raises(ValueError):
        run(spark, same, 4)


def test_golden_ids_and_field_provenance(spark):
    rows = [
        {"source": "demo", "id": "demo-101", "lat": 24.7136, "lon": 46.6753, "name_en": "Al Nakheel Pharmacy", "name_ar": "صيدلية النخيل", "phone": "+966 11 1"},
        {"source": "demo", "id": "demo-103", "lat": 24.713627, "lon": 46.6753, "name_en": "Al Nakheel Pharmacy", "phone": "966111"},
        {"source": "demo_alt", "id": "alt-501", "lat": 24.71361, "lon": 46.6753, "name_en": "Nakheel Pharmacy", "phone": "966 111", "hours": "09:00-22:00"},
        {"source": "demo", "id": "demo-102", "lat": 24.75, "lon": 46.7, "name_en": "Central Pharmacy"},
    ]
    src = spark.createDataFrame([("demo", "fixture", 0.9, "A", "L"), ("demo_alt", "fixture", 0.75, "B", "L")], SOURCES)
    raw = spark.createDataFrame([tuple({"category": "pharmacy", **r}.get(f) for f in FIELDS) for r in rows], RAW)
    merged = {r["stable_id"]: r for r in merge_clusters(conflate(canonicalize(raw, src))[0]).collect()}
    assert set(merged) == {"11fe76e4d009a9cc5cc9", "0d54eea781cb1bdb1b98"}
    one = merged["11fe76e4d009a9cc5cc9"]
    assert one["provenance"]["name_ar"] == "demo:demo-101" and one["provenance"]["hours"] == "demo_alt:alt-501"
    assert one["attributions"] == ["A", "B"] and one["licenses"] == ["L"] and one["language_complete"]


def test_components_equal_union_find(spark):
    import random

    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(400)] + [(rng.randrange(1000, 3000), rng.randrange(1000, 3000)) for _ in range(1500)] + [(7, 7), (5000, 5000), (None, 1)] + [(9000, 9001 + i) for i in range(500)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {n: root(n) for n in parent}
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_history(spark):
    old = spark.createDataFrame([("a", "111", {"x": "1"}), ("b", "222", None)], "stable_id string, phone string, m map<string,string>")
    new = spark.createDataFrame([("a", "333", {"x": "1"}), ("c", "444", None)], "stable_id string, phone string, m map<string,string>")
    got = {r["stable_id"]: (r["change"], r["changed_fields"]) for r in history.change_set(old, new).collect()}
    assert got == {"a": ("updated", ["phone"]), "b": ("removed", []), "c": ("added", [])}
    assert history.change_set(old, old).filter("change <> 'unchanged'").count() == 0
    before = spark.createDataFrame([("old", ["one:1"]), ("tie", ["x:1", "y:1"])], "stable_id string, source_keys array<string>")
    after = spark.createDataFrame([("n1", ["one:1", "two:99"]), ("n2", ["x:1"]), ("n3", ["y:1"]), ("n4", ["z:1"])], "stable_id string, source_keys array<string>")
    kept = {r["source_keys"][0]: r["stable_id"] for r in history.reconcile(before, after).collect()}
    assert kept == {"one:1": "old", "x:1": "tie", "y:1": "n3", "z:1": "n4"}


def test_incremental_counts(spark):
    rows = lambda r: spark.createDataFrame([(f"p{i}", str(v)) for i, v in r], "stable_id string, phone string")
    first, second = rows((i, 0) for i in range(100)), rows([(i, 1) for i in range(20, 70)] + [(i, 0) for i in range(70, 150)])
    got = {r["change"]: r["count"] for r in history.change_set(first, second).groupBy("change").count().collect()}
    assert got == {"added": 50, "updated": 50, "removed": 20, "unchanged": 30}


def test_review_corpus_hash():
    proper = ("Al Nakheel", "Olympia", "Amavita", "Olaya", "King Fahd", "Riyadh", "Zurich", "Zyrol", "Meridian", "Solara")
    kinds = {"pharmacy": "Pharmacy", "clinic": "Clinic", "hospital": "Hospital", "school": "School", "amenity_restaurant": "Restaurant", "tourism_hotel": "Hotel", "amenity_place_of_worship": "Mosque", "shop_bakery": "Bakery", "amenity_bank": "Bank", "amenity_atm": "ATM"}
    entries = []
    for category, kind in kinds.items():
        for p in proper:
            name = f"{p} {kind}"
            key = hashlib.sha256(f"{category}:{name}".encode()).hexdigest()[:16]
            r = enrich(name, None, category, f"review_fixture:{key}")
            entries.append({
                "id": key, "source": "project_authored_review_fixture", "source_name": name, "generated_arabic_name": r["name_ar"], "category": category, "transformation_method": r["name_ar_method"],
                "transformation_version": r["name_ar_version"], "confidence": r["name_ar_confidence"], "provenance": r["provenance_name_ar"], "review_reason": r["review_reason"],
                "reviewer": None, "review_status": "NOT_REVIEWED", "rating": None,
            })
    corpus = {"dataset_kind": "project_authored_synthetic_review_examples", "official_status": "NOT_CERTIFIED", "human_review_status": "NOT_REVIEWED", "enrichment_version": "rules-v3", "count": 100, "entries": entries}
    text = json.dumps(corpus, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert hashlib.sha256(text.encode()).hexdigest() == "cc43efb2920ebd21234b5c721f9c26eef5d72ac1287ac8fb8b0fd5bbe0296ec8"
    assert sum(e["confidence"] < 0.6 for e in entries) == 30


def test_names():
    assert generate("Al Nakheel Hospital", "hospital", "ar")[0] == "مستشفى النخيل"
    assert generate("Olympia Apotheke", "pharmacy", "ar")[0] == "صيدلية أوليمبيا"
    assert generate("صيدلية النخيل", "pharmacy", "en")[0] == "Al Nakheel Pharmacy"
    assert generate("صراف النخيل الآلي", "amenity_atm", "en")[0] == "Al Nakheel ATM"
    assert generate("Hotel Pharmacy", "pharmacy", "ar")[0] is None
    assert enrich("A", "ب", "pharmacy", "k")["review_reason"] is None
    assert enrich(None, "​", "pharmacy", "k")["name_status"] == "unnamed_source"
    assert clean_name("​‎\t") is None and clean_name(5) is None and arabic_key("کریم") == arabic_key("كريم")
    for bad in (None, " ", "​", "123 !", "�A", "A\x00", "صيدلية"):
        assert not has_script(bad, "en")
    assert has_script("Ａbc", "en") and has_script("ب‏", "ar")
    assert name_key("Al Nakheel Pharmacy") == "nkhl" and name_key("صيدلية النخيل") == "nkhl" and name_key(None) == ""
    tags = resolve_tags({"name": "صيدلية;Olaya", "alt_name:en": "Old ; New", "official_name:en": "​"}, "s:1")
    assert (tags["name_en"], tags["name_ar"], tags["provenance_name_en"]) == ("Old", "صيدلية", "s:1:tags.alt_name:en")
    assert set(tags["alternate_names"]) == {"New", "Olaya"} and resolve_tags(None, "s:1")["name_status"] == "unnamed_source"


def test_phone_digits(spark):
    row = spark.createDataFrame([("+966 (11) ٤",), (None,)], "p string").select(phone_digits(F.col("p")).alias("d")).collect()
    assert [r["d"] for r in row] == ["96611٤", ""]


def test_areas(spark):
    area = areas.polygon_area({"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]], [[1, 1], [1.8, 1], [1.8, 1.8], [1, 1.8], [1, 1]]], [[[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]]]})
    pts = spark.createDataFrame([("in", 0.5, 0.5), ("hole", 1.5, 1.5), ("part", 5.5, 5.5), ("out", 4.5, 4.5), ("edge", 0.0, 1.0), ("null", None, 1.0)], "k string, lat double, lon double")
    assert {r["k"] for r in pts.filter(areas.inside(area, F.col("lat"), F.col("lon"))).collect()} == {"in", "part", "edge"}
    assert areas.near_box(0, 0, 111_320)["bounds"] == (-1.0, -1.0, 1.0, 1.0)
    for bad in ({"type": "Point", "coordinates": [0, 0]}, {"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [2, 2]]]}, {"type": "FeatureCollection", "features": []}):
        with pytest.raises(ValueError):
            areas.polygon_area(bad)
    with pytest.raises(ValueError):
        areas.box_area(2, 0, 1, 1)


def test_routing_and_gates(spark):
    raw = spark.createDataFrame([("s", "1", "x", "1"), ("s", "1", "pharmacy", "1"), ("s", "200", "pharmacy", "1"), ("s", "1", "clinic", "1"), ("s", None, "spam", "1")], "source string, lat string, category string, lon string")
    got = sorted((r["category"], r["status"], r["reason"] or "") for r in route(raw, taxonomy(spark), ["pharmacy"]).collect())
    assert got == [("clinic", "dropped", ""), ("pharmacy", "accepted", ""), ("pharmacy", "review", "no usable coordinates"), ("spam", "review", "unmapped category spam"), ("x", "review", "unmapped category x")]
    reg = spark.createDataFrame([("a", ["internal", "commercial"], True, [0.0, 0.0, 9.0, 9.0]), ("b", ["commercial"], False, None), ("c", ["commercial"], True, [0.0, 0.0, 1.0, 1.0])], "name string, allowed_uses array<string>, commercial_use boolean, coverage_bbox array<double>")
    got = {r["name"]: r["refused"] is None for r in admitted_sources(reg, "commercial", (0.0, 0.0, 2.0, 2.0)).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_registry_and_readers(spark, tmp_path):
    good = {"name": "a", "kind": "fixture", "path": "x.json", "license": "L", "allowed_uses": ["internal"], "commercial_use": True, "auth_mode": "none", "coverage_bbox": None, "freshness": "f", "attribution": "A", "rate_limit_per_second": 1, "reliability_weight": 0.5}
    path = tmp_path / "sources.json"
    path.write_text(json.dumps({"sources": [good]}))
    assert load_registry(spark, str(path)).count() == 1
    path.write_text(json.dumps({"sources": [good, {**good, "reliability_weight": 2, "auth_mode": "key", "allowed_uses": ["resale"]}]}))
    with pytest.raises(ValueError, match="duplicate name"):
        load_registry(spark, str(path))
    assert checked(spark.createDataFrame([], "name string, kind string, path string, endpoint string, license string, allowed_uses array<string>, commercial_use boolean, auth_mode string, coverage_bbox array<double>, freshness string, attribution string, rate_limit_per_second double, reliability_weight double")).count() == 0
    (tmp_path / "r.json").write_text(json.dumps([{"id": "1", "lat": 1.0, "name_en": "x"}, {"id": "2"}]))
    assert [r["id"] for r in read_records(spark, str(tmp_path / "r.json"), "s").orderBy("rec_ord").collect()] == ["1", "2"]
    (tmp_path / "g.json").write_text(json.dumps({"entries": [{"address": " Main St", "lat": 1.0, "lon": 2.0, "confidence": 0.9}, {"address": "Twice", "lat": 1, "lon": 1}, {"address": "twice", "lat": 2, "lon": 2}]}))
    rows = spark.createDataFrame([("a", "MAIN st", None, None), ("b", "twice", None, None), ("c", "main st", 9.0, 9.0)], "id string, address string, lat double, lon double")
    got = {r["id"]: (r["lat"], r["geometry_confidence"]) for r in lookups.geocode(rows, read_catalog(spark, str(tmp_path / "g.json"))).collect()}
    assert got == {"a": (1.0, 0.5), "b": (None, None), "c": (9.0, None)}
    (tmp_path / "p.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"properties": {"id": "x", "name": "Olaya", "aliases": ["العليا"]}, "geometry": {"type": "Point"}}]}))
    assert {r["name"] for r in read_places(spark, str(tmp_path / "p.json")).collect()} == {"Olaya", "العليا"}


def test_payload(spark):
    el = lambda t, i, tags, lat=None, center=None: {"type": t, "id": i, "lat": lat, "lon": lat, "center": center, "version": 1, "timestamp": None, "tags": tags}
    elements = [el("node", 1, {"amenity": "pharmacy", "name": "X", "addr:city": "R"}, 1.0), el("way", 2, {"amenity": "clinic"}, None, {"lat": 2.0, "lon": 2.0}), el("node", 3, {"amenity": "bench"}, 1.0), el("node", 4, {"amenity": "pharmacy", "shop": "bakery"}, 1.0)]
    df = spark.createDataFrame([({"timestamp_osm_base": "t"}, None, None, elements)], PAYLOAD)
    cats = ["pharmacy", "clinic", "shop_bakery"]
    got = {r["id"]: r for r in parse_payload(df, taxonomy(spark), cats, "m").collect()}
    assert set(got) == {"node/1", "way/2", "node/4"} and got["node/1"]["name_en"] == "X" and got["node/1"]["address"] == "R"
    assert got["way/2"]["lat"] is None and got["node/4"]["category_review_reason"].startswith("Ambiguous")
    derived = {r["id"]: r for r in parse_payload(df, taxonomy(spark), cats, "m", True).collect()}["way/2"]
    assert derived["lat"] == 2.0 and derived["geometry_derived"] and derived["geometry_confidence"] == 0.35
    broken = spark.createDataFrame([({"timestamp_osm_base": "t"}, "timeout", None, [])], PAYLOAD)
    with pytest.raises(Exception, match="incomplete"):
        parse_payload(broken, taxonomy(spark), cats, "m").collect()


def test_robots(spark):
    def may(lines, url, agent="bot/1"):
        return robots.allowed(spark.createDataFrame([(url,)], "u string"), "u", lines, agent).first()["allowed"]

    star = ["User-agent: *", "Disallow: /*.json$"]
    assert not may(star, "http://x/data.json") and may(star, "http://x/data.json?x=1")
    assert may(["User-agent: *", "Disallow: /a", "Allow: /a/b"], "http://x/a/b/c") and may(["User-agent: *", "Allow: /a", "Disallow: /a"], "http://x/a")
    assert not may(["User-agent: *", "Disallow: /%41"], "http://x/A") and may(["User-agent: *", "Disallow: /"], "http://x/robots.txt")
    assert may(["User-agent: *", "Disallow: /", "User-agent: bot", "Disallow: /private"], "http://x/open") and may([], "http://x/")


def test_snapshot_rules(spark):
    state = "source string, endpoint string, query_hash string, timestamp timestamp, dataset_hash string"
    import datetime as dt

    t = dt.datetime(2026, 1, 2)
    store = spark.createDataFrame([("s", "e", "q", t, "h")], state)
    cases = [("s", "e", "q", t + dt.timedelta(1), "x"), ("s", "e", "q", t, "h"), ("s", "e", "q", t, "other"), ("s", "e", "q", t - dt.timedelta(1), "h"), ("s", "e", "q", None, "h"), ("s", "z", "q", t, "h"), ("s", "e", "new", None, "h"), ("s", "e", "new2", t, "h")]
    decided = snapshots.decide(spark.createDataFrame(cases, state), store)
    got = [r["decision"] for c in cases for r in decided.collect() if tuple(r)[:5] == c]
    assert got == ["NEWER_SNAPSHOT", "EQUAL_SNAPSHOT", "ERROR equal timestamp, other data", "ERROR older", "ERROR missing timestamp", "ERROR endpoint differs", "UNVERIFIED_TIMESTAMP", "NEWER_SNAPSHOT"]
    assert {(r["query_hash"], r["timestamp"]) for r in snapshots.accept(store, decided).collect()} == {("q", t + dt.timedelta(1)), ("new2", t)}
    texts = spark.createDataFrame([("2026-01-01T00:00:00Z",), ("2026-01-01T00:00:00",), ("x",), (None,)], "t string")
    assert [r["m"] for r in texts.select(snapshots.malformed(F.col("t")).alias("m")).collect()] == [False, True, True, False]
    rows = spark.range(2000).selectExpr("id", "cast(id as string) v", "id % 2 g")
    one, two = (snapshots.dataset_hash(d, ["g"], ["id", "v"]).orderBy("g").collect() for d in (rows, rows.repartition(7)))
    assert one == two and one != snapshots.dataset_hash(rows.withColumn("v", F.lit("x")), ["g"], ["id", "v"]).orderBy("g").collect()


def test_snapshot_stream(spark, tmp_path):
    import datetime as dt

    t = dt.datetime(2026, 1, 2)
    schema = "query_hash string, timestamp timestamp, dataset_hash string"
    stream = judged_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")) if (tmp_path / "in").mkdir() is None else None)
    query = stream.writeStream.format("memory").queryName("judged").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    for row in (("q", t, "h"), ("q", t - dt.timedelta(1), "x"), ("q", t, "h"), ("q", t, "z"), ("q", t + dt.timedelta(1), "n")):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query.processAllAvailable()
    query.stop()
    said = [r["decision"] for r in spark.table("judged").collect()]
    assert said == ["NEWER_SNAPSHOT", "ERROR older", "EQUAL_SNAPSHOT", "ERROR equal timestamp, other data", "NEWER_SNAPSHOT"]


def test_layer(spark):
    rows = lambda *r: spark.createDataFrame([(k, x, x, p, "s:1") for k, x, p in r], "stable_id string, longitude double, latitude double, phone string, geometry_provenance string")
    one = layer.upsert_layer(None, rows(("b", 1.0, "1"), ("a", 2.0, "2")))
    two = layer.upsert_layer(one, rows(("b", 1.0, "9"), ("c", 3.0, None)))
    three = layer.upsert_layer(two, rows(("a", 2.0, "2"), ("d", 1.0, "")))
    pick = lambda df: sorted((r["id"], r["stable_id"], r["is_active"], r["phone"]) for r in df.collect())
    assert pick(one) == [(1, "a", True, "2"), (2, "b", True, "1")]
    assert pick(two) == [(1, "a", False, "2"), (2, "b", True, "9"), (3, "c", True, None)]
    assert pick(three) == [(1, "a", True, "2"), (2, "b", False, "9"), (3, "c", False, None), (4, "d", True, "")]
    check = layer.verify_layer(rows(("a", 2.1, "2"), ("d", 1.0, "")), three).first().asDict()
    assert check == {"expected": 2, "published": 2, "missing": 0, "surplus": 0, "moved": 1, "without_provenance": 0}
    assert layer.public_columns(spark.createDataFrame([("a", None, " ", False, [])], "stable_id string, a string, b string, c boolean, d array<string>")) == ["stable_id", "c"]
    merged = merge_clusters(with_ordinals(canon(spark, [at("s0", "1:2", phone="1")])).withColumn("cluster", F.col("rec")))
    row = layer.published_rows(merged).first()
    assert (row["primary_source"], row["primary_source_id"], row["source_keys"], row["is_demo"]) == ("s0", "1:2", '["s0:1:2"]', False)
    feature = json.loads(layer.geojson_features(merged).first()["feature"])
    assert feature["geometry"]["coordinates"][0] == 46.7 and feature["properties"]["provenance_phone"] == "s0:1:2" and "lat" not in feature["properties"]


def test_reports(spark):
    pairs = lambda *p: spark.createDataFrame(list(p), "a string, b string")
    q = reports.pair_quality(pairs(("a", "b")), pairs(("a", "c"))).first()
    assert (q["true_pairs"], q["false_pairs"], q["missed_pairs"], q["f1"]) == (0, 1, 1, 0.0)
    assert reports.pair_quality(pairs(), pairs()).first()["precision"] == 1.0
    merged = merge_clusters(canon(spark, [at("s0", "1", name_ar="صيدلية"), at("s0", "2")]).withColumn("cluster", F.col("source_key")))
    r = reports.bilingual_counts(merged).first()
    assert (r["total"], r["valid_bilingual"], r["authoritative"], r["authoritative_fraction"]) == (2, 1, 1, 0.5)
    assert reports.bilingual_counts(merged.limit(0)).first()["authoritative_fraction"] is None
    cover = {r["provider"]: r for r in reports.crosswalk_coverage(taxonomy(spark)).collect()}
    assert cover["osm_tags"]["leaf_coverage"] == 1.0 and cover["osm_tags"]["ambiguous_count"] == 0
    data = spark.createDataFrame([(str(i),) for i in range(100)], "id string")
    rated = spark.createDataFrame([(str(i), "ACCEPTED" if i else "REJECTED") for i in range(100)], "id string, rating string")
    s = reports.review_score(data, rated).first()
    assert (s["accepted"], s["rejected"], s["complete"]) == (99, 1, True) and not reports.review_score(data, rated.limit(5)).first()["complete"]
    assert reports.unlabelled(spark.createDataFrame([("x",)], "source_key string"), spark.createDataFrame([("y",)], "source_key string")).count() == 1
