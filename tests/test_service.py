import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from atlasmill.operators import reports, snapshots
from atlasmill.plans.probe import grid, probe
from atlasmill.plans.service import area_near, invoke, registry_names, reprocess
from atlasmill.sources.taxonomy import taxonomy

SOURCE = {"kind": "fixture", "license": "L", "allowed_uses": ["internal"], "commercial_use": True, "auth_mode": "none", "coverage_bbox": None, "freshness": "f", "attribution": "A", "rate_limit_per_second": 1}


@pytest.fixture
def registry(tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"id": "1", "lat": 24.7, "lon": 46.7, "category": "pharmacy", "name_en": "Sidra Pharmacy"}, {"id": "2", "lat": 24.9, "lon": 46.7, "category": "pharmacy", "name_en": "Yara Pharmacy"}, {"id": "3", "lat": 24.7, "lon": 46.7, "category": "spaceport"}]))
    path = tmp_path / "sources.json"
    path.write_text(json.dumps({"sources": [{**SOURCE, "name": "one", "path": "one.json", "reliability_weight": 0.9}]}))
    return str(path)


def test_invoke_asks_fails_and_completes(spark, registry, tmp_path):
    out, catalogue = str(tmp_path / "run"), tmp_path / "places.json"
    ring = [[46.6, 24.6], [46.8, 24.6], [46.8, 24.8], [46.6, 24.8], [46.6, 24.6]]
    feature = lambda i, name: {"properties": {"id": i, "name": name, "aliases": []}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
    catalogue.write_text(json.dumps({"type": "FeatureCollection", "features": [feature("a", "Sidra Quarter"), feature("b", "Twin"), feature("c", "twin")]}))
    call = lambda **p: invoke(spark, p, registry, out, str(catalogue))
    assert [q["field"] for q in call(text="hello")["questions"]] == ["category", "area_of_interest"]
    assert call(text="pharmacies in Twin")["status"] == "needs_input" and call(text="pharmacies in Nowhere")["status"] == "needs_input"
    assert invoke(spark, {"text": "pharmacies in Twin"}, registry, out)["status"] == "needs_input"
    assert call(categories=["pharmacy"], area=[24, 46, 25, 47], use="resale")["status"] == "failed" and call(categories=["pharmacy"], area=[24, 46, 25, 47], sources=["two"])["status"] == "failed"
    done = call(text="pharmacies in sidra quarter")
    assert done["status"] == "completed" and done["counts"] == {"records": 1, "review": 2, "excluded": 0}, done
    assert call(text="pharmacies in sidra quarter")["status"] == "failed", "a run never replaces another"
    assert reprocess(spark, out, str(tmp_path / "again")) == {"unchanged": 1}
    spark.read.parquet(f"{out}/capture").limit(1).write.mode("overwrite").parquet(f"{tmp_path}/broken")
    assert registry_names(spark, registry) == ["one"] and area_near(0, 0, 111_320) == (-1.0, -1.0, 1.0, 1.0)


def test_descriptor_and_query_identity(spark):
    t = dt.datetime(2026, 1, 2)
    rows = spark.createDataFrame([("node", 1, 1, t), ("node", 2, 3, t + dt.timedelta(1)), ("way", 1, 0, t), ("node", 2, 3, t), ("node", 9, 1, t + dt.timedelta(9))], "type string, id long, version int, timestamp timestamp")
    now = F.lit(t + dt.timedelta(2)).cast("timestamp")
    faults = {(r["type"], r["id"], r["fault"]) for r in snapshots.element_faults(rows, now).collect()}
    assert faults == {("node", 2, "listed twice"), ("way", 1, "version below one"), ("node", 9, "stamped in the future")}
    asked = snapshots.query_hash("s", "e", (1.0, 2.0, 3.0, 4.0), ("b", "a", "b"))
    assert asked == snapshots.query_hash("s", "e", (1.0, 2.0, 3.0, 4.0), ("a", "b")) != snapshots.query_hash("s", "e", (1.0, 2.0, 3.0, 5.0), ("a", "b"))
    one = snapshots.descriptor(rows, "s", "e", asked, ["type", "id", "version"]).first()
    two = snapshots.descriptor(rows.repartition(3), "s", "e", asked, ["type", "id", "version"], "pinned").first()
    assert one["snapshot_id"] == two["snapshot_id"] and one["timestamp"] == t + dt.timedelta(9)
    assert snapshots.descriptor(rows.filter("id <> 9"), "s", "e", asked, ["type", "id", "version"]).first()["snapshot_id"] != one["snapshot_id"]
    assert snapshots.descriptor(rows.limit(0), "s", "e", asked, ["type"]).first()["timestamp"] is None and snapshots.element_faults(rows.limit(0), now).count() == 0


def test_field_accuracy_and_review_summary(spark):
    merged = spark.createDataFrame([(["a:1", "b:1"], {"phone": "a:1", "hours": "b:1"})], "source_keys array<string>, provenance map<string,string>")
    truth = spark.createDataFrame([("a:1", "phone", "a:1"), ("b:1", "hours", "a:1"), ("b:1", "fax", "b:1"), ("x:9", "phone", "x:9"), ("a:1", "phone", "a:1")], "source_key string, field string, expected_source_key string")
    got = {r["field"]: (r["judged"], r["correct"], r["accuracy"]) for r in reports.field_accuracy(merged, truth).collect()}
    assert got == {"phone": (2, 1, 0.5), "hours": (1, 0, 0.0), "fax": (1, 0, 0.0)}
    assert reports.field_accuracy(merged.limit(0), truth).filter("correct > 0").count() == 0
    review = spark.createDataFrame([("s", "r1"), ("s", "r1"), ("t", "r2")], "source string, reason string")
    got = {(r["source"], r["reason"]): (r["rows"], r["share"]) for r in reports.review_summary(review, spark.createDataFrame([("s",)] * 4, "source string")).collect()}
    assert got == {("s", "r1"): (2, 0.5), ("t", "r2"): (1, None)}


def test_probe_merges_nothing(spark):
    assert grid(spark, 250).agg(F.count_distinct("lat"), F.count_distinct("lon")).first() == (3, 100)
    got = probe(spark, 250)
    assert got["places"] == got["unchanged"] == 250 and got["features_per_hour"] > 0 and set(got["seconds"]) == {"records", "places", "artifacts"}
    assert taxonomy(spark).count() > 4


def test_catalogue_gate(spark, tmp_path):
    from atlasmill.sources.records import gated_catalog

    provider = {"name": "P", "license": "L", "attribution": "A", "allowed_uses": ["internal", "commercial"], "commercial_use": False}
    entry = {"address": "1 Sidra Road", "lat": 1.0, "lon": 2.0, "confidence": 0.4}

    def file(**more):
        path = tmp_path / "c.json"
        path.write_text(json.dumps({"provider": provider, "entries": [entry]} | more))
        return str(path)

    assert gated_catalog(spark, file(), "internal").count() == 1
    for path, use in ((file(), "commercial"), (file(), "redistribute")):
        with pytest.raises(ValueError, match="may not"):
            gated_catalog(spark, path, use)
    with pytest.raises(ValueError, match="twice"):
        gated_catalog(spark, file(entries=[entry, {**entry, "address": " 1 sidra ROAD"}]), "internal")
    with pytest.raises(ValueError, match="names no provider"):
        gated_catalog(spark, file(provider={**provider, "license": ""}), "internal")
