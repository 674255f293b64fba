import pytest
from pyspark.sql import functions as F

from atlasmill.functions.intent import categories_in, intent, plural, vocabulary
from atlasmill.plans.pipeline import Request, replay, run, verify_run, write_run
from atlasmill.sources.taxonomy import taxonomy

REGISTRY = "name string, kind string, allowed_uses array<string>, commercial_use boolean, coverage_bbox array<double>, attribution string, license string, reliability_weight double"
RAW = "source string, id string, lat string, lon string, category string, name_en string, name_ar string, phone string"
ROWS = [
    ("a", "1", "24.71", "46.70", "pharmacy", "Nakheel Pharmacy", None, "1111111"), ("b", "1", "24.71001", "46.70", "pharmacy", None, "صيدلية النخيل", "1111111"),
    ("a", "2", "24.72", "46.70", "spaceport", "X", None, None), ("a", "3", "99", "46.70", "pharmacy", "X", None, None), ("a", "4", "28.0", "46.70", "pharmacy", "Far", None, None),
    ("a", "5", "24.73", "46.70", "clinic", "Y", None, None), ("closed", "1", "24.74", "46.70", "pharmacy", "Z", None, None), ("a", "6", "24.75", "46.70", "pharmacy", None, None, None),
]


@pytest.fixture(scope="module")
def inputs(spark):
    reg = spark.createDataFrame([("a", "fixture", ["internal"], True, None, "A", "L", 0.9), ("b", "fixture", ["internal"], True, [46.0, 24.0, 47.0, 25.0], "B", "M", 0.5), ("closed", "fixture", ["commercial"], True, None, "C", "N", 0.9)], REGISTRY)
    return spark.createDataFrame(ROWS, RAW), reg, taxonomy(spark)


BOX = (24.6, 46.6, 24.8, 46.8)


def test_run_write_verify_replay(spark, inputs, tmp_path):
    raw, reg, tax = inputs
    result = run(raw, reg, tax, Request(BOX, ("pharmacy", "pharmacy")))
    places = {tuple(r["source_keys"]): r for r in result.tables["records"].collect()}
    assert set(places) == {("a:1", "b:1"), ("a:6",)}
    one = places["a:1", "b:1"]
    assert one["name_ar"] == "صيدلية النخيل" and one["provenance"]["name_ar"] == "b:1" and one["name_en"] == "Nakheel Pharmacy"
    assert places["a:6",]["name_status"] == "unnamed_source"
    assert {(r["id"], r["reason"]) for r in result.tables["review"].collect() if r["id"] in "23"} == {("2", "unmapped category spaceport"), ("3", "no usable coordinates")}
    assert [r["source"] for r in result.tables["excluded"].collect()] == ["closed"]
    path = str(tmp_path / "one")
    write_run(result, path)
    assert verify_run(spark, path) == [] and replay(spark, path, tax)
    with pytest.raises(FileExistsError):
        write_run(result, path)
    again = run(raw.filter("id <> '6'").withColumn("phone", F.lit("1111111")), reg, tax, Request(BOX, ("pharmacy", "clinic")), spark.read.parquet(f"{path}/records"))
    changes = {r["change"]: r["changed_fields"] for r in again.tables["changes"].collect()}
    assert set(changes) == {"added", "removed", "unchanged"}
    two = str(tmp_path / "two")
    write_run(again, two)
    assert replay(spark, two, tax)
    kept = spark.read.parquet(f"{two}/capture").collect()
    spark.createDataFrame(kept[:-1], spark.read.parquet(f"{two}/capture").schema).write.mode("overwrite").parquet(f"{two}/capture")
    assert verify_run(spark, two) == ["capture"] and not replay(spark, two, tax)


def test_refusals(inputs):
    raw, reg, tax = inputs
    with pytest.raises(ValueError, match="excluded"):
        run(raw, reg.filter("name = 'closed'"), tax, Request(BOX, ("pharmacy",)))
    for bad in ({"categories": ()}, {"use": "resale"}, {"categories": ("x",), "known": ("pharmacy",)}):
        with pytest.raises(ValueError):
            Request(**{"area": BOX, "categories": ("pharmacy",), **bad})


def test_intent():
    words = vocabulary([("pharmacy", "Pharmacy"), ("clinic", "Clinic"), ("amenity_fast_food", "Fast Food"), ("amenity_cafe", "Cafe"), ("shop_perfumery", "Perfumery")])
    assert categories_in("Fast food and pharmacies, please", words) == ("amenity_fast_food", "pharmacy") and categories_in("pharmacybar", words) == ()
    got = intent("كل الصيدليات والعيادات في الرياض", words)
    assert got["categories"] == ("clinic", "pharmacy") and got["area"] == "الرياض" and got["confidence"] == 0.9
    got = intent("clinics near King Fahd Road", words)
    assert got["near"] and got["radius_m"] == 500 and got["area"] == "King Fahd Road"
    assert intent("hello", words)["unresolved"] == ["category", "area_of_interest"] and plural("Perfumery") == "perfumeries" and plural("Bus") == "buses"


def test_tables_are_deleted_when_released(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from atlasmill.session import materialize, release

    one, two = (materialize(spark.range(n), "t") for n in (3, 4))
    at = [Path(urlparse(d._table_at).path) for d in (one, two)]
    assert all(p.exists() for p in at)
    release(one), release(None), release(spark.range(1))
    assert not at[0].exists() and two.count() == 4
