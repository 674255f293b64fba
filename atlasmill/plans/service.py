"""One call for a whole request: what is missing is asked for, what fails is named, what is done is written and counted."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.functions.intent import intent, vocabulary
from atlasmill.operators.areas import near_box
from atlasmill.plans.pipeline import Request, read_manifest, run, verify_run, write_run
from atlasmill.sources.records import read_places
from atlasmill.sources.registry import load_registry
from atlasmill.sources.taxonomy import taxonomy


def _asked(payload: dict, words: dict[str, str]) -> dict:
    """The request of a payload: its own fields, filled up from its text."""
    said = intent(payload["text"], words) if payload.get("text") else {}
    return {k: payload.get(k) or said.get(k) for k in ("categories", "area", "radius_m")} | {"use": payload.get("use") or "internal"}


def find_area(spark: SparkSession, asked: dict, places: str | None) -> tuple[tuple | str | None, dict | None]:
    """(area, question): a box or GeoJSON as given, else the one place of the catalogue that has the name; a question if it is not exactly one."""
    area = asked["area"]
    if isinstance(area, (list, tuple)):
        return tuple(map(float, area)), None
    if not area or area.lstrip().startswith("{"):
        return area or None, None if area else {"field": "area_of_interest", "question": "Which area?"}
    if places is None:
        return None, {"field": "area_of_interest", "question": f"No catalogue of places to look {area!r} up in."}
    met = read_places(spark, places).filter(F.lower(F.trim("name")) == area.strip().lower()).select("key", "geometry").distinct().limit(2).collect()
    if len(met) != 1:
        return None, {"field": "area_of_interest", "question": f"{'Several places are' if met else 'No place is'} called {area!r}."}
    return met[0]["geometry"], None


def invoke(spark: SparkSession, payload: dict, registry: str, out: str, places: str | None = None, previous: str | None = None) -> dict:
    """{'status': 'completed' | 'needs_input' | 'failed', ...} for a payload of text, categories, area (S, W, N, E or GeoJSON or a name) and use.

    Missing categories or an area that is not exactly one place are asked for, and nothing is read. A refused or unknown source, a broken previous
    run or a bad request fails with its reason, and leaves nothing behind. A completed run names its folder, its counts and its hashes.
    """
    leaves = taxonomy(spark)
    listed = leaves.select("id", "label_en").collect()
    asked = _asked(payload, vocabulary([(r["id"], r["label_en"]) for r in listed]))
    questions = [] if asked["categories"] else [{"field": "category", "question": "Which categories?"}]
    try:
        area, question = find_area(spark, asked, places)
        questions += [question] if question else []
        if questions:
            return {"status": "needs_input", "questions": questions}
        request = Request(area, tuple(asked["categories"]), asked["use"], known=tuple(r["id"] for r in listed))
        if previous and verify_run(spark, previous):
            raise ValueError("the previous run is not intact")
        from atlasmill.__main__ import read_sources

        raw, rows = read_sources(spark, registry, payload.get("sources"))
        write_run(run(raw, rows, leaves, request, spark.read.parquet(f"{previous}/records") if previous else None), out)
    except (ValueError, OSError, KeyError) as e:
        return {"status": "failed", "reason": str(e)}
    hashes = read_manifest(spark, out)["hashes"]
    return {"status": "completed", "out": out, "counts": {t: spark.read.parquet(f"{out}/{t}").count() for t in ("records", "review", "excluded")}, "hashes": hashes}


def reprocess(spark: SparkSession, saved: str, out: str, taxonomy_: DataFrame | None = None) -> dict:
    """A saved capture run again with today's rules under its own request, its ids kept; reviews of both runs are put together.

    The capture must be intact. Returns the counts of changes against the saved records.
    """
    if verify_run(spark, saved):
        raise ValueError("the saved run is not intact")
    asked = read_manifest(spark, saved)["request"]
    area = asked["area"] if isinstance(asked["area"], str) else tuple(asked["area"])
    request = Request(area, tuple(asked["categories"]), asked["use"], asked["version"])
    again = run(spark.read.parquet(f"{saved}/capture"), spark.read.parquet(f"{saved}/sources"), taxonomy_ or taxonomy(spark), request, spark.read.parquet(f"{saved}/records"))
    again.tables["review"] = again.tables["review"].unionByName(spark.read.parquet(f"{saved}/review")).distinct()
    write_run(again, out)
    return {r["change"]: r["count"] for r in spark.read.parquet(f"{out}/changes").groupBy("change").count().collect()}


def area_near(lat: float, lon: float, radius_m: float) -> tuple[float, float, float, float]:
    """The box (S, W, N, E) around a point that holds everything within radius_m."""
    return near_box(lat, lon, radius_m)["bounds"]


def registry_names(spark: SparkSession, registry: str) -> list[str]:
    """Names of the sources of a registry file, for a front end to choose from."""
    return [r["name"] for r in load_registry(spark, str(Path(registry))).select("name").collect()]
