"""The load probe: a grid of invented places through a whole run, timed by phase."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.operators.canonical import canonicalize
from atlasmill.operators.conflate import conflate
from atlasmill.operators.history import change_set, reconcile
from atlasmill.operators.merge import merge_clusters
from atlasmill.session import materialize
from atlasmill.sinks.layer import geojson_features

SOURCE = "name string, kind string, reliability_weight double, attribution string, license string"


def grid(spark: SparkSession, rows: int = 10_000, across: int = 100, step: float = 0.01) -> DataFrame:
    """rows places with an English name, `across` of them at a latitude, `step` degrees apart; none lies within 75 m of another."""
    i = F.col("id")
    number = i.cast("string")
    return spark.range(rows).select(
        F.lit("grid").alias("source"), F.concat(F.lit("g"), number).alias("id"), (F.lit(10.0) + F.floor(i / across) * step).alias("lat"), (F.lit(20.0) + (i % across) * step).alias("lon"),
        F.concat(F.lit("Place "), number, F.lit(" Pharmacy")).alias("name_en"), F.lit("pharmacy").alias("category"),
    )


def probe(spark: SparkSession, rows: int = 10_000) -> dict:
    """Seconds of the phases (records, places, artifacts), places and features an hour of a run over the grid."""
    sources = spark.createDataFrame([("grid", "fixture", 0.9, "A", "L")], SOURCE)
    took, began = {}, time.perf_counter()

    def done(phase: str) -> None:
        nonlocal began
        took[phase], began = round(time.perf_counter() - began, 3), time.perf_counter()

    records = materialize(canonicalize(grid(spark, rows), sources), "records")
    done("records")
    places = materialize(merge_clusters(conflate(records)[0]), "places")
    places = materialize(reconcile(places, places), "kept")
    done("places")
    n = materialize(geojson_features(places), "features").count()
    unchanged = change_set(places, places).filter("change = 'unchanged'").count()
    done("artifacts")
    return {"places": n, "unchanged": unchanged, "seconds": took, "features_per_hour": round(n / sum(took.values()) * 3600)}
