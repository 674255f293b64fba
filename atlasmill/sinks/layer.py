"""Published layers: row projection, column pruning by content, upsert with soft delete, verification, GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from atlasmill.operators.canonical import MERGE_FIELDS
from atlasmill.session import materialize
from atlasmill.tables import small

#: Columns that are public even where they are empty.
ALWAYS = ("stable_id", "longitude", "latitude", "primary_source", "primary_source_id", "name_en", "name_ar", "category", "phone", "address", "confidence", "source_keys", "attributions", "licenses", "geometry_provenance", "geometry_method", "is_demo")


def published_rows(merged: DataFrame, demo: bool = False) -> DataFrame:
    """One typed row per place: lists as JSON text, the first source key split at its first colon, flags without nulls."""
    first = F.coalesce(F.get("source_keys", F.lit(0)), F.lit(""))
    flag = lambda *c: F.coalesce(*c, F.lit(False))
    text = lambda c: F.to_json(F.coalesce(F.col(c), F.array().cast("array<string>"))).alias(c)
    return merged.select(
        "stable_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"),
        F.nullif(F.substring_index(first, ":", 1), F.lit("")).alias("primary_source"), F.nullif(F.regexp_replace(first, "^[^:]*:?", ""), F.lit("")).alias("primary_source_id"),
        *MERGE_FIELDS, "original_name_en", "original_name_ar",
        *((flag(F.col(f"name_{x}_generated")) | (F.coalesce(F.col(f"name_{x}_method"), F.lit("")) != "")).alias(f"name_{x}_generated") for x in ("en", "ar")),
        *(f"name_{x}_{s}" for x in ("en", "ar") for s in ("method", "version", "confidence")),
        text("alternate_names"), "harvested_at", "confidence", "language_complete", "name_status", "missing_name_reason",
        (flag(F.col("geometry_derived")) | (F.coalesce("geometry_method", F.lit("")) == "geocode_derived")).alias("geometry_derived"),
        F.coalesce("geometry_confidence", "confidence").alias("geometry_confidence"), "geometry_derivation",
        text("source_keys"), text("attributions"), text("licenses"), "geometry_provenance",
        F.coalesce("geometry_method", F.lit("fixture_synthetic" if demo else "source_point")).alias("geometry_method"), F.lit(demo).alias("is_demo"),
        *(F.col("provenance")[c].alias(f"provenance_{c}") for c in MERGE_FIELDS),
    )


def has_value(df: DataFrame, c: str) -> Column:
    """Whether a value says something: not null, not blank, not an empty list or map; false and 0 do."""
    kind = df.schema[c].dataType
    if isinstance(kind, StringType):
        return F.coalesce(~F.trim(F.col(c)).isin("", "[]", "{}"), F.lit(False))
    if isinstance(kind, (ArrayType, MapType)):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return F.col(c).isNotNull()


def value_counts(df: DataFrame) -> DataFrame:
    """One row: how many rows of each column say something."""
    return df.agg(*(F.count_if(has_value(df, c)).alias(c) for c in df.columns))


def public_columns(df: DataFrame, always: tuple[str, ...] = ALWAYS) -> list[str]:
    """Columns that are always public or say something in at least one row (one pass; one row comes to the driver)."""
    n = value_counts(df).first()
    return [c for c in df.columns if c in always or n[c]]


def upsert_layer(layer: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The layer after a run: id, is_active and the rows' columns. Known places keep their id, new ones get the next numbers in order of
    stable_id, places that are gone stay with their last values, inactive.

    Numbers are given without a global sort in one task: each range of stable_id counts its own rows, and the counts (one per range)
    are summed on the driver.
    """
    spark = rows.sparkSession
    columns = rows.columns
    start, fresh = 0, rows
    if layer is not None:
        start = layer.agg(F.max("id")).first()[0] or 0
        fresh = rows.join(layer.select("stable_id").hint("merge"), "stable_id", "left_anti")
    # Written down: the ranges are drawn from a sample, and another run of them could cut elsewhere between the count and the numbering.
    ranged = materialize(fresh.select("stable_id").distinct().repartitionByRange("stable_id").withColumn("_part", F.spark_partition_id()), "ranges")
    before, total = [], start
    for r in sorted(ranged.groupBy("_part").count().collect()):
        before.append((r["_part"], total))
        total += r["count"]
    offsets = spark.createDataFrame(before or [(0, start)], "_part int, _before long")
    numbered = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy("stable_id"))).join(small(offsets), "_part")
    ids = numbered.select("stable_id", (F.col("_before") + F.col("_n")).cast("long").alias("id"))
    if layer is None:
        return rows.join(ids.hint("merge"), "stable_id").select("id", F.lit(True).alias("is_active"), *columns)
    ids = layer.select("stable_id", "id").unionByName(ids)
    now = rows.join(ids.hint("merge"), "stable_id").select("id", F.lit(True).alias("is_active"), *columns)
    gone = layer.join(rows.select("stable_id").hint("merge"), "stable_id", "left_anti").withColumn("is_active", F.lit(False))
    return now.unionByName(gone.select("id", "is_active", *(c for c in columns if c in layer.columns)), allowMissingColumns=True)


def verify_layer(rows: DataFrame, layer: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """One row of checks of a layer against what was to be published: counts, ids on one side only, positions off, provenance missing."""
    a = rows.select("stable_id", F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    b = layer.filter("is_active").select(F.col("stable_id"), F.col("longitude").alias("lx"), F.col("latitude").alias("ly"), "geometry_provenance")
    both = a.join(b.hint("merge"), "stable_id", "full_outer")
    return both.agg(
        F.count_if(F.col("x").isNotNull()).alias("expected"), F.count_if(F.col("lx").isNotNull()).alias("published"),
        F.count_if(F.col("lx").isNull()).alias("missing"), F.count_if(F.col("x").isNull()).alias("surplus"),
        F.count_if((F.abs(F.col("x") - F.col("lx")) > tolerance) | (F.abs(F.col("y") - F.col("ly")) > tolerance)).alias("moved"),
        F.count_if(F.col("lx").isNotNull() & (F.coalesce("geometry_provenance", F.lit("")) == "")).alias("without_provenance"),
    )


def geojson_features(merged: DataFrame) -> DataFrame:
    """stable_id, feature: each place as a GeoJSON Feature; provenance is flattened into the properties."""
    plain = [c for c in merged.columns if c not in ("lat", "lon", "provenance")]
    notes = [F.col("provenance")[c].alias(f"provenance_{c}") for c in (*MERGE_FIELDS, "name_status")]
    feature = F.struct(
        F.lit("Feature").alias("type"), F.col("stable_id").alias("id"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"), F.struct(*plain, *notes).alias("properties"),
    )
    return merged.select("stable_id", F.to_json(feature).alias("feature"))
