"""Raw records of licence-gated sources to canonical ones: gates, routing and projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields merged one by one, in the order in which reports list them.
# Names of the fields that records of all sources share.
MERGE_FIELDS = (
    "name_en", "name_ar", "category", "phone", "email", "address", "hours", "source_category", "website",
    "address_street", "address_city", "address_region", "address_postcode", "address_country", "footprint_ref",
)
#: Optional fields carried over as they are.
CARRIED = (
    "name_status", "missing_name_reason", "geometry_derivation", "name_en_source_field", "name_ar_source_field", "name_normalization_version",
    "original_name_en", "original_name_ar", "name_en_method", "name_en_version", "name_ar_method", "name_ar_version",
)
CARRIED_TYPED = {"geometry_derived": "boolean", "geometry_confidence": "double", "name_en_generated": "boolean", "name_ar_generated": "boolean", "name_en_confidence": "double", "name_ar_confidence": "double"}


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def licence_reason(use: str) -> Column:
    """Why a source row may not serve a use, null if it may. Commercial use and redistribution both need the commercial flag."""
    commercial = F.lit(use in ("commercial", "redistribute")) & ~F.coalesce("commercial_use", F.lit(False))
    listed = F.coalesce(F.array_contains("allowed_uses", use), F.lit(False))
    return F.when(commercial, F.lit(f"commercial use is not licensed for {use}")).when(~listed, F.lit(f"{use} is not among the allowed uses"))


def covers(west: float, south: float, east: float, north: float) -> Column:
    """Whether a source's coverage_bbox (W, S, E, N; null is everywhere) holds a box wholly."""
    b = F.col("coverage_bbox")
    return b.isNull() | ((b[0] <= west) & (b[1] <= south) & (b[2] >= east) & (b[3] >= north))


def admitted_sources(registry: DataFrame, use: str, box: tuple[float, float, float, float]) -> DataFrame:
    """The registry with `refused`: the licence's reason, else that the box is not covered, else null."""
    return registry.withColumn("refused", F.coalesce(licence_reason(use), F.when(~covers(*box), F.lit("the area is not wholly covered"))))


def route(raw: DataFrame, categories: DataFrame, wanted: list[str]) -> DataFrame:
    """raw with `status`: 'review' with a `reason` (flagged geometry or category, then unmapped category, bad coordinates), 'dropped'
    (a category not asked for), else 'accepted'. The category is judged before coordinates are. categories: one column `id`, broadcast by its size."""
    known = categories.select(F.col("id").alias("category"), F.lit(True).alias("_known")).distinct()
    flagged = F.coalesce(column_or_null(raw, "geometry_review_reason"), column_or_null(raw, "category_review_reason"))
    lat, lon = F.expr("try_cast(lat as double)"), F.expr("try_cast(lon as double)")
    placed = F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))
    mapped = F.col("_known").isNotNull()
    reason = (
        F.when(flagged.isNotNull(), flagged)
        .when(~mapped, F.concat(F.lit("unmapped category "), F.coalesce("category", F.lit("null"))))
        .when(F.col("category").isin(wanted) & ~placed, F.lit("no usable coordinates"))
    )
    out = raw.join(known, "category", "left").withColumn("reason", reason).drop("_known")
    return out.withColumn("status", F.when(F.col("reason").isNotNull(), "review").when(~F.col("category").isin(wanted), "dropped").otherwise("accepted"))


def canonicalize(accepted: DataFrame, registry: DataFrame) -> DataFrame:
    """One canonical row per accepted row: source_key, confidence, provenance of every non-null field, licence and attribution of its source."""
    rules = registry.select(
        F.col("name").alias("source"), F.col("kind").alias("_kind"), F.coalesce("reliability_weight", F.lit(0.5)).alias("_weight"), "attribution", "license"
    )
    key = F.concat_ws(":", "source", "id")
    named = {c: column_or_null(accepted, c) for c in MERGE_FIELDS}
    rows = accepted.drop("attribution", "license").join(rules, "source")
    noted = F.map_from_entries(
        F.filter(
            F.array(*(F.struct(F.lit(c).alias("key"), F.when(v.isNotNull(), F.coalesce(column_or_null(accepted, f"provenance_{c}"), key)).alias("value")) for c, v in named.items())),
            lambda e: e["value"].isNotNull(),
        )
    )
    return rows.select(
        key.alias("source_key"),
        "source",
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        *(v.alias(c) for c, v in named.items()),
        F.coalesce(column_or_null(accepted, "alternate_names", "array<string>"), F.array().cast("array<string>")).alias("alternate_names"),
        F.coalesce(column_or_null(accepted, "geometry_method"), F.when(F.col("_kind") == "fixture", "fixture_synthetic").otherwise("source_point")).alias("geometry_method"),
        F.coalesce(column_or_null(accepted, "harvested_at"), F.lit("")).alias("harvested_at"),
        F.least(F.col("_weight"), F.coalesce(column_or_null(accepted, "geometry_confidence", "double"), F.lit(1.0))).alias("confidence"),
        "attribution",
        "license",
        column_or_null(accepted, "geometry_attribution").alias("geometry_attribution"),
        column_or_null(accepted, "geometry_license").alias("geometry_license"),
        noted.alias("provenance"),
        F.coalesce(column_or_null(accepted, "geometry_provenance"), key).alias("geometry_provenance"),
        *(column_or_null(accepted, c).alias(c) for c in CARRIED),
        *(column_or_null(accepted, c, t).alias(c) for c, t in CARRIED_TYPED.items()),
    )
