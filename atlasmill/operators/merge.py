"""One place per cluster: fields coalesced one by one by priority, with the provenance of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.operators.canonical import MERGE_FIELDS


def content_id(keys: Column) -> Column:
    """Stable id of a set of source keys: 20 hex digits of the SHA-256 of the sorted keys joined by bars."""
    return F.substring(F.sha2(F.concat_ws("|", F.array_sort(keys)), 256), 1, 20)


def _union(*columns: str) -> Column:
    parts = [F.collect_set(c) for c in columns]
    return F.array_sort(F.array_distinct(F.concat(*parts))) if len(parts) > 1 else F.array_sort(parts[0])


def merge_clusters(records: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One row per cluster. Rows rank by confidence (descending), then source_key; each field is the first non-null one in that order.

    A name of a source beats a generated one. Geometry comes from the best row alone. An empty text is a value. One shuffle: every
    aggregate is combined on the map side.
    """
    rank = F.struct(-F.col("confidence"), F.col("source_key"))
    aggs: list[Column] = [F.array_sort(F.collect_list("source_key")).alias("source_keys")]
    for c in MERGE_FIELDS:
        generated = F.coalesce(F.startswith(F.col("provenance")[c], F.lit("generated:")), F.lit(False))
        key = F.struct(generated, -F.col("confidence"), F.col("source_key")) if c in ("name_en", "name_ar") else rank
        got = [F.col(c).alias("value"), F.coalesce(F.col("provenance")[c], F.col("source_key")).alias("by")]
        if c in ("name_en", "name_ar"):
            got += [F.col(f"{c}_{s}").alias(s) for s in ("method", "version", "confidence", "generated", "source_field")] + [F.col(f"original_{c}").alias("original")]
        aggs.append(F.min_by(F.when(F.col(c).isNotNull(), F.struct(*got)), F.when(F.col(c).isNotNull(), key)).alias(f"_{c}"))
    best = ("lat", "lon", "geometry_provenance", "geometry_method", "geometry_derived", "geometry_derivation", "geometry_confidence", "name_normalization_version", "missing_name_reason")
    aggs.append(F.min_by(F.struct(*best, F.coalesce(F.col("provenance")["name_status"], F.col("source_key")).alias("status_by")), rank).alias("_best"))
    aggs += [
        F.max("harvested_at").alias("harvested_at"),
        F.max("confidence").alias("confidence"),
        _union("attribution", "geometry_attribution").alias("attributions"),
        _union("license", "geometry_license").alias("licenses"),
        F.max(F.col("name_status").isNotNull()).alias("_status"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("alternate_names")))).alias("alternate_names"),
    ]
    m = records.groupBy(cluster).agg(*aggs)
    unnamed = (F.coalesce("_name_en.value", F.lit("")) == "") & (F.coalesce("_name_ar.value", F.lit("")) == "")
    status = F.when(F.col("_status"), F.when(unnamed, "unnamed_source").otherwise("named"))
    notes = [F.struct(F.lit(c).alias("key"), F.col(f"_{c}.by").alias("value")) for c in MERGE_FIELDS]
    notes.append(F.struct(F.lit("name_status").alias("key"), F.when(status == "unnamed_source", F.col("_best.status_by")).alias("value")))
    extra = [F.col(f"_{n}.{s}").alias(f"{n}_{s}") for n in ("name_en", "name_ar") for s in ("method", "version", "confidence", "generated", "source_field")]
    return m.select(
        content_id(F.col("source_keys")).alias("stable_id"),
        "source_keys",
        *(F.col(f"_best.{c}").alias(c) for c in best[:-1]),
        *(F.col(f"_{c}.value").alias(c) for c in MERGE_FIELDS),
        *extra,
        *(F.col(f"_{n}.original").alias(f"original_{n}") for n in ("name_en", "name_ar")),
        "harvested_at",
        "confidence",
        "attributions",
        "licenses",
        F.map_from_entries(F.filter(F.array(*notes), lambda e: e["value"].isNotNull())).alias("provenance"),
        status.alias("name_status"),
        F.when(status == "unnamed_source", F.col("_best.missing_name_reason")).alias("missing_name_reason"),
        ((F.coalesce("_name_en.value", F.lit("")) != "") & (F.coalesce("_name_ar.value", F.lit("")) != "")).alias("language_complete"),
        "alternate_names",
    )
