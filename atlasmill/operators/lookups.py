"""Small reference tables joined to records: taxonomy tags, geocodes, place names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.tables import small


def lookup_key(text: Column) -> Column:
    """Trimmed and case-folded, as far as lower case folds."""
    return F.lower(F.trim(text))


def tag_categories(taxonomy: DataFrame, field: str = "osm_tags", unambiguous: bool = False) -> DataFrame:
    """tag, category of a crosswalk field; with `unambiguous` only tags of one category."""
    flat = taxonomy.select(F.explode(field).alias("tag"), F.col("id").alias("category")).distinct()
    if not unambiguous:
        return flat
    return flat.groupBy("tag").agg(F.count("*").alias("n"), F.min("category").alias("category")).filter("n = 1").select("tag", "category")


def geocode(records: DataFrame, catalog: DataFrame, most: float = 0.5) -> DataFrame:
    """Fill missing positions from a catalogue of addresses (address, lat, lon, confidence): filled rows are marked geometry_derived,
    of at most `most` confidence. Addresses listed twice fill nothing."""
    c = catalog.withColumn("_key", lookup_key(F.col("address"))).groupBy("_key").agg(
        F.count("*").alias("_n"), F.first("lat").alias("_lat"), F.first("lon").alias("_lon"), F.least(F.lit(most), F.coalesce(F.first("confidence"), F.lit(most))).alias("_conf")
    )
    c = c.filter("_n = 1 and _lat between -90 and 90 and _lon between -180 and 180").drop("_n")
    need = F.col("lat").isNull() | F.col("lon").isNull()
    both = records.withColumn("_key", F.when(need, lookup_key(F.col("address")))).join(small(c), "_key", "left")
    hit = F.col("_lat").isNotNull()
    return both.withColumns({
        "lat": F.when(hit, F.col("_lat")).otherwise(F.col("lat")), "lon": F.when(hit, F.col("_lon")).otherwise(F.col("lon")),
        "geometry_derived": hit, "geometry_confidence": F.when(hit, F.col("_conf")),
    }).drop("_key", "_lat", "_lon", "_conf")


def resolve_places(catalog: DataFrame, wanted: DataFrame, names: list[str]) -> DataFrame:
    """name, status ('completed', 'needs_input'), matches, key: how many places of a catalogue carry a name in any of its name columns."""
    listed = catalog.select(F.col(catalog.columns[0]).alias("key"), F.explode(F.array_compact(F.array(*(lookup_key(F.col(n)) for n in names)))).alias("_name")).distinct()
    hits = wanted.select("name", lookup_key(F.col("name")).alias("_name")).distinct().join(listed, "_name", "left")
    out = hits.groupBy("name").agg(F.count("key").alias("matches"), F.min("key").alias("key"))
    return out.select("name", F.when(F.col("matches") == 1, "completed").otherwise("needs_input").alias("status"), "matches", F.when(F.col("matches") == 1, F.col("key")).alias("key"))
