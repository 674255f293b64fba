"""Readers of saved source records: JSON arrays, map-service payloads, address and place catalogues."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.functions.names import resolve_tags_col
from atlasmill.tables import small
from atlasmill.operators.lookups import tag_categories

RAW = (
    "id string, lat double, lon double, category string, name_en string, name_ar string, phone string, email string, address string, hours string, "
    "source_category string, website string, address_street string, address_city string, address_region string, address_postcode string, address_country string, "
    "footprint_ref string, alternate_names array<string>, geometry_method string, geometry_confidence double, harvested_at string"
)
ELEMENT = (
    "type string, id long, lat double, lon double, center struct<lat:double,lon:double>, version int, timestamp string, tags map<string,string>"
)
PAYLOAD = f"osm3s struct<timestamp_osm_base:string>, remark string, error string, elements array<struct<{', '.join(p.replace(' ', ':', 1) for p in ELEMENT.split(', '))}>>"
DERIVED_CONFIDENCE = 0.35


def read_records(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Rows of a JSON array of records (or JSON lines), with the source's name and the order within the file as rec_ord."""
    return spark.read.schema(RAW).json(path, multiLine=True).select(F.lit(source).alias("source"), "*", F.monotonically_increasing_id().alias("rec_ord"))


def parse_payload(payload: DataFrame, taxonomy: DataFrame, categories: list[str], source: str, allow_centers: bool = False) -> DataFrame:
    """Records of map-service payloads (columns of PAYLOAD): elements whose tags name exactly one wanted category.

    Several categories send the element to review (category_review_reason). Nodes are points; ways and relations have none unless their
    centre is allowed, and then it is marked as derived. Elements without a wanted tag give nothing. A payload without elements, or
    with a remark or an error, fails the read instead of standing for an empty map.
    """
    bad = F.col("elements").isNull() | F.col("remark").isNotNull() | F.col("error").isNotNull()
    flat = payload.select(F.col("osm3s.timestamp_osm_base").alias("base"), F.inline(F.when(bad, F.raise_error(F.lit("the payload is incomplete")).cast(payload.schema["elements"].dataType)).otherwise(F.col("elements"))))
    rows = flat.select("*", F.concat_ws("/", "type", F.col("id").cast("string")).alias("rid"))
    tags = tag_categories(taxonomy.filter(F.col("id").isin(categories)))
    hits = rows.select("rid", F.explode("tags").alias("k", "v")).select("rid", F.concat_ws("=", "k", "v").alias("tag")).join(small(tags), "tag")
    found = hits.groupBy("rid").agg(F.array_sort(F.collect_set("category")).alias("cats"), F.array_sort(F.collect_set("tag")).alias("hit"))
    r = rows.join(found.hint("merge"), "rid")
    one = F.size("cats") == 1
    key = F.concat(F.lit(source + ":"), "rid")
    names = resolve_tags_col("tags", key)
    node = F.col("type") == "node"
    centre = ~node & F.lit(allow_centers) & F.coalesce(F.col("center.lat").between(-90, 90) & F.col("center.lon").between(-180, 180), F.lit(False))
    tag = lambda *ks: F.coalesce(*(F.nullif(F.col("tags")[k], F.lit("")) for k in ks))
    r = r.withColumn("n", names)
    return r.select(
        F.lit(source).alias("source"), F.col("rid").alias("id"),
        F.when(one, F.when(node, F.col("lat")).when(centre, F.col("center.lat"))).alias("lat"), F.when(one, F.when(node, F.col("lon")).when(centre, F.col("center.lon"))).alias("lon"),
        F.when(one, F.col("cats")[0]).alias("category"), F.when(one, F.col("hit")[0]).alias("source_category"),
        F.when(~one, F.concat(F.lit("Ambiguous tags: "), F.concat_ws(", ", "hit"))).alias("category_review_reason"), "n.*",
        F.when(node, "osm_node").when(centre, "source_center_derived").alias("geometry_method"), F.when(centre, True).alias("geometry_derived"),
        F.when(centre, F.lit(DERIVED_CONFIDENCE)).alias("geometry_confidence"), F.when(centre, F.concat(key, F.lit(":center"))).alias("geometry_provenance"),
        F.when(~node, F.concat(F.lit("https://www.openstreetmap.org/"), "rid")).alias("footprint_ref"),
        tag("phone", "contact:phone").alias("phone"), tag("email", "contact:email").alias("email"), tag("website", "contact:website").alias("website"), tag("opening_hours").alias("hours"),
        F.concat_ws(", ", tag("addr:street"), tag("addr:city")).alias("address"), tag("addr:street").alias("address_street"), tag("addr:city").alias("address_city"),
        tag("addr:state").alias("address_region"), tag("addr:postcode").alias("address_postcode"), tag("addr:country").alias("address_country"),
        F.coalesce(F.col("version").cast("string"), "timestamp", "base").alias("source_version"),
    )


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYLOAD).json(path, multiLine=True)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """address, lat, lon, confidence of a geocode catalogue {"provider": ..., "entries": [...]}."""
    return spark.read.schema("entries array<struct<id:string,address:string,lat:double,lon:double,confidence:double>>").json(path, multiLine=True).select(F.inline("entries"))


def gated_catalog(spark: SparkSession, path: str, use: str) -> DataFrame:
    """read_catalog() of a file whose provider may serve the use; a refused use, a provider without licence or attribution, and an address that is listed
    twice are errors."""
    provider = "provider struct<name:string,license:string,attribution:string,allowed_uses:array<string>,commercial_use:boolean>"
    who = spark.read.schema(provider).json(path, multiLine=True).select("provider.*").first()
    if who is None or not all((who["name"], who["license"], who["attribution"])):
        raise ValueError("the catalogue names no provider with licence and attribution")
    if use not in (who["allowed_uses"] or ()) or (use != "internal" and not who["commercial_use"]):
        raise ValueError(f"{who['name']} may not be used for {use}")
    entries = read_catalog(spark, path)
    twice = entries.groupBy(F.lower(F.trim("address")).alias("address")).count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"the address {twice['address']!r} is listed twice")
    return entries


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """key, name, geometry of a GeoJSON collection: one row for each name and alias of a feature."""
    schema = "features array<struct<properties:struct<id:string,name:string,aliases:array<string>>,geometry:string>>"
    f = spark.read.schema(schema).json(path, multiLine=True).select(F.posexplode("features").alias("i", "f"))
    all_names = F.concat(F.array("f.properties.name"), F.coalesce("f.properties.aliases", F.array().cast("array<string>")))
    return f.select(F.coalesce("f.properties.id", F.col("i").cast("string")).alias("key"), F.explode(F.array_compact(all_names)).alias("name"), F.col("f.geometry").alias("geometry"))


#: Readers by a source's kind; more kinds can be added.
ADAPTERS: dict[str, Callable[[SparkSession, str, str], DataFrame]] = {"fixture": read_records}


def collect(spark: SparkSession, kind: str, path: str, source: str) -> DataFrame:
    """Records of a source by its kind; an unknown kind is an error."""
    if kind not in ADAPTERS:
        raise ValueError(f"no adapter for sources of kind {kind!r}")
    return ADAPTERS[kind](spark, path, source)
