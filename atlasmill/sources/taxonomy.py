"""Categories and their crosswalks to other vocabularies. Own list: the words follow one rule, key_value of the map tag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The four core categories, and other map tags with their labels.
CORE = {"pharmacy": ("amenity=pharmacy", "Q13107184"), "clinic": ("amenity=clinic", "Q1774898"), "hospital": ("amenity=hospital", "Q16917"), "school": ("amenity=school", "Q3914")}
TAGS = {
    "amenity": "restaurant cafe fast_food bank atm fuel place_of_worship dentist doctors kindergarten library police post_office parking university veterinary marketplace cinema theatre",
    "shop": "bakery supermarket convenience clothes electronics furniture florist optician perfumery books hairdresser jewelry butcher greengrocer mobile_phone",
    "tourism": "hotel motel hostel museum gallery attraction",
    "leisure": "park playground stadium sports_centre swimming_pool",
    "office": "company government lawyer insurance",
}
SCHEMA = "id string, label_en string, osm_tags array<string>, google_types array<string>, wikidata_classes array<string>"


def taxonomy_rows() -> list[tuple]:
    """(id, label, map tags, place types, knowledge-base classes) of every category."""
    rows = [(k, k.title(), [tag], [k], [q]) for k, (tag, q) in CORE.items()]
    rows += [(f"{key}_{v}", v.replace("_", " ").title(), [f"{key}={v}"], [v] if key in ("amenity", "tourism") else [], []) for key, words in TAGS.items() for v in words.split()]
    return rows


def taxonomy(spark: SparkSession) -> DataFrame:
    """The categories as a table."""
    return spark.createDataFrame(taxonomy_rows(), SCHEMA)
