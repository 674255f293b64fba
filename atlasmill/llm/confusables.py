"""Visually identical text with different characters: groups of equal confusables skeleton."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.visible import skeleton_col
from atlasmill.session import materialize
from atlasmill.tables import small


def long_form(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field_name, text: one row for each non-null field."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields))
    return rows.select(F.col(key), F.inline(F.filter(pairs, lambda p: p["text"].isNotNull())))


def with_skeleton(texts: DataFrame, text: str = "text") -> DataFrame:
    """Add `skeleton`, computed once for each text of a batch. Null texts keep a null skeleton, unreadable ones get ''."""
    return texts.withColumn("skeleton", skeleton_col(F.col(text)))


def skeleton_groups(texts: DataFrame, text: str = "text") -> DataFrame:
    """skeleton, original, n_rows, n_originals: one row for each distinct text, beside the number of distinct texts that look like it (itself too).

    Equal texts are counted before their skeleton is taken, so a text that makes up a third of the rows is one row from then on; a group is never
    gathered in one row. Null and unreadable texts are in no group.
    """
    counted = texts.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("original")).agg(F.count("*").alias("n_rows"))
    seen = materialize(with_skeleton(counted, "original").filter("skeleton <> ''"), "skeletons")
    sizes = seen.groupBy("skeleton").agg(F.count("*").alias("n_originals"))
    return seen.join(sizes.hint("merge"), "skeleton").select("skeleton", "original", "n_rows", "n_originals")


def matches_register(rows: DataFrame, key: str, register: DataFrame, register_key: str, fields: list[str]) -> DataFrame:
    """key, field_name, register_key: fields that look exactly like that field of a register entry but are another string.

    Both sides are brought to their skeletons, and equal skeletons are joined per field. The register is broadcast if its count is
    within the bound for fixed tables, else the join shuffles. Nulls, blanks and texts of unseen characters alone match nothing;
    repeated rows give one row. Other columns are not read.
    """
    entries = with_skeleton(long_form(register, register_key, fields)).filter("skeleton <> ''")
    entries = entries.select(register_key, "field_name", F.col("text").alias("entry"), "skeleton").distinct()
    found = with_skeleton(long_form(rows, key, fields)).join(small(entries), ["field_name", "skeleton"]).filter("text <> entry")
    return found.select(key, "field_name", register_key).distinct()
