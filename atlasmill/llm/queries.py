"""Queries of the problems for training-data tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.llm import sql_text
from atlasmill.llm.addresses import same_address
from atlasmill.llm.bpe import encode_corpus
from atlasmill.llm.confusables import long_form, matches_register, skeleton_groups
from atlasmill.llm.leakage import leaks
from atlasmill.llm.matching import match_records
from atlasmill.llm.pii import mentions
from atlasmill.llm.survivors import survivors, true_values
from atlasmill.tables import current_rows, table


def _current(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return current_rows(table(spark, sf_dir, "riyadh_pharmacies"), table(spark, sf_dir, "snapshots"), columns)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, fields = F.concat_ws(":", "source", "id").alias("source_key"), ["name_en", "name_ar", "phone", "lat", "lon"]
    now = _current(spark, sf_dir, ["source", *fields]).select("id", *fields, key)
    alt = table(spark, sf_dir, "riyadh_pharmacies_alt").select("id", *fields, key).distinct()
    return match_records(now, alt, table(spark, sf_dir, "merge_groups")).select("id", "alt_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = _current(spark, sf_dir, ["name_en", "name_ar"])
    return matches_register(now, "id", table(spark, sf_dir, "name_register"), "name_id", ["name_en", "name_ar"])


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all rows that look like another name stored with other characters."""
    rows = long_form(table(spark, sf_dir, "riyadh_pharmacies"), "row_id", ["name_en", "name_ar"])
    return skeleton_groups(rows).filter("n_originals > 1")


def _field_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of merge_groups with their name_ar (both tables) and hours (the second)."""
    groups = table(spark, sf_dir, "merge_groups").select(F.col("entity_id").alias("group"), "source_key").distinct()
    key = F.concat_ws(":", "source", "id").alias("source_key")
    now = _current(spark, sf_dir, ["source", "harvested_at", "name_ar"])
    alt = table(spark, sf_dir, "riyadh_pharmacies_alt").filter("id is not null")
    parts = [t.select(key, "source", "harvested_at", F.lit(f).alias("field"), F.col(f).alias("value")) for t, f in ((now, "name_ar"), (alt, "name_ar"), (alt, "hours"))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("value is not null")
    return rows.join(groups.hint("merge"), "source_key")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dominant survivor of name_ar (members of both tables) and of hours (members of the second)."""
    best = survivors(_field_members(spark, sf_dir), table(spark, sf_dir, "sources")).filter("dominant")
    return best.select(F.col("group").alias("entity_id"), "field_name", "source_key")


def p5_true_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of a group's field that the model judges true."""
    kept = true_values(_field_members(spark, sf_dir), table(spark, sf_dir, "sources"))
    return kept.select(F.col("group").alias("entity_id"), "field_name", "value")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = same_address(_current(spark, sf_dir, ["address"]), "id", "address", table(spark, sf_dir, "districts"), table(spark, sf_dir, "name_register"))
    return found.select("id_a", "id_b")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), kinds=("verbatim",)).select("doc_id", "item_id")


def p8_paraphrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that reword a passage of an item without holding RUN of its words in a row."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), kinds=("paraphrase",))
    return found.select("doc_id", "item_id", "longest_run")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "pii_kind", "start_pos")


def queries() -> dict:
    return {"p1_found": p1_found, "p2_found": p2_found, "p2_groups": p2_groups, "p5_found": p5_found, "p5_true_values": p5_true_values, "p6_found": p6_found, "p7_ids": p7_ids, "p8_found": p8_found, "p8_paraphrases": p8_paraphrases, "p9_found": p9_found}


def sql() -> dict[str, str]:
    return sql_text.SQL
