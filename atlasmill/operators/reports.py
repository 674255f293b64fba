"""Counters and evaluations: bilingual names, merge quality, taxonomy coverage, licences, published layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.names import has_script_col


def bilingual_counts(merged: DataFrame) -> DataFrame:
    """total, valid_bilingual, authoritative, authoritative_fraction (null on no rows) of merged records.

    Valid: both names have letters of their script. Authoritative: neither is generated, and each one's provenance is one of the
    record's own source keys or a tag of it.
    """

    def own(lang: str) -> Column:
        by = F.coalesce(F.col("provenance")[f"name_{lang}"], F.lit(""))
        clean = F.coalesce(F.col(f"name_{lang}_method"), F.lit("")) == ""
        return clean & ~F.coalesce(F.col(f"name_{lang}_generated"), F.lit(False)) & F.exists("source_keys", lambda k: (by == k) | by.startswith(F.concat(k, F.lit(":tags."))))

    valid = has_script_col(F.col("name_en"), "en") & has_script_col(F.col("name_ar"), "ar")
    flags = merged.select(valid.alias("v"), (valid & own("en") & own("ar")).alias("a"))
    out = flags.agg(F.count("*").alias("total"), F.count_if("v").alias("valid_bilingual"), F.count_if("a").alias("authoritative"))
    return out.withColumn("authoritative_fraction", F.try_divide("authoritative", "total"))


def pairs_within(groups: DataFrame, group: str, key: str) -> DataFrame:
    """a < b: all pairs of distinct keys within a group (the form in which merges are evaluated)."""
    g = groups.select(F.col(group).alias("g"), F.col(key).alias("k")).distinct()
    return g.alias("x").join(g.alias("y").hint("merge"), "g").filter(F.col("x.k") < F.col("y.k")).select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()


def pair_quality(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """true_pairs, false_pairs, missed_pairs, precision, recall, f1 of two tables of pairs (a, b); 1 where there is nothing to find."""
    p, g = predicted.select("a", "b", F.lit(1).alias("p")), gold.select("a", "b", F.lit(1).alias("g"))
    counts = p.join(g.hint("merge"), ["a", "b"], "full_outer").agg(
        F.count_if(F.col("p").isNotNull() & F.col("g").isNotNull()).alias("true_pairs"),
        F.count_if(F.col("g").isNull()).alias("false_pairs"),
        F.count_if(F.col("p").isNull()).alias("missed_pairs"),
    )
    return _scores(counts)


def group_quality(groups: DataFrame, group: str, key: str, gold: DataFrame) -> DataFrame:
    """pair_quality() of all pairs within groups, counted without listing them: n (n - 1) / 2 a group, and the gold pairs both of whose keys it holds.

    A key is in one group only; repeated rows count once. Groups of any size cost one row each.
    """
    g = groups.select(F.col(group).alias("g"), F.col(key).alias("k")).filter("g is not null and k is not null").distinct()
    said = g.groupBy("g").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("said"))
    left, right = g.select(F.col("k").alias("a"), F.col("g").alias("ga")), g.select(F.col("k").alias("b"), F.col("g").alias("gb"))
    both = gold.select("a", "b").join(left.hint("merge"), "a", "left").join(right.hint("merge"), "b", "left")
    there = both.agg(F.count("*").alias("there"), F.count_if(F.col("ga") == F.col("gb")).alias("true_pairs"))
    counts = said.withColumn("_", F.lit(1)).join(F.broadcast(there.withColumn("_", F.lit(1))), "_")
    return _scores(counts.select("true_pairs", (F.col("said") - F.col("true_pairs")).alias("false_pairs"), (F.col("there") - F.col("true_pairs")).alias("missed_pairs")))


def _scores(counts: DataFrame) -> DataFrame:
    """Add precision, recall and f1 to true_pairs, false_pairs and missed_pairs."""
    said, there = F.col("true_pairs") + F.col("false_pairs"), F.col("true_pairs") + F.col("missed_pairs")
    precision = F.when(said > 0, F.col("true_pairs") / said).otherwise(F.when(there == 0, 1.0).otherwise(0.0))
    recall = F.when(there > 0, F.col("true_pairs") / there).otherwise(1.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return counts.select("*", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def field_accuracy(merged: DataFrame, truth: DataFrame) -> DataFrame:
    """field, judged, correct, accuracy: how often a merged place took a field from the record that a label names.

    merged: source_keys and provenance (field -> source key); truth: source_key, field, expected_source_key. Labels of keys that no place holds count
    as wrong.
    """
    held = merged.select(F.explode("source_keys").alias("source_key"), F.col("provenance").alias("by"))
    both = truth.select("source_key", "field", "expected_source_key").distinct().join(held.hint("merge"), "source_key", "left")
    right = F.coalesce(F.try_element_at("by", F.col("field")) == F.col("expected_source_key"), F.lit(False))
    out = both.groupBy("field").agg(F.count("*").alias("judged"), F.count_if(right).alias("correct"))
    return out.withColumn("accuracy", F.round(F.col("correct") / F.col("judged"), 6))


def review_summary(review: DataFrame, records: DataFrame) -> DataFrame:
    """source, reason, rows, share: the review queue rolled up, each reason with its share of the source's records."""
    n = records.groupBy("source").agg(F.count("*").alias("total"))
    queued = review.groupBy("source", "reason").agg(F.count("*").alias("rows"))
    return queued.join(n, "source", "left").select("source", "reason", "rows", F.round(F.try_divide("rows", "total"), 6).alias("share"))


def unlabelled(predicted_keys: DataFrame, labels: DataFrame, key: str = "source_key") -> DataFrame:
    """Predicted keys that no label names (an evaluation over them would be void)."""
    return predicted_keys.select(key).distinct().join(labels.select(key).distinct().hint("merge"), key, "left_anti")


def crosswalk_coverage(taxonomy: DataFrame) -> DataFrame:
    """provider, mapping_count, mapped_leaf_count, leaf_coverage, ambiguous_count of each crosswalk of a taxonomy."""
    long = taxonomy.select("id", F.explode(F.create_map(*(x for p in ("osm_tags", "google_types", "wikidata_classes") for x in (F.lit(p), F.col(p))))).alias("provider", "values"))
    leaves = long.groupBy("provider").agg(F.count("*").alias("n"), F.count_if(F.size("values") > 0).alias("mapped_leaf_count"))
    tags = long.select("provider", "id", F.explode("values").alias("value")).groupBy("provider", "value").agg(F.count_distinct("id").alias("n_ids"))
    tags = tags.groupBy("provider").agg(F.count("*").alias("mapping_count"), F.count_if(F.col("n_ids") > 1).alias("ambiguous_count"))
    return leaves.join(tags, "provider", "left").select(
        "provider", F.coalesce("mapping_count", F.lit(0)).alias("mapping_count"), "mapped_leaf_count", F.round(F.col("mapped_leaf_count") / F.col("n"), 4).alias("leaf_coverage"), F.coalesce("ambiguous_count", F.lit(0)).alias("ambiguous_count")
    )


def licence_report(registry: DataFrame) -> DataFrame:
    """One row per source: where it comes from and what it may be used for."""
    return registry.select(
        F.col("name").alias("source"), "kind", F.coalesce(F.nullif("endpoint", F.lit("")), "path").alias("endpoint_or_path"), "auth_mode", "license", "attribution",
        F.array_sort("allowed_uses").alias("allowed_use"), "commercial_use", F.array_contains("allowed_uses", "redistribute").alias("redistribution"),
        "rate_limit_per_second", "coverage_bbox", "freshness", "reliability_weight",
    )


def run_counters(routed: DataFrame, merged: DataFrame) -> DataFrame:
    """One row of counts of a run."""
    r = routed.agg(F.count("*").alias("records"), *(F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "review", "dropped")))
    m = merged.agg(
        F.count("*").alias("places"), F.count_if(F.size("source_keys") > 1).alias("merged_places"), F.count_if("language_complete").alias("bilingual_places"),
        F.count_if(F.coalesce("name_en_generated", F.lit(False)) | F.coalesce("name_ar_generated", F.lit(False))).alias("generated_names"),
    )
    return r.withColumn("_", F.lit(1)).join(F.broadcast(m.withColumn("_", F.lit(1))), "_").drop("_")


def contributors(accepted: DataFrame, registry: DataFrame) -> DataFrame:
    """source, attribution, license, records of the sources with at least one accepted record."""
    n = accepted.groupBy("source").agg(F.count("*").alias("records"))
    return n.join(registry.select(F.col("name").alias("source"), "attribution", "license"), "source").select("source", "attribution", "license", "records")


def review_score(dataset: DataFrame, ratings: DataFrame, least: int = 100) -> DataFrame:
    """reviewed, accepted, rejected, acceptance, complete of a review corpus; unknown and repeated ratings are counted as faults."""
    known = dataset.select("id").distinct()
    rated = ratings.groupBy("id").agg(F.count("*").alias("n"), F.max("rating").alias("rating"))
    both = known.withColumn("there", F.lit(True)).join(rated.hint("merge"), "id", "full_outer")
    done = F.col("there") & F.col("rating").isNotNull()
    out = both.agg(
        F.count_if(done).alias("reviewed"), F.count_if(done & (F.col("rating") == "ACCEPTED")).alias("accepted"), F.count_if(done & (F.col("rating") == "REJECTED")).alias("rejected"),
        F.count_if("there").alias("total"), F.count_if(F.col("there").isNull() | (F.col("n") > 1)).alias("faults"),
    )
    return out.withColumn("acceptance", F.try_divide("accepted", "reviewed")).withColumn("complete", (F.col("reviewed") == F.col("total")) & (F.col("reviewed") >= least) & (F.col("faults") == 0))
