"""Source registries: reading and checking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

USES = ("internal", "commercial", "redistribute")
SCHEMA = (
    "name string, kind string, path string, endpoint string, license string, allowed_uses array<string>, commercial_use boolean, auth_mode string, "
    "coverage_bbox array<double>, freshness string, attribution string, rate_limit_per_second double, reliability_weight double, freshness_policy string, "
    "request_timeout_seconds double, request_attempts int, total_timeout_seconds double, max_snapshot_age_seconds double"
)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The sources of a registry file {"sources": [...]}."""
    return spark.read.schema(f"sources array<struct<{', '.join(f'{c.split()[0]}:{c.split()[1]}' for c in SCHEMA.split(', '))}>>").json(path, multiLine=True).select(F.inline("sources"))


def _finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < float("inf"))


def faults(registry: DataFrame) -> Column:
    """All rules that a source row breaks, in a fixed order (array of texts; empty for a good row)."""
    has = lambda c: c in registry.columns
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    box = F.col("coverage_bbox")
    good_box = (F.size(box) == 4) & box[0].between(-180, 180) & box[2].between(-180, 180) & box[1].between(-90, 90) & box[3].between(-90, 90) & (box[0] <= box[2]) & (box[1] <= box[3])
    rules = [(blank(c), f"missing {c}") for c in ("name", "kind", "license", "attribution", "auth_mode", "freshness")]
    rules += [
        (F.coalesce(F.size("allowed_uses"), F.lit(0)) <= 0, "missing allowed_uses"),
        (~F.coalesce(_finite(F.col("rate_limit_per_second")) & (F.col("rate_limit_per_second") > 0), F.lit(False)), "rate_limit_per_second must be positive"),
        (~F.coalesce(_finite(F.col("reliability_weight")) & F.col("reliability_weight").between(0, 1), F.lit(False)), "reliability_weight must be between 0 and 1"),
        (F.col("commercial_use").isNull(), "missing commercial_use"),
        (box.isNotNull() & ~F.coalesce(good_box, F.lit(False)), "coverage_bbox must be ordered W, S, E, N"),
        (F.when(F.col("kind") == "fixture", blank("path")).otherwise(blank("endpoint")), "missing path or endpoint"),
        (F.col("auth_mode") != "none", "auth_mode must be none"),
        (F.size(F.array_except("allowed_uses", F.array(*map(F.lit, USES)))) > 0, "unknown allowed_uses"),
    ]
    rules += [(~(_finite(F.col(c)) & (F.col(c) > 0)), f"{c} must be positive") for c in ("request_timeout_seconds", "total_timeout_seconds", "max_snapshot_age_seconds") if has(c)]
    if has("request_attempts"):
        rules.append((~F.col("request_attempts").between(1, 4), "request_attempts must be between 1 and 4"))
    if has("freshness_policy"):
        rules.append((~F.col("freshness_policy").isin("strict", "latest_available"), "unknown freshness_policy"))
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for c, t in rules)))


def checked(registry: DataFrame) -> DataFrame:
    """The registry with `faults`, names that occur twice among them."""
    twice = registry.groupBy("name").count().filter("count > 1").select("name", F.lit(True).alias("_twice"))
    out = registry.join(twice, "name", "left").withColumn("faults", faults(registry))
    return out.withColumn("faults", F.when(F.col("_twice"), F.concat("faults", F.array(F.lit("duplicate name")))).otherwise(F.col("faults"))).drop("_twice")


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry of a file; raises with the first few faults if it has any."""
    registry = read_registry(spark, path)
    bad = checked(registry).filter(F.size("faults") > 0).select("name", "faults").limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r['name']}: {', '.join(r['faults'])}" for r in bad))
    return registry
