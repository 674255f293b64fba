"""Order, age and state of source snapshots, and their descriptors."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds by which a snapshot may lie ahead of the clock.
AHEAD_S = 300


def zoned_timestamp(text: Column) -> Column:
    """ISO timestamp with a zone as TIMESTAMP; null for null, malformed and zoneless texts (see malformed())."""
    return F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)$"), F.try_to_timestamp(text))


def malformed(text: Column) -> Column:
    """Set but not a timestamp with a zone."""
    return text.isNotNull() & zoned_timestamp(text).isNull()


def age_seconds(stamp: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(stamp)) / 1e6


def freshness(stamp: Column, mode: Column, limit_s: Column, now: Column) -> Column:
    """UNKNOWN without a stamp, without a limit or from the future; HISTORICAL unless live; else STALE or CURRENT."""
    age = age_seconds(stamp, now)
    return (
        F.when(stamp.isNull(), "UNKNOWN")
        .when(~mode.eqNullSafe(F.lit("live")), "HISTORICAL")
        .when(limit_s.isNull() | (age < -AHEAD_S), "UNKNOWN")
        .when(age > limit_s, "STALE")
        .otherwise("CURRENT")
    )


def age_error(stamp: Column, mode: Column, limit_s: Column, policy: Column, now: Column) -> Column:
    """Why a live snapshot with a limit is refused, else null; the policy 'latest_available' takes any age."""
    age = age_seconds(stamp, now)
    judged = mode.eqNullSafe(F.lit("live")) & limit_s.isNotNull()
    why = (
        F.when(stamp.isNull(), "missing timestamp")
        .when(age < -AHEAD_S, "timestamp in the future")
        .when((age > limit_s) & ~policy.eqNullSafe(F.lit("latest_available")), "stale")
    )
    return F.when(judged, why)


def compare(candidate: str, previous: str, identity: tuple[str, ...] = ("source", "endpoint", "query_hash")) -> Column:
    """What a candidate descriptor (struct column) is to the last accepted one: NEWER_SNAPSHOT, EQUAL_SNAPSHOT, UNVERIFIED_TIMESTAMP
    or a refusal ('ERROR ...'). An older one is refused, for it would make false removals."""
    c, p = F.col(candidate), F.col(previous)
    now, then = c["timestamp"], p["timestamp"]
    out = F.when(now.isNotNull(), "NEWER_SNAPSHOT").otherwise("UNVERIFIED_TIMESTAMP")
    known = (
        F.when(then.isNotNull() & now.isNull(), "ERROR missing timestamp")
        .when(now < then, "ERROR older")
        .when((now == then) & p["dataset_hash"].isNotNull() & ~c["dataset_hash"].eqNullSafe(p["dataset_hash"]), "ERROR equal timestamp, other data")
        .when(now == then, "EQUAL_SNAPSHOT")
        .otherwise(out)
    )
    for field in reversed(identity):
        known = F.when(~c[field].eqNullSafe(p[field]), f"ERROR {field} differs").otherwise(known)
    return F.when(p.isNull(), out).otherwise(known)


def decide(candidates: DataFrame, store: DataFrame, scope: str = "query_hash") -> DataFrame:
    """candidates with `decision` against the last accepted descriptor of their scope in the store."""
    fields = ("source", "endpoint", "query_hash", "timestamp", "dataset_hash")
    last = store.groupBy(F.col(scope).alias("_scope")).agg(F.max_by(F.struct(*fields), F.struct(F.col("timestamp"), F.col("dataset_hash"))).alias("_last"))
    both = candidates.withColumn("_now", F.struct(*fields)).join(last, F.col(scope) == F.col("_scope"), "left")
    return both.withColumn("decision", compare("_now", "_last")).drop("_now", "_last", "_scope")


def accept(store: DataFrame, decided: DataFrame) -> DataFrame:
    """The store after the run: accepted candidates with a timestamp replace their scope's row."""
    good = decided.filter("decision in ('NEWER_SNAPSHOT', 'EQUAL_SNAPSHOT') and timestamp is not null").select(*store.columns)
    w = Window.partitionBy("query_hash").orderBy(F.col("timestamp").desc(), F.col("dataset_hash"))
    return store.unionByName(good).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of a row: its columns as texts with marks for nulls, joined by the unit separator."""
    return F.sha2(F.concat_ws("\u001f", *(F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in columns)), 256)


def dataset_hash(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, dataset_hash: one digest per group of rows, whatever their order and however they are spread.

    Rows are hashed where they lie; a group's digest is that of its number of rows and of the sums of the four parts of their hashes, which tasks add up
    before anything is shuffled, so a group of any size is a few numbers.
    """
    h = df.select(*by, row_hash(df, columns).alias("_h"))
    parts = [F.sum(F.conv(F.substring("_h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("string") for i in range(4)]
    return h.groupBy(*by).agg(F.sha2(F.concat_ws("|", F.count("*").cast("string"), *parts), 256).alias("dataset_hash"))


def query_hash(source: str, endpoint: str | None, area: tuple | str, categories: tuple[str, ...]) -> str:
    """Identity of what was asked: the same source, place of delivery, area and set of categories give the same digest, whatever their order."""
    asked = {"area": area if isinstance(area, str) else list(area), "categories": sorted(set(categories)), "endpoint": endpoint, "source": source}
    return hashlib.sha256(json.dumps(asked, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def element_faults(elements: DataFrame, now: Column, slack_s: int = 300) -> DataFrame:
    """type, id, fault of delivered elements (type, id, version, timestamp): listed twice, of a version below one, or stamped in the future."""
    twice = elements.groupBy("type", "id").agg(F.count("*").alias("n"), F.min("version").alias("version"), F.max("timestamp").alias("timestamp"))
    late = F.unix_micros("timestamp") - F.unix_micros(now) > slack_s * 1_000_000
    faults = F.array_compact(F.array(F.when(F.col("n") > 1, "listed twice"), F.when(F.coalesce(F.col("version"), F.lit(1)) < 1, "version below one"), F.when(late, "stamped in the future")))
    return twice.select("type", "id", F.explode(faults).alias("fault"))


def descriptor(elements: DataFrame, source: str, endpoint: str, asked: str, columns: list[str], mode: str = "live") -> DataFrame:
    """One row that describes a delivery: source, endpoint, query_hash, newest timestamp, dataset_hash, mode and snapshot_id (which leaves the mode out)."""
    whole = dataset_hash(elements.withColumn("_all", F.lit(1)), ["_all"], columns).select("dataset_hash")
    newest = elements.agg(F.max("timestamp").alias("timestamp"))
    row = newest.withColumn("_", F.lit(1)).join(F.broadcast(whole.withColumn("_", F.lit(1))), "_", "left").drop("_")  # one row each
    row = row.select(F.lit(source).alias("source"), F.lit(endpoint).alias("endpoint"), F.lit(asked).alias("query_hash"), "timestamp", "dataset_hash", F.lit(mode).alias("mode"))
    return row.withColumn("snapshot_id", F.sha2(F.concat_ws("|", "source", "endpoint", "query_hash", F.unix_micros("timestamp").cast("string"), "dataset_hash"), 256))
