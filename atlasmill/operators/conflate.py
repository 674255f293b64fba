"""Duplicate places: pairs within 75 m, scored, then clustered by the order-dependent guarded rule inside each component."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from atlasmill.functions.names import name_key_col, phone_digits
from atlasmill.operators.components import connected_components
from atlasmill.operators.proximity import near_pairs
from atlasmill.session import materialize

#: Farthest two records of one place lie apart, and the score from which a pair is merged.
RADIUS_M, MERGE_SCORE = 75.0, 0.68


def _alike(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def with_ordinals(records: DataFrame) -> DataFrame:
    """Add rec: the source_key made unique by a counter, so that it sorts as the keys do and equal keys stay apart. No global sort."""
    within = Window.partitionBy("source_key").orderBy("lat", "lon", F.to_json(F.struct("name_en", "name_ar", "phone", "address")))
    return records.withColumn("rec", F.concat_ws("\u0001", "source_key", F.lpad(F.row_number().over(within).cast("string"), 9, "0")))


def scored_pairs(records: DataFrame) -> DataFrame:
    """All pairs of records within RADIUS_M whose source keys differ, with distance and score.

    records: canonical rows with rec. `i` precedes `j` in source_key order. Of records in different categories only the distance is kept (score 0).
    Comparison keys of names are made once per record, their likeness once per distinct pair of keys of a batch.
    """
    near = near_pairs(records, "rec", "lat", "lon", RADIUS_M)
    side = records.select("rec", "source_key", "source", "lat", "lon", "category", name_key_col("name_en").alias("en"), name_key_col("name_ar").alias("ar"), phone_digits(F.col("phone")).alias("digits"))
    side = materialize(side, "sides")
    p = near.join(side.select(*(F.col(c).alias(f"{c}_i") for c in side.columns)).hint("merge"), F.col("key_a") == F.col("rec_i"))
    p = p.join(side.select(*(F.col(c).alias(f"{c}_j") for c in side.columns)).hint("merge"), F.col("key_b") == F.col("rec_j")).filter("source_key_i <> source_key_j")

    def likeness(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, str], float] = {}

        def ratio(x: str, y: str) -> float:
            if (x, y) not in seen:
                seen[x, y] = _alike(x, y)
            return seen[x, y]

        for b in batches:
            same = (b["category_i"] == b["category_j"]).to_numpy()
            keys = zip(same, b["en_i"], b["ar_i"], b["en_j"], b["ar_j"])
            best = [max((ratio(x, y) for x in (ei, ai) for y in (ej, aj) if x and y), default=0.0) if s else 0.0 for s, ei, ai, ej, aj in keys]
            yield b.drop(columns=["en_i", "ar_i", "en_j", "ar_j"]).assign(name_likeness=best)
            if len(seen) > 200_000:
                seen.clear()

    slim = p.select("rec_i", "rec_j", "source_key_i", "source_key_j", "source_i", "source_j", "lat_i", "lat_j", "digits_i", "digits_j", "category_i", "category_j", "distance_m", "en_i", "ar_i", "en_j", "ar_j")
    kept = [f for f in slim.schema if f.name not in ("en_i", "ar_i", "en_j", "ar_j")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", name_likeness double"
    out = slim.mapInPandas(likeness, schema)
    phone = (F.col("digits_i") != "") & (F.col("digits_i") == F.col("digits_j"))
    passes = (F.col("category_i") == F.col("category_j")) & ((F.col("name_likeness") >= 0.70) | phone)
    score = 0.60 * F.col("name_likeness") + 0.25 * (1 - F.col("distance_m") / RADIUS_M) + 0.15 * phone.cast("double")
    return out.withColumn("score", F.when(passes, score).otherwise(0.0))


@F.pandas_udf(DoubleType())
def address_likeness(first: pd.Series, second: pd.Series) -> pd.Series:
    """Likeness of two addresses; null where one is missing. For the decision log only."""
    return pd.Series([_alike(x.casefold(), y.casefold()) if x and y else None for x, y in zip(first, second)], dtype=float)


# Decisions and reasons of the log, as its readers know them.
ALREADY, REJECT, MERGE = "ALREADY_MERGED", "REJECT", "MERGE"
IN_CLUSTER, PHONES, BRANCHES, EVIDENCE, CATEGORIES, TOO_LOW = "existing_cluster", "conflicting_phone_numbers", "same_source_branch_guard", "name_distance_phone_evidence", "category_mismatch", "below_match_threshold"


def _replay(g: pd.DataFrame, version: int) -> pd.DataFrame:
    """Decisions over the pairs of one component, in order of latitude; each merge is seen by the decisions after it."""
    g = g.sort_values(["first_lat", "first_rec", "second_lat", "second_rec"], kind="stable")
    cluster: dict[str, str] = {}
    members: dict[str, list[str]] = {}
    phones: dict[str, dict[str, str]] = {}
    said = []
    for r in g.itertuples(index=False):
        for rec, source, digits in ((r.rec_i, r.source_i, r.digits_i), (r.rec_j, r.source_j, r.digits_j)):
            if rec not in cluster:
                cluster[rec], members[rec], phones[rec] = rec, [rec], {source: digits}
        a, b = cluster[r.rec_i], cluster[r.rec_j]
        if a == b:
            said.append((ALREADY, IN_CLUSTER))
            continue
        pa, pb = phones[a], phones[b]
        known_a, known_b = {v for v in pa.values() if v}, {v for v in pb.values() if v}
        both = pa.keys() & pb.keys()
        if version >= 3 and known_a and known_b and known_a != known_b:
            said.append((REJECT, PHONES))
        elif version >= 2 and both and (r.distance_m > 15 or any(not pa[s] or pa[s] != pb[s] for s in both)):
            said.append((REJECT, BRANCHES))
        else:
            said.append((MERGE, EVIDENCE))
            for rec in members.pop(b):
                cluster[rec] = a
                members[a].append(rec)
            pa.update(phones.pop(b))
    return pd.DataFrame({
        "rec_i": g["rec_i"], "rec_j": g["rec_j"], "decision": [d for d, _ in said], "reason": [w for _, w in said],
        "cluster_i": [cluster[x] for x in g["rec_i"]], "cluster_j": [cluster[x] for x in g["rec_j"]],
    })


def conflate(records: DataFrame, version: int = 3) -> tuple[DataFrame, DataFrame]:
    """(records with cluster, decisions) of canonical records; version 1 has no guards, 2 the same-source one, 3 the phone one too.

    Decisions depend on order, but only within a connected component of pairs that reach MERGE_SCORE, so components are labelled first
    and replayed one by one, each in the order of latitude. A component is as large as a chain of places 75 m apart with one name.
    """
    if version not in (1, 2, 3):
        raise ValueError(f"Unsupported conflation version: {version}")
    rows = with_ordinals(records)
    pairs = materialize(scored_pairs(rows), "pairs")
    strong = pairs.filter(F.col("score") >= MERGE_SCORE)
    parts = connected_components(strong, "rec_i", "rec_j")
    swap = (F.col("lat_j") < F.col("lat_i")) | ((F.col("lat_j") == F.col("lat_i")) & (F.col("rec_j") < F.col("rec_i")))
    order = {
        "first_lat": F.least("lat_i", "lat_j"), "second_lat": F.greatest("lat_i", "lat_j"),
        "first_rec": F.when(swap, F.col("rec_j")).otherwise(F.col("rec_i")), "second_rec": F.when(swap, F.col("rec_i")).otherwise(F.col("rec_j")),
    }
    work = strong.withColumns(order).join(parts.withColumnRenamed("node", "rec_i").hint("merge"), "rec_i")
    work = work.select("component", "rec_i", "rec_j", "source_i", "source_j", "digits_i", "digits_j", "distance_m", *order)
    schema = "rec_i string, rec_j string, decision string, reason string, cluster_i string, cluster_j string"
    judged = materialize(work.groupBy("component").applyInPandas(lambda g: _replay(g, version), schema), "judged")
    label = judged.select(F.inline(F.array(F.struct(F.col("rec_i").alias("rec"), F.col("cluster_i").alias("cluster")), F.struct(F.col("rec_j").alias("rec"), F.col("cluster_j").alias("cluster"))))).distinct()
    clustered = rows.join(label.hint("merge"), "rec", "left").withColumn("cluster", F.coalesce("cluster", "rec"))
    log = pairs.join(judged.select("rec_i", "rec_j", "decision", F.col("reason").alias("why")).hint("merge"), ["rec_i", "rec_j"], "left")
    where = rows.select(F.col("rec").alias("rec_i"), F.col("address").alias("address_i"))
    log = log.join(where.hint("merge"), "rec_i").join(where.select(F.col("rec_i").alias("rec_j"), F.col("address_i").alias("address_j")).hint("merge"), "rec_j")
    south = F.col("lat_j") < F.col("lat_i")
    likeness = address_likeness(F.when(south, F.col("address_j")).otherwise(F.col("address_i")), F.when(south, F.col("address_i")).otherwise(F.col("address_j")))
    weak = F.when(F.col("category_i") != F.col("category_j"), CATEGORIES).otherwise(TOO_LOW)
    decisions = log.select(
        F.when(swap, F.col("source_key_j")).otherwise(F.col("source_key_i")).alias("left"),
        F.when(swap, F.col("source_key_i")).otherwise(F.col("source_key_j")).alias("right"),
        F.round("distance_m", 6).alias("distance_m"),
        F.round("score", 6).alias("match_score"),
        F.round(likeness, 6).alias("address_similarity"),
        F.lit(version).alias("algorithm_version"),
        F.coalesce("decision", F.lit(REJECT)).alias("decision"),
        F.coalesce("why", weak).alias("reason"),
    )
    return clustered, decisions
