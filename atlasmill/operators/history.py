"""Between runs: ids kept by overlap of sources, and field-level change sets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from atlasmill.operators.components import connected_components
from atlasmill.session import materialize


def overlaps(previous: DataFrame, current: DataFrame, by: str = "stable_id", keys: str = "source_keys") -> DataFrame:
    """old_id, new_id, overlap: how many distinct source keys each old and new place share (pairs that share none are absent)."""
    old = previous.select(F.col(by).alias("old_id"), F.explode(keys).alias("key")).distinct()
    new = current.select(F.col(by).alias("new_id"), F.explode(keys).alias("key")).distinct()
    return old.join(new.hint("merge"), "key").groupBy("old_id", "new_id").agg(F.count("*").alias("overlap"))


def _greedy(g: pd.DataFrame) -> pd.DataFrame:
    g = g.assign(less=-g["overlap"]).sort_values(["less", "old_id", "new_id"])
    old, new, out = set(), set(), []
    for r in g.itertuples(index=False):
        if r.old_id not in old and r.new_id not in new:
            old.add(r.old_id)
            new.add(r.new_id)
            out.append((r.new_id, r.old_id))
    return pd.DataFrame(out, columns=["new_id", "old_id"])


def assign_ids(previous: DataFrame, current: DataFrame) -> DataFrame:
    """new_id, old_id: the greedy one-to-one assignment by overlap (descending), old id, new id.

    Pairs that are the first choice of both sides are settled by windows; what is left, in places that split or merged, is solved
    component by component of the overlap graph.
    """
    pairs = materialize(overlaps(previous, current), "overlaps")
    order = [F.col("overlap").desc(), "old_id", "new_id"]
    first = pairs.withColumns({f"r_{c}": F.row_number().over(Window.partitionBy(c).orderBy(*order)) for c in ("old_id", "new_id")})
    sure = first.filter("r_old_id = 1 and r_new_id = 1").select("new_id", "old_id")
    rest = pairs.join(sure.select("new_id").hint("merge"), "new_id", "left_anti").join(sure.select("old_id").hint("merge"), "old_id", "left_anti")
    rest = materialize(rest, "rest")
    edges = rest.select(F.concat(F.lit("o"), "old_id").alias("a"), F.concat(F.lit("n"), "new_id").alias("b"))
    part = connected_components(edges)
    left = rest.join(part.select(F.col("node").alias("_n"), "component").hint("merge"), F.concat(F.lit("n"), "new_id") == F.col("_n")).select("component", "old_id", "new_id", "overlap")
    return sure.unionByName(left.groupBy("component").applyInPandas(_greedy, "new_id string, old_id string"))


def reconcile(previous: DataFrame, current: DataFrame) -> DataFrame:
    """current with the stable ids of the previous places it continues; new places keep their own."""
    kept = assign_ids(previous, current).withColumnRenamed("new_id", "stable_id")
    return current.join(kept.hint("merge"), "stable_id", "left").withColumn("stable_id", F.coalesce("old_id", "stable_id")).drop("old_id")


def _comparable(df: DataFrame, c: str) -> Column:
    return F.array_sort(F.map_entries(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c)


def change_set(previous: DataFrame, current: DataFrame, key: str = "stable_id", ignored: tuple[str, ...] = ("harvested_at",)) -> DataFrame:
    """key, change ('added', 'removed', 'updated', 'unchanged'), changed_fields (sorted). Null equals null and a missing column; maps
    are compared by content, arrays in order."""
    fields = sorted((set(previous.columns) | set(current.columns)) - {key, *ignored})

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.col(key), *(_comparable(df, c).alias(f"{tag}{c}") if c in df.columns else F.lit(None).alias(f"{tag}{c}") for c in fields), F.lit(True).alias(f"{tag}__there"))

    both = side(previous, "o_").join(side(current, "n_").hint("merge"), key, "full_outer")
    differ = F.array(*(F.when(~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")), F.lit(c)) for c in fields)) if fields else F.array().cast("array<string>")
    kind = F.when(F.col("o___there").isNull(), "added").when(F.col("n___there").isNull(), "removed")
    out = both.select(key, kind.alias("_k"), F.array_compact(differ).alias("_d"))
    none = F.array().cast("array<string>")
    return out.select(
        key,
        F.coalesce("_k", F.when(F.size("_d") > 0, "updated").otherwise("unchanged")).alias("change"),
        F.when(F.col("_k").isNull(), F.col("_d")).otherwise(none).alias("changed_fields"),
    )
