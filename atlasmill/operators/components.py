"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.session import materialize, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node, component (the least node of it) for every node of an edge; loops, repeated and reversed edges do not matter.

    Each step links the neighbours of a node to the least of them (Kiveris et al., 2014), so rounds grow with the logarithm of the
    longest path. Every round is written to the shared folder; only two numbers come to the driver. Neighbours are never listed in
    one row, so a node of very many edges costs no more than its edges do.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    nodes = e.select(F.col("u").alias("node")).unionByName(e.select(F.col("v").alias("node"))).distinct()
    now = materialize(e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        last, now = now, materialize(small.filter("u <> v").distinct(), "edges")
        release(last)
        size = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if size == before:
            break
        before = size
    else:
        raise RuntimeError("the components did not settle")
    roots = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(roots.hint("merge"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
