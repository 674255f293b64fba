"""Readers of the test tables and the rule that picks the row that counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows up to which a table that TESTDATA.md calls fixed is sent to every executor. The count is checked each time.
FIXED_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int = FIXED_ROWS) -> DataFrame:
    """Broadcast df if it has at most `rows` rows (counted now), else leave the join to a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def delivered(snapshots: DataFrame) -> DataFrame:
    """source, snapshot_no, pos, prev_no, next_no of the delivered snapshots; pos counts a source's deliveries from 0."""
    w = Window.partitionBy("source").orderBy("snapshot_no")
    return (
        snapshots.filter(F.col("delivered") & F.col("source").isNotNull() & F.col("snapshot_no").isNotNull())
        .select("source", "snapshot_no")
        .distinct()
        .withColumns(
            {
                "pos": F.row_number().over(w) - 1,
                "prev_no": F.lag("snapshot_no").over(w),
                "next_no": F.lead("snapshot_no").over(w),
            }
        )
    )


def current_rows(records: DataFrame, snapshots: DataFrame, columns: list[str]) -> DataFrame:
    """One row per id: of its rows in the last delivered snapshot of its source the one with the greatest harvested_at, then row_id.

    Rows without an id, and ids without a row in that snapshot, have none. A null harvested_at is older than any other.
    Only `columns` (and id) are read and moved. Shuffle: one, by id, after the map-side join that drops the older snapshots.
    """
    last = snapshots.filter("delivered").groupBy("source").agg(F.max("snapshot_no").alias("snapshot_no"))
    keep = [c for c in dict.fromkeys(columns) if c != "id"]
    rows = (
        records.select(*dict.fromkeys(["id", "source", "snapshot_no", "harvested_at", "row_id", *keep]))
        .filter("id is not null")
        .join(small(last), ["source", "snapshot_no"])
    )
    w = Window.partitionBy("id").orderBy(F.col("harvested_at").desc_nulls_last(), F.col("row_id").desc_nulls_last())
    return rows.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").select("id", *keep)
