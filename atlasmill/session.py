"""Session defaults and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
}


def local_session(cores: int | str = "*", name: str = "atlasmill", **conf: str) -> SparkSession:
    """A session for tests and the bench. Clusters bring their own; nothing here is needed by the operators."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for k, v in {**DEFAULTS, "spark.driver.memory": "8g", "spark.driver.host": "127.0.0.1", **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset (tests), a temporary one that is set as such.

    A folder of this machine alone would be invisible to executors elsewhere, so it is only taken on a local master.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = Path(tempfile.mkdtemp(prefix="atlasmill-")).as_uri()
        spark.sparkContext.setCheckpointDir(at)
    return at


_written: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df once as a table in the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._table_at = path
    return out


def release(df: DataFrame | None) -> None:
    """Delete the table behind a DataFrame that materialize() returned and that no plan reads any more."""
    path = getattr(df, "_table_at", None) if df is not None else None
    for entry in [w for w in _written if w[1] == path]:
        _written.remove(entry)
        _delete(*entry)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_materialized() -> None:
    """Delete every table that materialize() wrote in this process."""
    while _written:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session is gone; its temporary folders went with it
            pass


atexit.register(drop_materialized)
