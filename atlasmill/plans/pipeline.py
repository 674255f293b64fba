"""A whole run: gate, capture, route, enrich, conflate, reconcile, compare; written all at once, checked and replayed."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from atlasmill.functions.enrich import FIELDS, enrich_col
from atlasmill.operators.areas import box_area, inside, polygon_area
from atlasmill.operators.canonical import admitted_sources, canonicalize, column_or_null, route
from atlasmill.operators.conflate import conflate
from atlasmill.operators.history import change_set, reconcile
from atlasmill.operators.merge import merge_clusters
from atlasmill.operators.snapshots import dataset_hash
from atlasmill.session import materialize
from atlasmill.tables import small

USES = ("internal", "commercial", "redistribute")


@dataclass(frozen=True)
class Request:
    """What is asked for. area: a box (S, W, N, E) or GeoJSON text; categories are kept sorted and distinct."""

    area: tuple[float, float, float, float] | str
    categories: tuple[str, ...]
    use: str = "internal"
    version: int = 3
    known: tuple[str, ...] = field(default=(), repr=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "categories", tuple(sorted(set(self.categories))))
        if not self.categories or (self.known and set(self.categories) - set(self.known)):
            raise ValueError("unknown or no categories")
        if self.use not in USES:
            raise ValueError(f"unknown use {self.use!r}")

    def shape(self) -> dict:
        return polygon_area(self.area) if isinstance(self.area, str) else box_area(*self.area)


@dataclass
class Run:
    """Tables of a run, by name."""

    tables: dict[str, DataFrame]
    request: Request


def run(raw: DataFrame, registry: DataFrame, taxonomy: DataFrame, request: Request, previous: DataFrame | None = None) -> Run:
    """Places of raw records (columns of RAW and source) under a request.

    Sources that may not serve the use, or do not cover the area, are excluded before any record is read; if all are, that is an error.
    The capture holds the records as they came. Unmapped categories go to review before anything else is judged; rows outside the area
    or of other categories are dropped; a generated name of low confidence is reviewed and still used.
    """
    shape = request.shape()
    s, w, n, e = shape["bounds"]
    judged = admitted_sources(registry, request.use, (w, s, e, n))
    excluded = judged.filter("refused is not null").select(F.col("name").alias("source"), F.col("refused").alias("reason"))
    allowed = judged.filter("refused is null").drop("refused")
    if allowed.limit(1).count() == 0:
        raise ValueError("every source is excluded")
    capture = raw.join(small(allowed.select(F.col("name").alias("source"))), "source", "left_semi")
    routed = route(capture, taxonomy, list(request.categories))
    flagged = routed.filter("status = 'review'").select("source", "id", "reason")
    kept = routed.filter("status = 'accepted'").filter(inside(shape, F.col("lat").cast("double"), F.col("lon").cast("double")))
    names = enrich_col(column_or_null(kept, "name_en"), column_or_null(kept, "name_ar"), F.col("category"), F.concat_ws(":", "source", "id"))
    own = [c for c in kept.columns if c not in {f for f, _ in FIELDS} | {"reason", "status"}]
    keep_status = {c: column_or_null(kept, c) for c in ("name_status", "missing_name_reason") if c in kept.columns}
    enriched = materialize(kept.withColumn("_e", names).select(*own, *(F.coalesce(F.col(f"_e.{f}"), keep_status[f]).alias(f) if f in keep_status else F.col(f"_e.{f}").alias(f) for f, _ in FIELDS)), "enriched")
    weak = enriched.filter("review_reason is not null").select("source", "id", F.col("review_reason").alias("reason"))
    clustered, decisions = conflate(canonicalize(enriched.drop("review_reason"), allowed), request.version)
    places = merge_clusters(clustered)
    if previous is not None:
        places = reconcile(previous, places)
    places = materialize(places, "places")
    tables = {"capture": capture, "sources": registry, "excluded": excluded, "review": flagged.unionByName(weak), "decisions": decisions, "records": places}
    if previous is not None:
        tables |= {"previous": previous, "changes": change_set(previous, places)}
    return Run(tables, request)


def _digest(df: DataFrame) -> str | None:
    """One hash of a table whatever the order of its rows; maps by content."""
    flat = df.select(*(F.to_json(F.array_sort(F.map_entries(f.name))).alias(f.name) if isinstance(f.dataType, MapType) else F.col(f.name).cast("string").alias(f.name) for f in df.schema))
    key = list(flat.columns)
    row = dataset_hash(flat.withColumn("_all", F.lit(1)), ["_all"], key).first()
    return row["dataset_hash"] if row else None


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_run(result: Run, path: str) -> None:
    """All tables and a manifest of their hashes, staged beside `path` and renamed, so that a failing run leaves nothing behind."""
    spark = next(iter(result.tables.values())).sparkSession
    stage = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    here, fs = _fs(spark, stage)
    final, _ = _fs(spark, path)
    if fs.exists(final):
        raise FileExistsError(path)
    try:
        for name, df in result.tables.items():
            df.write.parquet(f"{stage}/{name}")
        hashes = {name: _digest(spark.read.parquet(f"{stage}/{name}")) for name in result.tables}
        manifest = json.dumps({"request": {k: v for k, v in asdict(result.request).items() if k != "known"}, "hashes": hashes}, sort_keys=True, ensure_ascii=False)
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.text(f"{stage}/manifest")
        if not fs.rename(here, final):
            raise OSError(f"cannot rename to {path}")
    finally:
        fs.delete(here, True)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest").first()["value"])


def verify_run(spark: SparkSession, path: str) -> list[str]:
    """Names of the tables of a saved run that no longer have their hash (empty: intact)."""
    hashes = read_manifest(spark, path)["hashes"]
    return sorted(name for name, h in hashes.items() if _digest(spark.read.parquet(f"{path}/{name}")) != h)


def replay(spark: SparkSession, path: str, taxonomy: DataFrame) -> bool:
    """Whether the records of a saved run come out again from its capture, without network or clock."""
    saved = read_manifest(spark, path)
    if "capture" in verify_run(spark, path):
        return False
    area = saved["request"]["area"]
    request = Request(area if isinstance(area, str) else tuple(area), tuple(saved["request"]["categories"]), saved["request"]["use"], saved["request"]["version"])
    previous = spark.read.parquet(f"{path}/previous") if "previous" in saved["hashes"] else None
    again = run(spark.read.parquet(f"{path}/capture"), spark.read.parquet(f"{path}/sources"), taxonomy, request, previous)
    return _digest(again.tables["records"]) == saved["hashes"]["records"]
