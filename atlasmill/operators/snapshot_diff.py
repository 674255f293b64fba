"""What changed between consecutive full snapshots: a merge that streams over ranges of sorted keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.visible import reading_key
from atlasmill.tables import delivered, small


def _events(g: pd.DataFrame, before: pd.Series | None, same: Callable[[object, object], bool]) -> list[pd.DataFrame]:
    """Events of rows sorted by id, source, pos, one per snapshot; `before` is the row ahead of the first."""
    ids, pos = g["id"].to_numpy(object), g["pos"].to_numpy()
    src, val = g["source"].to_numpy(object), g["value"].to_numpy(object)
    prev_id, prev_src = np.roll(ids, 1), np.roll(src, 1)
    prev_pos, prev_val, prev_next = np.roll(pos, 1), np.roll(val, 1), np.roll(g["next_no"].to_numpy(float), 1)
    if before is None:
        prev_id[0] = prev_src[0] = None
        prev_pos[0] = -9
    else:
        prev_id[0], prev_src[0], prev_pos[0], prev_val[0], prev_next[0] = before["id"], before["source"], before["pos"], before["value"], before["next_no"]
    known = (prev_id == ids) & (prev_src == src)
    step = known & (prev_pos == pos - 1)
    out = []
    added = ~step & (pos > 0)
    out.append(pd.DataFrame({"snapshot_no": g["snapshot_no"].to_numpy()[added], "id": ids[added], "change_kind": "added"}))
    # The row ahead ended without a successor in the next delivery.
    gone = ~step & ~np.isnan(prev_next) & np.array([x is not None for x in prev_id])
    out.append(pd.DataFrame({"snapshot_no": prev_next[gone].astype("int64"), "id": prev_id[gone], "change_kind": "removed"}))
    at = np.flatnonzero(step)
    at = at[[val[i] != prev_val[i] and not same(val[i], prev_val[i]) for i in at]] if len(at) else at
    out.append(pd.DataFrame({"snapshot_no": g["snapshot_no"].to_numpy()[at], "id": ids[at], "change_kind": "changed"}))
    return out


def snapshot_changes(records: DataFrame, snapshots: DataFrame, value: str = "address", partitions: int | None = None) -> DataFrame:
    """snapshot_no, id, change_kind ('added', 'removed', 'changed') between consecutive delivered snapshots of each source.

    Rows are range-partitioned by id and sorted by id, source, snapshot, so that one pass over each range merges all
    snapshots of a key; only the last row is carried from batch to batch. Of several rows of an id in a snapshot the one with the
    greatest harvested_at, then row_id, counts. 'changed' compares `value` by reading_key(): null and blank are alike. Rows
    without id or of snapshots that were not delivered take no part; a source's first delivery adds nothing. An id that comes back
    after an absence is added again. Equal rows count once; other columns are not read.
    """
    steps = delivered(snapshots)
    rows = (
        records.select("id", "source", "snapshot_no", "harvested_at", "row_id", F.col(value).cast("string").alias("value"))
        .filter("id is not null")
        .join(small(steps), ["source", "snapshot_no"])
        .select("id", "source", "pos", "snapshot_no", "next_no", "harvested_at", "row_id", "value")
    )
    ranged = rows.repartitionByRange(partitions, "id") if partitions else rows.repartitionByRange("id")
    ranged = ranged.sortWithinPartitions("id", "source", "pos", F.asc_nulls_first("harvested_at"), F.asc_nulls_first("row_id"))
    ranged = ranged.select("id", "source", "pos", "snapshot_no", "next_no", "value")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str | None, str] = {}

        def key(v: object) -> str:
            v = v if isinstance(v, str) else None
            if v not in cache:
                if len(cache) > 50_000:
                    cache.clear()
                cache[v] = reading_key(v)
            return cache[v]

        def same(a: object, b: object) -> bool:
            return key(a) == key(b)

        held: pd.DataFrame | None = None  # the last key's newest row, which the next batch may supersede
        before: pd.Series | None = None
        for batch in batches:
            g = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if g.empty:
                continue
            same_key = (g["id"].to_numpy(object)[1:] == g["id"].to_numpy(object)[:-1]) & (g["source"].to_numpy(object)[1:] == g["source"].to_numpy(object)[:-1])
            last = np.append(~(same_key & (g["pos"].to_numpy()[1:] == g["pos"].to_numpy()[:-1])), True)
            g = g[last].reset_index(drop=True)
            held, g = g.iloc[-1:], g.iloc[:-1]
            if len(g):
                yield from _events(g, before, same)
                before = g.iloc[-1]
        if held is not None:
            end = held.iloc[[0, 0]].reset_index(drop=True).astype({c: object for c in ("id", "source", "value")})
            end.loc[1, ["id", "source", "value"]] = None  # a row of no key, which ends the last one
            end["next_no"] = end["next_no"].astype("float64")
            end.loc[1, ["pos", "snapshot_no", "next_no"]] = [0, 0, float("nan")]
            yield from _events(end, before, same)

    return ranged.mapInPandas(merge, "snapshot_no int, id string, change_kind string")
