"""The snapshot rule on a stream: late and contradictory deliveries of a scope are refused as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "query_hash string, timestamp timestamp, dataset_hash string, decision string"
STATE = "timestamp timestamp, dataset_hash string"


def _judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, seen = state.get if state.exists else (None, None)
    rows = pd.concat(list(batches), ignore_index=True).sort_values(["timestamp", "dataset_hash"], na_position="last", ignore_index=True)
    said = []
    for at, data in zip(rows["timestamp"], rows["dataset_hash"]):
        if pd.isna(at):
            said.append("UNVERIFIED_TIMESTAMP" if last is None else "ERROR missing timestamp")
        elif last is None or at > last:
            said.append("NEWER_SNAPSHOT")
            last, seen = at, data
        elif at < last:
            said.append("ERROR older")
        else:
            said.append("EQUAL_SNAPSHOT" if seen is None or data == seen else "ERROR equal timestamp, other data")
    if last is not None:
        state.update((pd.Timestamp(last).to_pydatetime(), seen))
    yield pd.DataFrame({"query_hash": key[0], "timestamp": rows["timestamp"], "dataset_hash": rows["dataset_hash"], "decision": said})


def judged_stream(descriptors: DataFrame) -> DataFrame:
    """decision of every descriptor (query_hash, timestamp, dataset_hash) against the last accepted one of its query_hash.

    State is one timestamp and hash per scope. Micro-batches are judged as they come; within one, whose rows a shuffle has mixed, those of a
    scope are judged by timestamp, then hash, those without a timestamp last, so the result does not depend on the partitioning.
    """
    flat = descriptors.select("query_hash", "timestamp", "dataset_hash")
    return flat.groupBy("query_hash").applyInPandasWithState(_judge, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
