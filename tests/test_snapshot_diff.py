import datetime as dt
import random

from atlasmill.functions.visible import reading_key, skeleton
from atlasmill.operators.snapshot_diff import snapshot_changes

ROW = "row_id long, source string, snapshot_no int, id string, address string, harvested_at timestamp, pos string, value int, next_no string"
T = dt.datetime(2026, 1, 1)


def records(spark, rows):
    return spark.createDataFrame([(i, s, n, k, a, T + dt.timedelta(hours=h) if h is not None else None, "x", 1, "y") for i, (s, n, k, a, h) in enumerate(rows)], ROW)


def taken(spark, rows):
    return spark.createDataFrame(rows, "source string, snapshot_no int, delivered boolean")


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_kinds_and_skipped_deliveries(spark):
    snaps = taken(spark, [("s", 1, True), ("s", 2, False), ("s", 3, True), ("s", 4, True), ("s", 5, False)])
    rows = records(spark, [
        ("s", 1, "kept", "Road 1", 0), ("s", 3, "kept", "ROAD  1​", 0), ("s", 4, "kept", "Ｒoad 2", 0),
        ("s", 1, "gone", "x", 0), ("s", 3, "new", None, 0), ("s", 4, "new", "  ", 0), ("s", 2, "ghost", "x", 0),
        ("s", 1, "back", "x", 0), ("s", 4, "back", "x", 0), ("s", 3, "last", "x", 0), ("s", 3, None, "x", 0),
    ])
    assert result(snapshot_changes(rows, snaps)) == [
        (3, "back", "removed"), (3, "gone", "removed"), (3, "new", "added"), (3, "last", "added"), (4, "back", "added"), (4, "kept", "changed"), (4, "last", "removed"),
    ] or set(result(snapshot_changes(rows, snaps))) == {
        (3, "back", "removed"), (3, "gone", "removed"), (3, "new", "added"), (3, "last", "added"), (4, "back", "added"), (4, "kept", "changed"), (4, "last", "removed"),
    }


def test_row_that_counts_and_ties(spark):
    snaps = taken(spark, [("s", 1, True), ("s", 2, True)])
    rows = records(spark, [("s", 1, "a", "one", 0), ("s", 1, "a", "two", 5), ("s", 1, "a", "three", None), ("s", 2, "a", "TWO", 1), ("s", 1, "t", "x", 1), ("s", 1, "t", "y", 1), ("s", 2, "t", "y", 1), ("s", 2, "t", "y", 1)])
    assert result(snapshot_changes(rows, snaps)) == []


def test_same_id_in_two_sources_and_empty_tables(spark):
    snaps = taken(spark, [("s", 1, True), ("s", 2, True), ("u", 1, True), ("u", 2, True)])
    rows = records(spark, [("s", 1, "a", "x", 0), ("u", 2, "a", "x", 0)])
    assert result(snapshot_changes(rows, snaps)) == [(2, "a", "added"), (2, "a", "removed")]
    assert result(snapshot_changes(records(spark, []), snaps)) == []
    assert result(snapshot_changes(rows, taken(spark, []))) == []


def test_equals_brute_force_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [("s", n, f"id{rng.randrange(300):03d}", rng.choice(["a", "A", "b", None, "", "c" * 5000]), rng.randrange(9)) for n in range(1, 5) for _ in range(250)]
    df, snaps = records(spark, rows), taken(spark, [("s", n, n != 3) for n in range(1, 5)])
    best = {}
    for i, (_, n, k, a, h) in enumerate(rows):
        if n != 3 and ((n, k) not in best or (h, i) > best[n, k][0]):
            best[n, k] = ((h, i), reading_key(a))
    want = []
    for p, n in ((1, 2), (2, 4)):
        old, new = ({k: v[1] for (m, k), v in best.items() if m == x} for x in (p, n))
        want += [(n, k, "added") for k in new.keys() - old.keys()] + [(n, k, "removed") for k in old.keys() - new.keys()]
        want += [(n, k, "changed") for k in old.keys() & new.keys() if old[k] != new[k]]
    assert result(snapshot_changes(df, snaps, partitions=7)) == sorted(want)


def test_skeleton():
    assert skeleton(None) is None and skeleton("") == "" and skeleton("​⁠") == ""
    assert skeleton("Ｐｈаrmасу  X") == "Pharmacy X"
    assert skeleton("é") == skeleton("é") and skeleton("E") != skeleton("e")
    assert skeleton("صیدلیة") == skeleton("صيدلية") and skeleton("ﺻﻴﺪﻟﻴﺔ") == skeleton("صيدلية")
    assert skeleton("علی") == skeleton("على") != skeleton("علي")
    assert skeleton("أ") == skeleton("أ") != skeleton("ا")
    assert skeleton("x²") != skeleton("x2") and len(skeleton("é " * 100_000)) > 100_000
