"""merge_quality counts every predicted pair, however many keys share a phone."""

import datetime as dt

from atlasmill.plans.places import merge_quality

T = dt.datetime(2026, 1, 1)


def test_merge_quality_counts_busy_phones(spark, tmp_path):
    rows = [(i, "s", 1, f"c{i}", "929001418", T) for i in range(60)] + [(60, "s", 1, "p", "0111", T), (61, "s", 1, "q", "0111", T), (62, "s", 1, "r", None, T), (63, "s", 1, "c0", "929001418", T)]
    groups = [(f"e{i // 3}", f"s:c{i}") for i in range(60)] + [("x", "s:p"), ("x", "s:q"), ("x", "s:r"), ("x", "s:r")]
    for name, data, schema in (
        ("riyadh_pharmacies", rows, "row_id long, source string, snapshot_no int, id string, phone string, harvested_at timestamp"),
        ("riyadh_pharmacies_alt", [(1, "s", "r", "01-11"), (2, "s", "nobody", "0111"), (3, "s", None, "0111")], "row_id long, source string, id string, phone string"),
        ("snapshots", [("s", 1, T, True)], "source string, snapshot_no int, taken_at timestamp, delivered boolean"),
        ("merge_groups", groups, "entity_id string, source_key string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    q = merge_quality(spark, str(tmp_path)).first()
    said, true, gold = 60 * 59 // 2 + 3, 20 * 3 + 3, 20 * 3 + 3  # r has its phone from the second table
    assert (q["true_pairs"], q["false_pairs"], q["missed_pairs"]) == (true, said - true, gold - true)
    assert (q["precision"], q["recall"]) == (round(true / said, 6), round(true / gold, 6))
