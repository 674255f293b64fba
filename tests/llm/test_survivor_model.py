"""Where no member dominates, the quality model and not the weight picks the survivor."""

import datetime as dt

from atlasmill.llm.survivors import survivors

T = dt.datetime(2026, 1, 1)


def test_model_decides_without_a_dominant_member(spark):
    names = "نخيل كوثر رمال مشكاة زيتون فنار سلوان بدرية جمانة وسام حكمة ليان سحاب رواد قنديل غيمة".split()
    rows = []
    for i, n in enumerate(names):
        rows += [(f"g{i}", "name_ar", f"{s}:{i}", s, T, f"صيدلية {n}") for s in ("good1", "good2", "good3")]
        rows.append((f"g{i}", "name_ar", f"liar:{i}", "liar", T, f"صيدلية {names[i - 1]} {n}"))
    rows += [("x", "name_ar", "good1:x", "good1", T, "صيدلية شروق"), ("x", "name_ar", "liar:x", "liar", T, "صيدلية نورس")]
    members = spark.createDataFrame(rows, "group string, field string, source_key string, source string, harvested_at timestamp, value string")
    sources = spark.createDataFrame([("liar", 0.9), ("good1", 0.4), ("good2", 0.4), ("good3", 0.4)], "name string, reliability_weight double")
    got = {r["group"]: r for r in survivors(members, sources).collect()}
    assert got["x"]["source_key"] == "good1:x" and not any(r["dominant"] for r in got.values())
    assert all(not got[f"g{i}"]["source_key"].startswith("liar") for i in range(len(names)))
