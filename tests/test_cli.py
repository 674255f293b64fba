import json

from atlasmill.__main__ import main

SOURCE = {"kind": "fixture", "license": "L", "allowed_uses": ["internal"], "commercial_use": True, "auth_mode": "none", "coverage_bbox": None, "freshness": "f", "attribution": "A", "rate_limit_per_second": 1}


def test_run_verify_replay_and_errors(spark, tmp_path, capsys):
    (tmp_path / "one.json").write_text(json.dumps([{"id": "1", "lat": 24.71, "lon": 46.73, "category": "pharmacy", "name_en": "Sidra Pharmacy"}, {"id": "2", "lat": 24.71002, "lon": 46.73, "category": "pharmacy", "name_en": "Yara Pharmacy"}]))
    (tmp_path / "two.json").write_text(json.dumps([{"id": "9", "lat": 24.71001, "lon": 46.73, "category": "pharmacy", "name_ar": "صيدلية سدرة", "hours": "24/7"}]))
    registry = tmp_path / "sources.json"
    registry.write_text(json.dumps({"sources": [{**SOURCE, "name": "one", "path": "one.json", "reliability_weight": 0.9}, {**SOURCE, "name": "two", "path": "two.json", "reliability_weight": 0.5}]}))
    out = str(tmp_path / "run")
    common = ["run", "--registry", str(registry), "--categories", "pharmacy", "--out", out]
    assert main([*common, "--box", "24", "46", "25", "47"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["places"] == 2
    assert main(["verify", out], spark) == 0 and main(["replay", out], spark) == 0
    assert main(["run", "--registry", str(registry), "--categories", "spaceport", "--out", out, "--box", "24", "46", "25", "47"], spark) == 2
    assert main([*common, "--sources", "three", "--box", "24", "46", "25", "47"], spark) == 2
    assert main(["intent", "pharmacies in Olaya"], spark) == 0 and json.loads(capsys.readouterr().out.splitlines()[-1])["categories"] == ["pharmacy"]
