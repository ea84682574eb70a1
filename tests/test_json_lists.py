"""Objects of large JSON lists against the standard parser, over many byte ranges."""

import json
import random

import pytest

from wakeline.sources import json_lists, readers


def element(r, k):
    return {"id": f"f{k}", "properties": {"name": r.choice(["a},b", 'q"},{"', "\\", '\\"},', "é},[", "plain"]), "n": k, "deep": {"x": [{"y": 1}, {"z": {"w": "},"}}]}},
            "geometry": {"type": "Point", "coordinates": [k / 7, 1.5]}}


@pytest.mark.parametrize("split", [700, 1 << 20])
@pytest.mark.parametrize("kind", ["plain", "wrapped", "later", "spaced"])
def test_elements_equal_the_parser(spark, tmp_path, split, kind):
    r = random.Random(4)
    rows = [element(r, k) for k in range(60)]
    whole = {"plain": rows, "wrapped": {"features": rows, "after": {"a": {"b": 1}, "features": [{"no": 1}]}, "z": 1},
             "later": {"crs": {"p": {"q": "},"}, "features": [{"no": 2}]}, "bbox": [{"features": [1]}], "t": "x},y", "features": rows}, "spaced": {"type": "x", "features": rows}}[kind]
    text = json.dumps(whole, ensure_ascii=False, separators=(",", ":")) if kind != "spaced" else json.dumps(whole, indent=1)
    (tmp_path / "in.json").write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        path = str(tmp_path / "in.json")
        if split == 700:
            assert json_lists._fragments(spark, path).select("block").distinct().count() > 5  # one file, many ranges
        got = sorted((x["index"], x["record"]) for x in json_lists.read_lists(spark, path, ["vessels", "features"]).collect())
    finally:
        for name, value in zip(("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"), before):
            spark.conf.set(name, value)
    assert [k for k, _record in got] == list(range(60))
    assert [json.JSONDecoder().raw_decode(record)[0] for _k, record in got] == rows


def test_files_without_rows(spark, tmp_path):
    for k, text in enumerate(["[]", "{}", '{"features":[]}', '{"features":7}', "", "[5, 6]", '{"a":{"features":[{"x":1}]}}']):
        (tmp_path / f"{k}.json").write_text(text)
    assert json_lists.read_lists(spark, str(tmp_path), ["features"]).collect() == []


def test_geojson_file_equals_one_value(spark, tmp_path):
    r = random.Random(5)
    rows = [element(r, k) for k in range(20)] + [{"properties": None, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]
    (tmp_path / "layer.json").write_text(json.dumps({"type": "FeatureCollection", "features": rows}))
    path = str(tmp_path / "layer.json")
    whole = readers.feature_rows(spark.read.text(path, wholetext=True), "pipe")
    columns = ["feature_id", "infrastructure_type", "geometry", "geometry_type", "index"]
    assert sorted(map(tuple, readers.read_geojson(spark, {"pipe": path}).select(*columns).collect())) == sorted(map(tuple, whole.select(*columns).collect()))
