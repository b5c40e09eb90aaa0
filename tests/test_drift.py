import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pagewright.operators import drift

AT = dt.datetime(2024, 1, 1)
SCHEMA = "stream_key string, file_name string, line_no int, written_at timestamp, payload string, path string"


def rows(*files, stream="s"):
    out = []
    for i, records in enumerate(files):
        for j, r in enumerate(records):
            out.append((stream, f"{stream}{i}", j, AT + dt.timedelta(days=i), r if isinstance(r, (str, type(None))) else json.dumps(r), "clash"))
    return out


def found(spark, data):
    df = drift.changes(spark.createDataFrame(data, SCHEMA))
    return {(r.file, r.change_kind, r.old_path, r.new_path) for r in df.collect()}


def test_kinds(spark):
    data = rows(
        [{"image_dims": {"w": 1, "h": 2}, "boxes": [{"label": "a", "box": [1, 2]}], "page": "1"}],
        [{"page": "1", "image_dims": {"width": 1, "h": 2}, "boxes": [{"label": "a", "box": [1, 2]}, {"label": None, "box": None}], "dpi": 3}],
        [{"page": 1, "image_dims": {"width": 1.5, "h": 2}, "boxes": [{"label": "a", "box": ["1"]}]}],
        ["{broken", None, {"page": 7, "image_dims": {"width": 2, "h": None}, "boxes": []}, {"page": 7, "image_dims": {"width": 2.5, "h": 1}, "boxes": [{"label": "x", "box": ["1"]}]}],
    )
    assert found(spark, data + data[:1]) == {
        ("s1", "renamed", "image_dims.w", "image_dims.width"),
        ("s1", "added", "", "dpi"),
        ("s2", "removed", "dpi", ""),
        ("s2", "retyped", "page", "page"),
        ("s2", "retyped", "image_dims.width", "image_dims.width"),
        ("s2", "retyped", "boxes[].box", "boxes[].box"),
    }


def test_order_is_that_of_writing_and_nothing_from_nothing(spark):
    data = rows([{"a": 1}], [{"a": 1, "b": 2}])
    assert found(spark, data[::-1]) == {("s1", "added", "", "b")}
    assert found(spark, rows([{"b": 1, "a": 2}], [{"a": 1, "b": 2}])) == set()
    assert drift.changes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert drift.consistent(spark.createDataFrame([], SCHEMA)).count() == 0


def test_null_has_no_type(spark):
    assert found(spark, rows([{"a": 1}], [{"a": None}], [{"a": "x"}])) == set()


@pytest.mark.parametrize("types,want", [({"integer", "fraction"}, "fraction"), ({"null"}, ""), ({"array<>", "array<integer>"}, "array<integer>"), ({"array<integer>", "array<fraction>"}, "array<fraction>")])
def test_merge_types(types, want):
    assert drift.merge_types(types) == want


def test_consistent_table(spark):
    data = rows([{"d": {"w": 1}, "t": "x"}], [{"d": {"width": 2}, "t": "y"}], [{"d": {"img_w": 2.5}, "t": None}])
    got = drift.consistent(spark.createDataFrame(data + data, SCHEMA))
    assert {(r.file, r.d.w, r.t) for r in got.collect()} == {("s0", 1.0, "x"), ("s1", 2.0, "y"), ("s2", 2.5, None)}
    assert got.count() == 3
    with_default = drift.consistent(spark.createDataFrame(data, SCHEMA), defaults={"t": "none", "nowhere": 1})
    assert {r.t for r in with_default.collect()} == {"x", "y", "none"}
    assert drift.field_values(got).filter("field = 't' and value is null").count() == 1


def test_old_name_that_comes_back_is_another_field(spark):
    data = rows([{"a": 1}], [{"b": 2}], [{"b": 3, "a": "x"}], [{"b": 4}], [{"a": "y", "b": 5}])
    got = drift.consistent(spark.createDataFrame(data, SCHEMA))
    assert dict(got.dtypes)["a"] == "bigint" and dict(got.dtypes)["a#2"] == "string"
    assert [(r["a"], r["a#2"]) for r in got.orderBy("file").collect()] == [(1, None), (2, None), (3, "x"), (4, None), (5, "y")]
    # a field that is taken away and comes back under its own name is the same
    again = drift.consistent(spark.createDataFrame(rows([{"a": 1, "c": 1}], [{"c": 1}], [{"a": 2, "c": 1}]), SCHEMA))
    assert "a#2" not in again.columns and [r.a for r in again.orderBy("file").collect()] == [1, None, 2]


def test_one_name_for_all_streams_nested_arrays_and_rows_delivered_twice(spark):
    data = rows([{"n": [{"w": 1, "k": []}]}], [{"n": [{"width": 2, "k": [{"z": True}]}, {"width": 3}]}], [{"n": []}], stream="s")
    data += rows([{"n": [{"width": 7}], "v": [1, "x"]}], stream="t") + rows([{"n": [{"w": 4}]}], stream="u")
    df = spark.createDataFrame(data + data[:3], SCHEMA)
    rows_ = drift.consistent(df).collect()
    got = {r.file: r for r in rows_}
    assert len(rows_) == len(data)
    counts = {r.path: r.n_values for r in drift.path_counts(drift.consistent(df)).collect()}
    assert counts == {"n[].w": 5, "n[].k[].z": 1, "v": 1}
    assert {f: [x.w for x in r.n] for f, r in got.items()} == {"s0": [1], "s1": [2, 3], "s2": [], "t0": [7], "u0": [4]}
    assert got["s0"].n[0].k == [] and got["s1"].n[0].k[0].z is True and got["s1"].n[1].k is None
    # a value of one file where others have fields, and names of mixed types
    mixed = drift.consistent(spark.createDataFrame(rows([{"d": 5}], [{"d": {"x": 1}}], ["{broken"]), SCHEMA))
    assert {(r.d._value, r.d.x) for r in mixed.collect()} == {(5, None), (None, 1)}


def test_deep_and_long_records():
    deep = "[" * 5000 + "]" * 5000
    assert drift.parse(deep) is None
    assert drift.parse("[1]") is None and drift.parse("") is None
    assert set(drift.paths_of({"a": [{"b": [{"c": 1}]}], "e": {}})) == {"a[].b[].c", "e"}
