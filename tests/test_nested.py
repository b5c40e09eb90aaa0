from pyspark.sql import types as T

from pagewright.operators import nested

SCHEMA = "chunk_id bigint, pages array<array<string>>, lens array<array<int>>, boxs array<array<array<int>>>, group_no string"


def brute(rows):
    """Positions with some and without some value, by plain loops."""
    found = set()
    for cid, pages, lens, boxs, _ in rows:
        values = {}
        for i, col in enumerate((pages, lens, boxs)):
            for g, group in enumerate(col or []):
                for n, v in enumerate(group or []):
                    ok = v is not None and (i < 2 or any(x is not None for x in v))
                    if ok:
                        values.setdefault((g, n), set()).add(i)
        found |= {(cid, g, n) for (g, n), have in values.items() if 0 < len(have) < 3}
    return found


ROWS = [
    (1, [["a"], ["b", None]], [[1], [2, 3]], [[[1, 2, 3, 4]], [[1, 2, 3, 4], []]], "clash"),
    (1, [["a"], ["b", None]], [[1], [2, 3]], [[[1, 2, 3, 4]], [[1, 2, 3, 4], []]], "clash"),
    (2, None, [[1]], [[[None, None]]], None),
    (3, [], [], [], "x"),
    (4, None, None, None, None),
    (None, [["p"]], None, None, "y"),
    (5, [None, ["p", "q", ""]], [[7]], [None, [[1], [2], [3]]], "z"),
]


def test_unequal_positions(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    paths = ["pages", "lens", "boxs"]
    flat = nested.flatten(df, ["chunk_id"], paths, 2, ["group_no", "node_no"])
    got = [tuple(r) for r in nested.unequal_positions(flat, ["chunk_id", "group_no", "node_no"], paths).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(ROWS)


def test_empty_table(spark):
    flat = nested.flatten(spark.createDataFrame([], SCHEMA), ["chunk_id"], ["pages", "lens"], 2, ["g", "n"])
    assert flat.count() == 0
    assert isinstance(flat.schema["lens"].dataType, T.IntegerType)


def test_structs_and_long_records(spark):
    rows = [(1, [[{"a": i, "b": None} for i in range(5000)]]), (2, None), (3, [None, [None, {"a": None, "b": "x"}]])]
    df = spark.createDataFrame(rows, "id int, xs array<array<struct<a:int,b:string>>>")
    import pyarrow as pa

    triples = {t.path: t for t in nested.shred(pa.array([r[1] for r in rows[:2]]), "xs")}
    assert set(triples) == {"xs.a", "xs.b"} and len(triples["xs.a"].values) == 5000
    assert triples["xs.a"].ordinals[1][-1] == 4999
    assert nested.flatten(df.withColumn("ys", df.xs), ["id"], ["ys"], 1, ["g"]).count() == 3
    flat = nested.flatten(df, ["id"], ["xs"], 2, ["g", "n"])
    assert flat.columns == ["id", "g", "n", "xs_a", "xs_b", "has_xs"] and flat.count() == 5002
    assert {tuple(r) for r in flat.filter("id = 3").collect()} == {(3, 1, 0, None, None, False), (3, 1, 1, None, "x", True)}


NESTED = "id bigint, name string, dims struct<w:int,h:int>, boxes array<struct<label:string,box:array<int>,parts:array<struct<t:string>>>>, pages array<array<string>>, lens array<array<int>>, boxes_label string"
DEEP = [
    (1, "a", (3, 4), [("x", [1, 2], [("p",), ("q",)]), ("y", None, None), None], [["1"], ["2", None]], [[5, 6]], "clash"),
    (2, None, None, [], None, [None, [7]], None),
    (3, "c", (None, 1), None, [], None, None),
]


def test_related_tables_by_schema(spark):
    df = spark.createDataFrame(DEEP, NESTED)
    t = nested.related(df, ["id"], [nested.Aligned(["pages", "lens"], ["groups", "nodes"], ["group_no", "node_no"])])
    assert set(t) == {"records", "boxes", "boxes.box", "boxes.parts", "groups", "nodes"}
    rows = lambda n: sorted((tuple(r) for r in t[n].collect()), key=str)
    assert t["records"].columns == ["id", "name", "dims_w", "dims_h", "n_boxes", "n_pages", "n_lens", "boxes_label"]
    assert rows("records") == [(1, "a", 3, 4, 3, 2, 1, "clash"), (2, None, None, None, 0, None, 2, None), (3, "c", None, 1, None, 0, None, None)]
    assert t["boxes"].columns == ["id", "no_1", "label", "n_box", "n_parts"]
    assert rows("boxes") == [(1, 0, "x", 2, 2), (1, 1, "y", None, None), (1, 2, None, None, None)]
    assert rows("boxes.box") == [(1, 0, 0, 1), (1, 0, 1, 2)]
    assert rows("boxes.parts") == [(1, 0, 0, "p"), (1, 0, 1, "q")]
    assert rows("groups") == [(1, 0, 1, 2), (1, 1, 2, None), (2, 0, None, None), (2, 1, None, 1)]
    assert rows("nodes") == [(1, 0, 0, "1", 5), (1, 0, 1, None, 6), (1, 1, 0, "2", None), (1, 1, 1, None, None), (2, 1, 0, None, 7)]
    empty = nested.related(spark.createDataFrame([], NESTED), ["id"])
    assert {n: x.count() for n, x in empty.items()} == dict.fromkeys(["records", "boxes", "boxes.box", "boxes.parts", "pages", "pages[]", "lens", "lens[]"], 0)
