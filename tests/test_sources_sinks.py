import pytest
import json
import zipfile

from pyspark.sql import functions as F

from pagewright.operators import layout
from pagewright.plans import pipelines
from pagewright.sinks import files as sinks
from pagewright.sources import clients, docx, grounding
from pagewright.sources import files as sources
from pagewright.streaming import polling

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
DOC = f"""<w:document xmlns:w="{W}" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><w:body>
<w:p><w:r><w:t>第一段</w:t></w:r><w:r><w:footnoteReference w:id="2"/></w:r></w:p>
<w:p><w:r><w:br w:type="page"/></w:r><w:r><w:t>第二页</w:t></w:r></w:p>
<w:p><w:r><w:drawing><a:blip r:embed="rId1"/></w:drawing></w:r></w:p></w:body></w:document>"""


def word_file(path):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", DOC)
        z.writestr("word/_rels/document.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="media/i.png"/></Relationships>')
        z.writestr("word/media/i.png", b"png")
        z.writestr("word/footnotes.xml", f'<w:footnotes xmlns:w="{W}"><w:footnote w:id="2"><w:p><w:r><w:t>注文</w:t></w:r></w:p></w:footnote></w:footnotes>')


def test_docx(spark, tmp_path):
    word_file(tmp_path / "a.docx")
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    rows = docx.read(spark, str(tmp_path))
    assert rows.filter("kind = 'error'").count() == 1
    got = [(r.type, r.content, r.page, r.footnote) for r in docx.paragraphs(rows).orderBy("place").collect()]
    assert got == [("text", "第一段", 1, ["2: 注文"]), ("text", "第二页", 2, []), ("image", "cG5n", 2, [])]
    (tmp_path / "c.pdf").write_bytes(b"x")
    (tmp_path / "d.txt").write_bytes(b"x")
    files = spark.createDataFrame([(f"file:{tmp_path}/c.pdf",), (f"file:{tmp_path}/d.txt",)], "path string")
    out = pipelines.dispatch(spark, files, str(tmp_path), lambda p: {"pdfContent": [{"content": "甲"}, None, {"content": "乙"}]}).collect()
    assert sorted(r.content for r in out if r.path.endswith(".pdf") and r.content) == ["乙", "甲"]
    assert [r.error for r in out if r.path.endswith(".txt")] == ["no reader for txt"]


def test_json_sources(spark, tmp_path):
    page = {"success": True, "boxes": [{"label": "text", "box": [1, 2, 3, 4], "text_content": "甲"}, {"label": "text", "box": [0, 0, 9, 9], "text_content": "乙丙", "merged_boxes": [[1, 1, 2, 2], [3, 3, 4, 4]], "merged_text_lens": [1, 1]}], "image_dims": {"w": 10, "h": 10}}
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "10.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "p" / "x.json").write_text("")
    pages = sources.ocr_pages(spark, str(tmp_path / "p"))
    row = sources.to_nodes(pages).first()
    assert (pages.first().file_no, row.page, row.page_text_len) == (10, "10", 4)
    assert [n.node_index for n in row.nodes] == [[0], [1, 2]] and row.nodes[1].text_len == [1, 1]
    rec = {"filename": "8.json", "page": "8", "nodes": [{"node_index": 0, "text_len": 3, "box": [1, 2, 3, 4], "text": "a"}, {"node_index": [1, 2], "text_len": [1, 2], "box": [[1, 2, 3, 4], [5, 6, 7, 8]], "text": "b"}]}
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "8.json").write_text(json.dumps([rec]))
    n = sources.page_records(spark, str(tmp_path / "r")).first().nodes
    assert (n[0].node_index, n[0].boxs, n[1].text_len, n[1].boxs[1]) == ([0], [[1, 2, 3, 4]], [1, 2], [5, 6, 7, 8])
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a12.json").write_text(json.dumps({"id": "1", "errors": [{"content": "x", "rightSentences": "y"}]}))
    assert sources.check_results(spark, str(tmp_path / "c")).first().file_no == 12
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "1.json").write_text(json.dumps({"image_info": [{"width": 5, "height": 6}], "data": [{"layout": [], "text_lines": [{"poly": [1, 2, 9, 2, 9, 30, 1, 30], "text": "行"}]}]}))
    t = sources.third_party(spark, str(tmp_path / "t")).first()
    assert (t.box, t.font, t.text) == ([1, 2, 9, 30], 28, "行")
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "3.json").write_text(json.dumps({"blocks": [{"type": 0, "bbox": [0, 0, 1, 1], "lines": [{"spans": [{"text": "x", "size": 9, "flags": 0, "font": "f", "bbox": [0, 1, 2, 3]}]}]}]}))
    s = sources.spans(spark, str(tmp_path / "s")).first()
    assert (s.page, s.x1, s.text) == (3, 2.0, "x")
    lines = tmp_path / "l.txt"
    lines.write_text("　a \n\n b\n")
    assert [r.line for r in sources.text_lines(spark, str(lines)).collect()] == ["a", "b"]


def test_catalogue(spark, tmp_path):
    (tmp_path / "admin2").mkdir()
    (tmp_path / "admin2" / ("n" * 30 + ".pdf")).write_bytes(b"123")
    word_file(tmp_path / "w.docx")
    got = sources.catalogue(spark, str(tmp_path)).collect()
    assert {r.directory_name for r in got} >= {"admin2"} and max(len(r.shown) for r in got) > 30
    assert {r.length for r in got} >= {3}


def test_grounding(spark):
    raw = "<|ref|>text<|/ref|><|det|>[[0, 999, 10, 20]]<|/det|>\n甲\n\n<|ref|>bad<|/ref|><|det|>[[1, 2]]<|/det|>x<|ref|>title<|/ref|><|det|>[[1, 2, 3, 4]]<|/det|>\n乙"
    df = spark.createDataFrame([(1, raw, (100, 200)), (2, None, None), (3, "", (1, 1)), (4, "no tokens", None)], "page_id bigint, raw_text string, image_dims struct<w:int,h:int>")
    got = [(r.page_id, r.node_index, r.ref, r.d1, r.text) for r in grounding.parse(df).collect()]
    assert got == [(1, 0, "text", 999, "甲"), (1, 1, "title", 2, "乙")]


def test_clients(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")

    def client(x):
        if x == "b":
            raise OSError("down")
        return {"words": [{"w": x}]}

    out = clients.call(items, "k", "x", client, in_flight=2, attempts=2, wait=0.0).persist()
    assert {(r.k, r.error, r.attempts) for r in out.collect()} == {(1, None, 1), (2, "OSError: down", 2)}
    assert [r.k for r in clients.missing(items, out, "k").collect()] == [2]
    assert clients.extraction_parts(out, "k")["words"].first().id == 1
    pages = clients.pages_of(spark.createDataFrame([("p", bytearray(b"ab"))], "path string, content binary"), lambda c: [c[:1], c[1:]])
    assert [(r.page, bytes(r.image)) for r in pages.orderBy("page").collect()] == [(1, b"a"), (2, b"b")]
    boxes = spark.createDataFrame([("p", 1, 0, 1, 2, 3, 4, "t")], "path string, page int, box_no int, x0 int, y0 int, x1 int, y1 int, text string")
    drawn = clients.draw(pages, boxes, ["path", "page"], lambda i, b: i + str(len(b)).encode()).collect()
    assert [bytes(r.image) for r in drawn] == [b"a1"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("d", 1, 0, "甲"), ("d", 1, 1, "乙"), ("e", 1, 0, None)], "doc_key string, page int, box_no int, content string")
    sinks.markdown(df, str(tmp_path / "md"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "md" / "doc_key=d").glob("part*")))
    assert text == "甲\n\n乙\n\n"
    ids = sinks.with_ids(df, ["doc_key"], ["page", "box_no"], F.lit(7)).filter("doc_key = 'd'").orderBy("id").collect()
    assert [(r.id, r.type, r.number) for r in ids] == [(1, "text", 7), (2, "text", 7)]
    arr = sinks.json_array(df, "doc_key", ["page", "box_no"]).filter("doc_key = 'd'").first().json
    assert [x["content"] for x in json.loads(arr)] == ["甲", "乙"]
    sinks.json_lines(df, str(tmp_path / "jl"))
    assert spark.read.json(str(tmp_path / "jl")).count() == 3
    sinks.publish(df, str(tmp_path / "pub"), "1")
    sinks.publish(df.limit(1), str(tmp_path / "pub"), "2")
    assert sinks.current(spark, str(tmp_path / "pub")).count() == 1
    a = spark.createDataFrame([(1, None, True), (2, "e", True), (3, None, False)], "k int, error string, valid boolean")
    assert sinks.dead_letters(a, str(tmp_path / "dead")).count() == 1 and spark.read.parquet(str(tmp_path / "dead")).count() == 2
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    def fails(x):
        raise RuntimeError("half way")

    with pytest.raises(RuntimeError):
        pipelines.staged(df, None, "merge", fails, state, out, "1")
    pipelines.staged(df, None, "merge", lambda x: x, state, out, "1")
    pipelines.staged(df, None, "merge", lambda x: x, state, out, "1")
    assert spark.read.parquet(f"{out}/data").count() == 3
    more = df.unionByName(df.limit(1).withColumn("doc_key", F.lit("f")))
    again = pipelines.staged(more, spark.read.parquet(state), "merge", lambda x: x, state, out, "2")
    assert again.count() == 1 and spark.read.parquet(f"{out}/data").count() == 4
    assert {r.doc_key for r in sinks.stages_done(spark.read.parquet(state), "merge").collect()} == {"d", "e", "f"}


def test_document_keys_settings_and_regions(spark, tmp_path):
    for book in ("b 1", "b+2"):
        (tmp_path / "in" / book).mkdir(parents=True)
        span = {"blocks": [{"type": 0, "lines": [{"spans": [{"text": book, "size": 9.5, "flags": 0, "font": "f", "bbox": [0.5, 1.5, 2.5, 3.5]}]}]}]}
        (tmp_path / "in" / book / "3.json").write_text(json.dumps(span))
    got = sources.spans(spark, str(tmp_path / "in")).collect()
    assert {(r.doc_key, r.page, r.text) for r in got} == {("b 1", 3, "b 1"), ("b+2", 3, "b+2")}
    (tmp_path / "set" / "x").mkdir(parents=True)
    (tmp_path / "set" / "x" / "p.json").write_text('{"prompt": "ask", "n": 3}')
    (tmp_path / "set" / "y").mkdir()
    (tmp_path / "set" / "y" / "p.json").write_text("{broken")
    s = {r.doc_key: (r.prompt, r.mode) for r in sources.settings(spark, str(tmp_path / "set"), {"prompt": "default", "mode": "m"}).collect()}
    assert s == {"x": ("ask", "m"), "y": ("default", "m")}
    (tmp_path / "tp").mkdir()
    (tmp_path / "tp" / "1.json").write_text(json.dumps({"image_info": [{"width": 9, "height": 9}], "data": [{"layout": [{"loc": [0, 0, 9, 9], "sub_layout": [{"loc": [1, 1, 2, 2], "type": "t"}, {"loc": [3, 3, 4, 4], "type": "u"}]}, {"loc": [5, 5, 6, 6]}], "text_lines": [{"poly": [0, 0, 20, 0, 20, 14, 0, 14], "text": "x"}]}]}))
    regions = {(r.layout_no, r.sub_no, r.type) for r in sources.third_party_regions(spark, str(tmp_path / "tp")).collect()}
    assert regions == {(0, 0, "t"), (0, 1, "u"), (1, None, None)}
    lines = spark.createDataFrame([("x", [0, 1, 20, 1, 20, 15, 0, 15])], "text string, poly array<int>")
    big = clients.redraw(lines, 2).first()
    assert (big.points, big.x, big.y, big.font) == ([0, 2, 40, 2, 40, 30, 0, 30], 0, 2, 14)
    a, b = spark.createDataFrame([("p/1.png", 1), ("2.png", 2)], "file_name string, n int"), spark.createDataFrame([("1.json", 7)], "file_name string, n int")
    assert [(r.n, r.right_n) for r in clients.by_base_name(a, b).collect()] == [(1, 7)]


def test_answers_keep_nested_parts_and_endpoints(spark):
    answers = spark.createDataFrame([(1, '{"words": [{"t": "a", "box": {"x": 1}, "l": [1, 2]}, null], "docInfo": {"n": 3, "meta": {"a": "b"}}}')], "k int, result string")
    parts = clients.extraction_parts(answers, "k")
    rows = parts["words"].orderBy(F.col("id").isNull()).collect()
    assert rows[0].item == {"t": "a", "box": '{"x":1}', "l": "[1,2]"} and rows[1].id is None
    assert parts["docInfo"].first().item == {"n": "3", "meta": '{"a":"b"}'}
    items = spark.range(40).selectExpr("id k", "cast(id as string) x")
    out = clients.call(items, "k", "x", lambda x, at: at, endpoints=["u", "v"], per_endpoint=2, wait=0).collect()
    assert len(out) == 40 and {json.loads(r.result) for r in out} == {"u", "v"}


PAGES = "page_id bigint, doc_key string, page int, image_dims struct<w:int,h:int>, boxes array<struct<label:string,box:array<int>,text_content:string>>, ingested_at timestamp, text string"


def test_streaming(spark, tmp_path):
    src = str(tmp_path / "in")
    row = lambda i, d: (i, d, i, (10, 10), [("text", [0, 0, 1, 1], f"第{i}页没有完")])
    cols = "page_id bigint, doc_key string, page int, image_dims struct<w:int,h:int>, boxes array<struct<label:string,box:array<int>,text_content:string>>"

    def add(rows):
        spark.createDataFrame(rows, cols).withColumns({"ingested_at": F.current_timestamp(), "text": F.lit("x")}).write.mode("append").parquet(src)

    add([row(1, "a"), row(2, "a"), row(2, "a")])
    counts = spark.createDataFrame([("a", 2), ("b", 2)], "doc_key string, n_pages int")
    run = lambda df: layout.chunks(layout.pack(layout.items(layout.blocks(polling.complete_documents(df, counts)))))
    for _ in range(2):
        stream = polling.arriving(spark, src, PAGES, "parquet", key=["page_id"])
        q = polling.poll(stream, run, str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination(120)
        add([row(3, "b"), row(4, "b")])
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_key, r.content) for r in got.collect()) == [("a", "第1页没有完\n第2页没有完"), ("b", "第3页没有完\n第4页没有完")]
    w = polling.page_counts(polling.arriving(spark, src, PAGES, "parquet"))
    q = w.writeStream.outputMode("update").format("memory").queryName("pc").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select sum(pages) from pc where doc_key = 'b'").first()[0] >= 2
