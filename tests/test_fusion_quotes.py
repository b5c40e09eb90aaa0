import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.operators import fusion as FU
from pagewright.operators import quotes as Q
from pagewright.operators import spans, stats
from pagewright.plans import pipelines
from pagewright.sinks import envelope, report

TEXT = st.text(alphabet="ab 字\n。c", max_size=40)


@settings(max_examples=200, deadline=None)
@given(TEXT, TEXT)
def test_fusion_keeps_characters_and_blanks(layout, characters):
    out = FU.fuse(layout, characters)
    assert re.sub(r"\s", "", out) == re.sub(r"\s", "", characters)
    assert re.sub(r"\S", "", out) == re.sub(r"\S", "", layout)


def plain_fill(layout, characters):
    src, out, i = [c for c in characters if not c.isspace()], [], 0
    for c in layout:
        if c.isspace() or i >= len(src):
            out.append(c)
        else:
            out.append(src[i])
            i += 1
    return "".join(out + src[i:])


def test_positional_fill(spark):
    cases = [("甲 乙\n丙", "一二三四"), ("甲乙丙", "一"), ("", "ab"), (" \n", ""), (None, None), ("a b c", "x　y"), ("字" * 3000, "文" * 10)]
    got = [r.o for r in spark.createDataFrame(cases, "a string, b string").select(FU.filled(F.col("a"), F.col("b")).alias("o")).collect()]
    assert got == [plain_fill(a or "", b or "") for a, b in cases]
    assert [r.o for r in spark.createDataFrame(cases[:2], "a string, b string").select(FU.fused(F.col("a"), F.col("b")).alias("o")).collect()] == [FU.fuse(*c) for c in cases[:2]]


SAID = "会上，老馆长指出：“要先保存再整理[1]。”随后老馆长强调，原件必须留在库房里面。记录员说“好的呀”。老馆长表示：抄本比刻本少了两行，需要核对"


def test_candidates(spark):
    rules = Q.Rules("老馆长|记录员")
    found = Q.candidates_of(SAID, rules)
    assert {(c[6] and c[7], c[5]) for c in found} >= {("quoted", "老馆长"), ("noquote", "老馆长")}
    assert all(SAID[c[2] : c[3]] == c[1] for c in found)
    assert [c[2] for c in found] == sorted(c[2] for c in found)
    df = spark.createDataFrame([(1, SAID), (2, "没有"), (3, None), (4, "")], "id int, text string")
    assert {r.id for r in Q.candidates(df.select(F.col("id").alias("doc"), "text"), "doc", "text", rules).select(F.col("doc").alias("id")).collect()} == {1}
    assert Q.candidates_of("", rules) == []


def test_contained_quotes(spark):
    rows = [("d", 0, "要先保存再整理"), ("d", 1, "我们要先保存，再整理！"), ("d", 2, "整理"), ("d", 3, "好"), ("d", 4, "好。"), ("e", 5, "整理"), (None, 6, "整理"), ("d", 7, "，")]
    df = spark.createDataFrame(rows, "doc string, n int, q string")
    clean = lambda s: re.sub(r"[^\w]", "", s)
    want = {n for d, n, q in rows if not any(d == d2 and n != n2 and clean(q) in clean(q2) and (len(clean(q2)) > len(clean(q)) or (clean(q) == clean(q2) and n2 < n)) for d2, n2, q2 in rows)}
    assert {r.n for r in Q.without_contained(df, ["doc"], "q", ["n"]).collect()} == want


def test_adjudication_and_validation(spark):
    c = spark.createDataFrame([(1, "Q0", "原话甲"), (1, "Q1", "原话乙")], "k int, id string, text string")
    v = spark.createDataFrame([(1, "Q0", True, "", "direct"), (1, "Q1", False, "x", "direct"), (1, "Q9", True, "y", "direct")], "k int, id string, keep boolean, text string, type string")
    assert [(r.id, r.text) for r in Q.adjudicated(c, v, ["k"]).collect()] == [("Q0", "原话甲")]
    a = spark.createDataFrame([("{\"data\":{\"people\":[{\"name\":\"甲\",\"quotes\":[{\"text\":\"话\"}]}]}}", "甲说话"), ("not json", "x"), (None, "x"), ("{\"data\":{\"people\":[{\"name\":\"丙\",\"quotes\":[]}]}}", "甲")], "a string, s string")
    assert [r.valid for r in Q.valid_answers(a, "a", "s").collect()] == [True, False, False, False]
    p = spark.createDataFrame([("{\"错误列表\":[{\"原始值\":\"错子\",\"建议修改值\":\"错字\"}]}", "有<b>错 子</b>"), ("{\"错误列表\":[]}", "x")], "a string, s string")
    assert [r.valid for r in Q.valid_corrections(p, "a", "s").collect()] == [True, False]


def test_ask_never_raises(spark):
    def client(p):
        if "bad" in p:
            raise ValueError("no")
        return p.upper()

    got = {r.k: (r.answer, r.error, r.attempts) for r in Q.ask(spark.createDataFrame([("a", "x"), ("b", "bad")], "k string, p string"), "k", "p", client, 2).collect()}
    assert got == {"a": ("X", None, 1), "b": (None, "ValueError: no", 2)}


def test_answers_that_dont_hold_are_asked_again(spark):
    def client(p):
        return "{}" if "strict JSON" in p else "no json"

    df = spark.createDataFrame([("a", "x")], "k string, p string")
    r = Q.ask(df, "k", "p", client, 3, Q.is_json, Q.REPAIR).first()
    assert (r.answer, r.error, r.attempts, r.rejected) == ("{}", None, 2, ["no json"])
    r = Q.ask(df, "k", "p", lambda p: "no json", 3, Q.is_json).first()
    assert (r.error, r.attempts, len(r.rejected)) == ("the answer doesn't hold", 3, 3)
    rec = spark.createDataFrame([(1, SAID)], "rec int, text string")
    found = Q.candidates(rec, "rec", "text", Q.Rules("老馆长"))
    ids = [r.id for r in found.collect()]

    def judge(p):
        return "{\"items\":[{\"id\":\"%s\",\"keep\":true,\"text\":\"原话①\"}]}" % ids[0] if "strict JSON" in p else "sorry"

    v = Q.adjudicate(rec, "rec", "text", found, judge, "keep?").collect()
    assert [(x.rec, x.id, x.keep, x.text, x.type) for x in v] == [(1, ids[0], True, "原话", "direct")]
    assert [x.text for x in Q.adjudicated(found, spark.createDataFrame(v), ["rec"]).collect()] == ["原话"]


def test_cue_patterns(spark):
    said = "老馆长在会上讲话：“档案要保存下去，一页也不能少。”"
    got = Q.candidates_of(said, Q.Rules("老馆长"))
    assert any(c[7] == "quoted" and c[4] == "在会上讲话" for c in got)


def test_contained_quotations_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [(d, i, "".join(rng.choices("甲乙丙丁。", k=rng.choice([0, 1, 1, 2, 3, 6, 7, 12, 30])))) for d in ("a", "b", None) for i in range(60)]
    rows += [("c", 1, "。"), ("c", 2, "，"), ("e", 1, "。"), ("e", 2, "甲乙丙")]
    df = spark.createDataFrame(rows, "d string, i int, t string")
    clean = lambda t: "".join(c for c in t if c.isalnum())
    want = {(d, i) for d, i, t in rows if not any(e == d and clean(t) in clean(u) and (len(clean(u)) > len(clean(t)) or clean(u) == clean(t) and j < i) for e, j, u in rows)}
    got = [(r.d, r.i) for r in Q.without_contained(df, ["d"], "t", ["i"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_tables_found_by_alignment(spark):
    cols = "doc_key string, page int, block_no int, line_no int, span_no int, text string, size double, flags int, font string, x0 double, y0 double, x1 double, y1 double"
    line = lambda p, y, cells: [("d", p, 0, int(y), i, t, 10.0, 0, "f", x, y, x + 8.0 * len(t), y + 10) for i, (x, t) in enumerate(cells)]
    rows = line(1, 10.0, [(10.0, "plain text over"), (131.0, "the line")]) + line(1, 30.0, [(10.0, "a"), (100.0, "b"), (200.0, "c")]) + line(1, 45.0, [(10.0, "1"), (101.0, "2"), (200.0, "3")]) + line(1, 60.0, [(10.0, "end")]) + line(2, 30.0, [(10.0, "x"), (100.0, "y")])
    found = spans.find_tables(spark.createDataFrame(rows, cols)).collect()
    assert [(r.page, r.cells) for r in found] == [(1, [["a", "b", "c"], ["1", "2", "3"]])]


def test_check_pipeline(spark):
    df = spark.createDataFrame([(1, SAID), (2, "没有")], "id int, text string")
    rules = Q.Rules("老馆长")
    done = pipelines.check(df.withColumnRenamed("id", "rec"), "rec", "text", rules).collect()
    assert [r.rec for r in done] == [1]
    model, content = spark.createDataFrame([(done[0].answer,), ("x",)], "e string").select(*[c.alias(n) for n, c in zip("ab", envelope.read(F.col("e")))]).collect()
    assert model[0] == "rules" and model[1].startswith("```json") and tuple(content) == ("", "")
    by_model = pipelines.check(df.withColumnRenamed("id", "rec"), "rec", "text", rules, lambda p: "{\"data\":{\"people\":[{\"name\":\"老馆长\",\"quotes\":[{\"text\":\"不在\"}]}]}}").collect()
    assert [(r.rec, r.valid) for r in by_model] == [(1, False)]


def test_reports(spark):
    r = spark.createDataFrame([("2", [("错<", "对")]), ("10", []), ("x", None)], "id string, errors array<struct<content:string,rightSentences:string>>")
    page = report.check_html(r)
    assert "错&lt;" in page and "<p>1</p>" in page
    pairs = spark.createDataFrame([("m", ["a。"], ["a"]), ("m", ["a"], ["b"]), ("m", ["a"], [])], "model string, b array<string>, o array<string>")
    rate = stats.match_rates(pairs, "model", "b", "o").first()
    assert (rate["match"], rate.mismatch, rate.total) == (1, 2, 3)
    assert "33.3 %" in report.comparison_html(pairs, "model", "b", "o")


def test_span_rules(spark):
    rows = [
        (1, 0, 0, 0, "正文", 12.0, 0, "Song", 10.0, 700.0, 40.0, 712.0), (1, 0, 0, 1, "a", 7.0, 1, "Song", 41.0, 700.0, 45.0, 705.0),
        (1, 0, 1, 0, "hello", 12.0, 0, "Song", 10.0, 720.0, 40.0, 732.0), (1, 0, 1, 1, "world", 12.0, 0, "Song", 48.0, 720.0, 80.0, 732.0),
        (1, 0, 2, 0, "hello world", 12.0, 0, "Song", 10.0, 721.0, 80.0, 732.0), (1, 0, 3, 0, "......12", 12.0, 0, "Song", 10.0, 740.0, 80.0, 752.0), (1, 0, 4, 0, "完", 12.0, 0, "Song", 10.0, 760.0, 80.0, 772.0),
    ]
    df = spark.createDataFrame([("d", *r) for r in rows], "doc_key string, page int, block_no int, line_no int, span_no int, text string, size double, flags int, font string, x0 double, y0 double, x1 double, y1 double")
    out = spans.block_texts(df).collect()
    assert [r.text for r in out] == ["正文①\nhello world\n......12\r\n\n完"]


@pytest.mark.parametrize("n", [0, 3])
def test_totals(spark, n):
    rows = [(f"k{i}", "f", 10 * i, i % 2) for i in range(n)] * 2
    df = spark.createDataFrame(rows, "file_md5 string, file_name string, total_chars bigint, file_exist int")
    assert tuple(stats.file_totals(df).first()) == (n // 2, 10 if n else 0, n - n // 2, 20 if n else 0)


def test_convert(spark):
    cols = "doc_key string, page int, block_no int, line_no int, span_no int, text string, size double, flags int, font string, x0 double, y0 double, x1 double, y1 double"
    rows = [(1, 0, 0, 0, "Head", 24.0, 0, "f", 10.0, 10.0, 500.0, 34.0), (1, 1, 0, 0, "right column", 10.0, 0, "f", 320.0, 100.0, 500.0, 110.0), (1, 2, 0, 0, "left column", 10.0, 0, "f", 10.0, 120.0, 200.0, 130.0), (1, 3, 0, 0, "inside", 10.0, 0, "f", 20.0, 310.0, 60.0, 320.0), (2, 0, 0, 0, "next", 10.0, 0, "f", 10.0, 10.0, 500.0, 20.0)]
    tables = spark.createDataFrame([(1, 10.0, 300.0, 500.0, 400.0, [["a"], ["b"]])], "page int, x0 double, y0 double, x1 double, y1 double, cells array<array<string>>").selectExpr("'d' doc_key", "*")
    both = [(d, *r) for d in ("d", "e") for r in rows]
    whole = pipelines.convert(spark.createDataFrame(both, cols), tables).orderBy("doc_key", "page", "order_no").collect()
    out = [r for r in whole if r.doc_key == "d"]
    assert [r.text for r in whole if r.doc_key == "e"] == ["# Head", "left column", "inside", "right column", "next"]
    assert [r.text for r in out] == ["# Head", "left column", "right column", "| a |\n| --- |\n| b |\n", "next"]
    assert [r.md_line_index for r in out] == [0, 2, 4, 6, 11]


def test_closed_tags(spark):
    from pagewright.functions import html

    cases = [("<b>x", "<b>x</b>", True), ("<ul><li>a<li>b</ul>", "<ul><li>a<li>b</ul>", False), ("a < b", "a < b", False), ("<br><i><b>x</i>", "<br><i><b>x</i>", False), ("", "", False), (None, None, False), ("<p><q>x", "<p><q>x</q></p>", True)]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    got = [tuple(r) for r in df.select(html.closed(F.col("t")).alias("c")).select("c.*").collect()]
    assert got == [(c[1], c[2]) for c in cases]


def test_envelopes_of_whole_texts(spark, tmp_path):
    from pagewright.plans import text_queries

    texts = ["", "short", "第一行\n“引文”\r\n\t\"quoted\" \\ back", "```json\n{\"t\": 1}\n```", "} {", "a}\n```", "\u0001\u2028\x7f😀", "long “x”\n" * 20_000, None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.model, r.text) for r in text_queries.queries()["envelope_documents"](spark, str(tmp_path)).collect()}
    assert got == {i: ("rules", t) for i, t in enumerate(texts) if t is not None}
    broken = ["{broken", "", "[]", "{\"model\": \"m\"}", "{\"message\": {\"content\": \"c\"}}", None]
    read = spark.createDataFrame([(b,) for b in broken], "e string").select(*envelope.read(F.col("e"))).collect()
    assert [tuple(r) for r in read] == [("", ""), ("", ""), ("", ""), ("m", ""), ("", "c"), ("", "")]


def test_reports_show_or_name_all_rows(spark):
    r = spark.createDataFrame([(str(i), [(f"wrong{i};", "right")]) for i in range(7)], "id string, errors array<struct<content:string,rightSentences:string>>")
    assert "4 more not shown" in report.check_html(r, limit=3) and "not shown" not in report.check_html(r, limit=7)
    pages = list(report.check_pages(r, limit=3))
    assert [p.count("<li>") for p in pages] == [3, 3, 1] and all(f"wrong{i};" in "".join(pages) for i in range(7))
    pairs = spark.createDataFrame([(f"m{i}", ["a"], ["a"]) for i in range(5)], "model string, b array<string>, o array<string>")
    assert "3 more not shown" in report.comparison_html(pairs, "model", "b", "o", limit=2)
    assert sum(p.count("<td>m") for p in report.comparison_pages(pairs, "model", "b", "o", limit=2)) == 5
    assert [p.count("<li>") for p in report.check_pages(r.limit(0))] == [0]
