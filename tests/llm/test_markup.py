import pytest

from pagewright.llm import markup as M

MARKED = [
    ("html", "<p class=\"body\">这类仓单。</p><br/><b>标准</b>。"), ("html", "正文。</span></div>"), ("html", "&lt;h2&gt;题&lt;/h2&gt; 正文"), ("html", "a&nbsp;&nbsp;b"), ("html", "点<sup>10</sup>。"),
    ("markdown", "### 标题\n\n正文"), ("markdown", "**粗** 和 *斜*。"), ("markdown", "见 ![图](images/9_8.jpg)"), ("markdown", "[题](#sec-5) 正文~~删~~"), ("markdown", "- 甲项内容\n- 乙项内容"), ("markdown", "| 甲 | 乙 |\n|---|---:|\n| 丙 | 1 |"), ("markdown", "文\n```json\n{}\n```"), ("markdown", "> 引文。\n> —— 出处"), ("markdown", "x, _After the flood_."),
    ("wiki", "== 题 ==\n'''粗'''正文"), ("wiki", "[[甲|乙]] 正文"), ("wiki", "{{Cite|title=甲|page=2}}正文"), ("wiki", "{| class=\"wikitable\"\n! 甲 !! 乙\n|-\n| 49 || 75\n|}"),
    ("latex", "\\section{题}\n正文"), ("latex", "\\(\\sum_{i=1}^{n} q_i \\le 30\\) 正文"), ("latex", "值 $v_{1} = \\frac{93}{9}$ 为"), ("latex", "甲~\\cite{k40}, \\emph{乙}. \\\\"), ("latex", "\\begin{itemize}\n\\item 甲\n\\end{itemize}"),
]
PRINTED = ["点[11]。", "（27*96=2592）", "（55 < 89, 89 > 55）", "US$46 / $61", "（C# 60）", "（#52）", "book_34_part_70", "{22, 81}", "a=54; b=77", "50 | 64", "（* 37）", "（~64）", "«25» <92>", "R&D 44", "[52] [71]", "D:\\scan\\new_51\\66.json", "述略 | 29", "1934-\n1980", "- 12 -", "* * *", "harbour_v3.2.json", "", "plain"]


@pytest.mark.parametrize("kind,text", MARKED)
def test_marked(kind, text):
    assert kind in {e.kind for e in M.markup(text)}
    # the plain notation is a fixed point: headings, items, rows, fences and formulas keep their signs
    assert M.clean(M.clean(text)) == M.clean(text)


@pytest.mark.parametrize("text", PRINTED)
def test_printed(text):
    assert M.markup(text) == []
    assert M.clean(text) == text


def test_structure_stays():
    assert M.clean("<h2>题</h2><ul><li>甲</li><li>乙</li></ul>").split() == ["##", "题", "-", "甲", "-", "乙"]
    assert "| 甲 | 乙 |" in M.clean("{|\n! 甲 !! 乙\n|}")
    assert M.clean("\\(x_{1}\\) 文") == "$x_{1}$ 文"
    assert "```json" in M.clean("文\n```json\n{\"a\": \"**b**\"}\n```") and "**b**" in M.clean("文\n```json\n{\"a\": \"**b**\"}\n```")
    assert M.clean("<div>\n<p>很长的一段正文在这里。</p>\n</div>").strip() == "很长的一段正文在这里。"


def test_cheap_test_misses_nothing(spark):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(MARKED)], "k int, t string")
    assert df.filter(M.may_have("t")).count() == len(MARKED)


def test_frame(spark):
    df = spark.createDataFrame([(1, "<b>x</b>", "c"), (1, "<b>x</b>", "c"), (2, None, None), (3, "", ""), (4, "*" * 5000, ""), (5, "<" * 3000, "")], "box_key bigint, text string, clean string")
    assert [r.box_key for r in M.marked(df, "box_key", "text").collect()] == [1]
    assert M.marked(df.limit(0), "box_key", "text").count() == 0
    assert {(r.box_key, r.kinds, r.clean) for r in M.cleaned(df, "box_key", "text").collect()} == {(1, "html", "x"), (2, "", None), (3, "", ""), (4, "", "*" * 5000), (5, "", "<" * 3000)}
    assert M.cleaned(df, "box_key", "text").count() == 5 and M.cleaned(df.limit(0), "box_key", "text").count() == 0


def test_elements_and_commands_of_any_name():
    for text, kinds, clean in (
        ("see <formula>x + y</formula> here", {"html"}, "see x + y here"),
        ('a <tei:note place="foot">word</tei:note> b', {"html"}, "a word b"),
        ("line <pb n='3'/> on", {"html"}, "line  on"),
        (r"so x \approx y", {"latex"}, None),
        (r"x\approx y", {"latex"}, None),
        (r"a \rightarrow b, \forall c, \kappa", {"latex"}, None),
        (r"a \varkappa b", {"latex"}, None),
        (r"\kappa\approx 3", {"latex"}, None),
    ):
        assert {e.kind for e in M.markup(text)} == kinds, text
        if clean is not None:
            assert M.clean(text) == clean
    for text in ("a < b and c > d", "<see page 3>", "<https://a.org/x>", "<name@a.org>", "x<y>z", r"data\files\new", r"the folder \share\plans\one.txt", r"D:\maps\old", r"\\host\share"):
        assert M.markup(text) == [], text


BODY = "The commission met in spring and agreed on the new survey of the district, which was printed later."


def test_regions_are_chosen_by_parser_events_and_ratios():
    page = f'<div>\n<nav><a href="/">Home</a> <a href="/about">About us</a></nav>\n<h2>Title</h2>\n<p>{BODY}</p>\n<p>{BODY} <a href="x">more</a></p>\n<ul>\n<li><a href="y">Item</a></li>\n</ul>\n<footer><a href="z">Contact</a></footer>\n</div>'
    clean = M.clean(page)
    assert "Home" not in clean and "About" not in clean and "Contact" not in clean
    assert clean.count(BODY) == 2 and "## Title" in clean and "- Item" in clean and "more" in clean
    lines = M.measured(page, M.parse(page))
    assert [x.ratio for x in lines][1] == 0 and max(x.ratio for x in lines) > 20
    # short text in plain tags is content, and a text of links only isn't emptied
    assert "Note" in M.clean(f"<p>{BODY}</p>\n<b>Note</b>")
    assert "Home" in M.clean('<a href="/">Home</a>')


def test_long_marked_texts_take_linear_time():
    import time

    t0 = time.time()
    M.clean("<p>word <b>bold</b> and *more* words</p>\n" * 5000)
    small = time.time() - t0
    t0 = time.time()
    M.clean("<p>word <b>bold</b> and *more* words</p>\n" * 20000)
    assert time.time() - t0 < 12 * small + 1
