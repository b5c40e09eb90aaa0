import random

import numpy as np

from pagewright.llm import scan

WORDS = "the commission compares printed register of items with great care and repeats what every modest government records".split()


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    zh = ["测绘队重新装订了档案馆的图纸。", "人员不明，期限未定。", "因此资料中心已经抄录了条例草案。", "印章的位置大体上可疑。"]
    return [" ".join(rng.choices(WORDS, k=14)) + ". " + "".join(rng.choices(zh, k=2)) for _ in range(n)]


def test_editor_on_held_out_text():
    editor = scan.Editor(scan.train(corpus()))
    held = corpus(60, seed=9)
    clean = editor.edits(held)
    assert len(clean[0]) == 0
    damaged = [t.replace("测绘", "侧绘").replace("comm", "cornm").replace("register", "reg1ster").replace("government", "govcrnment") for t in held]
    row, pos, op, _ = editor.edits(damaged)
    mended = list(damaged)
    by = {}
    for i, p, o in zip(row, pos, op):
        by.setdefault(int(i), []).append((int(p), "misread", scan.OPS[o].written, scan.OPS[o].printed))
    for i, edits in by.items():
        mended[i] = scan.mend(mended[i], edits)[0]
    assert np.mean([a == b for a, b in zip(mended, held)]) >= 0.95


def test_no_texts():
    assert len(scan.Editor(scan.train([])).edits([""])[0]) == 0
    assert len(scan.Editor(scan.train(["短"])).edits(["", "x" * 200_000])[0]) == 0


PAGE = "page_id bigint, doc_key string, page int, boxes array<struct<label:string,box:array<int>,text_content:string>>, head string, n string"


def book():
    words = corpus(40, seed=3)
    rows = []
    for p in range(1, 9):
        label = "header" if p % 3 else "text"
        title = [("title", "第一章 河道札记")] if p == 1 else [(label, "第一章 河道札记")]
        body = words[p].replace("commission", "commis-\nsion") if p == 2 else words[p]
        body = body.replace("测绘", "侧绘") if p == 3 else body
        boxes = title + [("text", body), ("text", "1952"), ("text", words[p + 10] + " a north-\neast wind, the north-east, a north-east"), ("text", "（5）"), ("page_number" if p % 2 else "text", f"- {p} -")]
        if p == 4:
            boxes = [("text", "第一章 河道札记\n" + words[4]), ("image", None), ("text", ""), ("text", "· 4 ·")]
        rows.append((p, "d", p, [(lb, [0, 100 * i, 10, 100 * i + 50], t) for i, (lb, t) in enumerate(boxes)], None, None))
    rows.append(rows[1])
    rows.append((90, "d", None, None, None, None))
    rows.append((91, None, 1, [], None, None))
    return rows


def test_defects(spark):
    got = {(r.box_key, r.defect) for r in scan.defects(spark.createDataFrame(book(), PAGE), spark, 500).collect()}
    heads = {k for k, d in got if d == "running_head"}
    assert heads == {200, 300, 400, 500, 600, 700, 800}
    assert {k for k, d in got if d == "page_number"} == {105, 205, 305, 505, 605, 705, 805}
    assert (201, "split_word") in got and not any(d == "split_word" and k % 100 == 3 for k, d in got)
    assert any(d == "misread" and k == 301 for k, d in got) or "测绘" not in corpus(40, seed=3)[3]


def test_empty(spark):
    assert scan.defects(spark.createDataFrame([], PAGE), spark, 100).count() == 0


def test_paragraphs(spark):
    got = scan.paragraphs(spark.createDataFrame(book(), PAGE), spark, 500).collect()
    text = "\n".join(r.text for r in got if r.page_id == 2)
    assert "commission" in text and "- 2 -" not in text and "第一章" not in text
    assert scan.join_lines("一行\n两行\n\nab\ncd") == "一行两行\n\nab cd"


def test_only_furniture_is_taken_out():
    cut = lambda t, *args: scan.mend(t, [], scan.furniture(t, *args))[0]
    assert cut("2  The river and its banks", False, True, False) == "The river and its banks"
    assert cut("12  Title\nbody one.\nlast body line", False, True, False) == "Title\nbody one.\nlast body line"
    assert cut("12  Title\nbody one.\nlast body line", True, True, False) == "body one.\nlast body line"
    assert cut("12  Title\nbody one.", True, False, False) == "12  \nbody one."
    assert cut("Title · 7", False, False, True) == "Title" and cut("- 7 -", False, True, True) == ""
    assert cut("body.\n- 7 -", False, False, True) == "body." and cut("Head\nbody", True, False, False) == "body"
    assert scan.mend("ab 3 cd\nxx", [(0, "misread", "a", "o"), (8, "misread", "xx", "y")], [(0, 8)])[0] == "y"


def test_words_divided_over_boxes_and_pages(spark):
    body = corpus(12, seed=5)
    box = lambda i, t, label="text": (label, [0, 100 * i, 10, 100 * i + 50], t)
    one = [box(0, body[0]), box(1, "They spoke at length about the commis-"), box(2, "sion of the district and its items."), box(3, "In the end all of them compared the register and the govern-"), box(4, "3 Ein Name, 1920", "footnote"), box(5, "1")]
    two = [box(0, "ment records, which were kept"), box(1, "2")]
    three = [box(0, "with great care by the register."), box(1, body[3]), box(2, "3")]
    pages = spark.createDataFrame([(1, "d", 1, one), (2, "d", 2, two), (3, "d", 3, three), (4, "e", 2, [box(0, "another book. Here.")])], "page_id bigint, doc_key string, page int, boxes array<struct<label:string,box:array<int>,text_content:string>>")
    got = {(r.page_id, r.paragraph_no): r.text for r in scan.paragraphs(pages, spark, 200).collect()}
    whole = " | ".join(got.values())
    assert "about the commission of the district" in whole and "the government records, which were kept with great care by the register." in whole
    assert not any(p == 2 for p, _ in got) and sum("another book" in t for t in got.values()) == 1
    assert any("Ein Name" in t and "govern" not in t for t in got.values())


def test_no_limit_on_the_place_of_furniture(spark):
    rng = random.Random(2)
    rows = []
    for p in range(1, 7):
        top = [("text", f"Spalte {c}") for c in rng.sample("abcdefgh", 4)] + [("text", "Die Geschichte der " + "langen " * 12 + "Zeile")]
        rest = [("text", f"{rng.choice(WORDS)} {rng.choice(WORDS)} und Ende {p}.") for _ in range(14)] + [("text", f"Note {rng.random()}.") for _ in range(3)]
        both = top + rest[:10] + [("text", f"— {p + 4} —")] + rest[10:]
        rows.append((p, "d", p, [(lb, [0, 40 * i, 10, 40 * i + 30], t) for i, (lb, t) in enumerate(both)], (600, 40 * len(both))))
    df = spark.createDataFrame(rows, "page_id bigint, doc_key string, page int, boxes array<struct<label:string,box:array<int>,text_content:string>>, image_dims struct<w:int,h:int>")
    lines = scan.edge_lines(df)
    assert {(r.box_key) for r in scan.running_heads(lines).collect()} >= {p * 100 + 4 for p in range(1, 7)}
    assert {(r.box_key, r.first) for r in scan.page_numbers(lines).collect()} == {(p * 100 + 15, f) for p in range(1, 7) for f in (True, False)}


def test_pairs_drawn_from_the_corpus(spark):
    # no pair asked for is in the table; the last three texts only have a look-alike of another script
    zh = ["河务部门保存了这份名册。", "县里的河务由专人管理。", "他们在河务会上报告。", "各地河务逐年增加。"]
    la = ["the vessel carried heavy timber downstream", "another vessel waited near the harbour", "this village sold timber every spring", "the valley produced velvet and vinegar"]
    texts = [f"{a} {b}" for a in zh for b in la] * 30
    bad = [t.replace("河务", "河努") for t in texts[:4:4]] + [texts[4].replace("河务", "河努"), texts[8].replace("河务", "河努")]
    bad += ["the uessel carried heavy", "another uillage waited", "the ualley produced", "the timmber harbour", "heavy vellvet and vinegar", "the villlage sold", "the vallley near", "the harrbour", "the vеssel", "the vеlvet", "the vinеgar"]
    own = spark.createDataFrame([(i, t) for i, t in enumerate(texts + bad)], "k bigint, t string")
    table, forms = scan.operations(own, "t")
    new = set(table.ops[table.known :])
    assert {scan.Op("努", "务"), scan.Op("u", "v"), scan.Op("ll", "l")} <= new
    assert not any("е" in op.written for op in new)
    editor = scan.Editor(scan.train(texts, table=table), table)
    held = texts[:16]
    assert len(editor.edits(held)[0]) == 0
    for written, printed in (("uessel", "vessel"), ("河努", "河务"), ("vallley", "valley")):
        damaged = [t.replace(printed, written) for t in held if printed in t]
        row, pos, op, _ = editor.edits(damaged)
        by = {}
        for i, p, o in zip(row, pos, op):
            by.setdefault(int(i), []).append((int(p), "misread", table.ops[o].written, table.ops[o].printed))
        mended = [scan.mend(t, by.get(i, []))[0] for i, t in enumerate(damaged)]
        assert np.mean([a == b for a, b in zip(mended, [t for t in held if printed in t])]) >= 0.5, written
    # a usual word stays, whatever the editor says
    row = [(1, "misread", 0, "u", "v", 1.0, "uessel", "vessel"), (2, "misread", 0, "v", "u", 1.0, "vessel", "uessel"), (3, "misread", 0, "1", "l", 1.0, None, None)]
    asked = spark.createDataFrame(row, "k bigint, kind string, pos bigint, written string, printed string, score double, was string, would string")
    assert {r.k for r in scan.confirmed(asked, forms).collect()} == {1, 3}
    assert scan._form("在河努会上", 2, scan.Op("努", "务")) == tuple(str(scan._trigrams([t])[0]) for t in ("河努会", "河务会"))
