import random

import pytest
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators import layout as L
from pagewright.plans import pipelines

PAGES = "page_id bigint, doc_key string, page int, image_dims struct<w:int,h:int>, boxes array<struct<label:string,box:array<int>,text_content:string>>"
TERMINAL, CLOSERS = set("。！？!?…:：；;"), "”’\"'》>】]"


def cut(text):
    t = text.strip()
    if not t:
        return False
    c = t[-2] if len(t) > 1 and t[-1] in CLOSERS else t[-1]
    return c not in TERMINAL


def pages(n=60, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        boxes = []
        for _ in range(rng.randint(0, 7)):
            label = rng.choice(["text", "text", "text", "sub_title", "title", "image", "table", None])
            t = rng.choice(["正文没有结束", "正文结束了。", "他说“好。”", " ", None, "短", "一、标题", "第一行\n第二行还没有完"]) if label not in ("image",) else None
            x = rng.choice([50, 55, 600])
            boxes.append((label, [x, rng.randint(0, 900), x + 400, rng.randint(100, 1000)], t))
        out.append((i, f"d{i % 3}", i // 3, None if i % 9 == 8 else (1000, 1000), boxes))
    out.append((n, "d0", 99, (1000, 1000), None))
    return out + out[:2]


def once(rows):
    return list({r[0]: r for r in rows}.values())


def plain_inpage(row):
    groups, pending, parted = [], None, False
    w, h = row[3] or (1024, 1024)
    for no, (label, box, t) in enumerate(row[4] or []):
        if label not in ("text", "sub_title", "title"):
            parted = True
            continue
        if not (t or "").strip():
            continue
        if pending and pending["label"] == label == "text" and cut(pending["text"]) and (abs(pending["box"][0] - box[0]) > w * 0.05 or pending["box"][3] > h * 0.85 or parted):
            pending.update(text=t, box=box)
            groups[-1].append(no)
        else:
            pending = {"label": label, "text": t, "box": box}
            groups.append([no])
        parted = False
    return {(row[0], no, g[0]) for g in groups for no in g}


def test_page_islands(spark):
    rows = pages()
    got = {tuple(r) for r in L.page_islands(L.blocks(spark.createDataFrame(rows, PAGES))).collect()}
    assert got == set().union(*map(plain_inpage, once(rows)))


def test_document_islands(spark):
    rows = pages()
    want, pending = set(), {}
    for r in sorted(once(rows), key=lambda r: (r[1], r[2], r[0])):
        for no, (label, _, t) in enumerate(r[4] or []):
            if label in ("text", "sub_title", "title") and (t or "").strip():
                p = pending.get(r[1])
                head = p["head"] if p and p["label"] == label == "text" and cut(p["text"]) else (r[0], no)
                pending[r[1]] = {"label": label, "text": t, "head": head}
                want.add((r[0], no, *head))
    got = {tuple(r) for r in L.document_islands(L.blocks(spark.createDataFrame(rows, PAGES))).collect()}
    assert got == want


def plain_boxed(row):
    out, cur, parted = [], None, False
    w, h = row[3] or (1024, 1024)
    title = lambda t: t.startswith("#") or t.startswith("一、")
    for no, (label, box, t) in enumerate(row[4] or []):
        if label in ("text", "sub_title"):
            t = (t or "").strip()
            if not t:
                continue
            if cur and cut(cur[2]) and not title(cur[2]) and not title(t) and (abs(cur[1][0] - box[0]) > w * 0.05 or cur[1][3] > h * 0.85 or parted):
                b = cur[1]
                cur[1] = [min(b[0], box[0]), min(b[1], box[1]), max(b[2], box[2]), max(b[3], box[3])]
                cur[2] += t
                cur[3].append(len(t))
            else:
                cur = [no, box, t, [len(t)]]
                out.append(cur)
            parted = False
        elif label == "title":
            cur, parted = None, False
        else:
            parted = True
    return {(row[0], c[0], tuple(c[1]), c[2], tuple(c[3])) for c in out}


def test_boxed_merge(spark):
    rows = pages(seed=8)
    got = {(r.page_id, r.head_no, tuple(r.box), r.content, tuple(r.lens)) for r in L.boxed_merge(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == set().union(*map(plain_boxed, once(rows)))


def test_pack(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        text = rng.choice(["# 题", "<table>x</table>", "", "字" * rng.randint(1, 500), "y" * 1024, "z" * 1025])
        rows.append((f"d{i % 2}", i // 7, i // 7, i, text))
    df = spark.createDataFrame(rows, "doc_key string, page int, page_id bigint, box_no int, content string")
    got = sorted((r.doc_key, r.section, r.chunk_no, r.content) for r in L.chunks(L.pack(df)).collect())
    want = []
    for doc in ("d0", "d1"):
        out, cur = [], None
        for _, _, _, _, t in [r for r in rows if r[0] == doc]:
            if "<table>" in t:
                out += ([cur] if cur is not None else []) + [t]
                cur = None
            elif t.startswith("#") or cur is None:
                out += [cur] if cur is not None else []
                cur = t
            else:
                both = f"{cur}\n{t}" if cur else t
                if len(both) <= 1024:
                    cur = both
                else:
                    out.append(cur)
                    cur = t
        want += [(doc, c) for c in out + ([cur] if cur is not None else [])]
    assert [(d, c) for d, _, _, c in got] == want
    assert all(len(c) <= 1024 or len(c) == 1025 for _, c in want)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_page_merge_with_short_pages(spark, seed):
    rng = random.Random(seed)
    texts = [rng.choice(["", "短", "一行没有结束的话", "结束。", "第一章 题", "甲乙丙丁\n短", "短\n这一行比较长没有完"]) for _ in range(80)]
    rows = [(f"d{i % 2}", i // 2, i, t, len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_key string, page int, page_id bigint, box_text string, page_text_len int")
    want = []
    for doc in ("d0", "d1"):
        cur = None
        for _, page, pid, t, n in [r for r in rows if r[0] == doc]:
            a, b = [x for x in (cur[3].split("\n") if cur else []) if x.strip()], [x for x in t.split("\n") if x.strip()]
            if cur and a and b and not b[0].startswith("第一章") and a[-1][-1] not in "。！？!?" and len(a[-1].strip()) > 6:
                cur[3] += t
                cur[4] += 1
                cur[5] += n
            else:
                cur = [doc, pid, page, t, 1, n]
                want.append(cur)
    got = sorted((r.doc_key, r.head_page_id, r.first_page, r.n_pages, r.text_len) for r in L.page_merge(df).collect())
    assert got == sorted((c[0], c[1], c[2], c[4], c[5]) for c in want)


def test_empty(spark):
    empty = spark.createDataFrame([], PAGES)
    b = L.blocks(empty)
    for df in (L.page_islands(b), L.document_islands(b), L.boxed_merge(empty), L.chunks(L.pack(L.items(b))), L.reading_order(b), L.boundary_pairs(b), L.page_merge(L.page_texts(b)), L.line_index(b)):
        assert df.count() == 0


def test_golden_page(spark):
    """A page of eleven boxes whose eight text groups have the lengths 18 26 386+32 10 50 16 65 148+95."""
    lens = [18, 26, 386, 32, 10, 50, 16, 65, 0, 148, 95]
    label = ["sub_title", "text", "text", "text", "sub_title", "text", "text", "text", "image", "text", "text"]
    xs = [137, 134, 134, 463, 463, 463, 463, 463, 463, 463, 470]
    ends = "。。字。。。。。。字。"
    boxes = [(lb, [x, 100 + 50 * i, x + 300, 140 + 50 * i if i != 2 else 1512], "字" * (n - 1) + e if n else "") for i, (lb, n, x, e) in enumerate(zip(label, lens, xs, ends))]
    boxes[9] = ("text", [463, 1157, 1097, 1512], boxes[9][2])
    df = spark.createDataFrame([(8, "d", 8, (1225, 1650), boxes)], PAGES)
    got = sorted((r.head_no, r.lens) for r in L.boxed_merge(df).collect())
    assert [ls for _, ls in got] == [[18], [26], [386, 32], [10], [50], [16], [65], [148, 95]]
    b = L.blocks(df)
    grid = pipelines.nodes_1024(b, L.page_islands(b).withColumnRenamed("head_no", "h").select("page_id", "box_no", F.col("page_id").alias("head_page_id"), F.col("h").alias("head_no"))).collect()
    first = next(r for r in grid if r.head_no == 0).boxs[0]
    assert first == [round(v * 1024 / s) for v, s in zip(boxes[0][1], (1225, 1650, 1225, 1650))]
    assert pipelines.pages_to_chunks(df).count() >= 2


def test_text_functions(spark):
    rows = [("他说“好。”",), ("没有完",), ("　",), ("",), (None,), ("好】",), ("”",), ("x！ ",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.c for r in df.select(X.cut_off(F.col("t")).alias("c")).collect()]
    assert got == [cut(t or "") for (t,) in rows]
    case = spark.createDataFrame([("目录......12\n第二......3第三 … 4",)], "t string").select(X.contents_breaks(F.col("t")).alias("t")).first().t
    assert case == "目录......12\n第二......3\n第三 … 4"
    one = spark.range(1).select(
        X.mask_name(F.lit("a" * 30)).alias("m"), X.json_object(F.lit("x {\"a\": {}} y")).alias("j"), X.unfence(F.lit("```json\n[1]\n```")).alias("u"), X.strip_references(F.lit("话。[3]，①")).alias("r"),
        X.decrypt_token(X.encrypt_token(F.lit("秘"), F.lit("0123456789abcdef")), F.lit("0123456789abcdef")).alias("d"), X.decrypt_token(F.lit("AAAA"), F.lit("0123456789abcdef")).alias("n"), X.footnote_letters(F.lit("aT字")).alias("f"),
        X.markdown_table(F.array(F.array(F.lit("a"), F.lit(None).cast("string")), F.array(F.lit("b\nc"), F.lit("d")))).alias("t"),
    ).first()
    assert (one.m, one.j, one.u, one.d, one.n, one.f) == ("a" * 6 + "*" * 4 + "a" * 24, '{"a": {}}', "[1]", "秘", None, "①⑳字")
    assert one.r == "话。[3]" and one.t == "| a |  |\n| --- | --- |\n| b c | d |\n"


def test_packed_chunks_are_those_of_items(spark):
    import random

    rng = random.Random(6)
    rows = []
    for d, k in (("a", 60), (None, 25), ("b", 1)):
        for p in range(k):
            labels = rng.choices(["text", "text", "text", "title", "image", "table", "sub_title", None], k=rng.randint(0, 6))
            boxes = [(lb, [0, 0, 9, 9], rng.choice(["", " ", "短句", "没有结束的" * rng.randint(1, 90), "完了。" * rng.randint(1, 200), "<table>x</table>", "# 题"])) for lb in labels]
            rows.append((1000 * (d == "a") + 500 * (d is None) + p, d, p, (10, 10), boxes))
    pages = spark.createDataFrame(rows, "page_id bigint, doc_key string, page int, image_dims struct<w:int,h:int>, boxes array<struct<label:string,box:array<int>,text_content:string>>")
    b = L.blocks(pages)
    for plain in (False, True):
        want = sorted(map(tuple, L.chunks(L.pack(L.items(b, plain))).collect()), key=str)
        assert sorted(map(tuple, L.packed_chunks(b, plain).collect()), key=str) == want and len(want) > 20
