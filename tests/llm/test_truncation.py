import random

from pagewright.llm import truncation as T

SENT = ["测绘队重新装订了档案馆的图纸，其中第{}卷依照旧例被抄录。", "如果年景允许，账册应当在{}日内修补；否则由印刷厂另行核对。", "The commission compares the modest register of {} items with great care.", "据乡长回忆，全长约{}公里的河道流经白鹭港和梧野镇。"]


def texts():
    rng = random.Random(4)
    return ["".join(rng.choice(SENT).format(rng.randint(10, 99)) for _ in range(6)) for _ in range(300)]


def test_cut_and_not_cut(spark):
    full = texts()
    rows = [(i, t) for i, t in enumerate(full)]
    cut = {1000: full[0][:-9], 1001: full[1][: len(full[1]) // 2].rstrip("。.") + "�", 1002: full[2] + "如果年景允许，账册应", 1003: full[3] + "The commission compares the mod", 1004: full[4] + "据乡长回忆，全长约12公里的河道流经白...", 1005: full[5] + "据乡长回忆，"}
    whole = {2000: full[6][:-1], 2001: full[7] + "\n白鹭港河道述略", 2002: full[8] + "\n1. 甲题\n2. 乙题", 2003: full[9] + "\nVeldrick, 1925", 2004: full[10][:-1] + "……", 2005: full[11] + "（未完待续）", 2006: full[12] + "\n1956年2月", 2007: full[13] + "\n* * *", 2008: "", 2009: None}
    more = [(3000 + i, full[20 + i] + "\n白鹭港河道述略\n" + full[50 + i]) for i in range(6)]
    df = spark.createDataFrame(rows + list(cut.items()) + list(whole.items()) + more + [(1002, cut[1002])], "doc_id bigint, text string")
    got = {r.doc_id: r.evidence for r in T.truncated(df.withColumn("k", df.text), "doc_id", "text").collect()}
    assert set(cut) <= set(got)
    assert not set(whole) & set(got)
    assert not {i for i, _ in rows} & set(got)
    assert got[1000] == "copy"


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert T.truncated(df, "doc_id", "text").count() == 0
    long = spark.createDataFrame([(1, "字" * 300_000), (2, None)], "doc_id bigint, text string")
    assert [r.doc_id for r in T.truncated(long, "doc_id", "text").collect()] == [1]


def test_copies_prefix_by_level(spark):
    full = texts()
    long = [(i, f"{t}Zuletzt wurde der Band nach Abs. {i} geprüft, wie es der Rat verlangt.") for i, t in enumerate(full)]
    # cut inside a sentence, behind the point of an abbreviation, at a sentence's end, inside a closing list item
    cut = {5000: long[0][1][:-20], 5001: long[1][1].partition("Abs.")[0] + "Abs.", 5003: full[9] + "\n1. Ein langer Titel des Ban"}
    whole = {6000: full[2], 6001: full[3] + "\n1. Ein anderer Titel"}
    more = [(7000, full[9] + "\n1. Ein langer Titel des Bandes"), (7001, full[3] + "\n1. Ein anderer Titel\n2. Noch einer")]
    df = spark.createDataFrame([*long, *cut.items(), *whole.items(), *more], "doc_id bigint, text string")
    got = {r.doc_id: r.evidence for r in T.truncated(df, "doc_id", "text").collect()}
    assert {k: got.get(k) for k in cut} == dict.fromkeys(cut, "copy")
    assert not (set(whole) | {k for k, _ in long} | {7000, 7001}) & set(got)
    # without copies of the whole text, those of its last sentence decide
    alone = spark.createDataFrame([(i, f"Text {i}. {SENT[3].format(i)}") for i in range(20)] + [(99, "Neuer Anfang. 据乡长回忆，全长约77公里的河道流")], "doc_id bigint, text string")
    assert {r.doc_id: r.evidence for r in T.truncated(alone, "doc_id", "text").collect()} == {99: "sentence"}


def test_spans_equal_wherever_they_stand():
    import numpy as np

    from pagewright.llm.sketch import Spans

    codes = np.array([ord(c) for c in "abcXabcYabd"], np.uint32)
    a, b = Spans(codes), Spans(codes[4:7])
    at = np.array([0, 4, 8])
    h = a.of(at, at + 3)
    assert h[0] == h[1] == b.of(np.array([0]), np.array([3]))[0] and h[0] != h[2]
    assert a.of(at[:1], at[:1] + 3, 1)[0] != h[0]
