import itertools

from pagewright.llm import lookalike as L

SCHEMA = "doc_key string, k bigint, text string, canonical string"
BASE = "The commission compares a printed register, 第一卷 of 12 items; élan."
SAME = [
    BASE,
    BASE.replace("commission", "сommissiоn"),
    BASE.replace(" ", " ").replace("register", "reg­ister"),
    BASE.replace("é", "é").replace("第一卷", "第⼀卷"),
    BASE.replace("12", "１２").replace(",", "，").replace("printed", "ｐｒｉｎｔｅｄ"),
]
OTHER = [BASE.replace("12", "13"), BASE.replace("The", "the"), BASE.replace("é", "e"), BASE.replace("12", "1²"), BASE.replace("12", "⑫"), BASE.replace("items", "itmes"), BASE.replace("卷", "捲")]


def model():
    pairs = {}
    for w in ("the commission compares printed register of items".split()) * 20:
        for a, b in zip(w, w[1:]):
            pairs[ord(a), ord(b)] = pairs.get((ord(a), ord(b)), 0) + 1
    return L.Model(pairs)


def test_forms():
    m = model()
    one = {L.canonical(t, m) for t in SAME}
    assert one == {L.canonical(BASE, m)}
    assert "commission" in one.pop()
    for t in OTHER:
        assert L.canonical(t, m) != L.canonical(BASE, m), t
    assert L.canonical("", m) == "" and L.canonical("​﻿", m) == ""
    for t in SAME + OTHER:
        assert L.canonical(L.canonical(t, m), m) == L.canonical(t, m)
    assert len(L.canonical("со" * 50_000, m)) == 100_000


def test_other_shapes_stay():
    m = model()
    for a, b in (("ſo", "so"), ("x²", "x2"), ("½", "1/2"), ("№ 5", "No 5"), ("ｶﾞ", "カ"), ("記", "记")):
        assert L.canonical(a, m) != L.canonical(b, m)
    for a, b in (("ﬁn", "fin"), ("ｶﾞ", "ガ"), ("⾥", "里"), ("館", "館"), ("a\u2011b", "a-b"), ("x\u3000y", "x y"), ("क\u200dख", "कख")):
        assert L.canonical(a, m) == L.canonical(b, m)


def test_script_is_that_of_the_token():
    m = model()
    assert L.canonical("раздел", m) == "раздел"
    assert L.canonical("cοpy А464", m) == "copy A464"
    assert L.canonical("сору", m) == L.canonical("copy", m)


def test_pairs_equal_brute_force(spark):
    rows = [("d", i, t, "x") for i, t in enumerate(SAME + OTHER)] + [("d", 0, SAME[0], "x"), ("d", 50, SAME[0], "x"), ("e", 60, SAME[1], None), (None, 61, SAME[1], None), ("d", 70, None, None), ("d", 71, "", None), ("d", 72, "short", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    m = model()
    got = [(r.key_a, r.key_b) for r in L.same_looking(df, ["doc_key"], "k", "text", 30, m).collect()]
    texts = {(d, k): t for d, k, t, _ in rows if t and len(t) >= 30 and d}
    want = {(a[1], b[1]) for a, b in itertools.permutations(texts, 2) if a[1] < b[1] and a[0] == b[0] and texts[a] != texts[b] and L.canonical(texts[a], m) == L.canonical(texts[b], m)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) == 14
    assert L.same_looking(df.limit(0), ["doc_key"], "k", "text", 30, m).count() == 0


def test_letter_pairs(spark):
    df = spark.createDataFrame([("ab",), ("ba ab",), (None,), ("",)], "text string")
    assert L.letter_pairs(df, "text") == {(97, 98): 2, (98, 97): 1}


def test_canonical_form_keeps_rows(spark):
    df = spark.createDataFrame([(1, "ａ"), (2, None), (2, None), (3, "")], "k int, text string")
    got = sorted((r.k, r.canonical) for r in L.canonical_form(df, ["k"], "text", model()).collect() if r.canonical is not None)
    assert got == [(1, "a"), (3, "")]


def test_han_and_kana_of_one_shape():
    pairs = {(ord(a), ord(b)): 20 for w in ("人口", "努力", "カード", "ヘリ", "山へ", "へ行", "工人", "エア", "アジ") for a, b in zip(w, w[1:])}
    m = L.Model(pairs)
    for a, b in (("努力する", "努カする"), ("カード番号", "力ード番号"), ("人口の数", "人ロの数"), ("山へ行く", "山ヘ行く"), ("エア機材", "工ア機材"), ("ABCꓐ", "ABCB"), ("Ꭺ", "A")):
        assert L.canonical(a, m) == L.canonical(b, m), (a, b)
    assert L.canonical("努カする", m) == "努力する" and L.canonical("山ヘ行く", m) == "山へ行く" and L.canonical("力ード", m) == "カード"
    assert L.canonical("努力", m) != L.canonical("努刀", m)


def test_members_of_a_hot_class_are_linear(spark):
    texts = [SAME[i % 2] for i in range(20_000)] + [OTHER[0]]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(texts)] + [("d", 0, SAME[0]), (None, 30_000, SAME[0])], "doc_key string, k bigint, text string")
    own, members = L.classes(df, ["doc_key"], "k", "text", 30, model())
    assert {(r.doc_key, r.n_keys, r.n_texts, r.first_key) for r in own.collect()} == {("d", 20_000, 2, 0), ("d", 1, 1, 20_000), (None, 1, 1, 30_000)}
    assert {(r.n_links, r.n) for r in members.groupBy("n_links").count().withColumnRenamed("count", "n").collect()} == {(10_000, 20_000), (0, 2)}


def test_blocks_give_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 7)
    df = spark.createDataFrame([("d", i, SAME[i % 3]) for i in range(60)], "doc_key string, k bigint, text string")
    got = [(r.key_a, r.key_b) for r in L.same_looking(df, ["doc_key"], "k", "text", 30, model()).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in range(60) for b in range(a + 1, 60) if a % 3 != b % 3}
