import pytest

from pagewright.llm.sentences import sentence_ends, sentences


def parts(text):
    out, a = [], 0
    for b in sentence_ends(text):
        out.append(text[a:b].strip())
        a = b
    return out


CASES = [
    ["今天下雨。", "明天呢？！", "他写道：“原件必须留在库房里。”", "“这一页排反了？”教师问道。", "（数字要核对。）", "余下的"],
    ["难道要这样吗？！", "‘原件不动。’这句话出自《手稿问答？》一书。", "9. 河道全长3.5公里（图2。）。"],
    ["Dr. Veldrick confirms No. 83 of the list, i.e. the partial one.", "The A. B. Harnolt papers, vol. 3, were bound at 4.30 p.m. and kept.", "It holds maps, seals, etc.", "“Was it so?” asked the clerk.", "He wrote: “Keep it.”", "Done"],
    ["Die Akten lagern seit dem 16. Jahrhundert auf S. 41 ff. des Verzeichnisses.", "Er sagte: „Das ist alles.“", "„Stimmt die Zahl 9.703,83?“, fragte der Schreiber."],
    ["M. Torvane cite l’art. 71, p. ex. le fol. 84 v. du dossier.", "« Est-ce bien la copie ? » demanda le greffier.", "Il conclut : « Le relevé est bon. »", "Fin !"],
    ["記録には「数字が合わない。順序が逆である。」とある。", "水位は下がった（図2を参照。）。"],
    ["पुराना अभिलेख 6.2 पूरी तरह पढ़ा गया।", "यह पृष्ठ 7.3 मिला?"],
]


@pytest.mark.parametrize("case", CASES)
def test_languages(case):
    for glue in (" ", "\n", "　"):
        assert parts(glue.join(case)) == case


def test_empty_lines_end_units():
    assert parts("标题\n\n正文。\n \n没有句号") == ["标题", "正文。", "没有句号"]
    assert parts("one line\nbroken") == ["one line\nbroken"]
    assert sentence_ends("") == [] and sentence_ends(" \n\n ") == []
    text = "句子。  "
    assert sentence_ends(text) == [3]


def test_unclosed_quotes_and_long_texts():
    assert parts("他说：“没有结束。后面还有。") == ["他说：“没有结束。", "后面还有。"]
    assert len(sentence_ends("一句话。" * 50_000)) == 50_000


def test_missing_blanks():
    assert parts("It fell (approx. 9 km off).The road is open.Le fol. 7 v. est bon.") == ["It fell (approx. 9 km off).", "The road is open.", "Le fol. 7 v. est bon."]
    assert parts("See file_v3.2.json and No. 5.") == ["See file_v3.2.json and No. 5."]


#: Sentences that no rule was made for, by language; joined in any order they must come apart again.
HELD_OUT = {
    "en": ["He loved modern art.", "The next day he left.", "I said no.", "Then he asked Dr. Lowe for vol. 3.", "We met in the ch.", "The rest is history.", "It cost 3.50 dollars, see fig. 2.", "Was that e.g. a mistake?", "They met Mr. J. R. Hale at 4 p.m. and talked."],
    "de": ["Das war z. B. am 3. Mai der Fall.", "Er kam mit Hrn. Nr. 5 nicht weiter.", "Die Kunst ist lang, vgl. Müller.", "Sie wohnte im 2. Stock des Hauses.", "Das Ergebnis steht auf S. 12 der Akte.", "War es das?"],
    "fr": ["Voilà ce qu'il est.", "La fin du livre arrive.", "Le préfet cite M. Durand et la p. 12 du fol. 3.", "C'est l'art qui reste.", "Est-ce que la date est juste ?"],
    "zh": ["“谁来过？”他问道。", "清册共3.5万册！", "（见附录。）"],
    "ja": ["彼は「行かない。」と言った。", "水位は三尺下がった。"],
    "hi": ["यह पुस्तक 2.5 रुपये की है।", "क्या वह आया?"],
}


@pytest.mark.parametrize("language", HELD_OUT)
def test_held_out_sentences(language):
    own = HELD_OUT[language]
    for order in (own, own[::-1], own[1::2] + own[::2]):
        assert parts(" ".join(order)) == order


def test_languages_are_told_by_the_sentence():
    assert parts("Die Gemeinde nennt Abs. 5 und Nr. Sieben. I said no. Then it ended.")[-2:] == ["I said no.", "Then it ended."]
    assert parts("ผมไปตลาดครับ เขาไม่มา แต่ฝนตก  วันนี้ดี") == ["ผมไปตลาดครับ", "เขาไม่มา แต่ฝนตก", "วันนี้ดี"]
    assert parts("Կար մի գիրք։ Նա կարդաց։") == ["Կար մի գիրք։", "Նա կարդաց։"]


def test_no_rule_looks_into_a_quotation_and_long_sentences_are_whole():
    long = "Er sagte: „" + "Das war es. " * 3000 + "Ende.“"
    assert parts(long + " Danach ging er.") == [long, "Danach ging er."]
    assert parts("(" + "x" * 200 + ". y) was left out. Next.") == ["(" + "x" * 200 + ". y) was left out.", "Next."]
    assert len(sentence_ends("a.b" * 20_000)) == 1


def test_frame(spark):
    df = spark.createDataFrame([(1, "a. B c.", 3), (1, "a. B c.", 3), (2, None, 1), (3, "", 1)], "box_key bigint, text string, end_pos int")
    got = sorted((r.box_key, r.end_pos) for r in sentences(df, "box_key", "text").collect())
    assert got[-1] == (1, 7) and len(got) == len(set(got))
    assert sentences(df.limit(0), "box_key", "text").count() == 0
    told = spark.createDataFrame([(1, "Das war Nr. Sieben.", "de"), (2, "Das war Nr. Sieben.", None)], "k int, text string, lang string")
    assert [r.sentence for r in sentences(told, "k", "text", language="lang").orderBy("k", "sentence_no").collect()] == ["Das war Nr.", "Sieben."] * 2
    plain = sorted((r.box_key, r.end_pos) for r in sentences(df, "box_key", "text", with_text=False).collect())
    assert plain == got
