"""Sentence boundaries across languages and scripts.

Every position that may end a sentence (behind a run of sentence marks with its closing signs, behind a quotation or bracket,
at a blank in scripts that part sentences by blanks) is decided by ordered rules: pairs of regular expressions, one for what
stands before the position in the sentence so far and one for what follows, with break or no break; the first pair that
matches decides. The rules stand in tables that are cascaded: quotations and brackets, numbering, the tables of the text's own
languages, what is common to all.

The languages are told by a column, or else, as texts mix them, by the script and the stop words of the sentence at hand (up to
the next mark behind the position): those with at least half as many as the commonest. Where no stop word stands, all apply.

Rules read the text with the inside of closed quotations and brackets masked, so that no rule looks into them; only the marks
that close the inside stay. An empty line always ends a unit.
"""

from __future__ import annotations

import bisect
import functools
import itertools
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.tables import map_arrow, once_by_hash


@dataclass(frozen=True)
class Rule:
    """First match decides. ``before`` is matched backwards from the end of the sentence so far, ``after`` at the position."""

    breaks: bool
    before: regex.Pattern
    after: regex.Pattern
    #: Whether only blanks may stand before what ``before`` matches.
    opens: bool = False


def _rule(breaks: bool, before: str, after: str, opens: bool = False) -> Rule:
    return Rule(breaks, regex.compile(f"(?r)(?:{before})"), regex.compile(after), opens)


# Fixed values, by language: abbreviations in front of names and words; those that are none unless a number follows; stop words.
ABBREVIATIONS = {
    "en": "Dr Mr Mrs Ms Prof Rev Hon Gen Capt Lt Sgt Messrs Eds Ed Trans St Mt Ft cf Cf ca approx vs viz i.e e.g esp incl resp ed eds trans al c",
    "de": "Hr Hrn Fr Frl Bde Verf Vgl vgl Hrsg hrsg bzw geb gest sog z.B z d.h d u.a u i.d.R o v.a evtl ggf inkl Ing Dipl Jh Jhs ca Abb Anm St Dr Prof",
    "fr": "M MM Mme Mmes Mlle Me Mgr St Ste al cf éd env ibid id p.ex ex suiv",
}
NUMBERED = {
    "en": "No Nos Vol Vols Fig Figs Eq Sect Sec Ch Chap Art App Ref Pt Op Cat MS MSS vol vols fig figs no nos p pp ch chap sect sec art col Col fol ff f n est Abs Nr",
    "de": "Nr Nrn Bd Abs Abb Anm Aufl Bl Kap Str Tab Taf S s f ff Art Ziff Lfg Bd Heft Sp",
    "fr": "art chap fasc fig fol f ff l ms mss n no nos p pp pl s sq t tom v vol vols",
}
STOP_WORDS = {
    "en": "the of and to in is that was for with as by on are at from this which were be it he his not have had but they an or we",
    "de": "der die das und ist nicht mit den von auf dem ein eine im zu des wird wurde auch sich als bei nach oder aus wie einen einer sie er es vom zum zur beim am",
    "fr": "le la les des et est dans que pour une un du au aux par sur qui ce avec pas ne il elle sont a été ont son sa ses l d qu c j",
    "th": "",
}
MAY_END = "etc usw u.s.w a.m p.m A.M P.M Jr Sr Co Inc Ltd Bros ff et.al"
MONTHS_DE = "Januar Februar März April Mai Juni Juli August September Oktober November Dezember"
ORDINAL_NOUNS_DE = "Jahrhunderts? Jh Jahrestag Kapitels? Bandes? Band Auflage Abschnitts? Teils? Klasse Sitzung Stock Grad Lieferung Heft Blatt"
ARTICLES_DE = "Der Die Das Den Dem Des Ein Eine Einen Einem Es Er Sie Wir Ich Im In Am An Auf Aus Bei Mit Nach Von Vor Zu Zur Zum Auch Und Aber Doch Wenn Als Da Nur Nicht Hier So Ob Wer Was Dr Laut Seit"


def _words(ws: str) -> str:
    return "|".join(regex.escape(w) for w in sorted(ws.split(), key=len, reverse=True))


_OPEN = r"[“‘\"„«»‚「『（(\[《【]"
_UP = rf"\s+(?:{_OPEN}\s*)*[\p{{Lu}}\p{{Lt}}\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Devanagari}}\p{{Hangul}}\p{{Thai}}①-⑳¿¡]"
_CJK = r"[\p{Han}\p{Hiragana}\p{Katakana}]"
_MARK = "。！？!?.．｡।॥။።؟۔…։།༎។៕"

# In the masked text a closed pair has other signs: opening and closing by kind, and what it holds but for its last marks.
_HELD = "\ue000"
_KINDS = ("“‘«„‚\"", "「『", "（([【〔［", "《〈")
_OPENED, _CLOSED = "\ue001\ue002\ue003\ue004", "\ue011\ue012\ue013\ue014"
_TAIL = "”’」』）)»\"\\]】〕"
_CLOSE = rf"[\p{{Pe}}\p{{Pf}}“‘\"\s{_CLOSED}]"
_ANY = rf"[^{_OPENED}]*"
_NUMBER = r"\s*(?:\p{N}|(?!I\s+\p{Ll})[IVXLCDM]+\b|\p{Lu}\p{N}|(?![IA]\b)\p{Lu}(?![\p{L}’'])|§|\(\p{N})"
_ITEM = r"[(（]?(?:\d{1,3}|[ivxIVX]{1,5}|[A-Za-z])\."
# what goes on after a quotation: reporting words, joined without a blank or in lower case
_REPORT_LOWER = r"\s*[,，]|\s+\p{Ll}|\s*[—–-]\s*\p{Ll}"


def _abbreviated(language: str) -> list[Rule]:
    return [
        _rule(False, rf"(?<![\p{{L}}\p{{N}}])(?:{_words(NUMBERED[language])})\.", _NUMBER),
        _rule(False, rf"(?<![\p{{L}}\p{{N}}])(?:{_words(ABBREVIATIONS[language])})\.", r"\s*[\p{L}\p{N}„»«(§]"),
    ]


#: The cascade: tables in order, each a list of rules in order. Those named by a language apply to its texts.
CASCADE: dict[str, list[Rule]] = {
    "quotations": [
        _rule(False, rf"[{_CLOSED}][{_TAIL}]*", rf"[{_MARK}，,；;：:、]"),
        # what it holds is no whole sentence
        _rule(False, rf"[{_HELD}{_OPENED}][{_CLOSED}][{_TAIL}]*", r""),
        # a quotation that opens its sentence, and the words reporting it
        _rule(False, rf"[{_OPENED[:2]}]{_ANY}[{_CLOSED[:2]}][{_TAIL}]*", rf"{_CJK}|{_REPORT_LOWER}", opens=True),
        _rule(False, rf"[{_CLOSED[:2]}][{_TAIL}]*", _REPORT_LOWER),
        _rule(False, rf"{_CLOSED[1]}[{_TAIL}]*", _CJK),
        # a quotation within its sentence, unless a colon opens it
        _rule(False, rf"(?<![：:]\s*){_OPENED[0]}{_ANY}{_CLOSED[0]}[{_TAIL}]*", _CJK),
        # a text in brackets is a sentence only by itself
        _rule(False, rf"\S\s*{_OPENED[2]}{_ANY}{_CLOSED[2]}[{_TAIL}]*", r""),
        _rule(False, rf"{_CLOSED[3]}[{_TAIL}]*", r""),
    ],
    "numbering": [
        # an item number belongs to the sentence it opens
        _rule(False, rf"{_ITEM}", r"\s*\S", opens=True),
        _rule(False, rf"\n\s*{_ITEM}", r"\s*\S"),
        _rule(False, r"\d\.", r"\d"),
    ],
    "de": [
        _rule(False, r"(?<![\d.,])\d{1,2}\.", rf"\s+(?:{'|'.join(MONTHS_DE.split())}|{'|'.join(ORDINAL_NOUNS_DE.split())})\b"),
        _rule(False, r"(?<![\p{L}\p{N}])(?:z\.\s?[BT]|d\.\s?h|[suo]\.\s?[aäoUÄ]|v\.\s?a|i\.\s?d\.\s?R)\.", r"\s*[\p{L}\p{N}„»(]"),
        *_abbreviated("de"),
        _rule(False, r"\b(?:am|vom|zum|im|beim|ab|bis|seit dem|auf dem|des|der|dem)\s+\d{1,2}\.", rf"\s+(?!(?:{'|'.join(ARTICLES_DE.split())})\b)\p{{Lu}}"),
    ],
    "fr": _abbreviated("fr"),
    "en": [
        *_abbreviated("en"),
        # initials of a name
        _rule(False, r"(?<![\p{L}\p{N}])\p{Lu}\.", r"\s*\p{Lu}[\p{L}.]"),
    ],
    "th": [
        # sentences are parted by blanks; a final particle, or a wide blank, tells them from the blanks between clauses
        _rule(True, r"\p{Thai}", r"\s{2,}\p{Thai}"),
        _rule(True, r"(?:ครับ|ค่ะ|คะ|นะ|แล้ว|ด้วย)", r"\s+\p{Thai}"),
        _rule(False, r"\p{Thai}", r"\s+\p{Thai}"),
    ],
    "common": [
        _rule(True, rf"(?<![\p{{L}}\p{{N}}])(?:{_words(MAY_END)})\.{_CLOSE}*", _UP),
        _rule(False, rf"(?<![\p{{L}}\p{{N}}])(?:{_words(MAY_END)})\.", r"\s*[\p{Ll}\p{N},;:)\]]"),
        # marks of scripts without capitals decide by themselves; a mark within a run of marks doesn't
        _rule(True, rf"[。！？｡।॥။።؟۔．།༎។៕]{_CLOSE}*", r""),
        # an ellipsis, Latin or CJK, is a boundary only before a blank and a capital
        _rule(True, rf"(?:…|\.{{3,}}){_CLOSE}*", _UP),
        _rule(False, r"(?:…|\.{3,})", r""),
        _rule(True, rf"[.!?։]{_CLOSE}*", _UP),
        _rule(True, rf"[.!?]{_CLOSE}*", r"\s+\p{N}"),
        _rule(True, rf"[!?]{_CLOSE}*", rf"{_CJK}|{_OPEN}|\p{{Lu}}"),
        _rule(True, rf"[.]{_CLOSE}*", rf"{_CJK}"),
        # the blank between two sentences is missing
        _rule(True, rf"(?:\p{{Ll}}{{2}}|[\p{{Pe}}\p{{Pf}}{_CLOSED}]|\s\d+)[.]{_CLOSE}*", rf"{_OPEN}?\p{{Lu}}[\p{{Ll}}’\s]"),
        _rule(True, r"", r"\s*$"),
    ],
}

PAIRS = {"“": "”", "‘": "’", "「": "」", "『": "』", "（": "）", "(": ")", "[": "]", "【": "】", "《": "》", "〈": "〉", "«": "»", "„": "“”", "‚": "‘’", "〔": "〕", "［": "］"}
_TOKEN = regex.compile(rf"[{_MARK}]+|[“”‘’「」『』（）()\[\]【】《》〈〉«»„‚〔〕［］\"]|(?<=\p{{Thai}})(?=\s+\p{{Thai}})")
_SPACED_CLOSER = regex.compile(r"\s+»")
_EMPTY_LINE = regex.compile(r"\n[^\S\n]*\n\s*")
_ENDED = regex.compile(rf"[{_MARK}][\s{_MARK}”’“‘」』）)»\"\]】〕]*$")
_LATIN_WORD = regex.compile(r"(?<![\p{L}\p{N}])\p{Latin}+(?![\p{L}\p{N}])")
_STOPS = {w: [k for k, ws in STOP_WORDS.items() if w in ws.split()] for w in " ".join(STOP_WORDS.values()).split()}
_THAI = regex.compile(r"\p{Thai}")


@functools.lru_cache(256)
def _rules(languages: frozenset[str]) -> tuple[Rule, ...]:
    return tuple(r for name, rules in CASCADE.items() if name not in STOP_WORDS or name in languages for r in rules)


_COMMON = _rules(frozenset())


class _Words:
    """The stop words of a text, counted between any two places."""

    def __init__(self, text: str) -> None:
        self.text, self.at, self.sums = text, None, {}
        self.script = frozenset({"th"} if _THAI.search(text) else ())

    def between(self, begin: int, end: int) -> frozenset[str]:
        """The languages whose tables apply there: by script, and by stop words those with at least half as many as the commonest."""
        if self.at is None:
            own = [(m.start(), _STOPS[w]) for m in _LATIN_WORD.finditer(self.text) if (w := m.group().lower()) in _STOPS]
            self.at = [p for p, _ in own]
            self.sums = {k: list(itertools.accumulate((k in ks for _, ks in own), initial=0)) for k in STOP_WORDS if k != "th"}
        a, b = bisect.bisect_left(self.at, begin), bisect.bisect_left(self.at, end)
        n = {k: sums[b] - sums[a] for k, sums in self.sums.items()}
        most = max(n.values())
        return frozenset(self.script | ({k for k, v in n.items() if 2 * v >= most} if most else n.keys()))


def languages_of(text: str) -> frozenset[str]:
    return _Words(text).between(0, len(text))


def _matches(text: str) -> dict[int, int]:
    """Opening position -> closing position of the quotes and brackets that are closed within the text."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    for m in _TOKEN.finditer(text):
        ch, i = m.group(), m.start()
        if len(ch) > 1 or ch in _MARK:
            continue
        if ch == '"':
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
            if k is None:
                stack.append((ch, i))
            else:
                out[stack[k][1]] = i
                del stack[k:]
            continue
        k = next((k for k in range(len(stack) - 1, -1, -1) if ch in PAIRS.get(stack[k][0], "")), None)
        if ch in "’‘" and 0 < i < len(text) - 1 and text[i - 1].isalpha() and text[i + 1].isalpha() and text[i - 1] < "⺀" and text[i + 1] < "⺀":
            continue  # an apostrophe
        if k is not None:
            out[stack[k][1]] = i
            del stack[k:]
        elif ch in PAIRS:
            stack.append((ch, i))
    return out


def _masked(text: str, closing: dict[int, int]) -> str:
    """The text with closed pairs as signs of their kind, and what they hold masked but for its last marks."""
    if not closing:
        return text
    out, i = [], 0
    for a, b in sorted(closing.items()):
        if a < i:
            continue  # within another pair
        kind = next(k for k, signs in enumerate(_KINDS) if text[a] in signs)
        ended = _ENDED.search(text, a + 1, b)
        at = ended.start() if ended else b
        out += [text[i:a], _OPENED[kind], _HELD * (at - a - 1), text[at:b], _CLOSED[kind]]
        i = b + 1
    return "".join(out) + text[i:]


def _unit(text: str, base: int, out: list[int], languages: frozenset[str] | None) -> None:
    """Sentence ends of a text without empty lines."""
    if not text.strip():
        return
    n, begin, after_pair = len(text), 0, 0
    closing = _matches(text)
    masked = _masked(text, closing)
    own = None if languages is None else _rules(languages)
    words, tokens, after = _Words(text), list(_TOKEN.finditer(text)), 0
    for m in tokens:
        i = m.start()
        if i < begin or i < after_pair:
            continue
        if i in closing:
            # a quotation or bracket is passed as a whole
            tail = after_pair = closing[i] + 1
        elif not m.group() or m.group()[0] in _MARK:
            tail = m.end()
        else:
            continue
        while tail < n and text[tail] in "”’」』）)»\"]】〕" and tail not in closing:
            tail += 1
        if spaced := _SPACED_CLOSER.match(text, tail):
            tail = spaced.end()
        # only points and blanks need a language
        if own or m.group() not in ("", "."):
            rules = own or _COMMON
        else:
            while after < len(tokens) and tokens[after].start() < tail:
                after += 1
            rules = _rules(words.between(begin, tokens[after].start() if after < len(tokens) else n))
        if _decides(rules, masked, text, begin, tail):
            out.append(base + tail)
            begin = tail
    rest = text[begin:].rstrip()
    if rest.strip():
        out.append(base + begin + len(rest))


_BLANKS = regex.compile(r"\s*")


def _decides(rules: tuple[Rule, ...], masked: str, text: str, begin: int, at: int) -> bool:
    for rule in rules:
        if rule.after.match(text, at) and (m := rule.before.match(masked, begin, at)) and (not rule.opens or _BLANKS.fullmatch(masked, begin, m.start())):
            return rule.breaks
    return False


def sentence_ends(text: str, languages: frozenset[str] | None = None) -> list[int]:
    """End positions of the sentences, trailing blanks excluded; empty or blank texts have none."""
    out: list[int] = []
    begin = 0
    for m in _EMPTY_LINE.finditer(text):
        _unit(text[begin : m.start()], begin, out, languages)
        begin = m.end()
    _unit(text[begin:], begin, out, languages)
    return out


def sentences(df: DataFrame, key: str, text: str, with_text: bool = True, language: str | None = None) -> DataFrame:
    """One row per sentence: key, sentence_no, start_pos, end_pos, sentence (null if it isn't asked for).

    ``language`` names a column with a language (en, de, fr, th); null and other values leave it to the text. Null, empty and
    blank texts give no row. Rows delivered twice count once (of texts, hashes are compared); other columns are ignored.
    """
    told = F.col(language) if language else F.lit(None).cast("string")
    source = df.filter(F.length(text) > 0).select(F.col(key).alias("k"), F.col(text).alias("t"), told.alias("l"))
    kind = df.schema[key].dataType.simpleString()
    if with_text:
        source = once_by_hash(source, "k", "t")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for i, (t, told_) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            a = 0
            for no, b in enumerate(sentence_ends(t, frozenset([told_]) if told_ in STOP_WORDS else None)):
                a += len(t[a:b]) - len(t[a:b].lstrip())
                rows.append((i, no, a, b, t[a:b] if with_text else None))
                a = b
        if not rows:
            return None
        c = list(zip(*rows))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(c[0])), *[pa.array(c[i], pa.int64()) for i in (1, 2, 3)], pa.array(c[4], pa.string())], names=["k", "sentence_no", "start_pos", "end_pos", "sentence"])

    out = map_arrow(source, run, f"k {kind}, sentence_no bigint, start_pos bigint, end_pos bigint, sentence string")
    return (out if with_text else out.dropDuplicates(["k", "sentence_no", "start_pos", "end_pos"])).withColumnRenamed("k", key)
