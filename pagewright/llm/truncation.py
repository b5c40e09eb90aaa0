"""Texts that were cut off before their end.

The method is a self-join by prefix. The end of a text is looked up among the prefixes of *longer copies*, first of whole
texts, then of sentences, then of clauses: a text whose last sentence is a strict prefix of sentences elsewhere stops inside
a sentence, as the copies tell what follows. All prefixes of all units are hashed (a span's hash comes from one running sum)
and those that some text asks for are counted: how often a unit goes on after the prefix and how often it ends there.
Digits count as one digit in sentences and clauses.

Where no unit is known often enough, a second operator decides (``evidence`` 'context'): the same counts after the text's
last 12, 8, 5 or 3 characters, wherever they stand. A text that ends in a broken sign ('broken') needs no copy.

Closing headings, lists, signatures, notes, a purposely open end and a missing last mark are no cuts, unless a longer copy of
the whole text shows otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.sketch import Spans, bitmap, hits, size_of
from pagewright.llm.tables import code_points, map_arrow
from pagewright.session import keep

#: Lengths of the contexts (last characters).
CONTEXTS = (12, 8, 5, 3)
#: What a looked-up span is: a whole text, a sentence's or clause's beginning, or a context.
LEVELS = ("copy", "sentence", "clause", *("context",) * len(CONTEXTS))
#: Least number of occurrences for a span to count.
LEAST = 3
#: How much likelier than a missing mark a cut is, by the trace at the end: none, dots, a doubled ellipsis or dash. A cut falls
#: on any place alike and a missing mark only on ends; so, at even odds, ends speak for a missing mark where their share is
#: larger than that of ends among all places of the corpus, which is counted.
ODDS = {"open": 1.5, "dots": 25.0, "purpose": 0.1}
#: Code points that are worked on at once.
AT_ONCE = 1 << 20

MARKS = "。！？!?.।॥؟｡"
CLOSERS = "”’\"'」』）)]】》〉»›“‘〕"
#: Traces that a cut leaves behind.
TRACE = regex.compile(r"(?:\s|�|…|\.{2,}|\[(?:\.{2,}|…|more|cut|truncated)\]|\((?:\.{2,}|…|more)\)|<[/!]?[A-Za-z]{0,10}(?:\s[^<>]{0,40})?|&[#A-Za-z0-9]{0,6}|\\u?[0-9a-fA-F]{0,3}|[—–]{1,2})+$")
#: Traces by what they tell: broken signs prove a cut, dots speak for one, a doubled ellipsis or dash for an open end on purpose.
_PROOF = regex.compile(r"�|\[(?:\.{2,}|…|more|cut|truncated)\]\s*$|[<&\\][^\s<>&\\]*(?:\s[^<>]*)?$")
_PURPOSE = regex.compile(r"……\s*$|[—–]{2}\s*$")
#: Closed: a mark with closing signs behind it, and perhaps a short note in brackets.
_CLOSED = regex.compile(rf"[{regex.escape(MARKS)}][{regex.escape(CLOSERS)}\s]*(?:[（(\[【][^()（）\[\]【】\n]{{1,16}}[)）\]】]\s*)?$")
#: Last lines that close a text without a sentence mark: list items, rules, dates, signatures, notes.
_CLOSING_LINE = regex.compile(
    r"""\s*(?:
      (?:\d{1,3}[.)、．]|[（(][\p{N}一二三四五六七八九十]{1,3}[)）]|[-*•·–]\s|[①-⑳]).{1,60}
    | [*\-_=~·•\s]{3,}
    | \d{4}\s*年(?:\s*\d{1,2}\s*月(?:\s*\d{1,2}\s*日)?)?
    | [\p{Lu}][\p{L}’'. -]{1,40},\s*(?:le\s+|den\s+)?(?:\d{1,2}\.?\s+[\p{L}]+\s+)?\d{4}
    | \d{1,2}[./]\d{1,2}[./]\d{2,4}
    | [—–-]{1,2}\s*[\p{L}].{0,40}
    )\s*""",
    regex.X,
)
_TITLE_WORDS = regex.compile(r"(?:[\p{Lu}\p{N}][\p{L}\p{M}\p{N}’'-]*|of|the|and|de|du|des|la|le|les|von|der|die|das|aus|und|in|im|zu|zur|zum|à|d’\p{L}+|l’\p{L}+|&)(?:\s+|$)")
_INNER = regex.compile(r"[，,；;。！？!?：:“”]")


def open_end(text: str) -> tuple[str, str] | None:
    """(the text without traces, kind: 'open', 'dots', 'purpose' or 'proof') of an open text, None of a closed or empty one."""
    whole = text.rstrip()
    m = TRACE.search(whole)
    base = whole[: m.start()] if m else whole
    base = base.rstrip()
    if not base or _CLOSED.search(base):
        return None
    trace = m.group() if m else ""
    return base, "proof" if _PROOF.search(trace) else "purpose" if _PURPOSE.search(trace) else "dots" if trace.strip() else "open"


def closing_line(base: str, traced: bool) -> bool:
    """Whether the last line by itself closes the text: a list item, date, signature, note or heading below a closed line."""
    head, newline, last = base.rpartition("\n")
    if not newline or not last.strip():
        return False
    if _CLOSING_LINE.fullmatch(last):
        return not traced
    above = head.rstrip()
    if traced or not (_CLOSED.search(above) or len(above.rpartition("\n")[2]) < 40):
        return False
    words = last.strip()
    return len(words) <= 60 and not _INNER.search(words) and _TITLE_WORDS.match(words) is not None and "".join(m.group() for m in _TITLE_WORDS.finditer(words)) == words and len(words.split()) >= 2


def _plain(codes: np.ndarray) -> np.ndarray:
    """Digits of both widths as one."""
    digit = ((codes >= 48) & (codes <= 57)) | ((codes >= 0xFF10) & (codes <= 0xFF19))
    return np.where(digit, np.uint32(48), codes)


#: Signs behind which a sentence or a clause begins.
_BREAKS = np.array([ord(c) for c in "。！？!?\n।॥؟｡"], np.uint32)
_CLAUSES = np.array([ord(c) for c in "，、；：,;:（(“‘「『«„"], np.uint32)
_POINTS = np.array([ord(c) for c in ".!?"], np.uint32)
#: What may follow an open end without making it a cut.
_END = np.array([ord(c) for c in MARKS + "\n…"], np.uint32)
_STOP = np.array([ord(c) for c in CLOSERS], np.uint32)
_TRACED = set(" \n\t\r�….])—–;<>&\\")


class _Units:
    """Texts as one code point array with the beginnings of the sentence and the clause of each place."""

    def __init__(self, texts: list[str]) -> None:
        self.codes, self.offsets = code_points(texts)
        codes, n = self.codes, len(self.codes)
        self.start = np.repeat(self.offsets[:-1], np.diff(self.offsets))
        blank = codes == 32
        before = np.append(np.uint32(0), codes[:-1])
        sentence = np.isin(codes, _BREAKS) | (blank & np.isin(before, _POINTS))
        at = np.arange(n)

        def begins(border: np.ndarray) -> np.ndarray:
            # a unit begins behind the last border before the place; the blanks that follow a border belong to it
            first = np.where(border | (blank & np.append(False, border[:-1])), at + 1, 0)
            return np.maximum(np.append(0, np.maximum.accumulate(first)[:-1]) if n else first, self.start)

        self.sentence, self.clause = begins(sentence), begins(sentence | np.isin(codes, _CLAUSES))
        self.whole, self.plain = Spans(codes), Spans(_plain(codes))

    def hashes(self, level: int, at: np.ndarray) -> np.ndarray:
        """Hash of the span of a level that ends with each place; only for places with ``inside(level)``."""
        if level == 0:
            return self.whole.of(self.start[at], at + 1)
        begin = (self.sentence if level == 1 else self.clause)[at] if level < 3 else at + 1 - CONTEXTS[level - 3]
        return self.plain.of(begin, at + 1, min(level, 3))

    def inside(self, level: int, at: np.ndarray) -> np.ndarray:
        if level < 3:
            return (self.start if level == 0 else self.sentence if level == 1 else self.clause)[at] <= at
        return at + 1 - CONTEXTS[level - 3] >= self.start[at]

    def length(self, level: int, at: np.ndarray) -> np.ndarray:
        return at + 1 - (self.sentence if level == 1 else self.clause)[at] if level < 3 else np.full(len(at), CONTEXTS[level - 3])


def _parts(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) of at most ``AT_ONCE`` code points, or one text."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > AT_ONCE:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, texts[begin:]


def asked(df: DataFrame, key: str, text: str) -> DataFrame:
    """What texts ask for: k, state, spans (array of struct<level, size, h>, the whole text first).

    state: 'broken' if the end itself proves the cut (a broken sign, after a comma or an opening mark), 'line' if the last
    line closes the text, 'closed' if it ends with a point, which may be that of an abbreviation, else the kind of the trace.
    Texts that end with a mark which stands at ends of sentences only ask for nothing.
    """
    tail = F.right(F.rtrim(text), F.lit(16))
    never = tail.rlike(rf"[{regex.escape(MARKS.replace('.', ''))}][”’\"'」』）)\]】》〉»›“‘〕]*\s*$")
    source = df.filter(F.length(text) > 0).filter(~never | tail.rlike(r"(?:\.\.+|…+|\.\.\]|…\]|…\)|\.\.\))\s*$"))
    kind = df.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        at, bases, state = [], [], []
        for i, t in enumerate(batch.column(1).to_pylist()):
            found = open_end(t)
            if found is None:
                base = t.rstrip()
                if not base.endswith("."):
                    continue
                own = "closed"
            else:
                base, trace = found
                own = "broken" if trace == "proof" or base[-1] in "，、,;；（(《〈“‘「『„«[" else "line" if closing_line(base, trace != "open") else trace
            at.append(i)
            bases.append(base)
            state.append(own)
        if not at:
            return None
        spans = []
        for _, part in _parts(bases):
            u = _Units(part)
            last = u.offsets[1:] - 1
            by = [(level, u.length(level, last) if level else np.diff(u.offsets), _some(u, level, last), u.inside(level, last)) for level in range(len(LEVELS))]
            for j in range(len(part)):
                spans.append([{"level": level, "size": int(size[j]), "h": int(h[j])} for level, size, h, ok in by if ok[j]])
        levels = [s if state[i] not in ("broken", "line", "closed") else s[:1] for i, s in enumerate(spans)]
        kinds = pa.list_(pa.struct([("level", pa.int32()), ("size", pa.int64()), ("h", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(state), pa.array(levels, kinds)], names=["k", "state", "spans"])

    return map_arrow(source.select(F.col(key).alias("k"), F.col(text).alias("t")), run, f"k {kind}, state string, spans array<struct<level:int,size:bigint,h:bigint>>")


def _i64(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _some(u: _Units, level: int, at: np.ndarray) -> np.ndarray:
    """Hashes where a place has a span of the level, 0 elsewhere."""
    out, ok = np.zeros(len(at), np.int64), u.inside(level, at)
    out[ok] = _i64(u.hashes(level, at[ok]))
    return out


def _follows(df: DataFrame, text: str, filters: list[np.ndarray]) -> DataFrame:
    """Spans of all texts that may be asked for: level, h, ends, goes_on, mid (counts), reduced in every batch.

    mid counts points behind which a sentence goes on (a small letter, a digit or a comma follows). Level -1 counts all places.
    """
    shared = df.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # what a cut left behind is no continuation
            texts = [t if t[-1] not in _TRACED or (e := open_end(t)) is None else e[0] for t in batch.column(0).to_pylist()]
            for _, part in _parts(texts):
                if (out := count(part)) is not None:
                    yield out

    def count(texts: list[str]) -> pa.RecordBatch | None:
        u = _Units(texts)
        codes, n = u.codes, len(u.codes)
        if not n:
            return None
        following = np.append(codes[1:], np.uint32(0))
        last = u.offsets[1:][u.offsets[1:] > u.offsets[:-1]] - 1
        following[last] = 0
        # an end directly, or behind closing marks
        after = np.append(following[1:], np.uint32(0))
        digit = lambda c: (c >= 48) & (c <= 57)
        small = lambda c: ((c >= 97) & (c <= 122)) | ((c >= 0xDF) & (c <= 0xFF))
        # a point inside a number or name ends nothing
        inner = (following == 46) & (digit(after) | small(after))
        ends = (np.isin(following, _END) & ~inner) | (np.isin(following, _STOP) & np.isin(after, _END))
        next_ = np.where(following == 32, after, following)
        mid = (codes == 46) & (small(next_) | digit(next_) | (next_ == 44))
        at = np.flatnonzero(following)
        levels, hs, es, gs, ms = [], [], [], [], []
        for level in range(len(LEVELS)):
            own = at[u.inside(level, at)]
            h = u.hashes(level, own)
            found = hits(shared.value[min(level, 3)], h)
            if len(found):
                own, (h, inverse) = own[found], np.unique(h[found], return_inverse=True)
                total = np.bincount(inverse, minlength=len(h))
                e = np.bincount(inverse, weights=ends[own], minlength=len(h)).astype(np.int64)
                levels.append(np.full(len(h), level, np.int32))
                hs.append(_i64(h))
                es.append(e)
                gs.append(total - e)
                ms.append(np.bincount(inverse, weights=mid[own], minlength=len(h)).astype(np.int64))
        levels.append(np.array([-1], np.int32))
        all_ends = int(ends[at].sum())
        for xs, x in ((hs, 0), (es, all_ends), (gs, len(at) - all_ends), (ms, 0)):
            xs.append(np.array([x], np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (levels, hs, es, gs, ms)], names=["level", "h", "ends", "goes_on", "mid"])

    return df.filter(F.length(text) > 0).select(F.col(text).alias("t")).mapInArrow(run, "level int, h bigint, ends bigint, goes_on bigint, mid bigint")


def truncated(df: DataFrame, key: str, text: str) -> DataFrame:
    """Cut texts: key, evidence.

    evidence: 'copy' (a longer copy of the text goes on), 'broken' (the end proves it), 'sentence' or 'clause' (longer copies
    of its last sentence or clause go on), 'context' (its last characters are inside a sentence elsewhere). Null and empty
    texts are no cases. Exact copies of a cut text are all cases; a row delivered twice counts once; extra columns are
    ignored. The filters of the hashes asked for are sized by their number, at most 16 MB each; what passes them is joined
    exactly by 64-bit hash.
    """
    found = keep(asked(df, key, text))
    wanted = found.select("k", F.explode("spans").alias("s")).select("k", "s.*")
    n = {r.level: r.n for r in wanted.groupBy(F.least("level", F.lit(3)).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    filters = [bitmap(wanted.filter(F.least("level", F.lit(3)) == level), "h", size_of(n.get(level, 0))) for level in range(4)]
    counts = keep(_follows(df, text, filters).groupBy("level", "h").agg(*[F.sum(c).alias(c) for c in ("ends", "goes_on", "mid")]))
    all_ = counts.filter("level = -1").first()
    base = all_.ends / max(1, all_.ends + all_.goes_on) if all_ else 0.0
    answers = wanted.join(counts, ["level", "h"])
    known = (F.col("level") > 0) & (F.col("ends") + F.col("goes_on") >= LEAST)
    whole = lambda c: F.coalesce(F.max(F.when(F.col("level") == 0, F.col(c))), F.lit(0)).alias(f"copy_{c}")
    # the sentence decides before the clause, and the longest known context only where neither is known
    best = answers.groupBy("k").agg(F.max_by(F.when(known, F.struct("level", "ends", "goes_on")), F.when(known, -F.col("level"))).alias("c"), *[whole(c) for c in ("ends", "goes_on", "mid")])
    judged = found.select("k", "state").join(best, "k", "left")
    odds = F.coalesce(*[F.when(F.col("state") == k, F.lit(v)) for k, v in ODDS.items()])
    share = F.col("c.ends") / (F.col("c.ends") + F.col("c.goes_on"))
    inside = F.coalesce(share <= odds * base, F.col("state") != "purpose")
    level = F.coalesce(F.get(F.array(*[F.lit(x) for x in LEVELS]), F.col("c.level")), F.lit("context"))
    copies = lambda c: F.coalesce(f"copy_{c}", F.lit(0))
    evidence = (
        F.when((F.col("state") == "closed") & (copies("mid") > 0), "copy")
        .when(F.col("state") == "closed", None)
        .when(copies("goes_on") > copies("ends"), "copy")
        .when(F.col("state") == "broken", "broken")
        .when((F.col("state") == "line") | (copies("ends") > 0), None)
        .when(inside, level)
    )
    return judged.select(F.col("k").alias(key), evidence.alias("evidence")).filter("evidence is not null").distinct()
