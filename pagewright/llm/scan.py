"""Noise in text from scanned pages: divided words, misread characters, running heads and page numbers.

An averaged perceptron edits character by character: keep, replace (delete and insert are replacements of two characters
by one and of one by two) and join two lines at a mark. What it may replace is a table of known confusions and all pairs
that the corpus itself shows (``operations``). It is trained on text of the corpus itself that is damaged by these pairs; each
decision scores hashed patterns of the neighbouring characters. Vocabulary counts over all texts
and the perceptron's score then tell divided words from compounds broken at their own hyphen, within a box, from box to box and
from page to page. Head lines and page numbers ("furniture") are found from the place of a line on its page (the coordinates of
its box) and its repetition over the pages of a book.
"""

from __future__ import annotations

import gc
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.llm.tables import map_arrow
from pagewright.operators.deliveries import latest
from pagewright.session import ensure_checkpoint_dir

#: What OCR writes for what is printed, as pairs "written printed".
CONFUSIONS = """
券卷 具县 侧测 科料 囹图 入人 挡档 朔期 悦税 列例 钞抄 卯印 曰日 杈权 末未 奈条 傅传 冶治 太大 侯候 仵件 己已
卷券 县具 测侧 人入 日曰 未末 传傅 治冶 大太 候侯 已己 土士 士土 千干 干千 天夭 夭天 王玉 玉王 目日 白自 自白
问间 间问 晴睛 睛晴 埋理 理埋 乌鸟 鸟乌 拔拨 拨拔 夫失 失夫 免兔 兔免 折拆 拆折 午牛 牛午 户尸 戊戌 戌戍 辨辩 辩辨
贷货 货贷 贪贫 贫贪 矢失 析折 历厉 住往 往住 今令 令今 爪瓜 设没 没设 斤斥 徽微 微徽 淮准 准淮 泠冷 剌刺 粱梁 村材
材村 技枝 枝技 场扬 扬场 固因 因固 囚因 团困 困团 末木 木术 术木 本木 巳已 毫亳 毋母 母毋 幕墓 墓幕 慕幕 栽裁 载裁 坚竖
1l 1i 0o 5s 6b 9g ce ec l1 I1 O0 S5 B8 q9 Z2 hb bh nu un
""".split()
MULTI = [("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("li", "h")]
MARKS = "-‐­¬"
#: Marks that can't be part of a word.
SOFT = "­¬"

#: Offsets of the neighbours in each pattern.
PATTERNS = ((-1, 1), (-2, -1), (1, 2), (-3, -2, -1), (1, 2, 3), (-2, -1, 1), (-1, 1, 2), (-2, -1, 1, 2), (-4, -3, -2, -1), (1, 2, 3, 4), (-3, -2, -1, 1), (-1, 1, 2, 3))
SLOTS = 1 << 20
#: Bound of the training sample (texts), passes over it, and the share of printed characters that are damaged in it.
TRAIN_TEXTS, EPOCHS, DAMAGE = 12_000, 4, 0.12
#: Share of the printed characters damaged by drawn pairs, which are many and rarer each than those of the table.
DRAWN_DAMAGE = 0.04
#: A pair is drawn from contexts whose commonest string occurs so often and makes up half of them; a string that is so many
#: times rarer than it counts as written for it; so many contexts must show the pair.
USUAL, RARER, CONTEXTS = 8, 20, 3


@dataclass(frozen=True)
class Op:
    written: str
    printed: str


OPS = [Op(p[0], p[1]) for p in CONFUSIONS if len(p) == 2 and p[0] != p[1]] + [Op(a, b) for a, b in MULTI]
#: Pairs that also go the other way.
_BOTH = {op for op in OPS if Op(op.printed, op.written) in OPS}
#: Operations between letters that are both frequent need more evidence than the rest.
_FREQUENT = {op for op in OPS if len(op.written) == 1 and op.written.isascii() and op.written.isalpha() and op.printed.isalpha()} | {Op("m", "rn"), Op("d", "cl"), Op("li", "h")}


class Operations:
    """The operations of an editor: the table, then those drawn from the corpus, then the join of two lines.

    ``counts`` are those of the characters in the corpus: of pairs that go both ways, the one that takes away the commoner
    character needs more evidence.
    """

    def __init__(self, drawn: list[Op] | None = None, counts: dict[str, int] | None = None) -> None:
        n = counts or {}
        self.ops = list(OPS) + [op for op in drawn or [] if op not in set(OPS)]
        self.known, self.join = len(OPS), len(self.ops)
        self.width = np.array([len(o.written) for o in self.ops] + [1])
        # letters written for digits and digits written for letters need the right neighbours
        self.to_letter = np.array([op.written.isdigit() and op.printed.isalpha() for op in self.ops])
        self.to_digit = np.array([op.written.isalpha() and op.printed.isdigit() for op in self.ops])
        self.lower_l = np.array([op.written == "l" for op in self.ops])
        self.in_word = np.array([op.written.isascii() and op.written.isalpha() and op.printed.isalpha() for op in self.ops])
        listed = {op.written for op in OPS}
        # drawn pairs are seldom damaged in training, so that their scores stay lower; the table speaks against another reading of its own
        self.least = np.array([_KEEP_MARGIN + (0.4 if i >= self.known and op.written not in listed else 1.2 if i >= self.known or op in _FREQUENT or op in _BOTH and n.get(op.written, 0) > n.get(op.printed, 0) else 0.0) for i, op in enumerate(self.ops)] + [-1e9], np.float32)


_KEEP_MARGIN = 0.3
TABLE = Operations()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _neighbours(codes: np.ndarray) -> np.ndarray:
    """Codes with digits as one, line breaks and blanks as one."""
    out = codes.astype(np.uint64)
    out[(codes >= 48) & (codes <= 57)] = 48
    out[(codes == 10) | (codes == 32)] = 32
    return out


_PRIME = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _slots(plain: np.ndarray, at: np.ndarray, op: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Slots of the patterns around the positions; ``plain`` is padded by 5 on both sides, ``width`` is that of the written string."""
    out = np.empty((len(PATTERNS), len(at)), np.int32)
    base = op.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        for i, pattern in enumerate(PATTERNS):
            h = base + np.uint64(i + 1)
            for j, o in enumerate(pattern):
                where = at + o + 5 + (width - 1 if o > 0 else 0)
                h = (h ^ (plain[where] * _PRIME[j])) * np.uint64(0xFF51AFD7ED558CCD)
                h ^= h >> np.uint64(29)
            out[i] = ((h * _PRIME[0]) >> np.uint64(44)).astype(np.int32)
    return out


class Candidates:
    """Positions of a text array at which an operation applies."""

    def __init__(self, table: Operations = TABLE) -> None:
        self.first = np.full(0x110000, -1, np.int32)
        self.by: dict[int, list[int]] = {}
        for i, op in enumerate(table.ops):
            self.by.setdefault(ord(op.written[0]), []).append(i)
        self.most = max(map(len, self.by.values()))
        self.ops = np.full((len(self.by), self.most), -1, np.int32)
        for row, (code, ops) in enumerate(self.by.items()):
            self.first[code] = row
            self.ops[row, : len(ops)] = ops
        self.second = np.array([ord(o.written[1]) if len(o.written) > 1 else 0 for o in table.ops], np.uint32)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, operations) over codes; codes that no operation begins with have none."""
        row = self.first[np.minimum(codes, 0x10FFFF)]
        at = np.flatnonzero(row >= 0)
        row = row[at]
        following = np.append(codes[1:], np.uint32(0))[at]
        ats, ops = [], []
        for k in range(self.most):
            op = self.ops[row, k]
            ok = op >= 0
            two = self.second[np.maximum(op, 0)]
            ok &= (two == 0) | (two == following)
            ats.append(at[ok])
            ops.append(op[ok])
        return np.concatenate(ats), np.concatenate(ops)


_JOINS = regex.compile(rf"(?<=[\p{{L}}])[{MARKS}](?=[ \t]*(?:\n|$))")


def _joins(text: str) -> list[int]:
    return [m.start() for m in _JOINS.finditer(text)]


def _damage(text: str, rng: np.random.Generator, inverse: dict[str, list[int]], table: Operations = TABLE, drawn: dict[str, list[int]] | None = None) -> tuple[str, dict[int, int]]:
    """A damaged text and the operation that mends each damaged position."""
    out: list[str] = []
    mend: dict[int, int] = {}
    n, i, draw = 0, 0, rng.random(len(text) + 1)
    rare = rng.random(len(text)) if drawn else None
    size = len(text)
    while i < size:
        ch = text[i]
        two = text[i : i + 2]
        options = inverse.get(ch)
        pair = inverse.get(two) if len(two) == 2 else None
        if pair and draw[i] < DAMAGE:
            op = pair[int(draw[i + 1] * len(pair)) % len(pair)]
            mend[n] = op
            out.append(table.ops[op].written)
            n += len(table.ops[op].written)
            i += 2
        elif options and draw[i] < DAMAGE:
            op = options[int(draw[i + 1] * len(options)) % len(options)]
            mend[n] = op
            out.append(table.ops[op].written)
            n += len(table.ops[op].written)
            i += 1
        elif drawn and rare[i] < DRAWN_DAMAGE and (more := drawn.get(ch, []) + (drawn.get(two, []) if len(two) == 2 else [])):
            op = more[int(draw[i + 1] * len(more)) % len(more)]
            mend[n] = op
            out.append(table.ops[op].written)
            n += len(table.ops[op].written)
            i += len(table.ops[op].printed)
        elif draw[i] < 0.004 and ch.isalpha() and ch < "ʰ" and 1 < i < size - 2 and text[i - 2 : i + 2].isalpha():
            mend[n] = table.join
            out.append(MARKS[int(draw[i] * 1e6) % 4] + "\n" + ch)
            n += 3
            i += 1
        else:
            # a compound broken at its own hyphen, or a range, is to be kept
            if ch == "-" and draw[i] < 0.5 and 0 < i < size - 1 and text[i - 1].isalnum() and text[i + 1].isalnum():
                out.append("-\n")
                n += 2
            else:
                out.append(ch)
                n += 1
            i += 1
    return "".join(out), mend


def train(texts: list[str], seed: int = 7, epochs: int = EPOCHS, table: Operations = TABLE) -> np.ndarray:
    """Averaged weights (SLOTS + one bias per operation) from texts that are taken as printed."""
    rng = np.random.default_rng(seed)
    inverse: dict[str, list[int]] = {}
    drawn: dict[str, list[int]] = {}
    for i, op in enumerate(table.ops):
        (inverse if i < table.known else drawn).setdefault(op.printed, []).append(i)
    candidates = Candidates(table)
    w = np.zeros(SLOTS + table.join + 1, np.float32)
    total, steps = np.zeros_like(w, np.float64), 0
    for _ in range(epochs):
        slots, labels, ops_all = [], [], []
        for begin in range(0, len(texts), 500):
            damaged = [_damage(t, rng, inverse, table, drawn) for t in texts[begin : begin + 500]]
            codes = _codes("".join(d for d, _ in damaged)) if damaged else np.zeros(0, np.uint32)
            plain = np.pad(_neighbours(codes), 5)
            mend = np.full(len(codes), -1, np.int32)
            joins, base = [], 0
            for d, m in damaged:
                for k, op in m.items():
                    mend[base + k] = op
                joins += [base + k for k in _joins(d)]
                base += len(d)
            at, op = candidates.of(codes)
            at, op = np.append(at, np.array(joins, np.int64)), np.append(op, np.full(len(joins), table.join, np.int32))
            label = np.where(mend[at] == op, 1, -1).astype(np.float32)
            # keeping is by far the commoner case; a part of it is enough
            keep = (label > 0) | (rng.random(len(at)) < 0.35)
            at, op, label = at[keep], op[keep], label[keep]
            slots.append(_slots(plain, at, op, table.width[op]))
            labels.append(label)
            ops_all.append(op)
        if not slots:
            break
        x, y, o = np.concatenate(slots, axis=1), np.concatenate(labels), np.concatenate(ops_all)
        order = rng.permutation(len(y))
        # small samples are taken in small steps, so that there are enough of them
        for part in np.array_split(order, max(1, len(order) // max(64, min(4096, len(order) // 64)))):
            score = w[x[:, part]].sum(axis=0) + w[SLOTS + o[part]]
            wrong = part[(y[part] * score) <= 1.0]
            if len(wrong):
                np.add.at(w, x[:, wrong], np.broadcast_to(0.1 * y[wrong], (len(PATTERNS), len(wrong))))
                np.add.at(w, SLOTS + o[wrong], 0.1 * y[wrong])
            steps += 1
            if steps % 8 == 0:
                total += w
    return (total / max(1, steps // 8)).astype(np.float32)


class Editor:
    """The trained perceptron over texts."""

    def __init__(self, weights: np.ndarray, table: Operations = TABLE):
        self.w, self.table, self.candidates = weights, table, Candidates(table)

    def _possible(self, codes: np.ndarray, at: np.ndarray, op: np.ndarray) -> np.ndarray:
        """Whether the neighbours allow the operation: digits become letters inside words, letters digits inside numbers."""
        t = self.table
        wide = np.pad(codes, 3)
        before, after = wide[at + 2], wide[at + 3 + t.width[op]]
        digit = lambda c: (c >= 48) & (c <= 57)
        lower = lambda c: ((c >= 97) & (c <= 122)) | ((c >= 0xDF) & (c <= 0x24F))
        point = (before == 46) | (before == 44)
        to_letter = (lower(before) | lower(after)) & ~digit(before) & ~digit(after)
        to_digit = digit(before) | (point & digit(wide[at + 1])) | (t.lower_l[op] & digit(after) & ~lower(before))
        in_word = (lower(before) | lower(after)) & (before != 10) & (after != 10)
        return np.where(t.to_letter[op], to_letter, np.where(t.to_digit[op], to_digit, np.where(t.in_word[op], in_word, True)))

    def edits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, position in it, operation, score) of all proposed replacements, the best one per position."""
        joined = "\n\n\n\n\n".join(texts)
        codes = _codes(joined)
        if not len(codes):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int32), np.zeros(0, np.float32))
        starts = np.zeros(len(texts), np.int64)
        np.cumsum(np.fromiter((len(t) + 5 for t in texts[:-1]), np.int64, len(texts) - 1), out=starts[1:])
        plain = np.pad(_neighbours(codes), 5)
        at, op = self.candidates.of(codes)
        possible = self._possible(codes, at, op)
        at, op = at[possible], op[possible]
        score = np.empty(len(at), np.float32)
        for a in range(0, len(at), 200_000):
            p, o = at[a : a + 200_000], op[a : a + 200_000]
            score[a : a + 200_000] = self.w[_slots(plain, p, o, self.table.width[o])].sum(axis=0) + self.w[SLOTS + o]
        hit = score > self.table.least[op]
        at, op, score = at[hit], op[hit], score[hit]
        order = np.lexsort((-score, at))
        at, op, score = at[order], op[order], score[order]
        first = np.append(True, at[1:] != at[:-1]) if len(at) else np.zeros(0, bool)
        at, op, score = at[first], op[first], score[first]
        # a string of two characters that is replaced isn't changed again at its second
        apart = np.append(True, at[1:] >= at[:-1] + self.table.width[op[:-1]]) if len(at) else first
        at, op, score = at[apart], op[apart], score[apart]
        text = np.searchsorted(starts, at, side="right") - 1
        return text, at - starts[text], op, score

    def join_scores(self, text: str, positions: list[int]) -> np.ndarray:
        plain = np.pad(_neighbours(_codes(text)), 5)
        at = np.array(positions, np.int64)
        op = np.full(len(at), self.table.join, np.int32)
        return self.w[_slots(plain, at, op, self.table.width[op])].sum(axis=0) + self.w[SLOTS + op]


#: Scripts without blanks between words, as ranges of codes.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3041, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_SPACED = regex.compile(r"(?V1)(?<![\p{L}\p{M}\p{N}])(?<![-‐­¬]\n)(?=\p{N}*\p{L})[[\p{L}\p{M}\p{N}]--[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]]{4,40}(?![\p{L}\p{M}\p{N}])(?![-‐­¬](?:\s|$))")
#: Distinct trigrams that a task holds before it hands them on.
_HELD = 1 << 21


def _trigrams(texts: list[str]) -> np.ndarray:
    """All three neighbouring characters of unspaced scripts, 21 bits each."""
    codes = _codes("\n".join(texts))
    own = np.zeros(len(codes), bool)
    for a, b in _UNSPACED:
        own |= (codes >= a) & (codes <= b)
    at = np.flatnonzero(own[:-2] & own[1:-1] & own[2:])
    c = codes.astype(np.int64)
    return (c[at] << 42) | (c[at + 1] << 21) | c[at + 2]


def _pairs(seen: DataFrame, two: bool) -> list[tuple]:
    """Pairs (rare, usual) of strings in the same context: seen has key, seg, n and, where ``two``, strings of two characters.

    Strings that are both usual somewhere are different words, not one misread for the other.
    """
    size = F.length("seg") if two else F.lit(1)
    seen = seen.withColumn("size", size)
    tops = seen.groupBy("key", F.col("size").alias("top_size")).agg(F.max_by("seg", F.struct("n", "seg")).alias("usual"), F.max("n").alias("top"), F.sum("n").alias("total")).filter((F.col("top") >= USUAL) & (F.col("top") * 2 >= F.col("total")))
    both = seen.join(tops, "key").filter((F.col("seg") != F.col("usual")) & (F.col("size") + F.col("top_size") <= 3))
    if two:  # a character more or less at the end of a word is an ending
        both = both.filter((F.col("size") == F.col("top_size")) | ~F.endswith("key", F.lit(" ")))
    rare = F.col("n") * RARER <= F.col("top")
    counts = both.groupBy("seg", "usual").agg(F.count_if(rare).alias("rare"), F.count_if(~rare).alias("level"))
    found = {(r.seg, r.usual): (r.rare, r.level) for r in counts.filter((F.col("rare") >= CONTEXTS) & (F.col("level") * 2 <= F.col("rare"))).collect()}
    return sorted(p for p, (n, level) in found.items() if n >= 2 * (level + found.get(p[::-1], (0, 0))[0]))


_IGNORED = regex.compile(r"[\p{Default_Ignorable_Code_Point}]")
_SCRIPTS = [regex.compile(rf"\p{{Script_Extensions={name}}}") for name in ("Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Han", "Hangul", "Hiragana", "Katakana")]


def _in(char: str, codec: str) -> bool:
    try:
        return bool(char.encode(codec))
    except UnicodeEncodeError:
        return False


def _visible(op: Op) -> bool:
    """Whether the two look different: no other encoding, case or look-alike of another script, nor a traditional form of a simplified one."""
    plain = lambda t: _IGNORED.sub("", unicodedata.normalize("NFKC", t)).casefold()
    a, b = plain(op.written), plain(op.printed)
    if a == b:
        return False
    if any(s.search(a) and not s.search(b) and any(z.search(b) for z in _SCRIPTS) for s in _SCRIPTS):
        return False
    # forms that are each found in one of the two national standards only
    return not any(_in(x, p) and not _in(x, q) and _in(y, q) and not _in(y, p) for x, y in ((a, b),) for p, q in (("big5", "gb2312"), ("gb2312", "big5")))


def _form(text: str, pos: int, op: Op) -> tuple[str, str] | None:
    """What stands at the position and what it would become, as the forms that ``operations`` counts; None where neither is counted."""
    a, b = max(0, pos - 41), pos + len(op.written)
    for m in _SPACED.finditer(text, a, min(len(text), b + 41)):
        if m.start() <= pos and b <= m.end():
            return m.group(), text[m.start() : pos] + op.printed + text[b : m.end()]
    if len(op.written) == len(op.printed) == 1:
        for begin in (pos - 1, pos - 2, pos):
            if begin >= 0 and len(part := text[begin : begin + 3]) == 3:
                other = part[: pos - begin] + op.printed + part[pos - begin + 1 :]
                if len(own := _trigrams([part])) and len(new := _trigrams([other])):
                    return str(own[0]), str(new[0])
    return None


def confirmed(proposed: DataFrame, forms: DataFrame) -> DataFrame:
    """Proposals without those of drawn pairs that make no usual form out of a rare one; was and would are the forms."""
    asked = proposed.filter("was is not null")
    known = asked.join(forms.select(F.col("form").alias("would"), F.col("n").alias("n_would")), "would").filter(F.col("n_would") >= USUAL)
    known = known.join(forms.select(F.col("form").alias("was"), F.col("n").alias("n_was")), "was", "left").filter(F.coalesce("n_was", F.lit(0)) * RARER <= F.col("n_would"))
    columns = [c for c in proposed.columns if c not in ("was", "would")]
    return proposed.filter("was is null").select(columns).unionByName(known.select(columns))


def operations(df: DataFrame, text: str) -> tuple[Operations, DataFrame]:
    """(the table and the operations that all texts show, counts of forms: form, n). Shown are strings written in a context for the one that is usual there.

    Words of scripts with blanks are compared whole, but for one or two characters (one replaced, inserted or deleted, or
    two by one). Other scripts are compared by the character between two neighbours. Only counts of distinct words and
    trigrams are shuffled, and only pairs (bounded by the alphabets) reach the driver. Pairs that look alike (``_visible``)
    are no misreadings; digits are exchanged for letters and back only by the table.
    """
    ensure_checkpoint_dir(df.sparkSession)

    def words(batches):
        n: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                n.update(_SPACED.findall(t))
            if len(n) > _HELD // 8:
                yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["word", "n"])
                n = Counter()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["word", "n"])

    def trigrams(batches):
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            own, n = np.unique(_trigrams(batch.column(0).to_pylist()), return_counts=True)
            held, inverse = np.unique(np.append(held, own), return_inverse=True)
            counts = np.bincount(inverse, np.append(counts, n), len(held)).astype(np.int64)
            if len(held) > _HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], names=["t", "n"])
                held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], names=["t", "n"])

    texts = df.filter(F.length(text) > 0).select(text)
    whole = texts.mapInArrow(words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).checkpoint()
    cut = F.expr("flatten(transform(array(1, 2), s -> transform(sequence(1, length(word) - s + 1), i -> struct(concat(left(word, i - 1), ' ', substring(word, i + s)) as key, substring(word, i, s) as seg))))")
    spaced = whole.select("n", F.explode(cut).alias("x")).select("x.key", "x.seg", "n")
    mask = (1 << 21) - 1
    unspaced = texts.mapInArrow(trigrams, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).select(F.col("t").bitwiseAND(F.lit(~(mask << 21))).alias("key"), F.shiftright("t", 21).bitwiseAND(F.lit(mask)).alias("seg"), "n").checkpoint()
    found = [Op(a, b) for a, b in _pairs(spaced, True)] + [Op(chr(a), chr(b)) for a, b in _pairs(unspaced, False)]
    digit = lambda op: any(c.isdigit() for c in op.written + op.printed)
    asked = {ord(c) for op in _BOTH for c in op.written if len(op.written) == 1}
    counts = unspaced.filter(F.col("seg").isin(*asked)).groupBy("seg").agg(F.sum("n").alias("n")).collect()
    forms = whole.withColumnRenamed("word", "form").unionByName(unspaced.select(F.col("key").bitwiseOR(F.shiftleft("seg", 21)).cast("string").alias("form"), "n"))
    return Operations([op for op in found if not digit(op) and _visible(op)], {chr(r.seg): r.n for r in counts}), forms


def fitted(df: DataFrame, text: str, bound: int = TRAIN_TEXTS, table: Operations = TABLE) -> np.ndarray:
    """Weights trained on at most ``bound`` distinct texts in order of their hash.

    The sample goes to one task, which trains and returns the weights (4 MB); the driver never holds the texts.
    """
    # a share of the hashes that leaves a few times the bound, so that what the task reads doesn't grow with the data
    share = min(1.0, 4.0 * bound / max(1, df.count()))
    low = F.xxhash64("t") <= F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)
    own = df.select(F.col(text).alias("t")).filter(F.length("t").between(20, 2000)).filter(low).orderBy(F.xxhash64("t"), "t").limit(bound * 2)

    def run(batches):
        texts = sorted({t for batch in batches for t in batch.column(0).to_pylist()})
        # the order of the hash can't be had here; any fixed order does
        yield pa.RecordBatch.from_arrays([pa.array([train(texts[:: max(1, -(-len(texts) // bound))], table=table).tobytes()], pa.binary())], names=["w"])

    rows = own.coalesce(1).mapInArrow(run, "w binary").collect()
    return np.frombuffer(rows[0].w, np.float32) if rows else train([], table=table)


_WORD = r"(?<![\p{L}\p{N}])(?<![-‐­¬]\n)(\p{L}{2,}(?:[-‐]\p{L}{2,})*)(?![\p{L}\p{N}])(?![-‐­¬](?:\s|$))"
_WORDS = regex.compile(_WORD)
_LATIN = regex.compile(r"(?<![^\W\d_])(?<![-‐­¬]\n)([A-Za-zÀ-ɏ]{2,}(?:[-‐][A-Za-zÀ-ɏ]{2,})*)(?![A-Za-zÀ-ɏ0-9])(?![-‐­¬](?:\s|$))")


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Counts of all words that aren't broken: word (lower case, hyphens as -), n."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        n: Counter[str] = Counter()
        for t in batch.column(0).to_pylist():
            n.update(_LATIN.findall(t))
        if not n:
            return None
        lower: Counter[str] = Counter()
        for w, k in n.items():
            lower[w.lower().replace("‐", "-")] += k
        return pa.RecordBatch.from_arrays([pa.array(lower.keys(), pa.string()), pa.array(lower.values(), pa.int64())], names=["word", "n"])

    return map_arrow(df.filter(F.col(text).rlike(r"[A-Za-zÀ-ɏ]{2}")).select(text), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


_LEFT, _RIGHT = regex.compile(r"(?r)\p{L}+"), regex.compile(r"[ \t]*\n?[ \t]*(\p{L}+)")


def proposals(df: DataFrame, key: str, text: str, weights: np.ndarray, following: str | None = None, table: Operations = TABLE) -> DataFrame:
    """What the editor proposes: key, kind ('misread', 'soft', 'hard', 'open soft', 'open hard'), pos, written, printed, score.

    was and would are the forms before and after an operation that isn't in the table, for ``confirmed``.
    'soft' and 'hard' are joins at a mark that can't or can be part of a word; written and printed are then the parts of
    the word. ``following`` is the text that comes after (the next box), for marks at the end; they are 'open' if no word
    follows there.
    """
    # of what follows, the word that it begins with
    columns = [F.col(key).alias("k"), F.col(text).alias("t"), (F.regexp_extract(F.col(following), r"^(\s*\p{L}+)", 1) if following else F.lit(None).cast("string")).alias("f")]
    shared = df.sparkSession.sparkContext.broadcast(weights)  # 4 MB, whatever the data

    def run(batches):
        editor = Editor(shared.value, table)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            after = batch.column(2).to_pylist()
            row, pos, op, score = editor.edits(texts)
            rows = []
            for i, p, o, s in zip(row, pos, op, score):
                form = _form(texts[i], int(p), table.ops[o]) if o >= table.known else (None, None)
                if form:
                    rows.append((int(i), "misread", int(p), table.ops[o].written, table.ops[o].printed, float(s), *form))
            for i, t in enumerate(texts):
                if any(m in t for m in MARKS) and (found := _joins(t)):
                    for p, s in zip(found, editor.join_scores(t, found)):
                        left, at_end = _LEFT.match(t, 0, p), not t[p + 1 :].strip()
                        right = _RIGHT.match(t, p + 1) or (_RIGHT.match(after[i]) if after[i] and at_end else None)
                        kind = "soft" if t[p] in SOFT else "hard"
                        rows.append((i, kind if right or not at_end else f"open {kind}", p, left.group() if left else "", right.group(1) if right else "", float(s), None, None))
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(c[0])), pa.array(c[1]), pa.array(c[2], pa.int64()), pa.array(c[3], pa.string()), pa.array(c[4], pa.string()), pa.array(c[5], pa.float64()), pa.array(c[6], pa.string()), pa.array(c[7], pa.string())], names=["k", "kind", "pos", "written", "printed", "score", "was", "would"])

    kind = df.schema[key].dataType.simpleString()
    return df.filter(F.length(text) > 0).select(*columns).mapInArrow(run, f"k {kind}, kind string, pos bigint, written string, printed string, score double, was string, would string").distinct().withColumnRenamed("k", key)


def divided(proposed: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """Joins that are divided words: compounds and ranges broken at their own hyphen are taken out by the vocabulary."""
    soft = proposed.filter("kind = 'soft'").select(key, "pos")
    hard = proposed.filter("kind = 'hard' and written <> ''").withColumns({"l": F.lower("written"), "r": F.lower("printed")})
    asked = {"joined": F.concat("l", "r"), "compound": F.concat_ws("-", "l", "r"), "l": F.col("l"), "r": F.col("r")}
    keyed = hard.select(key, "pos", "r", "score", F.explode(F.array(*[F.struct(F.lit(name).alias("what"), form.alias("word")) for name, form in asked.items()])).alias("x")).select(key, "pos", "r", "score", "x.*")
    found = keyed.join(words, "word", "left").groupBy(key, "pos", "r", "score")
    counted = found.agg(*[F.coalesce(F.max(F.when(F.col("what") == name, F.col("n"))), F.lit(0)).alias(f"n_{name}") for name in asked])
    # the perceptron's score and what the vocabulary says for one word: the word as a whole against the compound, a second part
    # that is no word by itself, a first part that is none
    log = lambda x, y: F.log((F.col(x) + 0.5) / (F.col(y) + 0.5))
    known = (F.col("n_joined") + F.col("n_compound")) > 0
    alone = F.when(F.col("r") == "", F.when(F.col("n_l") < 2, 20.0).otherwise(-20.0)).when(F.col("n_r") >= 2, -PART).when(F.col("n_l") < 2, PART).otherwise(0.0)
    total = F.col("score") + F.when(known, WHOLE * log("n_joined", "n_compound")).otherwise(alone)
    return soft.unionByName(counted.filter(total > 0).select(key, "pos")).distinct()


#: Weight of the vocabulary beside the perceptron's score (which lies within about 5): of whole words, of a word's parts.
WHOLE, PART = 20.0, 20.0


# furniture

_NUMBER = r"([0-9]{1,5}|[ivxlc]{1,9}|[IVXLC]{1,9})"
_EDGE = r"[\s\-—–·•.|~*]*"
#: A line that is a page number, in the usual forms.
_BARE = rf"^{_EDGE}(?:第|[Pp]\.|[Pp]age|S\.|Seite)?\s*{_NUMBER}\s*(?:页|頁)?(?:\s*/\s*[0-9]{{1,5}})?{_EDGE}$"
_LEAD = r"^([0-9]{1,5})(?:\s{2,}|\s*[·|—–]\s*)(\S.*)$"
_TAIL = r"^(.*\S)(?:\s{2,}|\s*[·|—–]\s*)([0-9]{1,5})$"
_CHAPTER = r"^(?:第.{1,5}[章节節回篇卷部编講讲]|[0-9]{1,3}[.、．]|[IVXLC]{1,6}\.|(?i:chapter|kapitel|chapitre|part|teil|partie)\b)"
_SENTENCE_END = r"[。！？!?;；，,：:]$|\.$"


def _value(number: Column) -> Column:
    """Arabic or roman number; null for letters that form no roman number below 400."""
    r = F.lower(number)
    for pair, same in (("xc", "lxxxx"), ("xl", "xxxx"), ("ix", "viiii"), ("iv", "iiii")):
        r = F.replace(r, F.lit(pair), F.lit(same))
    count = lambda c: F.length(r) - F.length(F.replace(r, F.lit(c), F.lit("")))
    roman = count("c") * 100 + count("l") * 50 + count("x") * 10 + count("v") * 5 + count("i")
    form = F.lower(number).rlike("^c{0,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$") & (F.length(number) > 0)
    return F.when(number.rlike("^[0-9]+$"), number.cast("int")).when(form, roman)


#: The part of a page's height, from above and from below, in which head lines and page numbers stand.
EDGE = 1 / 3


def edge_lines(pages: DataFrame) -> DataFrame:
    """First and last lines of the boxes near the top and bottom of each page, with their place and what they may be.

    The place is that of the box's coordinates in the page's height; where either is missing, the order of the boxes.
    """
    # the first box that ends a sentence: nothing below it is a head line
    ended = lambda b: F.right(F.rtrim(b["text_content"]), F.lit(2)).rlike(r"[。！？!?.।…][”’」』）)»\"]?$")
    body = F.array_min(F.transform("boxes", lambda b, i: F.when(F.coalesce(ended(b), F.lit(False)), F.coalesce(F.get(b["box"], F.lit(1)), i))))
    height = F.col("image_dims.h") if "image_dims" in pages.columns else F.lit(None).cast("int")
    boxes = pages.select("page_id", "doc_key", "page", height.alias("h"), F.size("boxes").alias("n"), body.alias("body"), F.posexplode("boxes").alias("box_no", "b"))
    at = lambda i, order: F.coalesce(F.when(F.col("h") > 0, F.get("b.box", F.lit(i)) / F.col("h")), order / F.col("n"))
    boxes = boxes.withColumn("y", F.coalesce(F.get("b.box", F.lit(1)), F.col("box_no")))
    placed = boxes.withColumns({"above": F.col("y") <= F.coalesce("body", F.col("y")), "top": at(1, F.col("box_no")) <= EDGE, "bottom": at(3, F.col("box_no") + 1) >= 1 - EDGE}).filter("top or bottom")
    lines = F.split(F.col("b.text_content"), "\n")
    both = placed.select("page_id", "doc_key", "page", "n", "above", "top", "bottom", "box_no", F.col("b.label").alias("label"), F.explode(F.array(F.struct(F.lit(True).alias("first"), F.element_at(lines, 1).alias("raw")), F.struct(F.lit(False).alias("first"), F.element_at(lines, -1).alias("raw")))).alias("x"))
    digits = F.translate(F.col("x.raw"), "０１２３４５６７８９　／－．", "0123456789 /-.")
    line = F.trim(digits)
    out = both.select("page_id", "doc_key", "page", "n", "above", "top", "bottom", "box_no", "label", "x.first", line.alias("line")).filter("line <> ''")
    # what can be neither head nor number goes first, by the line's ends alone: most lines are running text
    begin, end = F.left("line", F.lit(1)), F.right("line", F.lit(1))
    numbered = begin.rlike(r"[0-9ivxlcIVXLC\s\-—–·•.|~*第pPS]") & end.rlike(r"[0-9ivxlcIVXLC\s\-—–·•.|~*页頁]") | begin.rlike("[0-9]") | end.rlike("[0-9]")
    out = out.filter(numbered | (F.col("first") & F.col("top") & F.col("above") & ~end.rlike("[。！？!?;；，,：:.]")))
    bare = F.regexp_extract("line", _BARE, 1)
    lead_n, lead_t = F.regexp_extract("line", _LEAD, 1), F.regexp_extract("line", _LEAD, 2)
    tail = F.when(F.right("line", F.lit(1)).rlike("[0-9]"), F.col("line")).otherwise("")
    tail_t, tail_n = F.regexp_extract(tail, _TAIL, 1), F.regexp_extract(tail, _TAIL, 2)
    number = F.when(bare != "", bare).when(lead_n != "", lead_n).when(tail_n != "", tail_n)
    head = F.when(bare != "", F.lit(None)).when(lead_n != "", lead_t).when(tail_n != "", tail_t).otherwise(F.col("line"))
    key = F.lower(F.regexp_replace(head, r"[\s​-‏⁠﻿]", ""))
    form = F.when(bare != "", F.regexp_replace("line", _NUMBER, "N")).when(lead_n != "", F.lit("N head")).when(tail_n != "", F.lit("head N"))
    may_head = F.col("first") & F.col("top") & F.col("above") & (F.length(key) >= 2) & head.rlike(r"^[\p{L}\p{N}（(《“「『]") & ~head.rlike(_SENTENCE_END)
    out = out.withColumns({"box_key": F.col("page_id") * 100 + F.col("box_no"), "bare": bare != "", "value": _value(number), "roman": number.rlike("^[ivxlcIVXLC]+$"), "head": F.when(may_head, key), "form": form})
    return out.filter("value is not null or head is not null").drop("line")


def page_numbers(lines: DataFrame) -> DataFrame:
    """Boxes with the printed number of their page: box_key, first (whether it is in the first line, else in the last).

    The number must be at an edge of the page and run with the pages of its book (one offset for arabic, one for roman
    numbers); forms that a book uses once are no page numbers.
    """
    at_edge = (F.col("top") & F.col("first")) | (F.col("bottom") & ~F.col("first")) | F.col("bare")
    own = lines.filter(F.col("value").isNotNull() & at_edge).select("box_key", "first", "doc_key", "page", "roman", "form", "bare", (F.col("value") - F.col("page")).alias("off")).distinct()
    counts = own.groupBy("doc_key", "roman", "off").agg(F.countDistinct("page").alias("c"))
    best = counts.groupBy("doc_key", "roman").agg(F.max_by("off", F.struct("c", (F.col("off") == 0).cast("int"), -F.abs("off"))).alias("best"), F.max("c").alias("best_n"))
    right = own.join(best, ["doc_key", "roman"]).filter((F.col("off") == F.when(F.col("best_n") >= 3, F.col("best")).otherwise(0)))
    forms = right.groupBy("doc_key", "form").agg(F.countDistinct("page").alias("f"))
    books = right.groupBy("doc_key").agg(F.countDistinct("page").alias("p"))
    return right.join(forms, ["doc_key", "form"]).join(books, "doc_key").filter("f >= 2 or p <= 3").select("box_key", "first").distinct()


def running_heads(lines: DataFrame) -> DataFrame:
    """Boxes that are or contain the head line repeated over the pages of a book.

    The heading that opens a chapter (the last occurrence of its line on the first page that has it, labelled or numbered
    as a heading) is none. Lines with a misread character are matched to a repeated line of the book by one of their halves.
    """
    top = lines.filter("head is not null").select("box_key", "page_id", "doc_key", "page", "box_no", "label", "head").distinct()
    title = F.col("label").isin("title", "sub_title")
    per = top.groupBy("doc_key", "head").agg(F.countDistinct("page").alias("pages"), F.min("page").alias("first_page"), F.max((F.col("label") == "header").cast("int")).alias("headers"), F.max(title.cast("int")).alias("titles"))
    repeated = per.filter("pages >= 3 or (pages = 2 and (headers = 1 or titles = 1))")
    last = Window.partitionBy("doc_key", "head", "page")
    known = top.join(repeated, ["doc_key", "head"]).withColumn("last_box", F.max("box_no").over(last))
    opens = (F.col("page") == F.col("first_page")) & (F.col("box_no") == F.col("last_box")) & (F.coalesce(F.col("label") != "header", F.lit(True))) & (title | F.col("head").rlike(_CHAPTER))
    exact = known.filter(~F.coalesce(opens, F.lit(False))).select("box_key")
    # a misread character leaves one half of the line as it is
    half = F.ceil(F.length("head") / 2).cast("int")
    halves = lambda df: df.withColumn("h", F.explode(F.array(F.concat(F.lit("l"), F.left("head", half)), F.concat(F.lit("r"), F.expr("substring(head, cast(ceil(length(head) / 2) as int) + 1)")))))
    rest = halves(top.join(repeated, ["doc_key", "head"], "left_anti").filter(F.length("head") >= 5)).withColumnRenamed("head", "other")
    near = rest.join(halves(repeated.select("doc_key", "head")), ["doc_key", "h"]).filter((F.length("head") == F.length("other")) & (F.levenshtein("head", "other") <= F.when(F.length("head") >= 8, 2).otherwise(1)))
    fuzzy = near.filter(~F.coalesce(title, F.lit(False))).select("box_key")
    # a head that stands on one page only, as in a chapter of two pages, is told by its place together with its label
    labelled = top.filter("label = 'header'").select("box_key")
    return exact.unionByName(labelled).unionByName(fuzzy).distinct()


def _freed(df: DataFrame) -> DataFrame:
    """The table, after the driver has let go of the plans and broadcasts that made it: long chains of jobs pile them up."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.java.lang.System.gc()
    return df


def _boxes(pages: DataFrame) -> DataFrame:
    """Boxes with the text of the next box of their page."""
    exploded = pages.select("page_id", F.col("boxes").alias("all"), F.posexplode("boxes").alias("box_no", "b"))
    return exploded.select((F.col("page_id") * 100 + F.col("box_no")).alias("box_key"), "page_id", "box_no", F.col("b.text_content").alias("text"), F.get("all", F.col("box_no") + 1)["text_content"].alias("following"))


def _starts(pages: DataFrame, heads: DataFrame) -> DataFrame:
    """The word that each page's running text begins with: doc_key, page, start."""
    rows = pages.select("page_id", "doc_key", "page", F.posexplode("boxes").alias("box_no", "b")).filter(F.coalesce(~F.col("b.label").isin(*ASIDE), F.lit(True)))
    word = lambda pattern: F.regexp_extract("b.text_content", pattern, 1)
    light = rows.select("doc_key", "page", "box_no", (F.col("page_id") * 100 + F.col("box_no")).alias("box_key"), word(r"^\s*(\p{L}+)").alias("first"), word(r"^[^\n]*\n\s*(\p{L}+)").alias("second")).filter("first <> '' or second <> ''")
    own = light.join(heads.withColumn("head", F.lit(True)), "box_key", "left").withColumn("start", F.when(F.col("head"), F.col("second")).otherwise(F.col("first")))
    return own.filter("start <> ''").groupBy("doc_key", "page").agg(F.min_by("start", F.struct("box_no", "start")).alias("start"))


#: Labels of boxes that stand beside the running text.
ASIDE = ("image", "table", "footnote", "page_number", "header", "footer")


def _continued(opened: DataFrame, pages: DataFrame, heads: DataFrame) -> DataFrame:
    """Marks at the end of a page's text with the word that the next page begins with."""
    place = pages.select("page_id", "doc_key", (F.col("page") + 1).alias("page")).distinct()
    at = opened.withColumn("page_id", F.expr("box_key div 100")).join(place, "page_id", "left").join(_starts(pages, heads), ["doc_key", "page"], "left")
    return at.withColumns({"kind": F.regexp_replace("kind", "open ", ""), "printed": F.coalesce("start", F.lit(""))}).select(opened.columns).distinct()


def analysed(pages: DataFrame, spark: SparkSession, train_texts: int = TRAIN_TEXTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edits, heads, numbers): what to mend in each box, the boxes with head lines (box_key) and page numbers (box_key, first).

    edits: box_key, kind, pos, written, printed. Lines near the edges, proposals and the results are small beside the texts;
    each is checkpointed, so that every further plan is short and nothing is worked out twice.
    """
    ensure_checkpoint_dir(spark)
    texts = _boxes(pages)
    table, forms = operations(texts, "text")
    weights = fitted(texts, "text", train_texts, table)
    lines = _freed(edge_lines(pages).checkpoint())
    heads, numbers = running_heads(lines).checkpoint(), _freed(page_numbers(lines).checkpoint())
    raw = confirmed(proposals(texts, "box_key", "text", weights, "following", table).checkpoint(), forms)
    opened = raw.filter("kind like 'open%'")
    proposed = _freed(raw.filter("kind not like 'open%'").unionByName(_continued(opened, pages, heads)).checkpoint())
    joins = divided(proposed, "box_key", vocabulary(texts, "text"))
    mended = proposed.filter("kind = 'misread'").unionByName(proposed.filter("kind <> 'misread'").join(joins, ["box_key", "pos"], "left_semi").withColumn("kind", F.lit("split_word")).select(proposed.columns))
    return _freed(mended.select("box_key", "kind", "pos", "written", "printed").checkpoint()), heads, numbers


def defects(pages: DataFrame, spark: SparkSession, train_texts: int = TRAIN_TEXTS) -> DataFrame:
    """One row per box and defect: box_key, defect. Boxes without text have none; a page delivered twice counts once."""
    edits, heads, numbers = analysed(pages, spark, train_texts)
    found = edits.select("box_key", F.col("kind").alias("defect"))
    return found.unionByName(heads.withColumn("defect", F.lit("running_head"))).unionByName(numbers.select("box_key").withColumn("defect", F.lit("page_number"))).distinct()


_ENDS = regex.compile(r"[。！？!?.।…：:][”’」』）)»\"]*$")
_CJK_END = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}，、；：。“”（）]$")


def join_lines(text: str) -> str:
    """Line breaks inside a paragraph as blanks (nothing between CJK characters); empty lines stay."""
    out = []
    for part in regex.split(r"\n[ \t]*\n\s*", text):
        lines = [x.strip() for x in part.split("\n") if x.strip()]
        whole = lines[0] if lines else ""
        for line in lines[1:]:
            whole += ("" if _CJK_END.search(whole) else " ") + line
        if whole:
            out.append(whole)
    return "\n\n".join(out)


_LEAD_OF, _TAIL_OF = regex.compile(r"\s*[0-9０-９]{1,5}(?:[\s　]{2,}|[\s　]*[·|—–][\s　]*)(?=\S)"), regex.compile(r"(?:[\s　]{2,}|[\s　]*[·|—–][\s　]*)[0-9０-９]{1,5}\s*$")


def furniture(text: str, head: bool, first_number: bool, last_number: bool) -> list[tuple[int, int]]:
    """Spans (start, end) of the text's head line and page numbers, and nothing else.

    A line that is nothing else goes with its break; of a line with a number beside other text only the number and what parts
    it from the text go, or only the head where the number isn't that of the page.
    """
    out = []
    breaks = [m.start() for m in regex.finditer("\n", text)]
    lines = list(zip([0] + [b + 1 for b in breaks], breaks + [len(text)]))
    for i, number in ((0, first_number), (len(lines) - 1, last_number)):
        is_head = head and i == 0
        if not number and not is_head:
            continue
        a, b = lines[i]
        line = text[a:b]
        lead, tail = _LEAD_OF.match(line), _TAIL_OF.search(line)
        if number and not is_head and (lead or tail):
            out.append((a, a + lead.end()) if lead else (a + tail.start(), b))
        elif is_head and not number and (lead or tail):
            out.append((a + lead.end(), b) if lead else (a, a + tail.start()))
        else:
            out.append((a, b + 1) if b < len(text) else (max(0, a - 1), b))
    return out


def mend(text: str, edits: list[tuple[int, str, str, str]], removed: list[tuple[int, int]] | None = None) -> tuple[str, bool]:
    """(the text after edits (position, kind, written, printed) and without the removed spans, whether its last word goes on)."""
    goes_on = False
    removed = removed or []
    steps = [(a, b, "") for a, b in removed]
    for pos, kind, written, printed in edits:
        if any(a <= pos < b for a, b in removed):
            continue
        if kind == "misread":
            steps.append((pos, pos + len(written), printed))
        else:
            rest = regex.compile(r"[ \t]*\n?[ \t]*").match(text, pos + 1)
            steps.append((pos, rest.end(), ""))
            goes_on |= not text[rest.end() :].strip()
    for a, b, to in sorted(set(steps), reverse=True):
        text = text[:a] + to + text[b:]
    return text, goes_on


def _page_parts(boxes: list[dict], marks: dict[int, dict]) -> list[tuple[str, bool, bool, bool]]:
    """Paragraphs of a page: (text, whether it belongs to the running text, whether it goes on, whether within a word)."""
    out: list[tuple[str, bool, bool, bool]] = []
    for i, b in enumerate(boxes):
        own = marks.get(i, {})
        t = b["text_content"] or ""
        spans = furniture(t, own.get("head", False), own.get("first", False), own.get("last", False))
        t, glued = mend(t, own.get("edits", ()), spans)
        body = b["label"] not in ASIDE
        for part in join_lines(t).split("\n\n"):
            if not part:
                continue
            before = next((k for k in range(len(out) - 1, -1, -1) if out[k][1]), None) if body else None
            if before is not None and out[before][2]:
                text, _, _, word = out[before]
                out[before] = (text + _glue(text, word) + part, True, False, False)
            else:
                out.append((part, body, False, False))
                before = len(out) - 1
            if body:
                text = out[before][0]
                out[before] = (text, True, not _ENDS.search(text) and len(text) > 40, False)
        if body and glued and (k := next((k for k in range(len(out) - 1, -1, -1) if out[k][1]), None)) is not None:
            out[k] = (out[k][0], True, True, True)
    return out


def _glue(text: str, within_word: bool) -> str:
    return "" if within_word or _CJK_END.search(text) else " "


def paragraphs(pages: DataFrame, spark: SparkSession, train_texts: int = TRAIN_TEXTS) -> DataFrame:
    """Continuous paragraphs: page_id (of the page on which it begins), paragraph_no, text.

    Misread characters are replaced and divided words joined, over boxes and pages too; head lines and page numbers are left
    out, of a line with other text nothing but them; lines are joined; a box of running text that doesn't end a sentence goes
    on in the next one, also on the next page of the book. Pages without text give no row; of a page delivered again the
    latest delivery counts. Pages move once, to their marks; of the paragraphs only those that go over a page move again.
    """
    edits, heads, numbers = analysed(pages, spark, train_texts)
    # one row of marks for each page, so that texts are moved once
    marks = edits.groupBy("box_key").agg(F.collect_set(F.struct("pos", "kind", "written", "printed")).alias("edits"))
    placed = numbers.groupBy("box_key").agg(F.max("first").alias("first"), F.max(~F.col("first")).alias("last"))
    marks = marks.join(heads.withColumn("head", F.lit(True)), "box_key", "full").join(placed, "box_key", "full")
    by_page = marks.groupBy(F.expr("box_key div 100").alias("page_id")).agg(F.collect_list(F.struct((F.col("box_key") % 100).alias("box_no"), "edits", "head", "first", "last")).alias("marks"))
    once = latest(pages, "page_id", "ingested_at").filter("boxes is not null").select("page_id", "doc_key", "page", F.transform("boxes", lambda b: F.struct(b["label"].alias("label"), b["text_content"].alias("text_content"))).alias("boxes"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for i, (boxes, found) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
            own = {m["box_no"]: {"edits": [(e["pos"], e["kind"], e["written"], e["printed"]) for e in m["edits"] or []], "head": bool(m["head"]), "first": bool(m["first"]), "last": bool(m["last"])} for m in found or []}
            parts = _page_parts(boxes, own)
            body = [no for no, p in enumerate(parts) if p[1]]
            rows += [(i, no, t, bool(body) and no == body[0], bool(body) and no == body[-1], goes_on, word, bool(_ENDS.search(t))) for no, (t, _, goes_on, word) in enumerate(parts)]
        if not rows:
            return None
        c = list(zip(*rows))
        at = pa.array(c[0])
        return pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in range(3)], pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), *[pa.array(x, pa.bool_()) for x in c[3:]]], names=["page_id", "doc_key", "page", "no", "text", "is_first", "is_last", "goes_on", "in_word", "ended"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "doc_key", "page"))
    parts = map_arrow(once.join(by_page, "page_id", "left"), run, f"{kinds}, no bigint, text string, is_first boolean, is_last boolean, goes_on boolean, in_word boolean, ended boolean").checkpoint()
    return _over_pages(parts)


def _over_pages(parts: DataFrame) -> DataFrame:
    """page_id, paragraph_no, text of parts, those that go on over a page joined with the first of the next page."""
    ends = parts.filter("is_last and (goes_on or is_first and not ended)").select("doc_key", (F.col("page") + 1).alias("page"), F.col("page_id").alias("before_id"), F.col("no").alias("before_no"), F.col("is_first").alias("before_single"), (~F.col("goes_on")).alias("short"))
    joined = parts.filter("is_first").join(ends, ["doc_key", "page"]).select("doc_key", "page", "page_id", "no", "before_id", "before_no", "before_single", "short")
    # a page that is one paragraph hands on the head of the page before it; only pages that are joined to another are ordered
    order = Window.partitionBy("doc_key").orderBy("page", "page_id")
    lag = lambda c: F.lag(c).over(order)
    chained = F.col("before_single") & (lag("page_id") == F.col("before_id"))
    head = F.when(~F.coalesce(chained, F.lit(False)), F.struct("before_id", "before_no", "short"))
    # a short text that is its whole page goes on only if it is itself the rest of a paragraph
    chains = joined.withColumn("head", F.last(head, True).over(order)).filter("not head.short").select("page_id", "no", F.col("head.before_id").alias("head_id"), F.col("head.before_no").alias("head_no"))
    own = parts.select("page_id", "no", "page", "text", "in_word").join(chains, ["page_id", "no"], "left")
    heads = chains.select(F.col("head_id").alias("page_id"), F.col("head_no").alias("no")).distinct().withColumn("is_head", F.lit(True))
    marked = own.join(heads, ["page_id", "no"], "left")
    alone = marked.filter("head_id is null and is_head is null").select("page_id", F.col("no").alias("paragraph_no"), "text")
    moved = marked.filter("head_id is not null or is_head").select(F.coalesce("head_id", "page_id").alias("page_id"), F.coalesce("head_no", "no").alias("paragraph_no"), "page", "text", "in_word")
    grouped = moved.groupBy("page_id", "paragraph_no").agg(F.array_sort(F.collect_list(F.struct("page", "text", "in_word"))).alias("x"))
    cjk = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}，、；：。“”（）]$"
    start = F.struct(F.lit("").alias("t"), F.lit(True).alias("w"))
    fold = F.aggregate("x", start, lambda acc, p: F.struct(F.concat(acc["t"], F.when(acc["w"] | acc["t"].rlike(cjk), "").otherwise(" "), p["text"]).alias("t"), p["in_word"].alias("w")))
    return alone.unionByName(grouped.select("page_id", "paragraph_no", fold["t"].alias("text")))
