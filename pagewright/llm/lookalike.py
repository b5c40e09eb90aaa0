"""One form for visually identical text.

Three steps: compatibility normalisation (width forms, composed accents, presentation forms, joined letters, radicals
and compatibility ideographs, kinds of blank), deletion of characters that print nothing, and a search through the
look-alike lattice of each token. The lattice of a token holds, for every letter, all letters of its look-alike class;
Viterbi finds the reading that is best under a character bigram model learned from the corpus, with a price for each
change of script. Two tokens that look the same have the same lattice and hence the same reading.

What a reader would notice stays: digits, case, accents, order, raised, circled, squared and traditional forms.
"""

from __future__ import annotations

import bisect
import functools
import math
import unicodedata
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.tables import code_points, map_arrow
from pagewright.session import keep

#: Look-alike classes of Latin, Greek, Cyrillic, Armenian, Cherokee and Lisu letters; the first is the usual one.
CLASSES = """
aаɑ cсϲ dԁ eе gɡ hһ iіι jјϳ lӏ oоοօ pрρ qԛ sѕ uս vνѵ wԝ xх yу ëё ïї
AАΑᎪꓮ BВΒᏴꓐ CСϹᏟꓚ DᎠꓓ EЕΕᎬꓰ FϜꓝ GԌᏀꓖ HНΗᎻꓧ IІΙӀꓲ JЈͿᎫꓙ KКΚᏦꓗ LᏞꓡ MМΜᎷꓟ NΝꓠ OОΟꓳ PРΡᏢꓑ QԚ RᎡꓣ SЅᏚꓢ TТΤᎢꓔ UՍꓴ VѴᏙꓦ WԜᎳꓪ XХΧꓫ YҮΥꓬ ZΖᏃꓜ ËЁ ÏЇΪ
""".split()
#: Look-alike classes of Han characters and kana.
CJK_CLASSES = "へヘ べベ ぺペ 口ロ 工エ 力カ 二ニ 八ハ 夕タ 卜ト 一ー 丿ノ 厶ム".split()

#: Single characters of the same shape outside the letters.
SHAPES = {"‐": "-", "‑": "-", "⁃": "-", "﹣": "-", "ʼ": "’", "‧": "·", "∙": "·", "⋅": "·", "・": "·", "･": "·", "ꞏ": "·", "‒": "–", "―": "—", "⸺": "——", "∶": ":", "։": ":", "꞉": ":", "ǃ": "!", "∕": "/", "⁄": "/", "❘": "|", "ǀ": "|", "∣": "|", "˗": "-", "ʻ": "‘", "ꓸ": ".", "․": ".", "⼀": "一"}

#: Compatibility tags under which a character looks like its decomposition.
_SAME = {"<wide>", "<narrow>", "<compat>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>"}
#: Characters whose compatibility form looks different.
_KEEP = set("№℡™℠ºªſẛϐϑϒϕϖϰϱϲϵ℀℁℅℆Ⅽ⁇⁈⁉") | {chr(c) for c in range(0x2135, 0x2139)}


def _fold_table() -> dict[int, str | None]:
    out: dict[int, str | None] = {}
    for lo, hi in ((0x80, 0x10000), (0x1F100, 0x1F200), (0x2F800, 0x2FA20), (0xE0000, 0xE0200)):
        for o in range(lo, hi):
            ch = chr(o)
            kind = unicodedata.category(ch)
            if kind == "Cn" or 0xD800 <= o < 0xE000:
                continue
            if kind in ("Zs", "Zl", "Zp"):
                out[o] = " "
                continue
            # format characters, variation selectors, fillers
            if kind == "Cf" or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or o in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, 0x2800, 0x180B, 0x180C, 0x180D, 0x180F):
                out[o] = None
                continue
            tag, _, rest = unicodedata.decomposition(ch).partition(" ")
            if tag in _SAME and ch not in _KEEP and not rest.startswith("0020 "):
                flat = unicodedata.normalize("NFKC", ch)
                # a decomposition that holds raised, circled or squared parts isn't of equal look
                if flat != ch:
                    out[o] = flat
    out.update({ord(ch): to for ch, to in SHAPES.items()})
    for o in (*range(0x0, 0x9), 0xB, *range(0xE, 0x1C), 0x7F, *range(0x80, 0x85), *range(0x86, 0xA0)):
        out[o] = None
    for o in (0x9, 0xA, 0xC, 0xD, 0x1C, 0x1D, 0x1E, 0x1F, 0x85):
        out[o] = " "
    return out


_FOLD: dict[int, str | None] = {}
_CLASS_OF: dict[str, str] = {}


def _tables() -> None:
    if not _FOLD:
        _FOLD.update(_fold_table())
        for c in (*CLASSES, *CJK_CLASSES):
            for ch in c:
                _CLASS_OF[ch] = c


_OTHERS = r"[Ͱ-ԯɑɡօսՍᎠ-ᏽꓐ-ꓽ]"
_AMBIGUOUS = regex.escape("".join(sorted({c[0] for c in CLASSES})))
#: Tokens that need the search: with a letter outside Latin, of Latin letters that all have look-alikes, or runs of Han and kana
#: look-alikes, which are read with their neighbours.
_TOKEN = regex.compile(rf"[\p{{L}}\p{{M}}--\p{{Han}}--\p{{Hiragana}}--\p{{Katakana}}]*{_OTHERS}[\p{{L}}\p{{M}}--\p{{Han}}--\p{{Hiragana}}--\p{{Katakana}}]*|(?<![\p{{L}}\p{{M}}])[{_AMBIGUOUS}]+(?![\p{{L}}\p{{M}}])", regex.V1)
_CJK_RUN = regex.compile(f"[{''.join(CJK_CLASSES)}]+")
_CJK_LETTER = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_BLANKS = regex.compile(r" {2,}")


def normalise(text: str) -> str:
    """Compatibility normalisation and deletion of what prints nothing; runs of blanks become one, the ends none."""
    _tables()
    if not text.isascii():
        text = unicodedata.normalize("NFC", text.translate(_FOLD))
    else:
        text = text.translate(_FOLD)
    return _BLANKS.sub(" ", text).strip(" ")


#: First code points of the scripts of the lattices.
_SCRIPTS = [(0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "latin"), (0x13A0, "cherokee"), (0x1400, "latin"), (0x3041, "hiragana"), (0x30A0, "katakana"), (0x3100, "han"), (0xA4D0, "lisu"), (0xA500, "latin"), (0xF900, "han"), (0xFB00, "latin"), (0x20000, "han")]
_BEGINS = [b for b, _ in _SCRIPTS]


def script(ch: str) -> str:
    return _SCRIPTS[bisect.bisect_right(_BEGINS, ord(ch)) - 1][1]


class Model:
    """Add-one character bigrams over letters, from the corpus; ``switch`` prices a change of script within a token."""

    def __init__(self, counts: Mapping[tuple[int, int], int], switch: float = 12.0):
        self.pair = {k: v for k, v in counts.items()}
        self.single: dict[int, int] = {}
        for (a, _), n in self.pair.items():
            self.single[a] = self.single.get(a, 0) + n
        self.size, self.switch = len(self.single) + 1, switch
        self.cache: dict[str, str] = {}

    def score(self, a: str, b: str) -> float:
        own = (self.pair.get((ord(a), ord(b)), 0) + 1) / (self.single.get(ord(a), 0) + self.size)
        return math.log(own) - (self.switch if script(a) != script(b) else 0)

    def read(self, token: str) -> str:
        """The best reading of a token's lattice; ties fall to the class's first letter."""
        key = "".join(_CLASS_OF.get(ch, ch)[0] for ch in token)
        if (known := self.cache.get(key)) is not None:
            return known
        lattice = [_CLASS_OF.get(ch, ch) for ch in key]
        best = {ch: (-i * 1e-6 + math.log(self.single.get(ord(ch), 0) + 1), ch) for i, ch in enumerate(lattice[0])}
        for options in lattice[1:]:
            best = {ch: max(((s + self.score(p[-1], ch) - i * 1e-6, p + ch) for s, p in best.values()), key=lambda x: (x[0], x[1])) for i, ch in enumerate(options)}
        found = max(best.values(), key=lambda x: x[0])[1]
        if len(self.cache) < 1_000_000:
            self.cache[key] = found
        return found


def canonical(text: str, model: Model) -> str:
    """The text in its one form."""
    text = normalise(text)
    if text.isascii() and not _TOKEN.search(text):
        return text
    text = _TOKEN.sub(lambda m: model.read(m.group()), text)

    def with_neighbours(m: regex.Match) -> str:
        a, b = m.span()
        left = text[a - 1] if a and _CJK_LETTER.match(text[a - 1]) else ""
        right = text[b] if b < len(text) and _CJK_LETTER.match(text[b]) else ""
        return model.read(left + m.group() + right)[len(left) : len(left) + b - a]

    return _CJK_RUN.sub(with_neighbours, text)


def letter_pairs(texts: DataFrame, column: str) -> dict[tuple[int, int], int]:
    """Counts of neighbouring letters of the scripts in the lattices, over all texts; of Han and kana those with a look-alike.

    Reduced in every batch; the result is bounded by the square of the alphabets and by the Han and kana look-alikes times
    their neighbours (a few 10,000 pairs in practice), not by the corpus.
    """
    cjk = np.array(sorted(ord(ch) for c in CJK_CLASSES for ch in c), np.uint32)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        codes, offsets = code_points(batch.column(0).to_pylist())
        letter = ((codes >= 97) & (codes <= 122)) | ((codes >= 65) & (codes <= 90)) | ((codes >= 0xC0) & (codes < 0x530) & (codes != 0xD7) & (codes != 0xF7))
        alike = np.isin(codes, cjk)
        wide = alike | ((codes >= 0x3041) & (codes < 0x3100)) | ((codes >= 0x3400) & (codes < 0xA000)) | ((codes >= 0xF900) & (codes < 0xFB00))
        both = (letter[:-1] & letter[1:]) | (alike[:-1] & wide[1:]) | (wide[:-1] & alike[1:])
        ends = offsets[1:-1]
        ends = ends[(ends > 0) & (ends < len(codes))]
        both[ends - 1] = False
        at = np.flatnonzero(both)
        pairs, n = np.unique(codes[at].astype(np.int64) * 65536 + codes[at + 1], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    rows = map_arrow(texts.filter(F.length(column) > 0).select(column), count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return {(r.pair >> 16, r.pair & 65535): r.n for r in rows}


def canonical_form(df: DataFrame, key: list[str], text: str, model: Model) -> DataFrame:
    """key columns and ``canonical``: every text in its one form, null for null, '' for texts of nothing printed."""
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in key)
    pairs = model.pair

    def run(batches):
        own = Model(pairs)
        for batch in batches:
            texts = batch.column(len(key)).to_pylist()
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(key))], pa.array([None if t is None else canonical(t, own) for t in texts], pa.string())], names=[*key, "canonical"])

    return df.select(*key, F.col(text).alias("__text")).mapInArrow(run, f"{kinds}, canonical string")


def _hashed(df: DataFrame, group: list[str], key: str, text: str, least: int, model: Model) -> DataFrame:
    """group, k, c1 and c2 (128-bit hash of the one form), raw (64-bit hash of the text) of texts of at least ``least`` characters."""
    pairs = model.pair
    source = df.filter(F.length(text) >= least).select(*group, F.col(key).alias("k"), F.col(text).alias("__text"))
    kinds = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in group)

    def run(batches):
        own = Model(pairs)
        for batch in batches:
            texts = batch.column(len(group) + 1).to_pylist()
            form = [xxhash.xxh3_128_intdigest(canonical(t, own).encode("utf-8", "surrogatepass")) for t in texts]
            raw = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts]
            signed = lambda xs: pa.array(np.array(xs, np.uint64).view(np.int64), pa.int64())
            low, high = [x & 0xFFFFFFFFFFFFFFFF for x in form], [x >> 64 for x in form]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(group) + 1)], signed(low), signed(high), signed(raw)], names=[*group, "k", "c1", "c2", "raw"])

    # hashes are small beside the texts and are read several times: kept, so that texts are folded once
    return keep(source.mapInArrow(run, f"{kinds}, k {df.schema[key].dataType.simpleString()}, c1 bigint, c2 bigint, raw bigint"))


def classes(df: DataFrame, group: list[str], key: str, text: str, least: int, model: Model) -> tuple[DataFrame, DataFrame]:
    """(classes, members): the texts of a group that look the same, without any pairs.

    classes: group columns, class_id (hash), n_keys, n_texts (different spellings), first_key, for every class, also of one
    spelling. members: group columns, key, class_id, text_hash, n_links (rows of the class spelled differently), each key and
    spelling once. Linear in the rows, whatever the size of a class.
    """
    hashed = _hashed(df, group, key, text, least, model).withColumn("class_id", F.concat(F.hex("c1"), F.lit("-"), F.hex("c2")))
    at = [*group, "class_id"]
    spelled = hashed.groupBy(*at, "raw").agg(F.count_distinct("k").alias("n"), F.min("k").alias("first"))
    own = spelled.groupBy(*at).agg(F.sum("n").alias("n_keys"), F.count(F.lit(1)).alias("n_texts"), F.min("first").alias("first_key"))
    sized = own.join(spelled, _same(own, spelled, at)).select(*[own[c] for c in at], "raw", (F.col("n_keys") - F.col("n")).alias("n_links"))
    rows = hashed.dropDuplicates([*at, "k", "raw"])
    members = rows.join(sized, _same(rows, sized, [*at, "raw"])).select(*[rows[c] for c in group], F.col("k").alias(key), rows["class_id"], rows["raw"].alias("text_hash"), "n_links")
    return own, members


def _same(a: DataFrame, b: DataFrame, columns: list[str]):
    return functools.reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


#: Rows of a class that one task pairs with each other; larger classes are split into blocks.
BLOCK = 2048


def same_looking(df: DataFrame, group: list[str], key: str, text: str, least: int, model: Model) -> DataFrame:
    """Pairs of rows of a group that differ in characters but not in look: group columns, key_a, key_b (key_a < key_b).

    ``key`` is a bigint. Texts shorter than ``least`` characters and null texts take no part, nor do rows without a group; a
    row delivered twice counts once; exact copies are no pairs. Classes are found by a 128-bit hash of the canonical form, so
    texts are never shuffled. Only classes with at least two different texts are expanded, and only between blocks of
    ``BLOCK`` rows, so that a class of any size is paired by many tasks; ``classes`` gives the same without pairs.
    """
    hashed = _hashed(df, group, key, text, least, model)
    at = [*group, "c1", "c2"]
    varied = hashed.groupBy(*at).agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo <> hi").select(*at, F.ceil(F.col("n") / BLOCK).alias("blocks"))
    members = hashed.join(varied, at).dropDuplicates([*at, "k", "raw"]).withColumn("block", F.pmod(F.xxhash64("k"), "blocks"))
    side = lambda name, to: members.select(*at, F.col("k").alias(f"k_{name}"), F.col("raw").alias(f"raw_{name}"), *to)
    a = side("a", [F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j")])
    b = side("b", [F.explode(F.sequence(F.lit(0).cast("bigint"), "block")).alias("i"), F.col("block").alias("j")])
    pairs = a.join(b, [*at, "i", "j"]).filter("raw_a <> raw_b and k_a <> k_b and (i < j or k_a < k_b)")
    return pairs.select(*group, F.least("k_a", "k_b").alias("key_a"), F.greatest("k_a", "k_b").alias("key_b")).distinct()
