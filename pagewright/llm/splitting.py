"""Splitting oversized texts at natural boundaries.

Pieces cover the text in order. Each piece has at most ``limit`` characters including the ``overlap`` characters that it
repeats from the end of the piece before, so dropping the first ``overlap`` characters of every piece but the first and
joining gives the text back exactly.

Cuts are chosen by dynamic programming over boundary positions: the cost of a set of cuts is the sum of the cut penalties
(paragraph, line, sentence, clause, blank, none) plus the squared deviation of the pieces from equal size.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_left, bisect_right

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.tables import map_arrow

LIMIT, OVERLAP = 1024, 64

#: Kinds of boundary with their penalties; a cut lies after the match.
BOUNDARIES = (
    (0.0, regex.compile(r"\n[ \t]*\n\s*")),
    (1.0, regex.compile(r"\n")),
    (2.0, regex.compile(r"[。！？!?।…]+[”’」』）)»\"]*\s*|\.[”’)»\"]*\s+")),
    (6.0, regex.compile(r"[；;：:，,、]\s*")),
    (12.0, regex.compile(r"[^\S\n]+")),
)
#: Penalty of a cut that is no boundary, and weight of a piece's squared relative deviation from equal size.
HARD, BALANCE = 60.0, 8.0


def boundaries(text: str, gap: int) -> dict[int, float]:
    """Position -> penalty of the natural boundaries. Weaker kinds are taken only inside stretches longer than ``gap`` without a stronger one."""
    out: dict[int, float] = {}
    open_ = [(0, len(text))]
    for penalty, pattern in BOUNDARIES:
        rest = []
        for a, b in open_:
            last = a
            # positions and context are those of the whole text
            for m in pattern.finditer(text, a, b):
                at = m.end()
                if a < at < b and at not in out:
                    out[at] = penalty
                    if at - last > gap:
                        rest.append((last, at))
                    last = at
            if b - last > gap:
                rest.append((last, b))
        open_ = rest
    return out


def _joined(text: str, at: int) -> bool:
    """Whether a cut at ``at`` would part a base character from a mark or joiner."""
    return unicodedata.category(text[at])[0] == "M" or text[at] in "‌‍" or text[at - 1] == "‍"


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces, the overlap included. A text within the limit is one piece; an empty one has none.

    The minimum is taken over the boundaries of ``boundaries``: weaker kinds count only where stronger ones are further apart
    than a quarter of a piece, and a grid of positions only where none is within half a piece.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    n = len(text)
    if n == 0:
        return []
    if n <= limit:
        return [(0, n)]
    step = limit - overlap
    cost = boundaries(text, step // 4)
    # where the next boundary is further than half a piece, a grid of positions that keep characters whole may be cut
    marks = sorted(cost)
    stride = max(1, step // 32)
    for a, b in zip([0, *marks], [*marks, n]):
        if b - a > step // 2:
            for p in range(a + stride, b, stride):
                whole = next((q for q in range(p, max(a, p - stride), -1) if not _joined(text, q)), p)
                cost.setdefault(whole, HARD)
    at = [0, *sorted(cost), n]
    ideal = n / math.ceil((n - overlap) / step)
    best, back = [0.0] + [math.inf] * (len(at) - 1), [0] * len(at)
    for j in range(1, len(at)):
        e, own = at[j], cost.get(at[j], 0.0)
        # the first piece may use the whole limit, later ones give the overlap away
        for i in range(bisect_left(at, e - step if e > limit else 0), j):
            size = e - at[i] if at[i] == 0 else e - at[i] + overlap
            if size <= limit and (i == 0 or at[i] >= overlap):
                c = best[i] + own + BALANCE * ((e - at[i] - ideal) / ideal) ** 2
                if c < best[j]:
                    best[j], back[j] = c, i
    if math.isinf(best[-1]):
        # no way through the boundaries, as within a character of more marks than a piece: characters stay whole where they can
        cuts, e = [], limit
        while e < n:
            whole = next((q for q in range(e, max(cuts[-1] if cuts else 0, e - step // 2), -1) if not _joined(text, q)), e)
            cuts.append(whole)
            e = whole + step
    else:
        cuts, j = [], back[-1]
        while j:
            cuts.append(at[j])
            j = back[j]
        cuts.reverse()
    return [(max(0, a - overlap) if a else 0, b) for a, b in zip([0, *cuts], [*cuts, n])]


def pieces(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of the texts over the limit: key, piece_no, n_pieces, start_pos, end_pos, piece.

    Texts within the limit (empty and null ones too) give no row here; they stay as they are. A row delivered twice
    counts once, other columns are ignored, so names can't clash.
    """
    long = df.filter(F.length(text) > limit).select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = df.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(i, no, len(cut), a, b, t[a:b]) for i, t in enumerate(batch.column(1).to_pylist()) for cut in [split(t, limit, overlap)] for no, (a, b) in enumerate(cut)]
        c = list(zip(*rows))
        ints = [pa.array(c[i], pa.int64()) for i in range(1, 5)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(c[0])), *ints, pa.array(c[5], pa.string())], names=["k", "piece_no", "n_pieces", "start_pos", "end_pos", "piece"])

    out = map_arrow(long, run, f"k {kind}, piece_no bigint, n_pieces bigint, start_pos bigint, end_pos bigint, piece string")
    return out.dropDuplicates(["k", "piece_no", "piece"]).withColumnRenamed("k", key)


def oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Keys whose text had to be cut."""
    return pieces(df, key, text, limit, overlap).filter("piece_no = 1").select(key).distinct()
