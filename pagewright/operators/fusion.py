"""Text fusion: the blanks and breaks of one reading with the characters of another."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import text as X
from pagewright.operators import joins as J


def fuse(layout: str | None, characters: str | None, autojunk: bool = True) -> str:
    """The blanks of ``layout`` with the characters of ``characters``, aligned by longest common runs.

    Each printed character of the layout is a slot. An equal run fills its slots one to one; a replaced run fills them in
    order and puts what is left over into its last slot; characters that the layout lacks go before the slot that
    follows; slots without a counterpart stay empty. Null counts as ''.
    """
    layout, characters = layout or "", characters or ""
    own = [c for c in layout if not c.isspace()]
    new = [c for c in characters if not c.isspace()]
    slots, before, tail = [""] * len(own), [""] * len(own), ""
    for tag, a, b, c, d in difflib.SequenceMatcher(None, own, new, autojunk=autojunk).get_opcodes():
        if tag == "insert":
            if a < len(own):
                before[a] += "".join(new[c:d])
            else:
                tail += "".join(new[c:d])
        elif tag != "delete":
            for k in range(a, b):
                slots[k] = new[c + k - a] if c + k - a < d else ""
            if d - c > b - a:
                slots[b - 1] += "".join(new[c + b - a : d])
    out, i = [], 0
    for ch in layout:
        if ch.isspace():
            out.append(ch)
        else:
            out.append(before[i] + slots[i])
            i += 1
    return "".join(out) + tail


def fused(layout: Column, characters: Column, autojunk: bool = True) -> Column:
    """``fuse`` over Arrow batches."""

    @F.pandas_udf("string")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([fuse(x, y, autojunk) for x, y in zip(a, b)], dtype=object)

    return run(layout, characters)


def filled(layout: Column, characters: Column) -> Column:
    """Positional fill without alignment: runs of printed characters take the next characters of the other reading.

    Surplus layout characters stay, surplus characters are put at the end. Built-in functions only: the text is cut into
    runs, and each run's place is a sum over the runs before it.
    """
    source = F.regexp_replace(F.coalesce(characters, F.lit("")), X.BLANK, "")
    not_blank = X.BLANK.replace("[", "[^", 1)
    runs = F.regexp_extract_all(F.coalesce(layout, F.lit("")), F.lit(f"({X.BLANK}+|{not_blank}+)"), F.lit(1))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, run: Column) -> Column:
        n = F.length(run)
        piece = F.substr(source, acc["at"] + 1, n)
        new = F.concat(piece, F.substr(run, F.length(piece) + 1))
        blank = run.rlike(f"^{X.BLANK}")
        return F.struct(F.when(blank, acc["at"]).otherwise(acc["at"] + n).alias("at"), F.concat(acc["out"], F.when(blank, run).otherwise(new)).alias("out"))

    done = F.aggregate(runs, start, step)
    return F.concat(done["out"], F.substr(source, done["at"] + 1))


def fuse_pages(boxes: DataFrame, layer: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Boxes with their text fused with the text layer: box_key, n_blocks, text.

    Tables keep their own HTML; boxes without a text-layer block keep their text, or the grounded segment's
    (``fallback``: page_id, box_no, text) if they have none.
    """
    found = boxes.join(J.spatial_text(boxes, layer).withColumnRenamed("text", "layer_text"), "box_key")
    if fallback is not None:
        found = found.join(fallback.withColumnRenamed("text", "raw"), ["page_id", "box_no"], "left")
    else:
        found = found.withColumn("raw", F.lit(None).cast("string"))
    own = F.coalesce(F.nullif("text", F.lit("")), "raw", F.lit(""))
    keep = F.contains("text", F.lit("<table>")) | (F.col("layer_text") == "")
    return found.select("box_key", "n_blocks", F.when(keep, own).otherwise(fused(own, F.col("layer_text"))).alias("text"))


# Fixed value: how a grounded segment that is a table begins.
TABLE_SEGMENT = "<table><tr><td>"


def staged_text(label: Column, text: Column, raw: Column, fuse_texts: bool = True) -> Column:
    """A box's text fused with its grounded segment ``raw``: the segment where the box has none; a heading sign by label; '' with
    a break for images; special spaces as blanks; layout of the segment with the characters of the box; tables as the segment."""
    own = F.coalesce(text, F.lit(""))
    signed = F.when(own == "", raw).when(label == "title", F.concat(F.lit("\r\n#"), own)).when(label == "sub_title", F.concat(F.lit("\r\n##"), own)).when(label == "image", "\r\n").otherwise(own)
    plain = X.special_spaces(signed)
    merged = fused(raw, plain) if fuse_texts else plain
    return F.when(F.contains(raw, F.lit(TABLE_SEGMENT)), raw).otherwise(merged)


def stage_boxes(boxes: DataFrame, nodes: DataFrame, fuse_texts: bool = True) -> DataFrame:
    """Boxes with the text of the box stage: page_id, box_no, label, text. The first box with the coordinates of a segment is
    changed, by the last of several segments that have them; others keep their text."""
    scaled = nodes.select("page_id", "node_index", F.col("text").alias("raw"), *[G.det_to_pixel(F.col(c), F.col(s)).alias(n) for c, s, n in (("d0", "w", "x0"), ("d1", "h", "y0"), ("d2", "w", "x1"), ("d3", "h", "y1"))])
    at = ["page_id", "x0", "y0", "x1", "y1"]
    first = boxes.groupBy(*at).agg(F.min("box_no").alias("box_no"))
    last = scaled.groupBy(*at).agg(F.max_by("raw", "node_index").alias("raw"))
    found = first.join(last, at).select("page_id", "box_no", "raw")
    joined = boxes.join(found, ["page_id", "box_no"], "left")
    return joined.select("page_id", "box_no", "label", F.when(F.col("raw").isNull(), F.col("text")).otherwise(staged_text(F.col("label"), F.col("text"), F.col("raw"), fuse_texts=fuse_texts)).alias("text"))


def stage_nodes(boxes: DataFrame, nodes: DataFrame, fuse_texts: bool = True) -> DataFrame:
    """Nodes of the node stage: page_id, node_index, ref, x0..y1, text_len, text. A segment takes the text of the last box with
    its coordinates; one without such a box has the text ''."""
    scaled = nodes.select("page_id", "node_index", "ref", F.col("text").alias("raw"), *[G.det_to_pixel(F.col(c), F.col(s)).alias(n) for c, s, n in (("d0", "w", "x0"), ("d1", "h", "y0"), ("d2", "w", "x1"), ("d3", "h", "y1"))])
    at = ["page_id", "x0", "y0", "x1", "y1"]
    last = boxes.groupBy(*at).agg(F.max_by(F.struct("label", "text"), "box_no").alias("b"))
    text = F.when(F.col("b").isNull(), "").otherwise(staged_text(F.col("b.label"), F.col("b.text"), F.col("raw"), fuse_texts=fuse_texts))
    return scaled.join(last, at, "left").withColumn("text", text).select("page_id", "node_index", "ref", "x0", "y0", "x1", "y1", F.length("text").alias("text_len"), "text")
