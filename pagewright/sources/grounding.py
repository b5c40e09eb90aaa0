"""Grounded OCR output: reference and detection tokens to nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as X

#: The tokens of the format.
SEGMENT = r"(?s)^(.*?)<\|/ref\|>.*?<\|det\|>\[\[(.*?)\]\]<\|/det\|>(.*)$"


def parse(pages: DataFrame, text: str = "raw_text") -> DataFrame:
    """Nodes of each page: page_id, w, h, node_index, ref, d0..d3 (0..999), text without blanks at its ends.

    Segments without four whole coordinates are skipped before nodes are numbered; pages without output give no row.
    """
    parts = F.split(F.col(text), r"<\|ref\|>")
    segments = pages.filter(F.col(text).isNotNull()).select("page_id", F.col("image_dims.w").alias("w"), F.col("image_dims.h").alias("h"), F.posexplode(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("n", "s"))
    det = F.transform(F.split(F.regexp_extract("s", SEGMENT, 2), ","), lambda x: F.trim(x).try_cast("int"))
    rows = segments.select("page_id", "w", "h", "n", F.regexp_extract("s", SEGMENT, 1).alias("ref"), det.alias("d"), X.strip(F.regexp_extract("s", SEGMENT, 3)).alias("text"))
    good = rows.filter((F.size("d") == 4) & ~F.exists("d", lambda x: x.isNull()))
    order = F.expr("row_number() over (partition by page_id order by n)") - 1
    return good.select("page_id", "w", "h", order.alias("node_index"), "ref", *[F.get("d", F.lit(i)).alias(f"d{i}") for i in range(4)], "text")
