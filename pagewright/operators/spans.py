"""Rules of the text layer: spans of lines of blocks to texts, with note marks, spacing and contents lines.

Input: doc_key, page, block_no, line_no, span_no, text, size, flags, font, x0, y0, x1, y1 (points).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators import stats

BLOCK = ["doc_key", "page", "block_no"]
# Parts of the names of symbol fonts.
SYMBOL_FONTS = ("symbol", "wingding", "dingbat", "ropesequencenumber")
CJK = "[一-鿿]"


def latin_only(text: Column) -> Column:
    return X.strip(text).rlike("^[A-Za-z\\s]+$")


def note_marks(spans: DataFrame, page_height: float = 842.0) -> DataFrame:
    """Adds is_mark and the text with note letters as circled numbers.

    A span of Latin letters is a mark if it is raised by its flag, is smaller and higher than its line, opens a block of
    Chinese text in the lowest 30 % of the page, or is set in a symbol font.
    """
    line, block = Window.partitionBy(*BLOCK, "line_no"), Window.partitionBy(*BLOCK)
    largest, bottom = F.max("size").over(line), F.max("y1").over(line)
    chinese = F.max(F.col("text").rlike(CJK).cast("int")).over(block) == 1
    first = F.row_number().over(block.orderBy("line_no", "span_no")) == 1
    raised = F.col("flags").bitwiseAND(1) == 1
    small = (F.col("size") < largest * 0.95) & (F.col("y1") < bottom - largest * 0.1)
    low = chinese & first & (F.col("y0") > page_height * 0.7)
    symbol = F.lower("font").rlike("|".join(SYMBOL_FONTS))
    mark = F.coalesce(latin_only(F.col("text")) & (raised | small | low | symbol), F.lit(False))
    return spans.withColumn("is_mark", mark).withColumn("text", F.when(F.col("is_mark"), X.footnote_letters(X.strip(F.col("text")))).otherwise(X.special_spaces(F.col("text"))))


def spaced(spans: DataFrame) -> DataFrame:
    """Puts a blank before a span that is no CJK text, behind another such span, with a gap of over a fifth of its size."""
    line = Window.partitionBy(*BLOCK, "line_no").orderBy("span_no")
    gap = F.col("x0") - F.lag("x1").over(line)
    foreign = ~F.col("text").rlike(CJK) & ~F.lag("text").over(line).rlike(CJK)
    return spans.withColumn("text", F.when(F.coalesce(foreign & (gap > F.col("size") * 0.2), F.lit(False)), F.concat(F.lit(" "), F.col("text"))).otherwise(F.col("text")))


def block_texts(spans: DataFrame, glue: str = "\n", page_height: float = 842.0) -> DataFrame:
    """Blocks: doc_key, page, block_no, text, max_size and the union box. Shadow lines are left out, contents lines end with CRLF."""
    s = spaced(note_marks(spans, page_height))
    per_line = s.groupBy(*BLOCK, "line_no").agg(F.array_sort(F.collect_list(F.struct("span_no", "text"))).alias("x"), F.min("y0").alias("ly"), F.max("size").alias("max_size"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    lines = per_line.withColumn("line", F.array_join(F.transform("x", lambda v: v["text"]), ""))
    lines = stats.first_lines(lines, BLOCK, "line", "ly", ["line_no"])
    contents = X.strip(F.col("line")).rlike(r"^[.。…\s]+[0-9]+$")
    lines = lines.withColumn("line", F.when(contents, F.concat("line", F.lit("\r\n"))).otherwise(F.col("line")))
    grouped = lines.groupBy(*BLOCK).agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"), F.max("max_size").alias("max_size"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return grouped.select(*BLOCK, X.strip(F.array_join(F.transform("l", lambda v: v["line"]), glue)).alias("text"), "max_size", "x0", "y0", "x1", "y1")


def find_tables(spans: DataFrame, least_rows: int = 2, least_columns: int = 2, gap: float = 12.0) -> DataFrame:
    """Tables set without rules: doc_key, page, x0, y0, x1, y1, cells (array of rows of texts).

    A line whose words leave gaps of more than ``gap`` points falls into cells; consecutive lines with as many cells, whose
    cells begin at the same places (within ``gap``), form a table. Works on each page by itself.
    """
    page = Window.partitionBy("doc_key", "page")
    flat = spans.filter(X.strip(F.col("text")) != "").withColumn("row_y", F.round(F.col("y0") / 3).cast("int"))
    inline = Window.partitionBy("doc_key", "page", "row_y").orderBy("x0", "span_no")
    cut = F.coalesce(F.col("x0") - F.max("x1").over(inline.rowsBetween(Window.unboundedPreceding, -1)) > gap, F.lit(True))
    celled = flat.withColumn("cell", F.sum(cut.cast("int")).over(inline))
    cells = celled.groupBy("doc_key", "page", "row_y", "cell").agg(F.array_sort(F.collect_list(F.struct("x0", "span_no", "text"))).alias("t"), *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])
    rows = cells.groupBy("doc_key", "page", "row_y").agg(F.array_sort(F.collect_list(F.struct("x0", F.array_join(F.transform("t", lambda v: X.strip(v["text"])), " ").alias("text")))).alias("c"), *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))]).withColumn("left", F.col("x0"))
    order = page.orderBy("row_y")
    n = F.size("c")
    same = F.coalesce((F.lag(n).over(order) == n) & F.forall(F.arrays_zip(F.transform("c", lambda v: v["x0"]).alias("a"), F.lag(F.transform("c", lambda v: v["x0"])).over(order).alias("b")), lambda z: F.abs(z["a"] - z["b"]) <= gap), F.lit(False))
    grouped = rows.withColumn("n", n).withColumn("table_no", F.sum((~same).cast("int")).over(order)).filter(F.col("n") >= least_columns)
    per = grouped.groupBy("doc_key", "page", "table_no").agg(F.array_sort(F.collect_list(F.struct("row_y", F.transform("c", lambda v: v["text"]).alias("texts")))).alias("r"), *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])
    return per.filter(F.size("r") >= least_rows).select("doc_key", "page", "x0", "y0", "x1", "y1", F.transform("r", lambda v: v["texts"]).alias("cells"))
