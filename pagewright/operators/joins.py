"""Joins of layouts: exact boxes, spatial containment, overlap, search context, work lists.

Spatial joins are equi-joins on book and page with the geometry as a residual condition, so that they stay hash joins; a
page is the unit, whatever the size of its book.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import text as X
from pagewright.operators.deliveries import latest

#: Pixels a point at the zoom at which pages are rastered.
ZOOM = 2.0


def mapping_blocks(rows: DataFrame, zoom: float = ZOOM) -> DataFrame:
    """Text-layer blocks in pixels; rows without a box are left out, rows delivered twice count once."""
    once = latest(rows, "map_id", "mapped_at").filter(F.size("bbox") == 4)
    c = [(G.coordinate(F.col("bbox"), i) * zoom).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return once.select("map_id", "doc_key", "page", "md_line_index", *c, "text")


def spatial_text(boxes: DataFrame, layer: DataFrame, margin: float = 5.0) -> DataFrame:
    """Every box with the texts whose centre lies in it, in the layer's order; '' where there is none."""
    m = layer.select("doc_key", "page", "md_line_index", "map_id", F.col("x0").alias("lx0"), F.col("y0").alias("ly0"), F.col("x1").alias("lx1"), F.col("y1").alias("ly1"), F.col("text").alias("lt"))
    b = boxes.select("doc_key", "page", "box_key", "x0", "y0", "x1", "y1")
    inside = G.centre_in(F.col("lx0"), F.col("ly0"), F.col("lx1"), F.col("ly1"), F.col("x0") - margin, F.col("y0") - margin, F.col("x1") + margin, F.col("y1") + margin)
    found = b.join(m, ["doc_key", "page"]).filter(inside).groupBy("box_key").agg(F.count(F.lit(1)).alias("n_blocks"), F.array_sort(F.collect_list(F.struct("md_line_index", "map_id", "lt"))).alias("n"))
    named = found.select("box_key", "n_blocks", F.array_join(F.transform("n", lambda x: x["lt"]), "\n").alias("text"))
    return boxes.select("box_key").join(named, "box_key", "left").select("box_key", F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"), F.coalesce("text", F.lit("")).alias("text"))


def match_boxes(nodes: DataFrame, boxes: DataFrame, last: bool = False) -> DataFrame:
    """Boxes with the grounded segment whose scaled coordinates equal theirs, the first of several (or the last): page_id, box_no, node_index."""
    scaled = nodes.select("page_id", "node_index", *[G.det_to_pixel(F.col(c), F.col(s)).alias(n) for c, s, n in (("d0", "w", "x0"), ("d1", "h", "y0"), ("d2", "w", "x1"), ("d3", "h", "y1"))])
    return boxes.join(scaled, ["page_id", "x0", "y0", "x1", "y1"]).groupBy("page_id", "box_no").agg((F.max if last else F.min)("node_index").alias("node_index"))


def match_tokens(nodes: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxes with the text of the first grounded segment that has the box's own numbers as its tokens: page_id, box_no, text.

    Pixels are compared with the 0..999 grid, as the token itself would be searched, so that few boxes match.
    """
    raw = nodes.select("page_id", "node_index", "text", *[F.col(f"d{i}").alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])
    found = boxes.select("page_id", "box_no", "x0", "y0", "x1", "y1").join(raw, ["page_id", "x0", "y0", "x1", "y1"])
    return found.groupBy("page_id", "box_no").agg(F.min_by("text", "node_index").alias("text"))


def refill(chunks: DataFrame, layer: DataFrame, grid: int = 1024) -> DataFrame:
    """Text of each chunk group from the layer: chunk_id, group_no, n_blocks, text, by node, then top, then left."""
    c = latest(chunks, "chunk_id", "processed_at")
    g = c.select("chunk_id", "doc_key", "pages", "image_dims", F.posexplode("boxs").alias("group_no", "gb"))
    n = g.select("chunk_id", "doc_key", "group_no", F.get("pages", "group_no").alias("pp"), F.get("image_dims", "group_no").alias("dd"), F.posexplode("gb").alias("node_no", "b"))
    at = lambda i: F.get("b", F.lit(i))
    q = n.filter(F.size("b") == 4).select("chunk_id", "group_no", "node_no", "doc_key", F.get("pp", "node_no").try_cast("int").alias("page"), at(0).alias("gx0"), at(1).alias("gy0"), at(2).alias("gx1"), at(3).alias("gy1"), F.get("dd", "node_no")["w"].alias("w"), F.get("dd", "node_no")["h"].alias("h"))
    cx, cy = (F.col("x0") + F.col("x1")) / 2 * float(grid) / F.col("w"), (F.col("y0") + F.col("y1")) / 2 * float(grid) / F.col("h")
    found = q.join(layer, ["doc_key", "page"]).filter(cx.between(F.col("gx0"), F.col("gx1")) & cy.between(F.col("gy0"), F.col("gy1")))
    grouped = found.groupBy("chunk_id", "group_no").agg(F.count(F.lit(1)).alias("n_blocks"), F.array_sort(F.collect_list(F.struct("node_no", "y0", "x0", "map_id", "text"))).alias("n"))
    return grouped.select("chunk_id", F.col("group_no").cast("bigint").alias("group_no"), "n_blocks", F.array_join(F.transform("n", lambda x: x["text"]), "\n").alias("text"))


def search(rows: DataFrame, boxes: DataFrame, query: str, margin: float = 5.0) -> DataFrame:
    """Hits of a query in the text layer, with the first box that holds them vertically as context, else the query."""
    hits = mapping_blocks(rows).filter(F.contains(F.lower("text"), F.lower(F.lit(query)))).select("map_id", "doc_key", "page", "x0", "y0", "x1", "y1")
    b = boxes.filter("text <> ''").select("doc_key", "page", "box_no", F.col("y0").alias("by0"), F.col("y1").alias("by1"), F.col("text").alias("bt"))
    inside = (F.col("y0") >= F.col("by0") - margin) & (F.col("y1") <= F.col("by1") + margin)
    first = hits.join(b, ["doc_key", "page"]).filter(inside).groupBy("map_id").agg(F.min_by("bt", "box_no").alias("bt"))
    text = F.replace(X.strip(F.col("bt")), F.lit("\n"), F.lit(" "))
    return hits.join(first, "map_id", "left").select("map_id", "page", "x0", "y0", "x1", "y1", F.coalesce(F.nullif(text, F.lit("")), F.lit(query)).alias("text"), F.lit(query).alias("query"))


def region(layer: DataFrame, clip: tuple[float, float, float, float]) -> DataFrame:
    """Texts of each page that meet a rectangle, in order."""
    x0, y0, x1, y1 = clip
    inside = layer.filter((F.col("x0") < x1) & (F.col("x1") > x0) & (F.col("y0") < y1) & (F.col("y1") > y0))
    grouped = inside.groupBy("doc_key", "page").agg(F.array_sort(F.collect_list(F.struct("md_line_index", "map_id", "text"))).alias("n"))
    return grouped.select("doc_key", "page", F.array_join(F.transform("n", lambda x: x["text"]), "\n").alias("text"))


def without_tables(boxes: DataFrame) -> DataFrame:
    """Blocks that no table of their page covers by more than half."""
    tables = boxes.filter("label = 'table'").select(F.col("page_id").alias("pid"), *[F.col(c).alias(f"t{c}") for c in ("x0", "y0", "x1", "y1")])
    c = [F.col(x) for x in ("x0", "y0", "x1", "y1", "tx0", "ty0", "tx1", "ty1")]
    rest = boxes.filter("label <> 'table' and x0 is not null and x1 is not null")
    return rest.join(tables, (F.col("page_id") == F.col("pid")) & G.mostly_inside(*c), "left_anti")


def pending(work: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Work that isn't done."""
    return work.join(done.select(*key).distinct(), key, "left_anti")


def pages_with_text_layer(pages: DataFrame, layer: DataFrame, how: str = "left") -> DataFrame:
    """Pages with the number of their text-layer blocks; 'inner' leaves pages without a layer out."""
    counts = layer.groupBy("doc_key", "page").agg(F.count(F.lit(1)).alias("n"))
    return pages.join(counts, ["doc_key", "page"], how).select("page_id", "doc_key", "page", F.coalesce("n", F.lit(0)).alias("n_blocks"))


def footnotes(paragraphs: DataFrame, notes: DataFrame) -> DataFrame:
    """Paragraphs (id, refs array<string>) with their notes (note_id, note) as "id: text", in order of reference."""
    refs = paragraphs.select("id", F.posexplode("refs").alias("n", "note_id")).join(notes.dropDuplicates(["note_id"]), "note_id")
    joined = refs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", F.concat_ws(": ", "note_id", "note").alias("t")))).alias("x"))
    return joined.select("id", F.transform("x", lambda x: x["t"]).alias("footnotes"))


def first_per_key(df: DataFrame, key: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
