"""Layout operators: blocks of pages, paragraph merges within and across pages, packing, reading order.

Order is explicit: a block is addressed by (page_id, box_no), a document is read by (page, box_no). Merges whose condition
looks only at neighbours are gaps-and-islands over light rows (flags, no texts), so that the window of a document with a
third of all pages moves little; texts are gathered afterwards by island, which spreads evenly.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import text as X
from pagewright.operators.deliveries import latest

TEXT_LABELS = ("text", "sub_title", "title")


def blocks(pages: DataFrame) -> DataFrame:
    """One row per box of the pages that have boxes; of a page delivered again the latest delivery counts."""
    once = latest(pages, "page_id", "ingested_at")
    rows = once.select("page_id", "doc_key", "page", F.col("image_dims.w").alias("w"), F.col("image_dims.h").alias("h"), F.posexplode("boxes").alias("box_no", "b"))
    c = [G.coordinate(F.col("b.box"), i).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return rows.select("page_id", "doc_key", "page", "box_no", (F.col("page_id") * 100 + F.col("box_no")).alias("box_key"), "w", "h", F.coalesce("b.label", F.lit("")).alias("label"), *c, F.coalesce("b.text_content", F.lit("")).alias("text"))


def without_texts(b: DataFrame, texts: list[str]) -> DataFrame:
    """Blocks whose text is none of the given ones (texts that an OCR model is known to make up)."""
    return b.filter(~F.col("text").isin(texts)) if texts else b


def _kept(b: DataFrame) -> DataFrame:
    return b.withColumn("is_text", F.col("label").isin(*TEXT_LABELS)).filter(~F.col("is_text") | (X.strip(F.col("text")) != ""))


def page_islands(b: DataFrame, plain: bool = False) -> DataFrame:
    """Text blocks with the head box of their paragraph within the page: page_id, box_no, head_no.

    A block goes on with the paragraph before it if that was cut off and the two are in different columns, at the foot of
    the page, or parted by something that is no text; both must be labelled text unless ``plain``.
    """
    light = _kept(b).select("page_id", "box_no", "label", "is_text", "x0", "y1", "w", "h", X.cut_off(F.col("text")).alias("cut"))
    order = Window.partitionBy("page_id").orderBy("box_no")
    apart = light.withColumn("others", F.sum((~F.col("is_text")).cast("int")).over(order)).filter("is_text")
    lag = lambda c: F.lag(c).over(order)
    across = F.abs(F.coalesce(lag("x0"), F.lit(0)) - F.coalesce("x0", F.lit(0))) > F.coalesce("w", F.lit(1024)) * 0.05
    foot = F.coalesce(lag("y1"), F.lit(0)) > F.coalesce("h", F.lit(1024)) * 0.85
    parted = F.col("others") > lag("others")
    same = F.lit(True) if plain else (F.col("label") == "text") & (lag("label") == "text")
    joins = F.coalesce(same & lag("cut") & (across | foot | parted), F.lit(False))
    marked = apart.withColumn("head", F.when(~joins, F.col("box_no")))
    return marked.select("page_id", "box_no", F.last("head", True).over(order).alias("head_no"))


def document_islands(b: DataFrame, plain: bool = False, others: bool = False) -> DataFrame:
    """Text blocks with the head of their paragraph within the document: page_id, box_no, head_page_id, head_no.

    With ``others``, blocks that are no text are rows too, each its own head.
    """
    light = (_kept(b) if others else _kept(b).filter("is_text")).select("doc_key", "page", "page_id", "box_no", "label", "is_text", X.cut_off(F.col("text")).alias("cut"))
    return _with_heads(light, plain).select("page_id", "box_no", F.col("head.page_id").alias("head_page_id"), F.col("head.box_no").alias("head_no"))


def _with_heads(light: DataFrame, plain: bool) -> DataFrame:
    """Adds head (page, page_id, box_no of the block that a block's paragraph begins with)."""
    order = Window.partitionBy("doc_key", "is_text").orderBy("page", "page_id", "box_no")
    same = F.lit(True) if plain else (F.col("label") == "text") & (F.lag("label").over(order) == "text")
    joins = F.coalesce(F.col("is_text") & same & F.lag("cut").over(order), F.lit(False))
    marked = light.withColumn("head", F.when(~joins, F.struct("page", "page_id", "box_no")))
    return marked.withColumn("head", F.last("head", True).over(order))


def paragraphs(b: DataFrame, islands: DataFrame) -> DataFrame:
    """Paragraphs of document islands: doc_key, head_page, head_page_id, head_no, label, n_nodes, content and nodes.

    nodes (array of structs) gathers page, box_no, text, box, size and label of each block in order.
    """
    joined = b.join(islands, ["page_id", "box_no"])
    node = F.struct("page", "page_id", "box_no", X.label_prefix(F.col("label"), F.col("text")).alias("t"), F.array("x0", "y0", "x1", "y1").alias("box"), "w", "h", "label")
    grouped = joined.groupBy("doc_key", "head_page_id", "head_no").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    return grouped.select("doc_key", F.get("nodes", F.lit(0))["page"].alias("head_page"), "head_page_id", "head_no", F.get("nodes", F.lit(0))["label"].alias("label"), F.size("nodes").alias("n_nodes"), F.array_join(F.transform("nodes", lambda n: n["t"]), "\n").alias("content"), "nodes")


def items(b: DataFrame, plain: bool = False) -> DataFrame:
    """The document's output items in order: merged paragraphs, and blocks that are no text as they are."""
    joined = b.join(document_islands(b, plain, others=True), ["page_id", "box_no"])
    node = F.struct("page", "page_id", "box_no", X.label_prefix(F.col("label"), F.col("text")).alias("t"))
    grouped = joined.groupBy("doc_key", "head_page_id", "head_no").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    return grouped.select("doc_key", F.get("nodes", F.lit(0))["page"].alias("page"), F.col("head_page_id").alias("page_id"), F.col("head_no").alias("box_no"), F.size("nodes").alias("n_nodes"), F.array_join(F.transform("nodes", lambda n: n["t"]), "\n").alias("content"))


def pack_lengths(lengths: list[int], limit: int, glue: int) -> list[int]:
    """Container of each item, greedily and in order: an item joins while the length, glue included, stays within the limit."""
    out, at, used = [], -1, None
    for n in lengths:
        if used is not None and used + glue * (used > 0) + n <= limit:
            used += glue * (used > 0) + n
        else:
            at, used = at + 1, n
        out.append(at)
    return out


def pack(rows: DataFrame, limit: int = 1024, glue: int = 1) -> DataFrame:
    """Size-bounded chunks of a document's items: adds section, chunk_no (unique within the document's section).

    Headings open a chunk and tables stand alone; both cut the document into sections that are packed independently. Lengths
    alone, about 40 bytes an item, are sorted by document and packed as they stream by, in the memory of one batch whatever the
    length of a section or document; texts join their chunk afterwards.
    """
    is_table = F.col("content").contains("<table>")
    light = rows.select("doc_key", "page", "page_id", "box_no", F.length("content").alias("n"), (is_table | F.col("content").startswith("#")).alias("opens"), is_table.alias("alone"))
    return rows.join(_packed(light, limit, glue), ["page_id", "box_no"])


def _packed(light: DataFrame, limit: int, glue: int) -> DataFrame:
    """page_id, box_no, section, chunk_no of items given by place, length n, opens and alone."""
    ordered = light.repartition("doc_key").sortWithinPartitions("doc_key", "page", "page_id", "box_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, section, chunk, used, closed = None, 0, -1, None, False
        begun = False
        for batch in batches:
            sections, chunks_ = [], []
            for d, n, o, alone in zip(*(batch.column(i).to_pylist() for i in (0, 4, 5, 6))):
                if not begun or d != doc:
                    begun, doc, section, used, closed = True, d, 0, None, False
                if o or closed:
                    section, used = section + 1, None
                if used is None:
                    chunk, used = 0, n
                elif used + glue * (used > 0) + n <= limit:
                    used += glue * (used > 0) + n
                else:
                    chunk, used = chunk + 1, n
                closed = alone
                sections.append(section)
                chunks_.append(chunk)
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(sections, pa.int64()), pa.array(chunks_, pa.int64())], names=["page_id", "box_no", "section", "chunk_no"])

    return ordered.mapInArrow(run, "page_id bigint, box_no int, section bigint, chunk_no bigint")


def packed_chunks(b: DataFrame, plain: bool = False, limit: int = 1024, glue: int = 1) -> DataFrame:
    """``chunks(pack(items(b)))`` without gathering paragraphs first: what packing needs to know of a paragraph (its length,
    whether it is a heading or holds a table) is summed up over flags and lengths of its blocks, and each text moves to its
    place once and to its chunk once."""
    t = X.label_prefix(F.col("label"), F.col("text"))
    light = _kept(b).select("doc_key", "page", "page_id", "box_no", "label", "is_text", X.cut_off(F.col("text")).alias("cut"), F.length(t).alias("n"), t.startswith("#").alias("sign"), t.contains("<table>").alias("alone"))
    found = _with_heads(light, plain)
    own = (F.col("page_id") == F.col("head.page_id")) & (F.col("box_no") == F.col("head.box_no"))
    heads = found.groupBy("doc_key", "head").agg((F.sum("n") + F.count(F.lit(1)) - 1).alias("n"), F.max("alone").alias("alone"), F.max(own & F.col("sign")).alias("sign"))
    packed = _packed(heads.select("doc_key", "head.page", "head.page_id", "head.box_no", F.col("n").cast("int").alias("n"), (F.col("alone") | F.col("sign")).alias("opens"), "alone"), limit, glue)
    placed = found.select("page_id", "box_no", "head").join(packed.select(F.struct("page_id", "box_no").alias("at"), "section", "chunk_no"), F.struct("head.page_id", "head.box_no") == F.col("at")).select("page_id", "box_no", "head", "section", "chunk_no")
    texts = _kept(b).select("doc_key", "page", "page_id", "box_no", t.alias("t"))
    node = F.struct("head", "page", "page_id", "box_no", "t")
    grouped = texts.join(placed, ["page_id", "box_no"]).groupBy("doc_key", "section", "chunk_no").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    # an empty item before another adds no break
    text = F.expr("aggregate(nodes, '', (acc, x) -> if(acc = '', x.t, concat(acc, '\n', x.t)))")
    n_items = F.size(F.array_distinct(F.transform("nodes", lambda x: x["head"])))
    return grouped.select("doc_key", "section", "chunk_no", F.get("nodes", F.lit(0))["head"]["page"].alias("page"), n_items.alias("n_items"), text.alias("content"))


def chunks(packed: DataFrame) -> DataFrame:
    """Packed items as chunks: doc_key, section, chunk_no, page (the first), n_items, content."""
    node = F.struct("page", "page_id", "box_no", "content")
    grouped = packed.groupBy("doc_key", "section", "chunk_no").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    # an empty item before another adds no break
    text = F.expr("aggregate(nodes, '', (acc, x) -> if(acc = '', x.content, concat(acc, '\n', x.content)))")
    return grouped.select("doc_key", "section", "chunk_no", F.get("nodes", F.lit(0))["page"].alias("page"), F.size("nodes").alias("n_items"), text.alias("content"))


def boxed_merge(pages: DataFrame) -> DataFrame:
    """In-page merge that keeps a union box and no glue: page_id, head_no, n_boxes, box, content, lens.

    The condition looks at the box and text merged so far, so each page is folded in order inside its own row. A title
    (by label or by form) ends the paragraph before it; the text takes breaks behind the page numbers of contents lines.
    """
    once = latest(pages, "page_id", "ingested_at").filter("boxes is not null")
    w, h = F.coalesce("image_dims.w", F.lit(1024)), F.coalesce("image_dims.h", F.lit(1024))
    node = F.transform(
        "boxes",
        lambda b, i: F.struct(i.alias("no"), F.coalesce(b["label"], F.lit("")).alias("label"), b["box"].alias("box"), X.contents_breaks(X.strip(F.coalesce(b["text_content"], F.lit("")))).alias("t")),
    )
    light = once.select("page_id", w.alias("w"), h.alias("h"), node.alias("nodes"))
    light = light.withColumn("nodes", F.filter("nodes", lambda n: ~n["label"].isin("text", "sub_title") | (n["t"] != "")))
    group = "array<struct<no:int,box:array<int>,t:string,lens:array<int>>>"
    start = F.struct(F.expr(f"cast(array() as {group})").alias("done"), F.expr("cast(null as struct<no:int,box:array<int>,t:string,lens:array<int>>)").alias("cur"), F.lit(False).alias("parted"))

    def step(acc: Column, n: Column) -> Column:
        is_text = n["label"].isin("text", "sub_title")
        cur, box = acc["cur"], lambda b, i: F.coalesce(F.get(b, F.lit(i)), F.lit(0))
        across = F.abs(box(cur["box"], 0) - box(n["box"], 0)) > F.col("w") * 0.05
        foot = box(cur["box"], 3) > F.col("h") * 0.85
        joins = cur.isNotNull() & X.cut_off(cur["t"]) & ~X.is_title_format(cur["t"]) & ~X.is_title_format(n["t"]) & (across | foot | acc["parted"])
        union = F.array(F.least(box(cur["box"], 0), box(n["box"], 0)), F.least(box(cur["box"], 1), box(n["box"], 1)), F.greatest(box(cur["box"], 2), box(n["box"], 2)), F.greatest(box(cur["box"], 3), box(n["box"], 3)))
        merged = F.struct(cur["no"].alias("no"), union.alias("box"), F.concat(cur["t"], n["t"]).alias("t"), F.concat(cur["lens"], F.array(F.length(n["t"]))).alias("lens"))
        fresh = F.struct(n["no"].alias("no"), n["box"].alias("box"), n["t"].alias("t"), F.array(F.length(n["t"])).alias("lens"))
        flushed = F.when(cur.isNotNull(), F.concat(acc["done"], F.array(cur))).otherwise(acc["done"])
        none = start["cur"]
        on_text = F.when(joins, F.struct(acc["done"].alias("done"), merged.alias("cur"), F.lit(False).alias("parted"))).otherwise(F.struct(flushed.alias("done"), fresh.alias("cur"), F.lit(False).alias("parted")))
        on_title = F.struct(flushed.alias("done"), none.alias("cur"), F.lit(False).alias("parted"))
        on_other = F.struct(acc["done"].alias("done"), cur.alias("cur"), F.lit(True).alias("parted"))
        return F.when(is_text, on_text).when(n["label"] == "title", on_title).otherwise(on_other)

    folded = light.withColumn("f", F.aggregate("nodes", start, step))
    out = folded.select("page_id", F.explode(F.when(F.col("f.cur").isNotNull(), F.concat("f.done", F.array("f.cur"))).otherwise(F.col("f.done"))).alias("g"))
    return out.select("page_id", F.col("g.no").alias("head_no"), F.size("g.lens").alias("n_boxes"), F.col("g.box").alias("box"), F.col("g.t").alias("content"), F.col("g.lens").alias("lens"))


def page_texts(b: DataFrame) -> DataFrame:
    """Text of each page: doc_key, page, page_id, n_nodes, page_text_len, box_text (non-empty box texts by line)."""
    grouped = b.groupBy("doc_key", "page", "page_id").agg(F.array_sort(F.collect_list(F.struct("box_no", "text"))).alias("n"))
    text = F.array_join(F.filter(F.transform("n", lambda x: x["text"]), lambda t: t != ""), "\n")
    return grouped.select("doc_key", "page", "page_id", F.size("n").alias("n_nodes"), F.length(text).alias("page_text_len"), text.alias("box_text"))


def page_merge(texts: DataFrame) -> DataFrame:
    """Pages whose text goes on over the page break: doc_key, head_page_id, first_page, n_pages, text_len.

    Whether a page joins depends on the last line of all text merged so far, which differs from that of the page before
    only if that page is a single line: then its line continues the merged one. Along such pages, a line of more than six
    characters anywhere since the last page of several lines makes every later one join.
    """
    order = Window.partitionBy("doc_key").orderBy("page", "page_id")
    light = texts.select("doc_key", "page", "page_id", X.first_line(F.col("box_text")).alias("first"), X.last_line(F.col("box_text")).alias("last"), F.col("page_text_len").alias("n"), F.size(F.filter(F.split("box_text", "\n"), lambda x: X.strip(x) != "")).alias("k"))
    flags = light.select("doc_key", "page", "page_id", "n", (F.col("k") > 1).alias("multi"), F.col("first").isNotNull().alias("any"), F.coalesce(X.is_title(F.col("first")), F.lit(False)).alias("title"), F.coalesce(X.ends_sentence(F.col("last")), F.lit(False)).alias("ended"), F.coalesce(F.length("last"), F.lit(0)).alias("line"))
    # a page can't join if it or the page before has no text, it is a title, or the page before ended
    free = F.col("any") & F.lag("any").over(order) & ~F.col("title") & ~F.lag("ended").over(order)
    flags = flags.withColumn("free", F.coalesce(free, F.lit(False)))
    runs = flags.withColumn("run", F.sum((F.col("multi") | ~F.col("free")).cast("int")).over(order))
    longest = F.max("line").over(Window.partitionBy("doc_key", "run").orderBy("page", "page_id"))
    joined = runs.withColumn("long", longest).withColumn("joins", F.col("free") & (F.lag("long").over(order) > 6))
    marked = joined.withColumn("head", F.when(~F.coalesce("joins", F.lit(False)), F.struct("page_id", "page"))).withColumn("head", F.last("head", True).over(order))
    return marked.groupBy("doc_key", F.col("head.page_id").alias("head_page_id"), F.col("head.page").alias("first_page")).agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("text_len"))


def boundary_pairs(b: DataFrame) -> DataFrame:
    """Last node of a page merged with the first of the next, pairs never chaining: page_id, box_no, next_page_id, next_no."""
    light = b.select("doc_key", "page", "page_id", "box_no", F.col("text").startswith("#").alias("mark"), X.first_line(F.col("text")).alias("first"), X.last_line(F.col("text")).alias("last"))
    order = Window.partitionBy("doc_key").orderBy("page", "page_id", "box_no")
    lead = lambda c: F.lead(c).over(order)
    edge = F.coalesce((lead("page_id") != F.col("page_id")) & X.may_join(F.col("last"), lead("first")), F.lit(False))
    # of consecutive edges every other one is taken
    edges = light.select("doc_key", "page", "page_id", "box_no", edge.alias("edge"), lead("page_id").alias("next_page_id"), lead("box_no").alias("next_no"))
    runs = edges.withColumn("run", F.sum((~F.col("edge")).cast("int")).over(order)).filter("edge")
    nth = F.row_number().over(Window.partitionBy("doc_key", "run").orderBy("page", "page_id", "box_no"))
    return runs.withColumn("nth", nth).filter("nth % 2 = 1").select("doc_key", "page_id", "box_no", "next_page_id", "next_no")


def reading_order(b: DataFrame, full: float = 0.75, gutter: float = 0.15) -> DataFrame:
    """Column-aware order: page_id, box_no, segment, column_no, order_no.

    Blocks wider than ``full`` of the page part it into segments; inside a segment, blocks are put into columns wherever
    the next centre is further than ``gutter`` of the page; columns are read one after the other, each from the top.
    """
    c = b.filter("x0 is not null and y0 is not null and x1 is not null").select("page_id", "box_no", "y0", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("x1") - F.col("x0")) > F.coalesce("w", F.lit(1024)) * full).alias("wide"), F.coalesce("w", F.lit(1024)).alias("w"))
    down = Window.partitionBy("page_id").orderBy("y0", "box_no")
    seg = c.withColumn("n_wide", F.sum(F.col("wide").cast("int")).over(down)).withColumn("segment", F.col("n_wide") * 2 - F.when(F.col("wide"), 1).otherwise(0))
    right = Window.partitionBy("page_id", "segment").orderBy("cx", "y0", "box_no")
    gap = F.coalesce(F.abs(F.col("cx") - F.lag("cx").over(right)) > F.col("w") * gutter, F.lit(False))
    cols = seg.withColumn("gap", gap.cast("int")).withColumn("column_no", F.sum("gap").over(right))
    order = Window.partitionBy("page_id").orderBy("segment", "column_no", "y0", "cx", "box_no")
    return cols.select("page_id", "box_no", "segment", "column_no", F.row_number().over(order).alias("order_no"))


def line_index(b: DataFrame) -> DataFrame:
    """First Markdown line of each block of a document: an exclusive running sum of lines and one blank line each."""
    order = Window.partitionBy("doc_key").orderBy("page", "page_id", "box_no").rowsBetween(Window.unboundedPreceding, -1)
    lines = b.filter("text <> ''").select("doc_key", "page", "page_id", "box_no", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 2).alias("n"))
    return lines.select("page_id", "box_no", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("md_line_index"))


def node_ranges(groups: DataFrame, key: list[str], order: list[str], size: str) -> DataFrame:
    """Consecutive counters: a group of k nodes takes k numbers; adds first_index and node_index (array)."""
    before = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(size).over(before), F.lit(0))
    return groups.withColumn("first_index", first).withColumn("node_index", F.sequence("first_index", F.col("first_index") + F.col(size) - 1))


def page_numbers_from_breaks(paragraphs_: DataFrame, key: str, order: str, breaks: str) -> DataFrame:
    """Page of each paragraph: one plus the page breaks up to it."""
    w = Window.partitionBy(key).orderBy(order)
    return paragraphs_.withColumn("page_no", 1 + F.sum(F.col(breaks).cast("int")).over(w))




def flattened_chunks(chunks_: DataFrame, grid: int = 1000) -> DataFrame:
    """Chunks in the flat form: boxs on the ``grid`` of the first page's size (as large as the grid where it is unknown), the
    other arrays by group, pages of a group as long as its lengths (its first page repeated where they differ), number as an
    array. Groups that are null are empty; boxes without four numbers stay as they are."""
    dims = F.get(F.get("image_dims", F.lit(0)), F.lit(0))
    w, h = F.coalesce(F.nullif(dims["w"], F.lit(0)), F.lit(grid)), F.coalesce(F.nullif(dims["h"], F.lit(0)), F.lit(grid))
    box = lambda b: F.when((F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull()), G.box_to_grid(b, w, h, grid)).otherwise(b)
    none = lambda g, kind: F.coalesce(g, F.expr(f"cast(array() as array<{kind}>)"))
    size = lambda i: F.size(none(F.get("nodes_text_len", i), "int"))
    pages = F.transform("pages", lambda g, i: F.when(F.size(none(g, "string")) == size(i), g).otherwise(F.array_repeat(F.coalesce(F.get(g, F.lit(0)), F.lit("1")), size(i))))
    changed = {
        "boxs": F.transform("boxs", lambda g: F.transform(none(g, "array<int>"), box)),
        "nodes_text_len": F.transform("nodes_text_len", lambda g: none(g, "int")),
        "nodes_index": F.transform("nodes_index", lambda g: none(g, "int")),
        "pages": pages,
    }
    if "number" in chunks_.columns:
        changed["number"] = F.when(F.col("number").isNull(), F.expr("cast(array() as array<int>)")).otherwise(F.array("number"))
    return chunks_.withColumns(changed)


def boundary_merged(b: DataFrame) -> DataFrame:
    """Blocks with text after the boundary merge: doc_key, page, page_id, box_no, n_nodes, label, content. The last block of a
    page and the first of the next are one where ``boundary_pairs`` joins them, by a line break."""
    own = b.filter("text <> ''")
    pairs = boundary_pairs(own)
    second = own.join(pairs.select(F.col("next_page_id").alias("page_id"), F.col("next_no").alias("box_no"), F.col("page_id").alias("to_id"), F.col("box_no").alias("to_no")), ["page_id", "box_no"], "left")
    at = second.select("doc_key", F.coalesce("to_id", "page_id").alias("head_id"), F.coalesce("to_no", "box_no").alias("head_no"), "page", "page_id", "box_no", "label", "text")
    nodes = F.array_sort(F.collect_list(F.struct("page", "page_id", "box_no", "label", "text")))
    grouped = at.groupBy("doc_key", "head_id", "head_no").agg(nodes.alias("n"))
    return grouped.select("doc_key", F.get("n", F.lit(0))["page"].alias("page"), F.col("head_id").alias("page_id"), F.col("head_no").alias("box_no"), F.size("n").alias("n_nodes"), F.get("n", F.lit(0))["label"].alias("label"), F.array_join(F.transform("n", lambda x: x["text"]), "\n").alias("content"))
