"""Composite pipelines: pages to chunks, fused pages, Word documents, checks. Each is one plan over its inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import text as X
from pagewright.operators import fusion, joins, layout, quotes, spans, stats
from pagewright.sinks import envelope
from pagewright.sinks import files as sinks
from pagewright.sources import clients, docx, grounding


def pages_to_chunks(pages: DataFrame, layer: DataFrame | None = None, limit: int = 1024, plain: bool = False) -> DataFrame:
    """The flat pipeline: (fusion with the text layer), paragraph merge over pages, packing, ids."""
    b = layout.blocks(pages)
    if layer is not None:
        fallback = joins.match_boxes(grounding.parse(pages), b).join(grounding.parse(pages).select("page_id", "node_index", "text"), ["page_id", "node_index"]).select("page_id", "box_no", "text")
        fused = fusion.fuse_pages(b, layer, fallback).select("box_key", F.col("text").alias("fused"))
        b = b.join(fused, "box_key").withColumn("text", F.col("fused")).drop("fused")
    chunks = layout.packed_chunks(b, plain, limit)
    return sinks.with_ids(chunks, ["doc_key"], ["section", "chunk_no"])


def nodes_1024(b: DataFrame, islands: DataFrame) -> DataFrame:
    """Paragraphs with their boxes on the 1024 grid and their nodes' lengths and dims."""
    p = layout.paragraphs(b, islands)
    box = lambda n: G.box_to_grid(n["box"], F.coalesce(n["w"], F.lit(1024)), F.coalesce(n["h"], F.lit(1024)))
    return p.select("doc_key", "head_page", "head_no", "content", F.transform("nodes", lambda n: F.length(n["t"])).alias("nodes_text_len"), F.transform("nodes", box).alias("boxs"), F.transform("nodes", lambda n: n["page"].cast("string")).alias("pages"), F.transform("nodes", lambda n: n["label"]).alias("ref"), F.transform("nodes", lambda n: F.struct(n["w"].alias("w"), n["h"].alias("h"))).alias("image_dims"))


def curpage_chunks(b: DataFrame, limit: int = 1024) -> DataFrame:
    """The page-wise pipeline: blocks (merged within their page) to boundary merge over pages to packing, with ids."""
    chunks = layout.chunks(layout.pack(layout.boundary_merged(b), limit))
    return sinks.with_ids(chunks, ["doc_key"], ["section", "chunk_no"])


def staged(pages: DataFrame, state: DataFrame | None, stage: str, run: Callable[[DataFrame], DataFrame], state_path: str, out_path: str, batch: str) -> DataFrame:
    """One resumable stage: documents that aren't marked are run, written below ``out_path`` as ``batch`` and then marked.

    The list of documents is written first, with the batch, and everything after it reads that list: documents that arrive in
    between wait for the next batch. A batch that failed and runs again replaces itself, and marks are made of what was written.
    Returns the pages of the batch.
    """
    keys = pages.select("doc_key").distinct()
    todo = keys if state is None else joins.pending(keys, sinks.stages_done(state, stage), ["doc_key"])
    listed = f"{out_path}/_todo/batch={batch}"
    todo.write.mode("overwrite").parquet(listed)
    spark = pages.sparkSession
    chosen = spark.read.schema(todo.schema).parquet(listed)
    own = pages.join(chosen, "doc_key", "left_semi")
    run(own).write.mode("overwrite").parquet(f"{out_path}/data/batch={batch}")
    sinks.mark(chosen, f"{state_path}/batch={stage}-{batch}", stage, mode="overwrite")
    return own


def word_items(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Paragraphs and images of Word documents with ids."""
    rows = docx.paragraphs(docx.read(spark, path))
    return rows.withColumn("id", F.row_number().over(layout.Window.partitionBy("path").orderBy("place")))


def dispatch(spark: SparkSession, files: DataFrame, folder: str, extract: Callable[[str], dict]) -> DataFrame:
    """Items of the listed files: Word files by our reader, PDF files by an injected service, an error row for any other kind."""
    suffix = F.lower(F.element_at(F.split("path", r"\."), -1))
    word = word_items(spark, folder).join(files.select("path").distinct(), "path", "left_semi").select("path", "id", "type", "content", F.lit(None).cast("string").alias("error"))
    answers = clients.call(files.filter(suffix == "pdf"), "path", "path", extract)
    pdf = clients.extraction_parts(answers.filter("error is null"), "path")["pdfContent"].select("path", "id", F.lit("text").alias("type"), F.try_element_at("item", F.lit("content")).alias("content"), F.lit(None).cast("string").alias("error"))
    failed = answers.filter("error is not null").select("path", F.lit(None).cast("int").alias("id"), F.lit("error").alias("type"), F.lit(None).cast("string").alias("content"), "error")
    other = files.filter(~suffix.isin("pdf", "docx")).select("path", F.lit(None).cast("int").alias("id"), F.lit("error").alias("type"), F.lit(None).cast("string").alias("content"), F.concat(F.lit("no reader for "), suffix).alias("error"))
    return word.unionByName(pdf).unionByName(failed).unionByName(other)


def check(records: DataFrame, key: str, text: str, rules: quotes.Rules, client: Callable[[str], str] | None = None, attempts: int = 3) -> DataFrame:
    """Checks records: rules find candidates, a model (if there is one) answers for the records that have any, its answers
    are validated against their text and asked for again while they don't hold. Columns: key, answer (an envelope), valid, error."""
    found = quotes.candidates(records, key, text, rules)
    if client is None:
        kept = quotes.distinct_by(found, [key], F.regexp_replace("text", r"[^\p{L}\p{N}_\s]", ""), ["start", "end"]).withColumn("type", F.lit("direct"))
        res = quotes.results(kept, [key], rules.speaker, ["start", "end"])
        return res.select(key, envelope.write("rules", F.to_json(F.struct("message", "status", "data"))).alias("answer"), F.lit(True).alias("valid"), F.lit(None).cast("string").alias("error"))
    asked = records.join(found.select(key).distinct(), key, "left_semi")
    answers = quotes.ask(asked, key, text, client, attempts, quotes.names_occur).join(asked.select(key, text), key)
    return quotes.valid_answers(answers, "answer", text).select(key, "answer", "valid", "error")


def evaluate(texts: DataFrame, key: str, text: str, baseline: Callable[[DataFrame], DataFrame], models: dict[str, Callable[[str], str]], done: DataFrame | None = None) -> DataFrame:
    """Rows (key, model, base, other) to compare models' quotation lists with the rules'. Rows of ``done`` (the same columns, from
    an earlier run) are taken over, and only the texts that a model hasn't answered yet are asked."""
    base = baseline(texts).select(key, F.col("quotes").alias("base"))
    out = done
    for name, client in sorted(models.items()):
        todo = texts if done is None else joins.pending(texts, done.filter(F.col("model") == name), [key])
        answers = quotes.ask(todo, key, text, client)
        listed = F.from_json(F.regexp_extract("answer", r"(?s)(\[.*\])", 1), "array<string>")
        part = answers.select(key, F.lit(name).alias("model"), F.coalesce(listed, F.expr("cast(array() as array<string>)")).alias("other")).join(base, key, "left")
        part = part.select(key, "model", F.coalesce("base", F.expr("cast(array() as array<string>)")).alias("base"), "other")
        out = part if out is None else out.select(part.columns).unionByName(part)
    return out


def convert(spans_: DataFrame, tables: DataFrame | None = None, page_width: float = 595.0, page_height: float = 842.0) -> DataFrame:
    """Span tables of any number of documents to Markdown lines: doc_key, page, order_no, md_line_index, text, mapping_text, box.

    Blocks that tables cover are left out, tables (doc_key, page, x0, y0, x1, y1, cells; found by ``spans.find_tables`` if none
    are given) come in as Markdown, headings by size, blocks in column-aware reading order.
    """
    tables = spans.find_tables(spans_) if tables is None else tables
    page_id = F.struct("doc_key", "page").alias("page_id")
    b = spans.block_texts(spans_, " ", page_height).withColumn("page_id", page_id)
    grid = tables.select(page_id, "doc_key", "page", "x0", "y0", "x1", "y1", X.markdown_table(F.col("cells")).alias("text"), F.lit("table").alias("label"), F.lit(None).cast("double").alias("max_size"))
    own = b.select("page_id", "doc_key", "page", "x0", "y0", "x1", "y1", "text", F.lit("text").alias("label"), "max_size")
    order = layout.Window.partitionBy("page_id").orderBy("y0", "x0", "text")
    all_ = own.unionByName(grid).withColumn("box_no", F.row_number().over(order))
    kept = joins.without_tables(all_).unionByName(all_.filter("label = 'table'"))
    # one row of sizes for each document
    sizes = stats.font_sizes(spans_, "doc_key", "size", "page").withColumnRenamed("max_size", "most")
    sign = stats.heading_sign(F.col("max_size"), F.col("heading_size"), F.col("most"))
    signed = kept.join(sizes, "doc_key", "left").withColumn("text", F.when(F.col("label") == "table", F.col("text")).otherwise(F.concat(sign, F.col("text"))))
    read = layout.reading_order(signed.withColumn("w", F.lit(page_width)))
    placed = signed.join(read, ["page_id", "box_no"]).withColumn("box", F.array("x0", "y0", "x1", "y1"))
    lines = layout.line_index(placed.select("doc_key", "page", "page_id", F.col("order_no").alias("box_no"), "text"))
    return placed.join(lines.withColumnRenamed("box_no", "order_no"), ["page_id", "order_no"]).select("doc_key", "page", "order_no", "md_line_index", "text", X.shorten(F.col("text")).alias("mapping_text"), "box")
