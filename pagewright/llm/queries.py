"""Queries of the training-data operators over the project's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import lookalike, markup, mixing, packing, scan, sentences, splitting, tokens, truncation
from pagewright.llm.tables import boxes, table
from pagewright.operators.deliveries import latest
from pagewright.session import keep


def _texts(spark: SparkSession, sf: str, once: bool = False) -> DataFrame:
    """Box and chunk texts with their keys; ``once``: of pages and chunks delivered again the latest."""
    pages, chunks = table(spark, sf, "ocr_pages"), table(spark, sf, "chunks")
    if once:
        pages, chunks = latest(pages, "page_id", "ingested_at"), latest(chunks, "chunk_id", "processed_at")
    box = boxes(pages, "doc_key").select("doc_key", F.lit("text_content").alias("field_name"), F.col("box_key").alias("key"), "text")
    chunk = chunks.select("doc_key", F.lit("content").alias("field_name"), F.col("chunk_id").alias("key"), F.col("content").alias("text"))
    return box.unionByName(chunk)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    texts = _texts(spark, sf)
    model = lookalike.Model(lookalike.letter_pairs(texts, "text"))
    return lookalike.same_looking(texts, ["doc_key", "field_name"], "key", "text", 30, model).select("field_name", "key_a", "key_b").distinct()


def p1_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of boxes and chunks in its one form, one row per key."""
    texts = _texts(spark, sf, once=True)
    model = lookalike.Model(lookalike.letter_pairs(texts, "text"))
    return lookalike.canonical_form(texts, ["field_name", "key"], "text", model)


def p1_members(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of at least 30 characters with its class of same-looking texts of its book and its number of links."""
    texts = _texts(spark, sf)
    model = lookalike.Model(lookalike.letter_pairs(texts, "text"))
    return lookalike.classes(texts, ["doc_key", "field_name"], "key", "text", 30, model)[1]


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.oversized(table(spark, sf, "chunks"), "chunk_id", "content")


def p2_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.pieces(table(spark, sf, "chunks"), "chunk_id", "content")


def p2_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks put together again from their pieces without the overlap."""
    p = p2_pieces(spark, sf)
    own = F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "start_pos", "end_pos", "piece"))), lambda x: F.struct(x["start_pos"].alias("a"), x["end_pos"].alias("b"), x["piece"].alias("t")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("t"), F.lit(True).alias("ok"))
    step = lambda acc, x: F.struct(x["b"].alias("at"), F.concat(acc["t"], F.substr(x["t"], (acc["at"] - x["a"] + 1).cast("int"))).alias("t"), (acc["ok"] & (x["b"] - x["a"] <= 1024) & ((x["a"] == 0) | (acc["at"] - x["a"] == 64))).alias("ok"))
    whole = p.groupBy("chunk_id").agg(own.alias("x")).select("chunk_id", F.aggregate("x", start, step).alias("r"))
    return whole.select("chunk_id", F.md5("r.t").alias("content_md5"), F.col("r.ok").alias("within_limits"))


def _running_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "ocr_pages").filter("prompt_type = 'free_ocr'")
    return boxes(pages).filter("label = 'text'")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.sentences(_running_text(spark, sf), "box_key", "text", with_text=False).select("box_key", "end_pos").distinct()


def p3_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of every box of every page."""
    return sentences.sentences(boxes(table(spark, sf, "ocr_pages")), "box_key", "text")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return markup.marked(boxes(table(spark, sf, "ocr_pages")), "box_key", "text").select("box_key").distinct()


def p4_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Every box with the kinds of its markup and its clean text."""
    return markup.cleaned(boxes(table(spark, sf, "ocr_pages")), "box_key", "text")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return scan.defects(table(spark, sf, "ocr_pages"), spark)


def p6_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Scanned pages as continuous paragraphs."""
    return scan.paragraphs(table(spark, sf, "ocr_pages"), spark)


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in containers of each capacity."""
    documents = table(spark, sf, "documents")
    sized = tokens.sizes(documents, "doc_id", "text", "lang")
    return packing.pack(sized, table(spark, sf, "pack_limits"), n_rows=documents.count())


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Containers and used space of each capacity."""
    return packing.fill(p8_containers(spark, sf), table(spark, sf, "pack_limits"))


def p8_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of each limit, and containers that hold more than it."""
    packed, limits = p8_containers(spark, sf), table(spark, sf, "pack_limits").select("pack_name", "capacity_tokens")
    per = packed.groupBy("pack_name", "container_id").agg(F.sum("n_tokens").alias("t")).join(limits, "pack_name").groupBy("pack_name").agg(F.count_if(F.col("t") > F.col("capacity_tokens")).alias("n_over"))
    docs = packed.groupBy("pack_name").agg(F.count_distinct("doc_id").alias("n_documents"))
    return docs.join(per, "pack_name")


def _mix(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    # sizes are used for the amounts and for the mix: encoded once
    sized = keep(tokens.sizes(table(spark, sf, "documents"), "doc_id", "text", "source"))
    return mixing.mix(spark, sized, table(spark, sf, "mix_targets"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The mixed sequence of documents."""
    return _mix(spark, sf)[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Shares reached by each source."""
    return _mix(spark, sf)[1]


def p9_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Sources of the mix: whether each keeps its repeats and uses no document twice in a pass."""
    mixed, shares = _mix(spark, sf)
    twice = mixed.groupBy("source", "doc_id", "repeat_no").count().groupBy("source").agg(F.count_if(F.col("count") > 1).alias("n_twice"))
    return shares.filter("used_tokens > 0").select("source", (F.col("repeats") <= F.col("max_repeats")).alias("within_repeats")).join(twice, "source")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.truncated(table(spark, sf, "documents"), "doc_id", "text").select("doc_id").distinct()


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Cut documents per source (null is a source of its own)."""
    documents = table(spark, sf, "documents")
    cut = truncation.truncated(documents, "doc_id", "text")
    marked = documents.select("doc_id", "source").join(cut, "doc_id", "left")
    by = marked.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count("evidence").alias("n_cut"))
    return by.withColumn("cut_rate", F.col("n_cut") / F.col("n_docs"))


def queries() -> dict:
    return {f.__name__: f for f in (p4_found, p4_clean, p6_found, p6_paragraphs, p8_containers, p8_fill, p8_whole, p9_mix, p9_shares, p9_repeats, p10_found, p10_rates, p1_found, p1_members, p1_canonical, p2_found, p2_pieces, p2_rebuilt, p3_found, p3_sentences)}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": "select distinct chunk_id from chunks where length(content) > 1024",
        "p2_rebuilt": "select distinct chunk_id, md5(content) content_md5, true within_limits from chunks where length(content) > 1024",
        "p8_whole": "select pack_name, count(distinct doc_id) n_documents, cast(0 as bigint) n_over from pack_limits l join documents d on (l.lang is null or l.lang = d.lang) where length(text) > 0 and capacity_tokens > 0 group by pack_name",
        "p9_repeats": "select distinct source, true within_repeats, cast(0 as bigint) n_twice from mix_targets join documents using (source) where target_share > 0 and max_repeats > 0 and length(text) > 0",
    }
