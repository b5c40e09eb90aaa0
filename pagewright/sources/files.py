"""Sources of pages, layouts, chunks and catalogues in files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOX = "struct<label:string,box:array<int>,text_content:string,merged_boxes:array<array<int>>,merged_text_lens:array<int>>"
#: The layouts of the files.
OCR_PAGE = f"success boolean, text string, raw_text string, boxes array<{BOX}>, image_dims struct<w:int,h:int>, prompt_type string, metadata struct<mode:string,grounding:boolean,has_boxes:boolean,engine:string>"
TEXT_LAYER = "page int, width double, height double, blocks array<struct<bbox:array<double>,text:string>>"
SPAN_TREE = "blocks array<struct<type:int,bbox:array<double>,lines:array<struct<bbox:array<double>,spans:array<struct<text:string,size:double,flags:int,font:string,bbox:array<double>>>>>>>"
CHUNKS = "id int, type string, content string, texts array<string>, ref array<string>, page string, pages array<array<string>>, nodes_text_len array<array<int>>, nodes_index array<array<int>>, boxs array<array<array<int>>>, image_dims array<array<struct<w:int,h:int>>>"
CHECKS = "id string, errors array<struct<content:string,rightSentences:string>>"
THIRD_PARTY = "image_info array<struct<width:int,height:int>>, data array<struct<layout:array<struct<loc:array<int>,sub_layout:array<struct<loc:array<int>,type:string>>>>,text_lines:array<struct<poly:array<int>,text:string>>>>"
NODE = "struct<filename:string,page:string,node_index:string,text_len:string,ref:string,box:string,text:string>"


def file_number(name: Column) -> Column:
    """The number that a file's name is; 0 for other names."""
    return F.coalesce(F.regexp_extract(name, r"([^/]*)\.[^./]*$", 1).try_cast("int"), F.lit(0))


def first_number(name: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(name, r"([0-9]+)[^/]*$", 1), F.lit("")).try_cast("int"), F.lit(0))


def json_files(spark: SparkSession, path: str, schema: str, glob: str = "*.json", recursive: bool = True) -> DataFrame:
    """Whole JSON files (an object or a list of objects each) with path, doc_key, file_name and file_no; empty files are skipped.

    doc_key is the folder below ``path`` in which a file lies ('' for ``path`` itself), as a book has a folder of its own.
    """
    reader = spark.read.schema(schema).option("multiLine", "true").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    rows = reader.json(path).withColumn("file_name", F.col("_metadata.file_name")).withColumn("path", F.col("_metadata.file_path")).filter(F.col("_metadata.file_size") > 0)
    return rows.withColumn("file_no", file_number(F.col("file_name"))).withColumn("doc_key", folder_key(F.col("path"), path))


def folder_key(file_path: Column, root: str) -> Column:
    """The folder of a file below ``root``, decoded, without its name."""
    own = F.url_decode(F.replace(F.regexp_replace(file_path, r"^[a-zA-Z]+:/+", "/"), F.lit("+"), F.lit("%2B")))
    base = "/" + re.sub(r"^[a-zA-Z]+:/+", "", root).strip("/")
    return F.btrim(F.regexp_replace(F.when(F.startswith(own, F.lit(base)), F.substr(own, F.lit(len(base) + 1))).otherwise(own), r"[^/]*$", ""), F.lit("/"))


def ocr_pages(spark: SparkSession, path: str) -> DataFrame:
    return json_files(spark, path, OCR_PAGE)


def text_layer(spark: SparkSession, path: str) -> DataFrame:
    return json_files(spark, path, TEXT_LAYER)


def spans(spark: SparkSession, path: str) -> DataFrame:
    """Span trees as a flat table of spans, by document (folder) and page (the number that a file's name is)."""
    t = json_files(spark, path, SPAN_TREE).select("doc_key", F.col("file_no").alias("page"), F.posexplode("blocks").alias("block_no", "b"))
    lines = t.select("doc_key", "page", "block_no", F.posexplode("b.lines").alias("line_no", "l"))
    s = lines.select("doc_key", "page", "block_no", "line_no", F.posexplode("l.spans").alias("span_no", "s"))
    c = [F.get("s.bbox", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    return s.select("doc_key", "page", "block_no", "line_no", "span_no", "s.text", "s.size", "s.flags", "s.font", *c)


def chunk_items(spark: SparkSession, path: str) -> DataFrame:
    """Text items of chunk files."""
    return json_files(spark, path, CHUNKS).filter("type = 'text'")


def check_results(spark: SparkSession, path: str) -> DataFrame:
    return json_files(spark, path, CHECKS).withColumn("file_no", first_number(F.col("file_name")))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, stripped, without the blank ones."""
    from pagewright.functions import text as X

    return spark.read.text(path).select(X.strip(F.col("value")).alias("line")).filter("line <> ''")


def third_party(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of foreign layouts with bounding box and font height."""
    from pagewright.functions import geometry as G

    d = json_files(spark, path, THIRD_PARTY).select("file_name", "image_info", F.posexplode_outer("data").alias("page_no", "d"))
    t = d.select("file_name", "page_no", F.get("image_info", "page_no").alias("image"), F.posexplode_outer("d.text_lines").alias("line_no", "t"))
    box = G.polygon_box(F.col("t.poly"))
    return t.select("file_name", "page_no", "image", "line_no", "t.text", box.alias("box"), F.greatest((F.get(box, F.lit(3)) - F.get(box, F.lit(1))).cast("int"), F.lit(10)).alias("font"))


def third_party_regions(spark: SparkSession, path: str) -> DataFrame:
    """Regions of foreign layouts: file_name, page_no, layout_no, loc and, per part, sub_no, sub_loc, type (null without parts)."""
    d = json_files(spark, path, THIRD_PARTY).select("file_name", F.posexplode_outer("data").alias("page_no", "d"))
    regions = d.select("file_name", "page_no", F.posexplode_outer("d.layout").alias("layout_no", "l"))
    return regions.select("file_name", "page_no", "layout_no", "l.loc", F.posexplode_outer("l.sub_layout").alias("sub_no", "s")).select("file_name", "page_no", "layout_no", "loc", "sub_no", F.col("s.loc").alias("sub_loc"), "s.type")


def settings(spark: SparkSession, path: str, defaults: dict[str, str], glob: str = "*.json") -> DataFrame:
    """Setting files as one row per document: doc_key and a string column per name of ``defaults``.

    A file holds one object; files of one folder are taken together (of equal names the largest value); what none of them has,
    and what a broken file should have had, takes its default.
    """
    files = spark.read.option("wholetext", "true").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path).withColumn("doc_key", folder_key(F.col("_metadata.file_path"), path))
    held = F.from_json("value", "map<string,string>")
    per = files.groupBy("doc_key").agg(*[F.max(held[n]).alias(n) for n in defaults])
    return per.select("doc_key", *[F.coalesce(n, F.lit(v)).alias(n) for n, v in defaults.items()])


def catalogue(spark: SparkSession, path: str, globs: tuple[str, ...] = ("*.pdf", "*.docx"), newest_first: bool = True) -> DataFrame:
    """Files below a folder: path, name, name_key, shown name, directory, size, time. Contents are never read."""
    from pagewright.functions import text as X

    found = None
    for glob in globs:
        part = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "modificationTime", "length")
        found = part if found is None else found.unionAll(part)
    name = F.element_at(F.split("path", "/"), -1)
    out = found.select("path", name.alias("file_name"), F.md5(name).alias("name_key"), F.md5("path").alias("path_key"), X.mask_name(name).alias("shown"), F.element_at(F.split("path", "/"), -2).alias("directory_name"), "length", "modificationTime")
    return out.orderBy(F.desc("modificationTime") if newest_first else F.asc("modificationTime"), "path")


def node_arrays(nodes: Column) -> Column:
    """Nodes whose index, length and box are a value or a list, with lists in every case."""
    index = lambda s: F.from_json(F.when(F.trim(s).startswith("["), s).otherwise(F.concat(F.lit("["), s, F.lit("]"))), "array<int>")
    box = lambda s: F.from_json(F.when(F.regexp_replace(s, r"\s", "").startswith("[["), s).otherwise(F.concat(F.lit("["), s, F.lit("]"))), "array<array<int>>")
    return F.transform(nodes, lambda n: F.struct(n["page"].alias("page"), index(n["node_index"]).alias("node_index"), index(n["text_len"]).alias("text_len"), n["ref"].alias("ref"), box(n["box"]).alias("boxs"), n["text"].alias("text")))


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Page records with nodes, lists in every case."""
    schema = f"filename string, page string, page_text_len int, image_dims struct<w:int,h:int>, box_text_all string, nodes array<{NODE}>"
    return json_files(spark, path, schema).withColumn("nodes", node_arrays(F.col("nodes")))


def to_nodes(pages: DataFrame) -> DataFrame:
    """OCR pages (merged or not) as page records: counters run over the page, a merged box takes one for each of its parts."""
    parts = F.transform("boxes", lambda b: F.struct(b["label"].alias("ref"), F.coalesce(b["text_content"], F.lit("")).alias("text"), F.coalesce(b["merged_boxes"], F.array(b["box"])).alias("boxs"), F.coalesce(b["merged_text_lens"], F.array(F.length(F.coalesce(b["text_content"], F.lit(""))))).alias("text_len")))
    sized = pages.withColumn("__p", parts)
    first = lambda i: F.aggregate(F.slice("__p", F.lit(1), i), F.lit(0), lambda a, p: a + F.size(p["boxs"]))
    nodes = F.transform("__p", lambda p, i: F.struct(F.sequence(first(i), first(i) + F.size(p["boxs"]) - 1).alias("node_index"), p["text_len"].alias("text_len"), p["ref"].alias("ref"), p["boxs"].alias("boxs"), p["text"].alias("text")))
    text = F.array_join(F.filter(F.transform("__p", lambda p: p["text"]), lambda t: t != ""), "\n")
    return sized.select("file_name", F.regexp_replace("file_name", r"\.json$", "").alias("page"), F.length(text).alias("page_text_len"), "image_dims", text.alias("box_text_all"), nodes.alias("nodes"))


