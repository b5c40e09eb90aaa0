"""Word documents by the standard library: paragraphs with page numbers, foot notes and images."""

from __future__ import annotations

import base64
import io
import posixpath
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: XML namespaces of the format.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"

RECORD = "path string, kind string, ordinal bigint, type string, content string, page_break boolean, refs array<string>, error string"


def records(path: str, content: bytes) -> Iterator[tuple]:
    """Paragraph, image and note records of one document; a document that can't be read gives one record with its error."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = set(z.namelist())
            body = ElementTree.fromstring(z.read("word/document.xml"))
            links = {}
            if "word/_rels/document.xml.rels" in names:
                links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("word/_rels/document.xml.rels")).iter(RELATION)}
            n = 0
            for p in body.iter(f"{W}p"):
                text = "".join(t.text or "" if t.tag == f"{W}t" else "\t" if t.tag == f"{W}tab" else "" for t in p.iter() if t.tag in (f"{W}t", f"{W}tab"))
                brk = any(b.get(f"{W}type") == "page" for b in p.iter(f"{W}br")) or p.find(f".//{W}lastRenderedPageBreak") is not None
                refs = [r.get(f"{W}id") for r in p.iter(f"{W}footnoteReference")]
                images = [b.get(f"{R}embed") for b in p.iter(f"{A}blip") if b.get(f"{R}embed")]
                if text.strip() or brk:
                    yield path, "paragraph", n, "text", text, brk, refs, None
                    n += 1
                for image in images:
                    target = posixpath.normpath(posixpath.join("word", links.get(image, "")))
                    if target in names:
                        yield path, "paragraph", n, "image", base64.b64encode(z.read(target)).decode(), False, [], None
                        n += 1
            if "word/footnotes.xml" in names:
                for note in ElementTree.fromstring(z.read("word/footnotes.xml")).iter(f"{W}footnote"):
                    text = "".join(t.text or "" for t in note.iter(f"{W}t")).strip()
                    if text:
                        yield path, "note", int(note.get(f"{W}id")), "text", text, False, [note.get(f"{W}id")], None
    except Exception as e:  # noqa: BLE001
        yield path, "error", 0, "error", None, False, [], f"{type(e).__name__}: {e}"


def read(spark: SparkSession, path: str, glob: str = "*.docx") -> DataFrame:
    """Records of all documents below a path: one task reads a document at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        for pdf in frames:
            yield pd.DataFrame([r for p, c in zip(pdf.path, pdf.content) for r in records(p, c)], columns=names)

    return files.mapInPandas(run, RECORD)


def paragraphs(rows: DataFrame) -> DataFrame:
    """Paragraphs and images with id, page (one plus the breaks so far) and foot notes."""
    from pagewright.operators import joins, layout

    p = layout.page_numbers_from_breaks(rows.filter("kind = 'paragraph'"), "path", "ordinal", "page_break").withColumn("id", F.concat_ws("#", "path", "ordinal"))
    notes = rows.filter("kind = 'note'").select(F.concat_ws("#", "path", F.get("refs", F.lit(0))).alias("note_id"), F.col("content").alias("note"))
    keyed = p.select("id", F.transform("refs", lambda r: F.concat_ws("#", F.col("path"), r)).alias("refs"))
    named = joins.footnotes(keyed, notes).select("id", F.transform("footnotes", lambda t: F.regexp_replace(t, "^.*#", "")).alias("footnote"))
    return p.join(named, "id", "left").select("path", F.col("ordinal").alias("place"), "type", "content", F.col("page_no").alias("page"), F.coalesce("footnote", F.expr("array()")).alias("footnote"))
