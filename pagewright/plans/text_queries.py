"""Queries of the text functions over the project's boxes, documents and mappings, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import html
from pagewright.functions import text as X
from pagewright.operators import fusion, layout
from pagewright.operators import joins as J
from pagewright.operators.deliveries import latest
from pagewright.plans.layout_queries import _B, _BLANK, _CLOSERS, _MAP, _TERMINAL, _TITLE
from pagewright.session import table


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    return layout.blocks(table(spark, sf, "ocr_pages"))


def _of_blocks(columns: Callable[[Column], dict[str, Column]]):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _blocks(spark, sf).select("box_key", *[c.alias(n) for n, c in columns(F.col("text")).items()])

    return query


_BLOCK_QUERIES = {
    "footnote_letters": _of_blocks(lambda t: dict(out=X.footnote_letters(t))),
    "special_spaces": _of_blocks(lambda t: dict(out=X.special_spaces(t))),
    "label_prefix": _of_blocks(lambda t: dict(out=X.label_prefix(F.col("label"), t), staged=X.staged_prefix(F.col("label"), t))),
    "clean_chars": _of_blocks(lambda t: dict(out=X.clean_characters(t), listed=X.clean_characters(t, listed=True))),
    "strip_refs": _of_blocks(lambda t: dict(out=X.strip_references(t))),
    "toc_breaks": _of_blocks(lambda t: dict(out=X.contents_breaks(t))),
    "title_filter": _of_blocks(lambda t: dict(is_title=X.is_title(t), is_title_format=X.is_title_format(t))),
    "sentence_end": _of_blocks(lambda t: dict(ends=X.ends_sentence(t), last=X.last_char(t))),
    "cut_off_blocks": _of_blocks(lambda t: dict(cut=X.cut_off(t))),
    "html_strip": _of_blocks(lambda t: dict(out=X.strip_tags(t))),
    "truncate_text": _of_blocks(lambda t: dict(short=X.shorten(t, 100), context=X.shorten(t, 50))),
    "no_punctuation": _of_blocks(lambda t: dict(out=X.no_punctuation(t, keep_blanks=False))),
    "latin_and_cjk": _of_blocks(lambda t: dict(latin=X.strip(t).rlike(r"^[A-Za-z\s]+$"), cjk=t.rlike("[一-鿿]"), contents=X.strip(t).rlike(r"^[.。…\s]+[0-9]+$"))),
    "circled_counts": _of_blocks(lambda t: dict(n1=(F.length(t) - F.length(F.replace(t, F.lit("①"), F.lit("")))).cast("bigint"), n2=(F.length(t) - F.length(F.replace(t, F.lit("②"), F.lit("")))).cast("bigint"))),
    "keyword_words": _of_blocks(lambda t: dict(words=F.array_join(F.filter(F.array(*[F.lit(w) for w in ("档案", "河道", "register", "Archiv")]), lambda w: F.contains(t, w)), ","))),
    "point_to_pixel": _of_blocks(lambda t: dict(px=F.col("x0") / 2.0, py=F.col("y0") / 2.0, ex0=F.col("x0") - 5, ey1=F.col("y1") + 5)),
}


def html_table_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """HTML tables of boxes as Markdown tables."""
    t = _blocks(spark, sf).filter(F.contains("text", F.lit("<table>")))
    rows = F.transform(F.regexp_extract_all("text", F.lit(r"<tr>(.*?)</tr>"), F.lit(1)), lambda r: F.regexp_extract_all(r, F.lit(r"<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)))
    return t.select("box_key", X.markdown_table(rows).alias("md"))


def polygon_boxes(spark: SparkSession, sf: str) -> DataFrame:
    m = J.mapping_blocks(table(spark, sf, "mapping_rows"), zoom=1.0)
    poly = F.array("x0", "y0", "x1", "y0", "x1", "y1", "x0", "y1")
    box = G.polygon_box(poly)
    at = lambda i: F.get(box, F.lit(i))
    return m.select("map_id", at(0).alias("bx0"), at(1).alias("by0"), at(2).alias("bx1"), at(3).alias("by1"), F.greatest((at(3) - at(1)).cast("int"), F.lit(10)).alias("font"))


def document_model_names(spark: SparkSession, sf: str) -> DataFrame:
    """Sanitised engine names and formatted times of pages."""
    p = latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at")
    name = F.concat_ws(":", "metadata.engine", F.lit("v1.2-b"))
    return p.select("page_id", X.sanitize_model(name).alias("model"), F.date_format("scanned_at", "yyyy-MM-dd HH:mm:ss").alias("scanned"), F.pmod(F.col("page_id"), F.lit(4)).alias("endpoint"))


def natural_page_order(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of a book in the order of the number in their file's name; other names count as 0."""
    p = latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at")
    stem = F.coalesce(F.regexp_extract("filename", r"^([0-9]+)\.", 1).try_cast("int"), F.lit(0))
    n = F.row_number().over(layout.Window.partitionBy("doc_key").orderBy(stem, "filename", "page_id"))
    return p.select("page_id", stem.alias("stem"), n.cast("bigint").alias("place"))


def json_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts as JSON objects out of fenced answers with words around the object."""
    d = table(spark, sf, "documents").filter("text is not null")
    answer = F.concat(F.lit("```json\nHere it is: "), F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("t"))), F.lit("\n```"))
    plain = d.select("doc_id", answer.alias("a")).withColumn("a", X.unfence(F.col("a")))
    return plain.withColumn("o", F.from_json(X.json_object(F.col("a")), "id bigint, t string")).select("doc_id", F.col("o.id").alias("id"), F.md5("o.t").alias("text_md5"))


def envelope_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts of all documents, written to model envelopes and read out of their fenced content again."""
    from pagewright.sinks import envelope

    d = table(spark, sf, "documents").filter("text is not null").select("doc_id", F.col("text").alias("t"))
    model, content = envelope.read(envelope.write("rules", F.to_json(F.struct("t"))))
    # in steps, as each function names its text several times
    read = d.select("doc_id", model.alias("model"), content.alias("content")).withColumn("content", X.unfence(F.col("content")))
    return read.withColumn("o", X.json_object(F.col("content"))).select("doc_id", "model", F.from_json("o", "t string")["t"].alias("text"))


def closed_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Fragments with HTML, their open elements closed."""
    b = _blocks(spark, sf).filter(F.contains("text", F.lit("<")))
    return b.select("box_key", html.closed(F.col("text")).alias("c")).select("box_key", "c.text", "c.changed")


def text_fusion_positional(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    found = b.join(J.spatial_text(b, J.mapping_blocks(table(spark, sf, "mapping_rows"))).withColumnRenamed("text", "lt").filter("n_blocks > 0"), "box_key")
    return found.select("box_key", fusion.filled(F.col("text"), F.col("lt")).alias("fused"))


def text_fusion_aligned(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    found = b.join(J.spatial_text(b, J.mapping_blocks(table(spark, sf, "mapping_rows"))).withColumnRenamed("text", "lt").filter("n_blocks > 0"), "box_key")
    return found.select("box_key", fusion.fused(F.col("text"), F.col("lt")).alias("fused"))


def page_fusion(spark: SparkSession, sf: str) -> DataFrame:
    return fusion.fuse_pages(_blocks(spark, sf), J.mapping_blocks(table(spark, sf, "mapping_rows")))


def queries() -> dict:
    own = (closed_tags, html_table_markdown, polygon_boxes, document_model_names, natural_page_order, json_extraction, envelope_documents, text_fusion_positional, text_fusion_aligned, page_fusion)
    return _BLOCK_QUERIES | {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    blank = _BLANK
    strip = lambda c: f"regexp_replace({c}, '^{blank}+|{blank}+$', '', 'g')"
    block = lambda cols: _B + f"select box_key, {cols} from s"
    low = "abcdefghijklmnopqrst"
    # fixed values, as the SQL has them for itself
    forms = r"^第[一二三四五六七八九十百千万\p{Nd}]+[章节篇部分条款]|^[一二三四五六七八九十]+[、，\.]|^\([一二三四五六七八九十]+\)|^（[一二三四五六七八九十]+）|^\p{Nd}+\.|^\(\p{Nd}+\)|^（\p{Nd}+）"
    letters = "Җ&˅ᮠᦞҹAṸᇎ+᡻޼3ĉ''ѝᇦ(ᵜṨᆇ"
    garbled = f"'{letters}'||" + "||".join(f"chr({c})" for c in (3, 15, 16, 17, 18, 19, 20, 21, 23, 24, 25, 26, 27))
    controls = "||".join(f"chr({c})" for c in (1, 2, 3, 4, 5, 6, 7, 8, 11, *range(14, 32), 127))
    refs = strip(f"regexp_replace({strip(f'''regexp_replace({strip('''regexp_replace(st, '[①-⑳]+$', '')''')}, '(\\[\\p{{Nd}}+\\]|（\\p{{Nd}}+）|\\(\\p{{Nd}}+\\))+$', '')''')}, '[，,;；:：]+$', '')")
    last = f"case when length(st) > 1 and contains('{_CLOSERS}', right(st, 1)) then substr(st, length(st) - 1, 1) else right(st, 1) end"
    return {
        "footnote_letters": block(f"translate(text, '{low + low.upper()}', '{X.CIRCLED * 2}') as out"),
        "special_spaces": block("translate(text, chr(8195) || chr(7) || chr(1), '   ') as out"),
        "label_prefix": block("case when st = '' then '' when label = 'title' then '# ' || text when label = 'sub_title' then '## ' || text else text end as out, case when text = '' then '' when label = 'title' then chr(13) || chr(10) || '#' || text when label = 'sub_title' then chr(13) || chr(10) || '##' || text when label = 'image' then chr(13) || chr(10) || text else text end staged"),
        "clean_chars": block(f"translate(text, {controls}, '') as out, replace(replace(translate(text, {garbled}, ''), '##', chr(10)), '#', chr(10)) listed"),
        "strip_refs": block(f"{refs} as out"),
        "toc_breaks": _B + ", m as (select box_key, replace(regexp_replace(regexp_replace(text, '([.。…]{2,}[\\s\\x{3000}]*\\p{Nd}+)', '\\1' || chr(1), 'g'), chr(1) || '([\\n\\r])', '\\1', 'g'), chr(1), chr(10)) r from s) select box_key, replace(r, chr(10) || chr(10), chr(10)) as out from m",
        "title_filter": block(f"starts_with(st, '#') or regexp_matches(text, '{_TITLE}') is_title, starts_with(st, '#') or regexp_matches(st, '{forms}') is_title_format"),
        "sentence_end": block(f"regexp_matches(st, '[。！？!?]$') ends, {last} as last"),
        "cut_off_blocks": block(f"({last}) <> '' and not contains('{_TERMINAL}', {last}) cut"),
        "html_strip": block("regexp_replace(regexp_replace(text, '<[^>]*>', '', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g') as out"),
        "truncate_text": block("case when length(text) > 100 then left(text, 100) || '...' else text end short, case when length(text) > 50 then left(text, 50) || '...' else text end context"),
        "no_punctuation": block("regexp_replace(text, '[^\\p{L}\\p{N}_]', '', 'g') as out"),
        "latin_and_cjk": block("regexp_matches(st, '^[A-Za-z\\s]+$') latin, regexp_matches(text, '[一-鿿]') cjk, regexp_matches(st, '^[.。…\\s]+[0-9]+$') contents"),
        "circled_counts": block("length(text) - length(replace(text, '①', '')) n1, length(text) - length(replace(text, '②', '')) n2"),
        "keyword_words": block("array_to_string(list_filter(['档案', '河道', 'register', 'Archiv'], lambda w: contains(text, w)), ',') words"),
        "point_to_pixel": block("x0 / 2.0 px, y0 / 2.0 py, x0 - 5 ex0, y1 + 5 ey1"),
        "html_table_markdown": _B + """, t as (select box_key, list_transform(regexp_extract_all(text, '<tr>(.*?)</tr>', 1), lambda r: regexp_extract_all(r, '<t[dh][^>]*>(.*?)</t[dh]>', 1)) rs from s where contains(text, '<table>')),
m as (select box_key, rs, list_transform(rs, lambda r: '| ' || array_to_string(list_transform(r, lambda c: replace(c, chr(10), ' ')), ' | ') || ' |' || chr(10)) ls from t)
select box_key, case when len(rs) < 1 then '' else ls[1] || '| ' || array_to_string(list_transform(rs[1], lambda c: '---'), ' | ') || ' |' || chr(10) || array_to_string(ls[2:], '') end md from m""",
        "polygon_boxes": "select distinct on (map_id) map_id, least(bbox[1], bbox[3]) bx0, least(bbox[2], bbox[4]) by0, greatest(bbox[1], bbox[3]) bx1, greatest(bbox[2], bbox[4]) by1, greatest(cast(trunc(abs(bbox[4] - bbox[2])) as int), 10) font from mapping_rows where len(bbox) = 4",
        "document_model_names": "select distinct on (page_id) page_id, translate(concat_ws(':', metadata.engine, 'v1.2-b'), '.:-', '___') model, strftime(scanned_at, '%Y-%m-%d %H:%M:%S') scanned, page_id % 4 endpoint from ocr_pages",
        "natural_page_order": "with p as (select distinct on (page_id) page_id, doc_key, filename, coalesce(try_cast(nullif(regexp_extract(filename, '^([0-9]+)\\.', 1), '') as int), 0) stem from ocr_pages) select page_id, stem, row_number() over (partition by doc_key order by stem, filename, page_id) place from p",
        "json_extraction": "select doc_id, doc_id id, md5(text) text_md5 from documents where text is not null",
        "envelope_documents": "select doc_id, 'rules' model, text from documents where text is not null",
        "text_fusion_positional": _MAP + _B.replace("with pg", ", pg", 1) + f""",
lt as (select b.box_key, any_value(b.text) as text, string_agg(mb.text, chr(10) order by mb.md_line_index, mb.map_id) l from b join mb on mb.doc_key = b.doc_key and mb.page = b.page and (mb.x0 + mb.x1) / 2 between b.x0 - 5 and b.x1 + 5 and (mb.y0 + mb.y1) / 2 between b.y0 - 5 and b.y1 + 5 group by b.box_key),
ch as (select box_key, regexp_extract_all(text, '(?s).') o, regexp_extract_all(regexp_replace(l, '{blank}', '', 'g'), '(?s).') n from lt),
rk as (select *, list_transform(o, lambda c: case when regexp_matches(c, '^{blank}$') then 0 else 1 end) f from ch),
cs as (select box_key, o, n, f, list_transform(range(1, len(o) + 1), lambda i: cast(list_sum(f[1:i]) as bigint)) r from rk)
select box_key, array_to_string(list_transform(range(1, len(o) + 1), lambda i: case when f[i] = 0 then o[i] else coalesce(n[r[i]], o[i]) end), '') || array_to_string(n[cast(coalesce(list_sum(f), 0) + 1 as bigint):], '') fused from cs""",
    }
