"""Queries of composed stages: fusion stages, the page-wise pipeline, flat chunks, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators import fusion
from pagewright.operators import joins as J
from pagewright.operators import layout as L
from pagewright.operators.deliveries import latest
from pagewright.plans import pipelines
from pagewright.plans.layout_queries import _B, _MAP, _NODES, pack_sql
from pagewright.session import table
from pagewright.sources import grounding

#: A text that an OCR model is taken to have made up, for the filter of such texts.
MADE_UP = "本节提要"


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at")


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    return grounding.parse(_pages(spark, sf)).filter("w is not null and h is not null")


def stage_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes after the box stage, their readings not yet aligned."""
    return fusion.stage_boxes(L.blocks(table(spark, sf, "ocr_pages")), _nodes(spark, sf), fuse_texts=False)


def stage_boxes_fused(spark: SparkSession, sf: str) -> DataFrame:
    """The box stage with aligned fusion."""
    return fusion.stage_boxes(L.blocks(table(spark, sf, "ocr_pages")), _nodes(spark, sf))


def stage_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes after the node stage, their readings not yet aligned."""
    n = fusion.stage_nodes(L.blocks(table(spark, sf, "ocr_pages")), _nodes(spark, sf), fuse_texts=False)
    return n.select("page_id", F.col("node_index").cast("bigint").alias("node_index"), "ref", "x0", "y0", "x1", "y1", F.col("text_len").cast("bigint").alias("text_len"), "text")


def stage_nodes_fused(spark: SparkSession, sf: str) -> DataFrame:
    """The node stage with aligned fusion."""
    return fusion.stage_nodes(L.blocks(table(spark, sf, "ocr_pages")), _nodes(spark, sf))


def grounding_box_match_last(spark: SparkSession, sf: str) -> DataFrame:
    n = _nodes(spark, sf)
    return J.match_boxes(n, L.blocks(table(spark, sf, "ocr_pages")), last=True).select("page_id", "box_no", F.col("node_index").cast("bigint").alias("node_index"))


def grounding_token_match(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes whose own numbers are tokens of the raw output, with the segment's text."""
    return J.match_tokens(grounding.parse(_pages(spark, sf)), L.blocks(table(spark, sf, "ocr_pages")))


def curpage_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Page-wise pipeline: boundary merge over pages, packing, ids."""
    c = pipelines.curpage_chunks(L.blocks(table(spark, sf, "ocr_pages")))
    return c.select("doc_key", "id", "section", "chunk_no", "page", F.col("n_items").cast("bigint").alias("n_items"), "content")


def boundary_merge(spark: SparkSession, sf: str) -> DataFrame:
    m = L.boundary_merged(L.blocks(table(spark, sf, "ocr_pages")))
    return m.select("page_id", "box_no", F.col("n_nodes").cast("bigint").alias("n_nodes"), "label", "content")


def made_up_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks without the texts that a model is known to make up."""
    return L.without_texts(L.blocks(table(spark, sf, "ocr_pages")), [MADE_UP]).select("box_key")


def toc_breaks_glued(spark: SparkSession, sf: str) -> DataFrame:
    """Contents lines broken behind dotted numbers and before headings glued to a number."""
    return L.blocks(table(spark, sf, "ocr_pages")).select("box_key", X.contents_breaks(F.col("text"), glued=True).alias("out"))


def chunk_flat(spark: SparkSession, sf: str) -> DataFrame:
    """Flat chunks by group and node: page, length, box on the 1000 grid."""
    c = L.flattened_chunks(latest(table(spark, sf, "chunks"), "chunk_id", "processed_at"))
    g = c.select("chunk_id", F.posexplode("boxs").alias("group_no", "gb"), "pages", "nodes_text_len")
    n = g.select("chunk_id", "group_no", F.posexplode("gb").alias("node_no", "b"), F.get("pages", "group_no").alias("p"), F.get("nodes_text_len", "group_no").alias("l"))
    at = lambda i: F.get("b", F.lit(i))
    return n.select("chunk_id", F.col("group_no").cast("bigint").alias("group_no"), F.col("node_no").cast("bigint").alias("node_no"), F.get("p", "node_no").alias("page"), F.get("l", "node_no").alias("text_len"), at(0).alias("x0"), at(1).alias("y0"), at(2).alias("x1"), at(3).alias("y1"))


def nodes_1024(spark: SparkSession, sf: str) -> DataFrame:
    """Merged paragraphs with the boxes of their nodes on the 1024 grid, one row a node."""
    b = L.blocks(table(spark, sf, "ocr_pages"))
    p = pipelines.nodes_1024(b, L.document_islands(b)).select("doc_key", "head_page", "head_no", F.posexplode(F.arrays_zip("nodes_text_len", "boxs", "pages", "ref")).alias("node_no", "n"))
    at = lambda i: F.get("n.boxs", F.lit(i))
    return p.select("doc_key", "head_page", "head_no", F.col("node_no").cast("bigint").alias("node_no"), F.col("n.pages").alias("page"), F.col("n.ref").alias("ref"), F.col("n.nodes_text_len").cast("bigint").alias("text_len"), at(0).alias("x0"), at(1).alias("y0"), at(2).alias("x1"), at(3).alias("y1"))


def tokens_in_time(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of the books' keys, read within their time and after it."""
    key, now = F.lit("0123456789abcdef"), F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    t = table(spark, sf, "book_files").select("file_md5").distinct().withColumn("t", X.expiring_token(F.col("file_md5"), key, now))
    later = lambda days: F.to_timestamp(F.lit(f"2026-01-0{1 + days} 00:00:00"))
    return t.select("file_md5", X.valid_token(F.col("t"), key, later(2)).alias("in_time"), X.valid_token(F.col("t"), key, later(3)).alias("late"), X.valid_token(F.concat(F.lit("x"), F.col("t")), key, now).alias("foreign"))


def queries() -> dict:
    own = (stage_boxes, stage_boxes_fused, stage_nodes, stage_nodes_fused, grounding_box_match_last, grounding_token_match, curpage_chunks, boundary_merge, made_up_texts, toc_breaks_glued, chunk_flat, nodes_1024, tokens_in_time)
    return {f.__name__: f for f in own}


#: Nodes with pixels, and boxes, of one delivery of each page.
_STAGE = _NODES + """,
nx as (select page_id, node_index, ref, text, cast(trunc(d0 / 999.0 * w) as int) x0, cast(trunc(d1 / 999.0 * h) as int) y0, cast(trunc(d2 / 999.0 * w) as int) x1, cast(trunc(d3 / 999.0 * h) as int) y1, d0, d1, d2, d3 from v where w is not null and h is not null),
""" + _B.replace("with pg as", "pb as").replace("from pg", "from pb")
_SIGNED = """case when contains(raw, '<table><tr><td>') then raw else translate(case when bt = '' then raw when label = 'title' then chr(13) || chr(10) || '#' || bt when label = 'sub_title' then chr(13) || chr(10) || '##' || bt when label = 'image' then chr(13) || chr(10) else bt end, chr(8195) || chr(7) || chr(1), '   ') end"""
_PAIRED = _B.replace("with pg", "with recursive pg") + """,
ln as (select doc_key, page, page_id, box_no, label, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{blank}+|{blank}+$', '', 'g')), lambda x: x <> '') ls, row_number() over (partition by doc_key order by page, page_id, box_no) k from b where text <> ''),
e as (select ln.*, lead(page_id) over w np, lead(ls) over w nl from ln window w as (partition by doc_key order by k)),
ed as (select *, coalesce(np <> page_id and len(ls) > 0 and len(nl) > 0 and not starts_with(nl[1], '#') and not regexp_matches(nl[1], '^第[\\p{Nd}一二三四五六七八九十百]+[章节篇]') and not regexp_matches(ls[-1], '[。！？!?]$') and length(ls[-1]) > 6, false) edge from e),
tk as (select doc_key, k, edge taken from ed where k = 1
  union all select ed.doc_key, ed.k, ed.edge and not tk.taken from tk join ed on ed.doc_key is not distinct from tk.doc_key and ed.k = tk.k + 1),
mg as (select ed.*, tk.taken, coalesce(lag(tk.taken) over (partition by ed.doc_key order by ed.k), false) is_second from ed join tk on tk.doc_key is not distinct from ed.doc_key and tk.k = ed.k),
bm as (select a.doc_key, a.page, a.page_id, a.box_no, a.label, a.text || case when a.taken then chr(10) || z.text else '' end content, case when a.taken then 2 else 1 end n_nodes from mg a left join mg z on a.taken and z.doc_key is not distinct from a.doc_key and z.k = a.k + 1 where not a.is_second)
""".replace("{blank}", r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def oracle_sql() -> dict[str, str]:
    return {
        "stage_boxes": _STAGE + f""",
fb as (select page_id, x0, y0, x1, y1, min(box_no) box_no from b group by all),
lr as (select page_id, x0, y0, x1, y1, arg_max(text, node_index) raw from nx group by page_id, x0, y0, x1, y1),
fx as (select fb.page_id, fb.box_no, lr.raw from fb join lr using (page_id, x0, y0, x1, y1)),
jn as (select b.page_id, b.box_no, b.label, b.text bt, fx.raw from b left join fx on fx.page_id = b.page_id and fx.box_no = b.box_no)
select page_id, box_no, label, case when raw is null then bt else {_SIGNED} end as text from jn""",
        "stage_nodes": _STAGE + f""",
lb as (select page_id, x0, y0, x1, y1, arg_max(label, box_no) label, arg_max(text, box_no) bt from b group by page_id, x0, y0, x1, y1),
jn as (select nx.page_id, node_index, ref, nx.x0, nx.y0, nx.x1, nx.y1, nx.text raw, label, bt from nx left join lb on lb.page_id = nx.page_id and lb.x0 = nx.x0 and lb.y0 = nx.y0 and lb.x1 = nx.x1 and lb.y1 = nx.y1),
t as (select *, case when bt is null then '' else {_SIGNED} end tx from jn)
select page_id, node_index, ref, x0, y0, x1, y1, cast(length(tx) as bigint) text_len, tx as text from t""",
        "grounding_box_match_last": _STAGE + "select b.page_id, b.box_no, max(nx.node_index) node_index from b join nx using (page_id, x0, y0, x1, y1) group by b.page_id, b.box_no",
        "grounding_token_match": _STAGE + "select b.page_id, b.box_no, arg_min(v.text, v.node_index) as text from b join v on v.page_id = b.page_id and v.d0 = b.x0 and v.d1 = b.y0 and v.d2 = b.x1 and v.d3 = b.y1 group by b.page_id, b.box_no",
        "boundary_merge": _PAIRED + "select page_id, box_no, n_nodes, label, content from bm",
        "curpage_chunks": pack_sql(_PAIRED + ", it as (select doc_key, page, page_id, box_no, content from bm)", 1) + """,
ch as (select doc_key, cast(section as bigint) section, chunk_no, arg_min(page, rn) page, count(*) n_items, ltrim(string_agg(content, chr(10) order by rn), chr(10)) content from z group by doc_key, section, chunk_no)
select doc_key, cast(row_number() over (partition by doc_key order by section, chunk_no) as int) id, section, chunk_no, page, n_items, content from ch""",
        "made_up_texts": _B + "select box_key from b where text <> '本节提要'",
        "toc_breaks_glued": _B + """, m as (select box_key, replace(regexp_replace(regexp_replace(text, '([.。…]{2,}[\\s\\x{3000}]*\\p{Nd}+)', '\\1' || chr(1), 'g'), chr(1) || '([\\n\\r])', '\\1', 'g'), chr(1), chr(10)) r from s),
g as (select box_key, regexp_replace(regexp_replace(r, '(\\p{Nd})[\\s\\x{3000}\\x{A0}]+([第#])', '\\1' || chr(10) || '\\2', 'g'), '(\\p{Nd})([第#])', '\\1' || chr(10) || '\\2', 'g') r from m)
select box_key, replace(r, chr(10) || chr(10), chr(10)) as out from g""",
        "chunk_flat": """with c as (select distinct on (chunk_id) chunk_id, coalesce(nullif(image_dims[1][1].w, 0), 1000) w, coalesce(nullif(image_dims[1][1].h, 0), 1000) h, boxs, pages, nodes_text_len from chunks),
g as (select *, unnest(range(len(boxs))) gi from c),
n as (select *, unnest(range(len(boxs[gi + 1]))) ni, coalesce(len(nodes_text_len[gi + 1]), 0) k from g where boxs[gi + 1] is not null),
x as (select *, boxs[gi + 1][ni + 1] bb from n),
y as (select *, len(bb) = 4 and len(list_filter(bb, lambda q: q is null)) = 0 ok from x)
select chunk_id, cast(gi as bigint) group_no, cast(ni as bigint) node_no,
  case when pages is null or gi >= len(pages) then null when coalesce(len(pages[gi + 1]), 0) = k then pages[gi + 1][ni + 1] when ni < k then coalesce(pages[gi + 1][1], '1') end page, nodes_text_len[gi + 1][ni + 1] text_len,
  case when ok then cast(round_even(bb[1] * 1000.0 / w, 0) as int) else bb[1] end x0, case when ok then cast(round_even(bb[2] * 1000.0 / h, 0) as int) else bb[2] end y0,
  case when ok then cast(round_even(bb[3] * 1000.0 / w, 0) as int) else bb[3] end x1, case when ok then cast(round_even(bb[4] * 1000.0 / h, 0) as int) else bb[4] end y1 from y""",
        "tokens_in_time": "select distinct file_md5, file_md5 in_time, cast(null as varchar) late, cast(null as varchar) \"foreign\" from book_files",
    }
