"""Queries of the layout operators over the project's pages, chunks and mappings, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import text as X
from pagewright.operators import joins as J
from pagewright.operators import layout as L
from pagewright.operators.deliveries import latest
from pagewright.sources import grounding
from pagewright.session import table


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    return L.blocks(table(spark, sf, "ocr_pages"))


def layout_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _blocks(spark, sf).select("box_key", "doc_key", "page", "box_no", "label", "x0", "y0", "x1", "y1", F.length("text").alias("text_len"))


def inpage_merge(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    joined = b.join(L.page_islands(b), ["page_id", "box_no"])
    nodes = F.array_sort(F.collect_list(F.struct("box_no", X.label_prefix(F.col("label"), F.col("text")).alias("t"))))
    return joined.groupBy("page_id", "head_no").agg(F.count(F.lit(1)).alias("n_nodes"), F.array_join(F.transform(nodes, lambda n: n["t"]), "\n").alias("content"))


def crosspage_merge(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    return L.paragraphs(b, L.document_islands(b)).select("doc_key", "head_page_id", "head_no", F.col("n_nodes").cast("bigint").alias("n_nodes"), "content")


def crosspage_merge_plain(spark: SparkSession, sf: str) -> DataFrame:
    """The merge without a condition on labels."""
    b = _blocks(spark, sf)
    return L.paragraphs(b, L.document_islands(b, plain=True)).select("doc_key", "head_page_id", "head_no", F.col("n_nodes").cast("bigint").alias("n_nodes"), "content")


def chunk_pack(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: pages to merged paragraphs to chunks of at most 1,024 characters."""
    return L.packed_chunks(_blocks(spark, sf)).select("doc_key", "section", "chunk_no", "page", F.col("n_items").cast("bigint").alias("n_items"), "content")


def chunk_pack_v3(spark: SparkSession, sf: str) -> DataFrame:
    """Packing that doesn't count the breaks between items."""
    return L.packed_chunks(_blocks(spark, sf), glue=0).select("doc_key", "section", "chunk_no", F.col("n_items").cast("bigint").alias("n_items"), F.length("content").alias("content_len"))


def boxed_merge(spark: SparkSession, sf: str) -> DataFrame:
    m = L.boxed_merge(table(spark, sf, "ocr_pages"))
    return m.select("page_id", "head_no", F.col("n_boxes").cast("bigint").alias("n_boxes"), *[F.get("box", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))], "content")


def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return L.page_texts(_blocks(spark, sf)).select("page_id", F.col("n_nodes").cast("bigint").alias("n_nodes"), F.col("page_text_len").cast("bigint").alias("page_text_len"), "box_text")


def page_merge(spark: SparkSession, sf: str) -> DataFrame:
    return L.page_merge(L.page_texts(_blocks(spark, sf))).select("doc_key", "head_page_id", "first_page", "n_pages", F.col("text_len").cast("bigint").alias("text_len"))


def boundary_pair_merge(spark: SparkSession, sf: str) -> DataFrame:
    return L.boundary_pairs(_blocks(spark, sf).filter("text <> ''"))


def reading_order(spark: SparkSession, sf: str) -> DataFrame:
    return L.reading_order(_blocks(spark, sf)).select("page_id", "box_no", F.col("segment").cast("bigint").alias("segment"), F.col("column_no").cast("bigint").alias("column_no"), F.col("order_no").cast("bigint").alias("order_no"))


def md_line_index(spark: SparkSession, sf: str) -> DataFrame:
    return L.line_index(_blocks(spark, sf)).select("page_id", "box_no", F.col("md_line_index").cast("bigint").alias("md_line_index"))


def node_index_ranges(spark: SparkSession, sf: str) -> DataFrame:
    groups = inpage_merge(spark, sf).select("page_id", "head_no", "n_nodes")
    return L.node_ranges(groups, ["page_id"], ["head_no"], "n_nodes").select("page_id", "head_no", F.col("first_index").cast("bigint").alias("first_index"), F.array_join("node_index", ",").alias("node_index"))


def para_page_number(spark: SparkSession, sf: str) -> DataFrame:
    """Pages counted by breaks: titles open a page here, as a document's page breaks do."""
    p = _blocks(spark, sf).filter("doc_key is not null").select("doc_key", "box_key", (F.col("label") == "title").alias("brk"))
    return L.page_numbers_from_breaks(p, "doc_key", "box_key", "brk").select("box_key", F.col("page_no").cast("bigint").alias("page_no"))


def union_box(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    joined = b.join(L.page_islands(b), ["page_id", "box_no"])
    return joined.groupBy("page_id", "head_no").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def box_rescale_1024(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf).filter("w > 0 and h > 0")
    return b.select("box_key", *[G.grid(F.col(c), F.col(s), 1024).alias(c) for c, s in (("x0", "w"), ("y0", "h"), ("x1", "w"), ("y1", "h"))])


def chunk_box_flatten_1000(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of a chunk's groups as one list on the 1000 grid of its first page."""
    c = latest(table(spark, sf, "chunks"), "chunk_id", "processed_at")
    dims = F.get(F.get("image_dims", F.lit(0)), F.lit(0))
    rows = c.select("chunk_id", dims["w"].alias("w"), dims["h"].alias("h"), F.posexplode(F.flatten(F.filter("boxs", lambda g: g.isNotNull()))).alias("n", "b")).filter("w > 0 and h > 0 and b is not null")
    at = lambda i, s: G.grid(F.get("b", F.lit(i)), F.col(s), 1000)
    return rows.select("chunk_id", F.col("n").cast("bigint").alias("n"), at(0, "w").alias("x0"), at(1, "h").alias("y0"), at(2, "w").alias("x1"), at(3, "h").alias("y1"))


def grounding_parse(spark: SparkSession, sf: str) -> DataFrame:
    return grounding.parse(latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at")).select("page_id", F.col("node_index").cast("bigint").alias("node_index"), "ref", "d0", "d1", "d2", "d3", "text")


def det_scale_999(spark: SparkSession, sf: str) -> DataFrame:
    n = grounding.parse(latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at")).filter("w is not null and h is not null")
    return n.select("page_id", F.col("node_index").cast("bigint").alias("node_index"), *[G.det_to_pixel(F.col(c), F.col(s)).alias(f"p{i}") for i, (c, s) in enumerate((("d0", "w"), ("d1", "h"), ("d2", "w"), ("d3", "h")))])


def grounding_box_match(spark: SparkSession, sf: str) -> DataFrame:
    n = grounding.parse(latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at")).filter("w is not null and h is not null")
    return J.match_boxes(n, _blocks(spark, sf)).select("page_id", "box_no", F.col("node_index").cast("bigint").alias("node_index"))


def spatial_text_join(spark: SparkSession, sf: str) -> DataFrame:
    """Text-layer blocks of the mapping whose centre lies in a box (5 pixels wider), at two pixels a point."""
    return J.spatial_text(_blocks(spark, sf), J.mapping_blocks(table(spark, sf, "mapping_rows")))


def chunk_refill(spark: SparkSession, sf: str) -> DataFrame:
    return J.refill(table(spark, sf, "chunks"), J.mapping_blocks(table(spark, sf, "mapping_rows")))


def search_hits(spark: SparkSession, sf: str) -> DataFrame:
    return J.search(table(spark, sf, "mapping_rows"), _blocks(spark, sf), "档案")


def region_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text of the upper half of each page's left part, in reading order of the mapping."""
    return J.region(J.mapping_blocks(table(spark, sf, "mapping_rows")), (0.0, 0.0, 800.0, 900.0))


def table_overlap_anti(spark: SparkSession, sf: str) -> DataFrame:
    return J.without_tables(_blocks(spark, sf)).select("box_key")


def pending_work(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of scans for which the text layer has no rows yet."""
    work = table(spark, sf, "ocr_pages").select("doc_key", "page").filter("doc_key is not null and page is not null").distinct()
    return J.pending(work, table(spark, sf, "mapping_rows"), ["doc_key", "page"])


def text_layer_pages(spark: SparkSession, sf: str) -> DataFrame:
    """OCR pages with their text-layer pages, where there is one (left) by book and page."""
    pages = latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at").select("page_id", "doc_key", "page")
    return J.pages_with_text_layer(pages, J.mapping_blocks(table(spark, sf, "mapping_rows")))


def queries() -> dict:
    own = (layout_blocks, inpage_merge, crosspage_merge, crosspage_merge_plain, chunk_pack, chunk_pack_v3, boxed_merge, page_text, page_merge, boundary_pair_merge, reading_order, md_line_index, node_index_ranges, para_page_number, union_box, box_rescale_1024, chunk_box_flatten_1000, grounding_parse, det_scale_999, grounding_box_match, spatial_text_join, chunk_refill, search_hits, region_text, table_overlap_anti, pending_work, text_layer_pages)
    return {f.__name__: f for f in own}


# Fixed values, as the SQL has them for itself: blanks, sentence marks, closing signs, titles.
_BLANK = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_TERMINAL = "。！？!?…:：；;"
_CLOSERS = "”’\"''》>】]"
_TITLE = r"^第[\p{Nd}一二三四五六七八九十百]+[章节篇]"
_B = f"""
with pg as (select distinct on (page_id) page_id, doc_key, page, image_dims.w w, image_dims.h h, boxes, raw_text from ocr_pages),
bx as (select page_id, doc_key, page, w, h, unnest(boxes) b, generate_subscripts(boxes, 1) - 1 box_no from pg),
b as (select page_id, doc_key, page, cast(box_no as int) box_no, page_id * 100 + box_no box_key, w, h, coalesce(b.label, '') label,
  b.box[1] x0, b.box[2] y0, b.box[3] x1, b.box[4] y1, coalesce(b.text_content, '') as text from bx),
s as (select *, regexp_replace(text, '^{_BLANK}+|{_BLANK}+$', '', 'g') st, label in ('text', 'sub_title', 'title') is_text from b),
k as (select *, case when length(st) > 1 and contains('{_CLOSERS}', right(st, 1)) then substr(st, length(st) - 1, 1) else right(st, 1) end lc,
  case when st = '' then '' when label = 'title' then '# ' || text when label = 'sub_title' then '## ' || text else text end pt
  from s where not is_text or st <> ''),
c as (select *, lc <> '' and not contains('{_TERMINAL}', lc) cut from k)
"""
_INPAGE = _B + """,
o as (select *, sum(case when is_text then 0 else 1 end) over (partition by page_id order by box_no) others from c),
t as (select *, lag(label) over w pl, lag(cut) over w pc, lag(x0) over w px0, lag(y1) over w py1, lag(others) over w po, row_number() over w rn from o where is_text window w as (partition by page_id order by box_no)),
j as (select *, rn > 1 and label = 'text' and pl = 'text' and pc and (abs(coalesce(px0,0) - coalesce(x0,0)) > coalesce(w,1024) * 0.05 or coalesce(py1,0) > coalesce(h,1024) * 0.85 or others > po) joins from t),
i as (select *, max(case when not coalesce(joins, false) then box_no end) over (partition by page_id order by box_no) head_no from j)
"""


def _cross(plain: bool) -> str:
    same = "true" if plain else "label = 'text' and pl = 'text'"
    return _B + f""",
t as (select *, lag(label) over w pl, lag(cut) over w pc, row_number() over w rn from c where is_text window w as (partition by doc_key order by page, page_id, box_no)),
j as (select *, rn > 1 and {same} and pc joins from t),
i as (select *, sum(case when coalesce(joins, false) then 0 else 1 end) over (partition by doc_key order by page, page_id, box_no) g from j),
para as (select doc_key, g, min(struct_pack(page := page, page_id := page_id, box_no := box_no)) hd, count(*) n_nodes, string_agg(pt, chr(10) order by page, page_id, box_no) content from i group by doc_key, g)
"""


def pack_sql(before: str, glue: int) -> str:
    """Greedy packing of the items that ``before`` ends with, as ``it``."""
    used = f"p.used + (case when p.used > 0 then {glue} else 0 end)"
    return before + f""",
f as (select *, contains(content, '<table>') alone, length(content) n, row_number() over (partition by doc_key order by page, page_id, box_no) rn from it),
g as (select *, alone or starts_with(content, '#') or coalesce(lag(alone) over (partition by doc_key order by rn), false) opens from f),
x as (select *, sum(case when opens then 1 else 0 end) over (partition by doc_key order by rn) section from g),
y as (select *, row_number() over (partition by doc_key, section order by rn) k from x),
p as (select doc_key, section, k, cast(0 as bigint) chunk_no, cast(n as bigint) used from y where k = 1
  union all select y.doc_key, y.section, y.k, case when {used} + y.n <= 1024 then p.chunk_no else p.chunk_no + 1 end, case when {used} + y.n <= 1024 then {used} + y.n else y.n end
  from p join y on p.doc_key is not distinct from y.doc_key and p.section = y.section and y.k = p.k + 1),
z as (select y.*, p.chunk_no from y join p on p.doc_key is not distinct from y.doc_key and p.section = y.section and p.k = y.k)
"""


def _pack(glue: int) -> str:
    items = ", it as (select doc_key, hd.page page, hd.page_id page_id, hd.box_no box_no, content from para union all select doc_key, page, page_id, box_no, pt from c where not is_text)"
    return pack_sql(_cross(False).replace("with pg", "with recursive pg") + items, glue)


_FORMS = r"^第[一二三四五六七八九十百千万\p{Nd}]+[章节篇部分条款]|^[一二三四五六七八九十]+[、，\.]|^\([一二三四五六七八九十]+\)|^（[一二三四五六七八九十]+）|^\p{Nd}+\.|^\(\p{Nd}+\)|^（\p{Nd}+）"


def _boxed() -> str:
    """The boxed merge as a recursion over the boxes of a page: own is the group that a box opens or joins."""
    strip = lambda x: f"regexp_replace({x}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"
    broken = f"replace(replace(regexp_replace(regexp_replace({strip('text')}, '([.。…]{{2,}}[\\s\\x{{3000}}]*\\p{{Nd}}+)', '\\1' || chr(1), 'g'), chr(1) || '([\\n\\r])', '\\1', 'g'), chr(1), chr(10)), chr(10) || chr(10), chr(10))"
    last = lambda x: f"case when length({x}) > 1 and contains('{_CLOSERS}', right({x}, 1)) then substr({x}, length({x}) - 1, 1) else right({x}, 1) end"
    cut = f"({last(strip('r.t'))}) <> '' and not contains('{_TERMINAL}', {last(strip('r.t'))})"
    title = lambda x: f"(starts_with({strip(x)}, '#') or regexp_matches({strip(x)}, '{_FORMS}'))"
    joins = f"(r.open and {cut} and not {title('r.t')} and not {title('n.t')} and (abs(r.x0 - coalesce(n.x0, 0)) > n.w * 0.05 or r.y1 > n.h * 0.85 or r.parted))"
    return _B.replace("with pg", "with recursive pg") + f""",
n0 as (select page_id, box_no, label, coalesce(w, 1024) w, coalesce(h, 1024) h, x0, y0, x1, y1, {broken} t from b),
n as (select *, label in ('text', 'sub_title') is_t, row_number() over (partition by page_id order by box_no) k from n0 where label not in ('text', 'sub_title') or t <> ''),
r as (select page_id, k, case when is_t then 1 else 0 end g, is_t open, case when is_t then 1 end own, coalesce(x0, 0) x0, coalesce(y1, 0) y1, case when is_t then t else '' end t, not is_t and label <> 'title' parted from n where k = 1
  union all
  select n.page_id, n.k, case when n.is_t and not j then r.g + 1 else r.g end, case when n.is_t then true when n.label = 'title' then false else r.open end, case when n.is_t and j then r.g when n.is_t then r.g + 1 end,
    case when n.is_t and j then least(r.x0, coalesce(n.x0, 0)) when n.is_t then coalesce(n.x0, 0) else r.x0 end, case when n.is_t and j then greatest(r.y1, coalesce(n.y1, 0)) when n.is_t then coalesce(n.y1, 0) else r.y1 end,
    case when n.is_t and j then r.t || n.t when n.is_t then n.t else r.t end, case when n.is_t or n.label = 'title' then false else true end
  from r join n on n.page_id = r.page_id and n.k = r.k + 1, lateral (select coalesce({joins}, false) j) j)
select n.page_id, min(n.box_no) head_no, count(*) n_boxes, min(n.x0) x0, min(n.y0) y0, max(n.x1) x1, max(n.y1) y1, string_agg(n.t, '' order by n.k) as content from r join n on n.page_id = r.page_id and n.k = r.k where r.own is not null group by n.page_id, r.own
"""


_NODES = f"""
with pg as (select distinct on (page_id) page_id, image_dims.w w, image_dims.h h, raw_text from ocr_pages where raw_text is not null),
sg as (select page_id, w, h, unnest(string_split(raw_text, '<|ref|>')[2:]) s, generate_subscripts(string_split(raw_text, '<|ref|>')[2:], 1) sn from pg),
m as (select page_id, w, h, sn, regexp_extract(s, '(?s)^(.*?)<\\|/ref\\|>.*?<\\|det\\|>\\[\\[(.*?)\\]\\]<\\|/det\\|>(.*)$', ['ref', 'det', 'txt']) r from sg),
n as (select page_id, w, h, sn, r.ref as ref, list_transform(string_split(r.det, ','), lambda x: try_cast(trim(x) as int)) d, regexp_replace(r.txt, '^{_BLANK}+|{_BLANK}+$', '', 'g') txt from m where r.det <> ''),
v as (select page_id, w, h, ref, d[1] d0, d[2] d1, d[3] d2, d[4] d3, txt as text, row_number() over (partition by page_id order by sn) - 1 node_index from n where len(d) = 4 and len(list_filter(d, lambda x: x is null)) = 0)
"""
_MAP = """
with mr as (select distinct on (map_id) * from mapping_rows),
mb as (select map_id, doc_key, page, md_line_index, bbox[1] * 2.0 x0, bbox[2] * 2.0 y0, bbox[3] * 2.0 x1, bbox[4] * 2.0 y1, text from mr where len(bbox) = 4)
"""


def oracle_sql() -> dict[str, str]:
    mapb = _MAP + _B.replace("with pg", ", pg", 1)
    return {
        "layout_blocks": _B + "select box_key, doc_key, page, box_no, label, x0, y0, x1, y1, cast(length(text) as int) text_len from b",
        "inpage_merge": _INPAGE + "select page_id, head_no, count(*) n_nodes, string_agg(pt, chr(10) order by box_no) content from i group by page_id, head_no",
        "crosspage_merge": _cross(False) + "select doc_key, hd.page_id head_page_id, hd.box_no head_no, n_nodes, content from para",
        "crosspage_merge_plain": _cross(True) + "select doc_key, hd.page_id head_page_id, hd.box_no head_no, n_nodes, content from para",
        "chunk_pack": _pack(1) + "select doc_key, cast(section as bigint) section, chunk_no, arg_min(page, rn) page, count(*) n_items, ltrim(string_agg(content, chr(10) order by rn), chr(10)) content from z group by doc_key, section, chunk_no",
        "chunk_pack_v3": _pack(0) + "select doc_key, cast(section as bigint) section, chunk_no, count(*) n_items, cast(length(ltrim(string_agg(content, chr(10) order by rn), chr(10))) as int) content_len from z group by doc_key, section, chunk_no",
        "boxed_merge": _boxed(),
        "page_text": _B + ", q as (select page_id, count(*) n_nodes, coalesce(string_agg(nullif(text, ''), chr(10) order by box_no), '') box_text from b group by page_id) select page_id, n_nodes, length(box_text) page_text_len, box_text from q",
        "page_merge": _B.replace("with pg", "with recursive pg") + f""",
q as (select doc_key, page, page_id, coalesce(string_agg(nullif(text, ''), chr(10) order by box_no), '') tx from b group by doc_key, page, page_id),
ln as (select *, list_filter(list_transform(string_split(tx, chr(10)), lambda x: regexp_replace(x, '^{_BLANK}+|{_BLANK}+$', '', 'g')), lambda x: x <> '') ls, row_number() over (partition by doc_key order by page, page_id) k from q),
r as (select doc_key, k, page_id, page, tx, len(ls) nl, ls[-1] cur, page_id head, page hp from ln where k = 1
  union all select ln.doc_key, ln.k, ln.page_id, ln.page, ln.tx, len(ln.ls), case when j.j and len(ln.ls) = 1 then r.cur || ln.ls[1] else ln.ls[-1] end, case when j.j then r.head else ln.page_id end, case when j.j then r.hp else ln.page end
  from r join ln on ln.doc_key is not distinct from r.doc_key and ln.k = r.k + 1,
  lateral (select coalesce(len(ln.ls) > 0 and r.nl > 0 and not starts_with(ln.ls[1], '#') and not regexp_matches(ln.ls[1], '{_TITLE}') and not regexp_matches(r.cur, '[。！？!?]$') and length(r.cur) > 6, false) j) j)
select doc_key, head head_page_id, hp first_page, count(*) n_pages, cast(sum(length(tx)) as bigint) text_len from r group by doc_key, head, hp""",
        "boundary_pair_merge": _B.replace("with pg", "with recursive pg") + f""",
ln as (select doc_key, page_id, box_no, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{_BLANK}+|{_BLANK}+$', '', 'g')), lambda x: x <> '') ls, row_number() over (partition by doc_key order by page, page_id, box_no) k from b where text <> ''),
e as (select ln.*, lead(page_id) over w np, lead(box_no) over w nn, lead(ls) over w nl from ln window w as (partition by doc_key order by k)),
f as (select *, coalesce(np <> page_id and len(ls) > 0 and len(nl) > 0 and not starts_with(nl[1], '#') and not regexp_matches(nl[1], '{_TITLE}') and not regexp_matches(ls[-1], '[。！？!?]$') and length(ls[-1]) > 6, false) edge from e),
r as (select doc_key, k, page_id, box_no, np, nn, edge taken from f where k = 1
  union all select f.doc_key, f.k, f.page_id, f.box_no, f.np, f.nn, f.edge and not r.taken from r join f on f.doc_key is not distinct from r.doc_key and f.k = r.k + 1)
select doc_key, page_id, box_no, np next_page_id, nn next_no from r where taken""",
        "reading_order": _B + """,
e as (select page_id, box_no, y0, (x0 + x1) / 2.0 cx, (x1 - x0) > coalesce(w, 1024) * 0.75 wide, coalesce(w, 1024) w from b where x0 is not null and y0 is not null and x1 is not null),
f as (select *, 2 * sum(case when wide then 1 else 0 end) over (partition by page_id order by y0, box_no) - case when wide then 1 else 0 end segment from e),
g as (select *, case when abs(cx - lag(cx) over (partition by page_id, segment order by cx, y0, box_no)) > w * 0.15 then 1 else 0 end gap from f),
h as (select *, sum(gap) over (partition by page_id, segment order by cx, y0, box_no) column_no from g)
select page_id, box_no, cast(segment as bigint) segment, cast(column_no as bigint) column_no, row_number() over (partition by page_id order by segment, column_no, y0, cx, box_no) order_no from h""",
        "md_line_index": _B + "select page_id, box_no, cast(coalesce(sum(length(text) - length(replace(text, chr(10), '')) + 2) over (partition by doc_key order by page, page_id, box_no rows between unbounded preceding and 1 preceding), 0) as bigint) md_line_index from b where text <> ''",
        "node_index_ranges": _INPAGE + """, q as (select page_id, head_no, count(*) n from i group by page_id, head_no),
r as (select *, cast(coalesce(sum(n) over (partition by page_id order by head_no rows between unbounded preceding and 1 preceding), 0) as bigint) f from q)
select page_id, head_no, f first_index, array_to_string(range(f, f + n), ',') node_index from r""",
        "para_page_number": _B + "select box_key, cast(1 + sum(case when label = 'title' then 1 else 0 end) over (partition by doc_key order by box_key) as bigint) page_no from b where doc_key is not null",
        "union_box": _INPAGE + "select page_id, head_no, min(x0) x0, min(y0) y0, max(x1) x1, max(y1) y1 from i group by page_id, head_no",
        "box_rescale_1024": _B + "select box_key, cast(round_even(x0 * 1024.0 / w, 0) as int) x0, cast(round_even(y0 * 1024.0 / h, 0) as int) y0, cast(round_even(x1 * 1024.0 / w, 0) as int) x1, cast(round_even(y1 * 1024.0 / h, 0) as int) y1 from b where w > 0 and h > 0",
        "chunk_box_flatten_1000": """with c as (select distinct on (chunk_id) chunk_id, image_dims[1][1].w w, image_dims[1][1].h h, flatten(list_filter(boxs, lambda g: g is not null)) f from chunks),
e as (select chunk_id, w, h, unnest(f) b, generate_subscripts(f, 1) - 1 n from c)
select chunk_id, cast(n as bigint) n, cast(round_even(b[1] * 1000.0 / w, 0) as int) x0, cast(round_even(b[2] * 1000.0 / h, 0) as int) y0, cast(round_even(b[3] * 1000.0 / w, 0) as int) x1, cast(round_even(b[4] * 1000.0 / h, 0) as int) y1 from e where w > 0 and h > 0 and b is not null""",
        "grounding_parse": _NODES + "select page_id, node_index, ref, d0, d1, d2, d3, text from v",
        "det_scale_999": _NODES + "select page_id, node_index, cast(trunc(d0 / 999.0 * w) as int) p0, cast(trunc(d1 / 999.0 * h) as int) p1, cast(trunc(d2 / 999.0 * w) as int) p2, cast(trunc(d3 / 999.0 * h) as int) p3 from v where w is not null and h is not null",
        "grounding_box_match": _NODES.replace("with pg as (select distinct on (page_id) page_id, image_dims.w w, image_dims.h h, raw_text", "with pg as (select distinct on (page_id) page_id, image_dims.w w, image_dims.h h, raw_text, boxes") + """,
bx as (select page_id, unnest(boxes) b, generate_subscripts(boxes, 1) - 1 box_no from pg),
s as (select page_id, node_index, trunc(d0 / 999.0 * w) p0, trunc(d1 / 999.0 * h) p1, trunc(d2 / 999.0 * w) p2, trunc(d3 / 999.0 * h) p3 from v where w is not null and h is not null)
select bx.page_id, cast(bx.box_no as int) box_no, min(s.node_index) node_index from bx join s on s.page_id = bx.page_id and s.p0 = b.box[1] and s.p1 = b.box[2] and s.p2 = b.box[3] and s.p3 = b.box[4] group by bx.page_id, bx.box_no""",
        "spatial_text_join": mapb + """select b.box_key, count(mb.map_id) n_blocks, coalesce(string_agg(mb.text, chr(10) order by mb.md_line_index, mb.map_id), '') as text
from b left join mb on mb.doc_key = b.doc_key and mb.page = b.page and (mb.x0 + mb.x1) / 2 between b.x0 - 5 and b.x1 + 5 and (mb.y0 + mb.y1) / 2 between b.y0 - 5 and b.y1 + 5 group by b.box_key""",
        "chunk_refill": _MAP + """,
c as (select distinct on (chunk_id) chunk_id, doc_key, pages, boxs, image_dims from chunks),
g as (select chunk_id, doc_key, unnest(boxs) gb, generate_subscripts(boxs, 1) g, pages, image_dims from c),
n as (select chunk_id, doc_key, g, unnest(gb) bb, generate_subscripts(gb, 1) n, pages[g] pp, image_dims[g] dd from g),
q as (select chunk_id, g, n, doc_key, try_cast(pp[n] as int) page, bb, dd[n].w w, dd[n].h h from n where len(bb) = 4),
t as (select q.chunk_id, q.g, q.n, mb.* exclude (doc_key, page) from q join mb on mb.doc_key = q.doc_key and mb.page = q.page and (mb.x0 + mb.x1) / 2 * 1024.0 / q.w between bb[1] and bb[3] and (mb.y0 + mb.y1) / 2 * 1024.0 / q.h between bb[2] and bb[4])
select chunk_id, cast(g - 1 as bigint) group_no, count(*) n_blocks, string_agg(text, chr(10) order by n, y0, x0, map_id) as text from t group by chunk_id, g""",
        "search_hits": mapb + """,
hit as (select * from mb where contains(lower(text), lower('档案'))),
cand as (select hit.map_id, hit.page, hit.x0, hit.y0, hit.x1, hit.y1, b.text bt, row_number() over (partition by hit.map_id order by b.box_no nulls last) rn from hit left join b on b.doc_key = hit.doc_key and b.page = hit.page and b.text <> '' and hit.y0 >= b.y0 - 5 and hit.y1 <= b.y1 + 5)
select map_id, page, x0, y0, x1, y1, coalesce(nullif(replace(regexp_replace(bt, '^{0}+|{0}+$', '', 'g'), chr(10), ' '), ''), '档案') as text, '档案' as query from cand where rn = 1""".replace("{0}", _BLANK),
        "region_text": _MAP + "select doc_key, page, string_agg(text, chr(10) order by md_line_index, map_id) as text from mb where x0 < 800 and x1 > 0 and y0 < 900 and y1 > 0 group by doc_key, page",
        "table_overlap_anti": _B + """select box_key from b where label <> 'table' and x0 is not null and x1 is not null and not exists (select 1 from b t where t.page_id = b.page_id and t.label = 'table'
and least(b.x1, t.x1) >= greatest(b.x0, t.x0) and least(b.y1, t.y1) >= greatest(b.y0, t.y0)
and (least(b.x1, t.x1) - greatest(b.x0, t.x0)) * (least(b.y1, t.y1) - greatest(b.y0, t.y0)) > 0.5 * (b.x1 - b.x0) * (b.y1 - b.y0))""",
        "pending_work": "select distinct doc_key, page from ocr_pages o where doc_key is not null and page is not null and not exists (select 1 from mapping_rows m where m.doc_key = o.doc_key and m.page = o.page)",
        "text_layer_pages": _MAP + ", pg as (select distinct on (page_id) page_id, doc_key, page from ocr_pages), lp as (select doc_key, page, count(*) n from mb group by doc_key, page) select pg.page_id, pg.doc_key, pg.page, coalesce(lp.n, 0) n_blocks from pg left join lp on lp.doc_key = pg.doc_key and lp.page = pg.page",
    }
