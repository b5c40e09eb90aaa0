"""Queries of the nested-record and schema-drift operators over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import drift, nested
from pagewright.session import table

PATHS = ["pages", "nodes_text_len", "boxs"]
#: The parallel arrays of a chunk: groups (paragraphs), their nodes, the numbers of a node's box.
CHUNK = nested.Aligned([*PATHS, "nodes_index", "image_dims"], ["groups", "nodes", "numbers"], ["group_no", "node_no", "number_no"])


def _related(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return nested.related(table(spark, sf, "chunks"), ["chunk_id"], [CHUNK], "chunks")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    flat = nested.flatten(table(spark, sf, "chunks"), ["chunk_id"], PATHS, 2, ["group_no", "node_no"])
    return nested.unequal_positions(flat, ["chunk_id", "group_no", "node_no"], PATHS)


def p5_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks: what they have outside arrays, and the lengths of their arrays."""
    return _related(spark, sf)["chunks"].distinct()


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of a chunk with the lengths that each parallel array has for them (null: it has none)."""
    return _related(spark, sf)["groups"].distinct()


def p5_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of a group with their page, length, index, size of page and length of box."""
    return _related(spark, sf)["nodes"].distinct()


def p5_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of nodes with their numbers as columns, pivoted from the numbers' own table."""
    n = _related(spark, sf)["numbers"].filter("boxs is not null")
    at = lambda i: F.max(F.when(F.col("number_no") == i, F.col("boxs")))
    return n.groupBy("chunk_id", "group_no", "node_no").agg(*[at(i).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))])


def p5_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The texts of a chunk, a repeated field of plain values."""
    return _related(spark, sf)["texts"].select("chunk_id", F.col("no_1").alias("text_no"), F.col("value").alias("text")).distinct()


def _page_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    pages = table(spark, sf, "ocr_pages").select("page_id", "image_dims", "boxes", "metadata", "prompt_type")
    return nested.related(pages, ["page_id"], [nested.Aligned(["boxes"], ["boxes"], ["box_no"])], "pages")


def p5_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with their objects' fields as columns and the number of their boxes; a page delivered twice counts once."""
    return _page_tables(spark, sf)["pages"].distinct()


def p5_page_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of pages, an array of objects."""
    t = _page_tables(spark, sf)["boxes"]
    return t.select("page_id", "box_no", F.col("boxes_label").alias("label"), F.col("n_boxes_box").alias("n_numbers"), F.md5("boxes_text_content").alias("text_md5")).distinct()


def p5_page_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """The numbers of the boxes of pages, an array below an array of objects."""
    return _page_tables(spark, sf)["boxes.box"].distinct()


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    found = drift.changes(table(spark, sf, "raw_page_records"))
    return found.select(F.col("file").alias("file_name"), "change_kind", "old_path", "new_path").distinct()


def p7_consistent(spark: SparkSession, sf: str) -> DataFrame:
    """All records of all streams in one table."""
    return drift.consistent(table(spark, sf, "raw_page_records"))


def p7_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The consistent table by record and field; a missing value is a row with null."""
    return drift.field_values(p7_consistent(spark, sf))


def p7_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Values of each path of the consistent table."""
    return drift.path_counts(p7_consistent(spark, sf))


def queries() -> dict:
    own = (p5_found, p5_chunks, p5_groups, p5_nodes, p5_boxes, p5_texts, p5_pages, p5_page_boxes, p5_page_numbers, p7_found, p7_consistent, p7_fields, p7_paths)
    return {f.__name__: f for f in own}


_ARRAYS = ("pages", "nodes_text_len", "boxs", "nodes_index", "image_dims")
_LONGEST = lambda prefix="": "greatest(" + ", ".join(f"coalesce(len({prefix}{a}), 0)" for a in _ARRAYS) + ")"
_POS = f"""
with c as (select distinct chunk_id, {', '.join(_ARRAYS)} from chunks),
g as (select *, unnest(range({_LONGEST()})) as gi from c),
n as (select chunk_id, cast(gi as bigint) group_no, {', '.join(f'{a}[gi + 1] {a}' for a in _ARRAYS)} from g),
u as (select *, unnest(range({_LONGEST()})) as ni from n),
v as (select chunk_id, group_no, cast(ni as bigint) node_no, {', '.join(f'{a}[ni + 1] {a}' for a in _ARRAYS)} from u),
w as (select *, pages is not null hp, nodes_text_len is not null hl, coalesce(len(list_filter(boxs, lambda x: x is not null)), 0) > 0 hb from v)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": _POS + "select distinct chunk_id, group_no, node_no from w where (hp or hl or hb) and not (hp and hl and hb)",
        "p5_chunks": "select distinct chunk_id, doc_key, id, type, content, page, processed_at, cast(len(texts) as int) n_texts, cast(len(ref) as int) n_ref, " + ", ".join(f"cast(len({a}) as int) n_{a}" for a in _ARRAYS) + " from chunks",
        "p5_groups": _POS + "select distinct chunk_id, group_no, " + ", ".join(f"cast(len({a}) as int) n_{a}" for a in _ARRAYS) + " from n",
        "p5_nodes": _POS + "select distinct chunk_id, group_no, node_no, pages, nodes_text_len, nodes_index, image_dims.w image_dims_w, image_dims.h image_dims_h, cast(len(boxs) as int) n_boxs from v",
        "p5_boxes": _POS + "select distinct chunk_id, group_no, node_no, boxs[1] x0, boxs[2] y0, boxs[3] x1, boxs[4] y1 from w where hb",
        "p5_texts": "select distinct chunk_id, cast(unnest(range(len(texts))) as bigint) text_no, unnest(texts) as text from chunks where texts is not null",
        "p5_pages": "select distinct page_id, image_dims.w image_dims_w, image_dims.h image_dims_h, cast(len(boxes) as int) n_boxes, metadata.mode metadata_mode, metadata.grounding metadata_grounding, metadata.has_boxes metadata_has_boxes, metadata.engine metadata_engine, prompt_type from ocr_pages",
        "p5_page_boxes": "with e as (select page_id, unnest(range(len(boxes))) i, unnest(boxes) b from ocr_pages) select distinct page_id, cast(i as bigint) box_no, b.label as label, cast(len(b.box) as int) n_numbers, md5(b.text_content) text_md5 from e",
        "p5_page_numbers": "with e as (select page_id, unnest(range(len(boxes))) i, unnest(boxes) b from ocr_pages) select distinct page_id, cast(i as bigint) no_1, cast(unnest(range(len(b.box))) as bigint) no_2, unnest(b.box) as value from e",
        "p7_found": _P7 + "select distinct o.f file_name, change_kind, old_path, new_path from ch join o using (s, n)",
        "p7_paths": _P7.replace("with r as", "with recursive r as") + _P7_NAMES,
    }


#: Paths of every record from the parsed tree; types by structure, a file's path from all its records; then each file against
#: the one written before it. Gone and new paths of one parent are paired by order of name, first those of equal type.
_P7 = """
with r as (select distinct stream_key s, file_name f, written_at w, payload p from raw_page_records where json_valid(payload) and json_type(payload) = 'OBJECT'),
e as (select s, f, min(w) over (partition by s, f) w, t.fullkey k, t.type y, t.value v from r, json_tree(r.p) t),
l as (select s, f, w, regexp_replace(replace(regexp_replace(k, '^\\$\\.?', ''), '"', ''), '\\[[0-9]+\\]', '[]', 'g') p, y, v from e where not ends_with(k, ']') and k <> '$' and y <> 'OBJECT'),
m as (select s, f, w, p, case when y = 'ARRAY' then cast(json_structure(v) as varchar) else y end t from l where not (y = 'ARRAY' and len(list_filter(json_extract(v, '$[*]'), lambda x: json_type(x) = 'OBJECT')) > 0)),
q as (select distinct s, f, w, p, regexp_replace(regexp_replace(regexp_replace(t, 'UBIGINT|HUGEINT|BIGINT', 'integer', 'g'), 'DOUBLE', 'fraction', 'g'), '"', '', 'g') t from m),
a as (select s, f, min(w) w, p, list_filter(list(t), lambda x: x not in ('NULL', '[NULL]')) ts, bool_or(t = '[NULL]') emp from q group by s, f, p),
b as (select s, f, w, p, emp and len(ts) = 0 only_empty, array_to_string(list_sort(list_filter(ts, lambda x: not contains(ts, replace(x, 'integer', 'fraction')) or not contains(x, 'integer'))), '|') t from a),
o as (select s, f, dense_rank() over (partition by s order by w, f) n from (select distinct s, f, w from a)),
c as (select b.*, o.n from b join o using (s, f)),
x as (select c.*, exists (select 1 from c d where d.s = c.s and d.n in (c.n, c.n - 1) and (starts_with(d.p, c.p || '.') or starts_with(d.p, c.p || '['))) stem_back, exists (select 1 from c d where d.s = c.s and d.n in (c.n, c.n + 1) and (starts_with(d.p, c.p || '.') or starts_with(d.p, c.p || '['))) stem_on, regexp_replace(c.p, '\\.?[^.]*$', '') parent from c),
nw as (select * from x where n > 1 and not (t = '' and stem_back)),
od as (select * from x where not (t = '' and stem_on)),
gone as (select od.s, od.n + 1 n, od.p, od.t, od.parent from od where exists (select 1 from o where o.s = od.s and o.n = od.n + 1) and not exists (select 1 from nw where nw.s = od.s and nw.n = od.n + 1 and nw.p = od.p)),
come as (select nw.* from nw where not exists (select 1 from od where od.s = nw.s and od.n = nw.n - 1 and od.p = nw.p)),
g1 as (select *, row_number() over (partition by s, n, parent, t order by p) k from gone where t <> ''),
c1 as (select *, row_number() over (partition by s, n, parent, t order by p) k from come where t <> ''),
r1 as (select g1.s, g1.n, g1.p old_path, c1.p new_path from g1 join c1 using (s, n, parent, t, k)),
g2 as (select *, row_number() over (partition by s, n, parent order by p) k from gone where (s, n, p) not in (select (s, n, old_path) from r1)),
c2 as (select *, row_number() over (partition by s, n, parent order by p) k from come where (s, n, p) not in (select (s, n, new_path) from r1)),
r2 as (select g2.s, g2.n, g2.p old_path, c2.p new_path from g2 join c2 using (s, n, parent, k)),
ch as (
  select s, n, 'renamed' change_kind, old_path, new_path from r1 union all select s, n, 'renamed', old_path, new_path from r2
  union all select s, n, 'removed', p, '' from g2 where (s, n, p) not in (select (s, n, old_path) from r2)
  union all select s, n, 'added', '', p from c2 where (s, n, p) not in (select (s, n, new_path) from r2)
  union all select nw.s, nw.n, 'retyped', nw.p, nw.p from nw join od on od.s = nw.s and od.n = nw.n - 1 and od.p = nw.p where nw.t <> od.t and nw.t <> '' and od.t <> '')
"""
#: Names carried along the files of a stream by the renames; names of other streams taken over; then values counted by name.
_P7_NAMES = """,
rn as (select s, n, old_path, new_path from ch where change_kind = 'renamed'),
al as (select c.s, c.n, c.p, coalesce(rn.old_path, c.p) pred from c left join rn on rn.s = c.s and rn.n = c.n and rn.new_path = c.p),
cn as (select s, n, p, p canon from al where not exists (select 1 from c b where b.s = al.s and b.n = al.n - 1 and b.p = al.pred)
  union all select al.s, al.n, al.p, cn.canon from cn join al on al.s = cn.s and al.n = cn.n + 1 and al.pred = cn.p),
st as (select canon, count(distinct s) k from cn group by canon),
pr as (select distinct cn.canon, cn.p, a.k ka from cn join st a on a.canon = cn.canon join st b on b.canon = cn.p where cn.p <> cn.canon and b.k < a.k
  and not exists (select 1 from cn x join cn y on x.s = y.s where x.canon = cn.canon and y.canon = cn.p)),
mp as (select p, arg_max(canon, (ka, canon)) as goal from pr group by p),
fin as (select cn.s, cn.n, cn.p, coalesce(mp.goal, cn.canon) canon from cn left join mp on mp.p = cn.canon),
rec as (select distinct stream_key s, file_name f, line_no, payload p from raw_page_records where json_valid(payload) and json_type(payload) = 'OBJECT'),
ev as (select rec.s, rec.f, regexp_replace(replace(regexp_replace(t.fullkey, '^\\$\\.?', ''), '"', ''), '\\[[0-9]+\\]', '[]', 'g') p, t.type y, t.value v from rec, json_tree(rec.p) t where not ends_with(t.fullkey, ']') and t.fullkey <> '$' and t.type not in ('OBJECT', 'NULL')),
lv as (select * from ev where not (y = 'ARRAY' and len(list_filter(json_extract(v, '$[*]'), lambda x: json_type(x) = 'OBJECT')) > 0)),
kv as (select fin.canon, lv.y, lv.v from lv join o on o.s = lv.s and o.f = lv.f join fin on fin.s = lv.s and fin.n = o.n and fin.p = lv.p)
select canon path, count(*) n_values from kv where not exists (select 1 from fin where starts_with(fin.canon, kv.canon || '.') or starts_with(fin.canon, kv.canon || '[')) group by canon
"""
