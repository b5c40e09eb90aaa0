"""Queries of counts, catalogues and reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators import joins as J
from pagewright.operators import layout, stats
from pagewright.operators.deliveries import latest
from pagewright.plans import quote_queries as Q
from pagewright.plans.layout_queries import _B, _BLANK, _MAP
from pagewright.session import table


def char_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.text_totals(table(spark, sf, "chunks")).select("doc_key", "text_items", "total_chars", F.col("max_id").cast("bigint").alias("max_id"))


def char_stats_clean(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.groupBy("source").agg(F.coalesce(F.sum(X.visible_length(F.col("text"))), F.lit(0)).cast("bigint").alias("chars"), F.count(F.lit(1)).alias("docs"))


def doc_totals_by_flag(spark: SparkSession, sf: str) -> DataFrame:
    return stats.file_totals(table(spark, sf, "book_files"))


def file_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Files with masked names, keys, times and the characters of their chunks, newest first."""
    files = stats.files_once(table(spark, sf, "book_files"))
    chars = stats.text_totals(table(spark, sf, "chunks")).select(F.col("doc_key").alias("file_md5"), F.col("total_chars").alias("chunk_chars"))
    joined = files.join(chars, "file_md5", "left")
    at = stats.upload_time(F.col("file_upload_time"))
    return joined.select("file_md5", X.mask_name(F.col("file_name")).alias("shown"), F.md5("file_name").alias("name_key"), F.md5("file_path").alias("path_key"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("uploaded"), F.coalesce("total_chars", F.lit(0)).alias("total_chars"), F.coalesce("chunk_chars", F.lit(0)).alias("chunk_chars"), "file_exist").orderBy(F.desc("uploaded"), "file_md5")


def file_states(spark: SparkSession, sf: str) -> DataFrame:
    """Books with the characters of their chunks, their paths, and whether scanned pages of them are there."""
    files = stats.files_once(table(spark, sf, "book_files"))
    chars = stats.text_totals(table(spark, sf, "chunks")).withColumnRenamed("doc_key", "file_md5")
    pages = table(spark, sf, "ocr_pages").select(F.col("doc_key").alias("file_md5"))
    return stats.catalogue(files.select("file_md5", "file_name", "directory_name"), chars, files, pages)


def stats_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of all books, those of one folder counted again from their text items alone."""
    totals = stats.text_totals(table(spark, sf, "chunks")).select("doc_key", "total_chars")
    again = stats.files_once(table(spark, sf, "book_files")).filter("directory_name = 'admin2'").select(F.col("file_md5").alias("doc_key"))
    texts = table(spark, sf, "chunks").filter("type = 'text'").join(again, "doc_key", "left_semi")
    return stats.refreshed(totals, stats.text_totals(texts).select("doc_key", "total_chars"), "doc_key")


def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    files = stats.files_once(table(spark, sf, "book_files"))
    after = F.when(F.contains("file_path", F.lit("uploads")), F.regexp_replace("file_path", "^.*?uploads", ""))
    return files.select("file_md5", F.regexp_extract("file_path", "check_book/(.*?)/1_Json", 1).alias("key_part"), after.alias("rest"))


def directory_files(spark: SparkSession, sf: str) -> DataFrame:
    f = stats.files_once(table(spark, sf, "book_files"))
    return f.filter("directory_name = 'admin2'").select("file_md5", "file_name")


def line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    m = J.mapping_blocks(table(spark, sf, "mapping_rows"), zoom=1.0)
    return stats.first_lines(m, ["doc_key", "page"], "text", "y0", ["md_line_index", "map_id"]).select("map_id")


def distinct_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """The first document of each text without punctuation."""
    d = table(spark, sf, "documents").filter("text is not null")
    return d.groupBy(F.md5(X.no_punctuation(F.col("text"))).alias("k")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).select("doc_id", "n")


def font_stats(spark: SparkSession, sf: str) -> DataFrame:
    m = J.mapping_blocks(table(spark, sf, "mapping_rows"), zoom=1.0).withColumn("size", F.col("y1") - F.col("y0"))
    return stats.font_sizes(m, "doc_key", "size", "page").select("doc_key", F.round("heading_size", 6).alias("heading_size"), "max_size")


def heading_levels(spark: SparkSession, sf: str) -> DataFrame:
    m = J.mapping_blocks(table(spark, sf, "mapping_rows"), zoom=1.0).withColumn("size", F.col("y1") - F.col("y0"))
    sizes = stats.font_sizes(m, "doc_key", "size", "page").withColumn("heading_size", F.round("heading_size", 6))
    return m.join(sizes, "doc_key").select("map_id", stats.heading_sign(F.col("size"), F.col("heading_size"), F.col("max_size")).alias("sign"))


def check_report(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of check results; the foot notes of a page stand for its errors here."""
    p = latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at").filter("boxes is not null")
    errors = F.transform(F.filter("boxes", lambda b: b["label"] == "footnote"), lambda b: F.struct(b["text_content"].alias("content"), F.lit("").alias("rightSentences")))
    return stats.check_report(p.select("page_id", errors.alias("errors")), "page_id", "errors")


def model_match_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Agreement of two readers with the rules, document by document: one that knows one verb, one that knows another speaker's."""
    d = Q._documents(spark, sf)
    listed = lambda speaker, verbs: Q.Q.sentence_quotes(d, "doc_id", "text", speaker, verbs).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("sentence_no", "quote_no", "quote"))), lambda x: x["quote"]).alias("q"))
    base = listed(Q.ONE, Q.VERBS).withColumnRenamed("q", "base")
    pairs = None
    for name, verbs in (("one verb", Q.VERBS[:1]), ("two verbs", Q.VERBS[:2])):
        part = base.join(listed(Q.ONE, verbs), "doc_id", "left").select(F.lit(name).alias("model"), "base", F.coalesce("q", F.expr("cast(array() as array<string>)")).alias("other"))
        pairs = part if pairs is None else pairs.unionByName(part)
    rates = stats.match_rates(pairs, "model", "base", "other")
    return rates.select("model", "match", "mismatch", "total", F.round("rate", 6).alias("rate"))


def union_items(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs and images as one bag."""
    b = layout.blocks(table(spark, sf, "ocr_pages"))
    text = b.filter("label = 'text'").select(F.lit("text").alias("type"), "page", F.length("text").alias("n"))
    images = b.filter("label = 'image'").select(F.lit("image").alias("type"), "page", F.col("box_key").alias("image"))
    both = text.unionByName(images, allowMissingColumns=True)
    return both.groupBy("type").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("chars"), F.count("image").alias("images"))


def page_round_robin(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of work per endpoint, round robin by ordinal."""
    p = latest(table(spark, sf, "ocr_pages"), "page_id", "ingested_at")
    return p.groupBy(F.pmod("page_id", F.lit(4)).alias("endpoint")).agg(F.count(F.lit(1)).alias("pages"))


def queries() -> dict:
    own = (char_stats, char_stats_clean, doc_totals_by_flag, file_catalogue, file_states, stats_refresh, path_parts, directory_files, line_dedup, distinct_clean_text, font_stats, heading_levels, check_report, model_match_rate, union_items, page_round_robin)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    blank = _BLANK
    files = "with f as (select distinct on (file_md5) * from book_files)"
    chars = "c as (select distinct on (chunk_id) * from chunks), t as (select doc_key, count(*) filter (where type = 'text') text_items, cast(coalesce(sum(length(content)) filter (where type is distinct from 'image'), 0) as bigint) total_chars, cast(coalesce(max(id) filter (where type = 'text'), 0) as bigint) max_id from c group by doc_key)"
    fonts = _MAP + ", z as (select map_id, doc_key, page, bbox[4] - bbox[2] size from mr where len(bbox) = 4), fs as (select doc_key, round(coalesce(avg(size) filter (where page <= 5) * 1.2, 12.0), 6) heading_size, coalesce(max(size) filter (where page <= 5), 12.0) max_size from z group by doc_key)"
    ends = " 。，；：！？、,.;:!?\"''“”‘’「」『』"
    return {
        "char_stats": f"with {chars} select doc_key, text_items, total_chars, max_id from t",
        "char_stats_clean": "select source, cast(coalesce(sum(length(translate(text, '# ' || chr(10) || chr(13) || chr(9) || chr(12288), ''))), 0) as bigint) chars, count(*) docs from documents group by source",
        "doc_totals_by_flag": files + " select count(*) filter (where file_exist = 1) total_file_counts, cast(coalesce(sum(total_chars) filter (where file_exist = 1), 0) as bigint) total_file_chars, count(*) filter (where file_exist <> 1) total_file_counts_del, cast(coalesce(sum(total_chars) filter (where file_exist <> 1), 0) as bigint) total_file_chars_del from f",
        "file_catalogue": f"{files}, {chars} select file_md5, case when length(file_name) > 26 then left(file_name, 6) || repeat('*', length(file_name) - 26) || right(file_name, 24) else file_name end shown, md5(file_name) name_key, md5(file_path) path_key, coalesce(left(replace(file_upload_time, 'T', ' '), 19), '1970-01-01 00:00:00') uploaded, coalesce(f.total_chars, 0) total_chars, coalesce(t.total_chars, 0) chunk_chars, file_exist from f left join t on t.doc_key = f.file_md5",
        "file_states": f"{files}, {chars} select f.file_md5, file_name, directory_name, coalesce(t.total_chars, 0) total_chars, f.file_path, case when exists (select 1 from ocr_pages o where o.doc_key = f.file_md5) then 1 else 0 end file_exist from f left join t on t.doc_key = f.file_md5",
        "stats_refresh": f"{files}, {chars}, a as (select doc_key, cast(coalesce(sum(length(content)), 0) as bigint) total_chars from c where type = 'text' and doc_key in (select file_md5 from f where directory_name = 'admin2') group by doc_key) select t.doc_key, coalesce(a.total_chars, t.total_chars) total_chars from t left join a on a.doc_key = t.doc_key",
        "path_parts": files + " select file_md5, regexp_extract(file_path, 'check_book/(.*?)/1_Json', 1) key_part, case when contains(file_path, 'uploads') then regexp_replace(file_path, '^.*?uploads', '') end rest from f",
        "directory_files": files + " select file_md5, file_name from f where directory_name = 'admin2'",
        "line_dedup": _MAP + f", l as (select map_id, row_number() over (partition by doc_key, page, regexp_replace(text, '^{blank}+|{blank}+$', '', 'g'), cast(trunc(bbox[2] / 2.0) as int) order by md_line_index, map_id) n from mr where len(bbox) = 4) select map_id from l where n = 1",
        "distinct_clean_text": "select min(doc_id) doc_id, count(*) n from documents where text is not null group by md5(regexp_replace(text, '[^\\p{L}\\p{N}_\\s]', '', 'g'))",
        "font_stats": fonts + " select doc_key, heading_size, max_size from fs",
        "heading_levels": fonts + " select map_id, case when size >= heading_size then case when size >= max_size * 0.9 then '# ' else '## ' end else '' end sign from z join fs on z.doc_key is not distinct from fs.doc_key",
        "check_report": _B + "select count(*) n_errors, cast(coalesce(sum(length(regexp_replace(text, '[^\\p{L}\\p{N}_\\s]', '', 'g'))), 0) as bigint) n_chars from b where label = 'footnote'",
        "model_match_rate": Q.quotes_sql(Q.VERBS, "") + Q.quotes_sql(Q.VERBS[:1], "1").replace("with d1", ", d1") + Q.quotes_sql(Q.VERBS[:2], "2").replace("with d2", ", d2") + f""",
l0 as (select doc_id, list(quote order by sentence_no, quote_no) a from r group by doc_id),
l1 as (select 'one verb' model, doc_id, list(quote order by sentence_no, quote_no) b from r1 group by doc_id union all select 'two verbs', doc_id, list(quote order by sentence_no, quote_no) from r2 group by doc_id),
mm as (select m.model, l0.a, coalesce(l1.b, []) b from l0 cross join (select 'one verb' model union all select 'two verbs') m left join l1 on l1.model = m.model and l1.doc_id = l0.doc_id),
p as (select model, a, b, coalesce(len(a) = len(b) and len(list_filter(list_zip(a, b), lambda x: not (contains(trim(coalesce(x[1], ''), '{ends}'), trim(coalesce(x[2], ''), '{ends}')) or contains(trim(coalesce(x[2], ''), '{ends}'), trim(coalesce(x[1], ''), '{ends}'))))) = 0, false) ok from mm)
select model, count(*) filter (where ok) as "match", count(*) filter (where not ok) mismatch, count(*) total, round(count(*) filter (where ok) * 100.0 / count(*), 6) rate from p group by model""",
        "union_items": _B + "select label as type, count(*) as rows, cast(sum(case when label = 'text' then length(text) end) as bigint) chars, count(*) filter (where label = 'image') images from b where label in ('text', 'image') group by label",
        "page_round_robin": "select page_id % 4 endpoint, count(distinct page_id) pages from ocr_pages group by 1",
    }
