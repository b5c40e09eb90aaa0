"""Counts, totals and reports over documents, files and check results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators.deliveries import latest


def text_totals(chunks: DataFrame) -> DataFrame:
    """Per book: text items, characters of what is no image, largest id of a text item (0 without any)."""
    once = latest(chunks, "chunk_id", "processed_at")
    not_image = ~F.col("type").eqNullSafe("image")
    return once.groupBy("doc_key").agg(
        F.count_if(F.col("type") == "text").alias("text_items"),
        F.coalesce(F.sum(F.when(not_image, F.length("content"))), F.lit(0)).cast("bigint").alias("total_chars"),
        F.coalesce(F.max(F.when(F.col("type") == "text", F.col("id"))), F.lit(0)).alias("max_id"),
    )


def files_once(files: DataFrame) -> DataFrame:
    return latest(files, "file_md5", "ingested_at")


def file_totals(files: DataFrame) -> DataFrame:
    """Files and characters, of present and of deleted files."""
    here = F.col("file_exist") == 1
    return files_once(files).agg(
        F.count_if(here).alias("total_file_counts"),
        F.coalesce(F.sum(F.when(here, F.col("total_chars"))), F.lit(0)).alias("total_file_chars"),
        F.count_if(~here).alias("total_file_counts_del"),
        F.coalesce(F.sum(F.when(~here, F.col("total_chars"))), F.lit(0)).alias("total_file_chars_del"),
    )


def refreshed(totals: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Totals with the rows of the documents that were counted again in place of their earlier ones."""
    return totals.join(changed.select(key), key, "left_anti").unionByName(changed.select(totals.columns))


def catalogue(files: DataFrame, chars: DataFrame, paths: DataFrame, present: DataFrame, key: str = "file_md5") -> DataFrame:
    """Files with what three other tables know of them: total_chars (0), file_path (null), file_exist (1 where present, else 0)."""
    here = present.select(key).distinct().withColumn("__here", F.lit(1))
    joined = files.join(chars.select(key, "total_chars"), key, "left").join(paths.select(key, "file_path"), key, "left").join(here, key, "left")
    return joined.withColumns({"total_chars": F.coalesce("total_chars", F.lit(0)), "file_exist": F.coalesce("__here", F.lit(0))}).drop("__here")


def upload_time(text: Column) -> Column:
    """Both formats of the catalogue; null as the epoch, so that undated files sort last."""
    parsed = F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return F.coalesce(parsed, F.lit("1970-01-01 00:00:00").cast("timestamp"))


def first_lines(lines: DataFrame, key: list[str], text: str, y: str, order: list[str], step: float = 2.0) -> DataFrame:
    """Lines without their shadows: of lines of a block with equal trimmed text within ``step`` of height, the first."""
    w = Window.partitionBy(*key, X.strip(F.col(text)), (F.col(y) / step).cast("int")).orderBy(*order)
    return lines.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def font_sizes(spans: DataFrame, key: str, size: str, page: str, pages: int = 5) -> DataFrame:
    """Per document: threshold of headings (1.2 of the mean size on the first pages) and the largest size; 12 and 12 without spans."""
    own = F.col(page) <= pages
    return spans.groupBy(key).agg(F.coalesce(F.avg(F.when(own, F.col(size))) * 1.2, F.lit(12.0)).alias("heading_size"), F.coalesce(F.max(F.when(own, F.col(size))), F.lit(12.0)).alias("max_size"))


def heading_sign(size: Column, heading: Column, most: Column) -> Column:
    return F.when(size >= heading, F.when(size >= most * 0.9, "# ").otherwise("## ")).otherwise("")


def check_report(results: DataFrame, key: str, errors: str) -> DataFrame:
    """Totals over exploded check errors: errors, characters of their cleaned contents."""
    e = results.select(F.explode(F.col(errors)).alias("e"))
    return e.agg(F.count(F.lit(1)).alias("n_errors"), F.coalesce(F.sum(F.length(X.no_punctuation(F.col("e.content")))), F.lit(0)).cast("bigint").alias("n_chars"))


#: Signs taken off both ends before answers are compared.
_ENDS = " 。，；：！？、,.;:!?\"'“”‘’「」『』"


def match_rates(pairs: DataFrame, model: str, base: str, other: str) -> DataFrame:
    """Per model: positional agreement of two lists: match, mismatch, total, rate (%).

    Lists match if they have as many items and every item contains its counterpart or is contained in it.
    """
    strip = lambda x: F.btrim(x, F.lit(_ENDS))
    both = F.arrays_zip(F.col(base).alias("a"), F.col(other).alias("b"))
    same = F.forall(both, lambda p: F.contains(strip(F.coalesce(p["a"], F.lit(""))), strip(F.coalesce(p["b"], F.lit("")))) | F.contains(strip(F.coalesce(p["b"], F.lit(""))), strip(F.coalesce(p["a"], F.lit("")))))
    ok = F.coalesce((F.size(base) == F.size(other)) & same, F.lit(False))
    by = pairs.withColumn("__ok", ok).groupBy(model).agg(F.count_if("__ok").alias("match"), F.count_if(~F.col("__ok")).alias("mismatch"), F.count(F.lit(1)).alias("total"))
    return by.withColumn("rate", F.col("match") * 100.0 / F.col("total"))


def occurrences(text: Column, sign: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))) / len(sign)
