"""Writers of results: Markdown per document, JSON with ids, dead letters, markers, versioned publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def markdown(paragraphs: DataFrame, path: str, key: str = "doc_key", order: tuple[str, ...] = ("page", "box_no"), text: str = "content") -> None:
    """One text folder per document: each paragraph followed by an empty line, in order.

    Rows are range-partitioned by document and order, so a long document spans files whose names keep the order.
    """
    rows = paragraphs.filter(F.col(text).isNotNull()).select(key, *order, F.concat(F.col(text), F.lit("\n")).alias("value"))
    rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).select(key, "value").write.mode("overwrite").partitionBy(key).option("lineSep", "\n").text(path)


def with_ids(items: DataFrame, key: list[str], order: list[str], number: Column | None = None) -> DataFrame:
    """Adds id (1..n per document), type = text and number (the first node index)."""
    w = Window.partitionBy(*key).orderBy(*order)
    out = items.withColumn("id", F.row_number().over(w)).withColumn("type", F.lit("text"))
    return out if number is None else out.withColumn("number", number)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def json_array(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One JSON array per document as text (key, json), for readers that want a single value per document."""
    fields = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("v")))).alias("x"))
    return grouped.select(key, F.to_json(F.transform("x", lambda r: r["v"])).alias("json"))


def publish(df: DataFrame, path: str, version: str) -> str:
    """Writes a version beside earlier ones and names it current; earlier versions are the backup."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    df.sparkSession.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").json(f"{path}_current")
    return f"{path}/version={version}"


def current(spark, path: str) -> DataFrame:
    version = spark.read.schema("version string").json(f"{path}_current").first().version
    return spark.read.parquet(f"{path}/version={version}")


def dead_letters(answers: DataFrame, path: str, error: str = "error", valid: str = "valid") -> DataFrame:
    """Writes answers that failed or don't hold; returns the rest."""
    bad = F.col(error).isNotNull() | ~F.coalesce(F.col(valid), F.lit(False))
    answers.filter(bad).write.mode("append").parquet(path)
    return answers.filter(~bad)


def mark(done: DataFrame, path: str, stage: str, key: str = "doc_key", mode: str = "append") -> None:
    """Appends (or writes anew) state rows (key, stage, count, time) of finished work; only work that succeeded is marked."""
    rows = done.groupBy(key).agg(F.count(F.lit(1)).alias("finish_num")).select(key, F.lit(stage).alias("stage"), "finish_num", F.current_timestamp().alias("finish_time"))
    rows.write.mode(mode).parquet(path)


def stages_done(state: DataFrame, stage: str, key: str = "doc_key") -> DataFrame:
    return state.filter(F.col("stage") == stage).select(key).distinct()
