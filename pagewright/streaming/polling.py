"""Continuously arriving files, by Structured Streaming: the batch operators over micro-batches with done-markers.

A poll loop becomes a file source with a processing-time trigger (or availableNow for one pass); markers become the
checkpoint and a state table; a record delivered twice is dropped within the watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: str, fmt: str = "json", at: str | None = "ingested_at", late: str = "30 days", key: list[str] | None = None, max_files: int = 1000) -> DataFrame:
    """A stream of files; rows with an earlier key within the watermark are dropped."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    rows = (reader.option("multiLine", "true") if fmt == "json" else reader).format(fmt).load(path)
    if key is None:
        return rows
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(key) if at else rows.dropDuplicates(key)


def poll(stream: DataFrame, run: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Writes ``run`` of each micro-batch below ``out``, one folder per batch, so that a repeated batch replaces itself.

    Without ``seconds`` everything that has arrived is worked off and the query ends.
    """

    def batch(df: DataFrame, n: int) -> None:
        run(df).write.mode("overwrite").parquet(f"{out}/batch={n}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)
    return writer.start()


def complete_documents(pages: DataFrame, counts: DataFrame) -> DataFrame:
    """Pages of documents of which all pages are there (counts: doc_key, n_pages): merges over pages need whole documents."""
    have = pages.groupBy("doc_key").agg(F.countDistinct("page").alias("have"))
    ready = have.join(counts, "doc_key").filter("have >= n_pages").select("doc_key")
    return pages.join(ready, "doc_key", "left_semi")


def page_counts(stream: DataFrame, window: str = "1 day", late: str = "7 days", at: str = "ingested_at") -> DataFrame:
    """Pages and characters that arrived per book and window."""
    rows = stream.withWatermark(at, late)
    return rows.groupBy(F.window(at, window), "doc_key").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("text")).alias("chars"))
