"""The project's texts as rows, and small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators.deliveries import once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(pages: DataFrame, *columns: str) -> DataFrame:
    """One row per box: box_key = page_id * 100 + box_no, box_no, label, box, text and the named page columns.

    Pages without boxes give no row. A page delivered twice gives its rows twice: operators keep one row per key in
    their (much smaller) results rather than shuffle all texts.
    """
    exploded = pages.select("page_id", *columns, F.posexplode("boxes").alias("box_no", "b"))
    return exploded.select((F.col("page_id") * 100 + F.col("box_no")).alias("box_key"), "box_no", F.col("b.label").alias("label"), F.col("b.box").alias("box"), F.col("b.text_content").alias("text"), "page_id", *columns)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, and the n + 1 offsets of the texts in it."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def filled(text: Column) -> Column:
    return text.isNotNull() & (F.length(text) > 0)


def once_by_hash(df: DataFrame, key: str, text: str) -> DataFrame:
    """Each key and text once; texts of keys that occur once aren't moved."""
    return once(df, [key], text)
