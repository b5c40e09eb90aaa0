"""Calls to outside services, through injected clients: page rasters, OCR, text extraction, chat models.

A client is a function of one item; it runs inside a task, so the number of partitions bounds the calls in flight. Failures
are rows with an error. Nothing here knows a host or a key: both belong to the client.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def call(items: DataFrame, key: str, item: str, client: Callable[[Any], Any], in_flight: int = 8, attempts: int = 3, wait: float = 2.0, endpoints: list[str] | None = None, per_endpoint: int = 2) -> DataFrame:
    """key, result (JSON text), error, attempts for every item; every attempt counts towards the bound.

    ``wait`` seconds lie between the attempts for one item. With ``endpoints``, items are dealt to them by hash and ``client``
    is called with (item, endpoint); a partition serves one endpoint, so that at most ``per_endpoint`` calls to each are in
    flight. Each partition is one stream of calls.
    """
    source = items.select(F.col(key).alias("k"), F.col(item).alias("x"), F.lit(0).alias("at"))
    if endpoints:
        n = len(endpoints) * per_endpoint
        source = source.withColumn("at", F.pmod(F.xxhash64("k"), F.lit(n)).cast("int")).repartitionById(n, F.col("at"))
    else:
        source = source.repartition(in_flight)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for k, x, at in zip(pdf.k, pdf.x, pdf["at"]):
                result, error, n = None, None, 0
                for n in range(1, attempts + 1):
                    try:
                        result, error = json.dumps(client(x, endpoints[at % len(endpoints)]) if endpoints else client(x), ensure_ascii=False), None
                        break
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                        if n < attempts:
                            time.sleep(wait)
                rows.append((k, result, error, n))
            yield pd.DataFrame(rows, columns=["k", "result", "error", "attempts"])

    return source.mapInPandas(run, f"k {items.schema[key].dataType.simpleString()}, result string, error string, attempts int").withColumnRenamed("k", key)


def missing(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items without a result yet."""
    return items.join(done.filter("error is null").select(key), key, "left_anti")


def pages_of(files: DataFrame, render: Callable[[bytes], list[bytes]]) -> DataFrame:
    """Rasters of all pages of files (path, content): path, page (from 1), image, error. ``render`` is the optional library."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for p, c in zip(pdf.path, pdf.content):
                try:
                    rows = [(p, i, image, None) for i, image in enumerate(render(bytes(c)), 1)]
                except Exception as e:  # noqa: BLE001
                    rows = [(p, 0, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["path", "page", "image", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, image binary, error string")


# The parts of the extraction service's answer.
PARTS = ("words", "lines", "sections", "pdfContent")


def extraction_parts(answers: DataFrame, key: str, result: str = "result") -> dict[str, DataFrame]:
    """The answer's lists as tables: key, id (1..n, null items keep their place without an id), item; and docInfo: key, item.

    An item is a map of its fields; a nested field is its JSON text, so that no part of an answer is lost.
    """
    out = {}
    for p in PARTS:
        listed = F.from_json(F.get_json_object(result, f"$.{p}"), "array<string>")
        rows = answers.select(key, F.posexplode(listed).alias("pos", "t"))
        item = F.from_json("t", "map<string,string>")
        out[p] = rows.select(key, F.when(F.col("t").isNotNull(), F.col("pos") + 1).alias("id"), item.alias("item"))
    return out | {"docInfo": answers.select(key, F.from_json(F.get_json_object(result, "$.docInfo"), "map<string,string>").alias("item"))}


def draw(pages: DataFrame, boxes: DataFrame, key: list[str], paint: Callable[[bytes, list[tuple]], bytes]) -> DataFrame:
    """Images with their boxes painted by an injected function: key, image. Pages without an image are left out."""
    per = boxes.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("box_no", "x0", "y0", "x1", "y1", "text"))).alias("b"))
    joined = pages.filter("image is not null").select(*key, "image").join(per, key)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf = pdf.assign(image=[paint(bytes(i), [tuple(x.values()) if isinstance(x, dict) else tuple(x) for x in b]) for i, b in zip(pdf.image, pdf.b)])
            yield pdf[[*key, "image"]]

    kinds = ", ".join(f"{k} {pages.schema[k].dataType.simpleString()}" for k in key)
    return joined.mapInPandas(run, f"{kinds}, image binary")


def redraw(lines: DataFrame, scale: int = 1) -> DataFrame:
    """What to paint of foreign text lines (poly, text) on a blank page ``scale`` times as large: points and place scaled, and
    the font as high as the line in its own size, at least 10."""
    at = lambda i: F.get("poly", F.lit(i))
    xs, ys = [at(i) for i in (0, 2, 4, 6)], [at(i) for i in (1, 3, 5, 7)]
    good = lines.filter(F.size("poly") == 8)
    return good.withColumns({"points": F.transform("poly", lambda v: v * scale), "x": F.least(*xs) * scale, "y": F.least(*ys) * scale, "font": F.greatest((F.greatest(*ys) - F.least(*ys)).cast("int"), F.lit(10))})


def by_base_name(left: DataFrame, right: DataFrame, name: str = "file_name") -> DataFrame:
    """Rows of two tables of files whose names are equal but for the suffix; right columns that clash get ``right_`` before them."""
    base = lambda df: F.regexp_replace(F.element_at(F.split(df[name], "/"), -1), r"\.[^.]*$", "")
    other = right.withColumn("__base", base(right)).withColumnsRenamed({c: f"right_{c}" for c in right.columns if c in left.columns})
    return left.withColumn("__base", base(left)).join(other, "__base").drop("__base")
