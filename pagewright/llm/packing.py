"""Filling containers of fixed capacity: first-fit decreasing in randomised groups of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents per group, on average. A group is packed by one task; more documents make more groups, not larger ones.
GROUP = 16_384
#: Limits at most, which are read to the driver.
LIMITS = 1000


class Tournament:
    """First fit over containers in O(log n): a complete binary tree whose nodes hold the largest free space below."""

    def __init__(self, containers: int, capacity: int):
        self.size = 1 << max(0, containers - 1).bit_length()
        self.tree = [capacity] * (2 * self.size)

    def place(self, size: int) -> int:
        """The first container with room for the item, which then takes it."""
        tree, i = self.tree, 1
        while i < self.size:
            i *= 2
            if tree[i] < size:
                i += 1
        tree[i] -= size
        at = i - self.size
        while i > 1:
            i //= 2
            a, b = tree[2 * i], tree[2 * i + 1]
            most = a if a > b else b
            if tree[i] == most:
                break
            tree[i] = most
        return at


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Container of each item (sizes at most the capacity), items taken in decreasing size, ties in the given order."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    tree, out = Tournament(len(sizes), capacity), [0] * len(sizes)
    for i in order:
        out[i] = tree.place(sizes[i])
    return out


def pieces(size: int, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(piece_no, start, length): one piece, unless the item alone exceeds the capacity."""
    for no, start in enumerate(range(0, size, capacity)):
        yield no, start, min(capacity, size - start)


def pack(sizes: DataFrame, limits: DataFrame, key: str = "doc_id", lang: str = "lang", group: int = GROUP, seed: int = 11, n_rows: int | None = None) -> DataFrame:
    """Containers for each limit: pack_name, container_id, key, piece_no, start_token, n_tokens.

    ``sizes`` has key, lang and n_tokens (> 0); ``limits`` has pack_name, capacity_tokens and lang (null: all languages).
    Documents of null language belong only to limits for all languages. Groups are drawn by hash of the key, so no key,
    source or language makes a large one. A limit without documents gives no row; limits of null or no capacity are left out.
    """
    n = sizes.count() if n_rows is None else n_rows
    groups = max(1, round(n / group))
    own = limits.filter("capacity_tokens > 0").select("pack_name", F.col("capacity_tokens").cast("bigint").alias("capacity"), F.col("lang").alias("pack_lang")).distinct()
    rows = own.limit(LIMITS + 1).collect()
    if len(rows) > LIMITS:
        raise ValueError(f"more than {LIMITS} limits")
    docs = sizes.select(F.col(key).alias("k"), F.col(lang).alias("l"), "n_tokens")
    # each document with its limits, those of its language and those of all, from constants: nothing is joined
    of = lambda ls: F.array(*[F.struct(F.lit(r.pack_name).alias("pack_name"), F.lit(r.capacity).alias("capacity")) for r in ls]) if ls else F.expr("cast(array() as array<struct<pack_name:string,capacity:bigint>>)")
    settings = of([r for r in rows if r.pack_lang is None])
    for name in sorted({r.pack_lang for r in rows if r.pack_lang is not None}):
        settings = F.concat(settings, F.when(F.col("l") == name, of([r for r in rows if r.pack_lang == name])).otherwise(of([])))
    matches = docs.withColumn("s", F.explode(settings)).select("k", "n_tokens", "s.pack_name", F.col("s.capacity").cast("bigint").alias("capacity"))
    drawn = matches.select("pack_name", "capacity", "k", "n_tokens", F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(groups)).cast("int").alias("g"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity, name, g = int(pdf.capacity.iloc[0]), pdf.pack_name.iloc[0], int(pdf.g.iloc[0])
        # by key, so that a rerun of the task gives the same containers
        pdf = pdf.sort_values("k", kind="stable")
        rows = [(k, no, start, length) for k, n_ in zip(pdf.k, pdf.n_tokens) for no, start, length in pieces(int(n_), capacity)]
        at = first_fit_decreasing([r[3] for r in rows], capacity)
        k, no, start, length = zip(*rows)
        return pd.DataFrame({"pack_name": name, "container_id": np.array(at, np.int64) * groups + g, "k": k, "piece_no": no, "start_token": start, "n_tokens": length})

    kind = sizes.schema[key].dataType.simpleString()
    packed = drawn.groupBy("pack_name", "capacity", "g").applyInPandas(run, f"pack_name string, container_id bigint, k {kind}, piece_no bigint, start_token bigint, n_tokens bigint")
    return packed.withColumnRenamed("k", key)


def fill(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """Per limit: containers, tokens, capacity_tokens and the share of the space that is used."""
    per = packed.groupBy("pack_name", "container_id").agg(F.sum("n_tokens").alias("t")).groupBy("pack_name").agg(F.count(F.lit(1)).alias("containers"), F.sum("t").alias("tokens"))
    joined = limits.select("pack_name", F.col("capacity_tokens").cast("bigint").alias("capacity_tokens")).join(per, "pack_name", "left").fillna(0, ["containers", "tokens"])
    return joined.withColumn("used_share", F.when(F.col("containers") > 0, F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))))
