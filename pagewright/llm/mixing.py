"""Mixing sources to target shares by Pfair scheduling.

The mix is a sequence of slots of one block of tokens each. Block j of a source of weight w is released at slot floor(j / w)
and due by slot ceil((j + 1) / w); earliest deadline first among the released blocks then interleaves the sources so that
each is always within one block of its share. Weights are whole numbers with a sum of P, so the schedule repeats after P
slots: one period is computed, and block j of a source with p of the P slots comes at slot P * (j div p) + place(j mod p). The
block has a fixed size and the sequence any length. Documents find their block from running token sums; a document that is
larger than a block runs over the next blocks of its source.

A source is repeated as whole passes over its documents, each in another order, at most max_repeats times.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tokens of a block, documents of a bucket of the running sums on average, sources at most.
BLOCK, BUCKET, SOURCES = 4096, 8192, 10_000
#: Slots of a period at most. Shares of up to six decimals are exact; finer ones are taken to this precision.
PERIOD = 1 << 20


def weights(shares: list[float]) -> list[int]:
    """Whole numbers in proportion to the shares (at least 1 for a positive one) with a sum of at most ``PERIOD`` (and one for each source)."""
    exact = [Fraction(repr(round(float(w), 9))) for w in shares]
    lowest = math.lcm(*[f.denominator for f in exact]) if exact else 1
    whole = [int(f * lowest) for f in exact]
    common = math.gcd(*whole) or 1
    whole = [n // common for n in whole]
    if sum(whole) <= PERIOD:
        return whole
    parts = [f * PERIOD / sum(exact) for f in exact]
    out = [max(1, math.floor(p)) if p else 0 for p in parts]
    # largest remainders take what is left
    for i in sorted(range(len(out)), key=lambda i: (math.floor(parts[i]) - parts[i], i))[: max(0, PERIOD - sum(out))]:
        out[i] += 1
    return out


def schedule(n: list[int]) -> list[tuple[int, int]]:
    """(source, block of that source) per slot of one period, in which source s has n[s] blocks."""
    total = sum(n)
    waiting: list[tuple[int, int, int]] = []  # release, source, block
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    release = lambda s, j: j * total // n[s]
    due = lambda s, j: -(-(j + 1) * total // n[s])
    for s, k in enumerate(n):
        if k:
            heapq.heappush(waiting, (0, s, 0))
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due(s, j), s, j))
        _, s, j = heapq.heappop(ready)
        out.append((s, j))
        if j + 1 < n[s]:
            heapq.heappush(waiting, (release(s, j + 1), s, j + 1))
    return out


def amounts(available: dict[str, int], targets: list[tuple[str, float, int]], total: int | None = None) -> dict[str, int]:
    """Tokens that each source contributes.

    Shares are those of the sources with documents, scaled to sum 1. Without a total, it is the largest one at which every
    source reaches its share within its repeats; with a larger total, sources that fall short give what they can.
    """
    own = [(s, w, max(0, r)) for s, w, r in targets if w and w > 0 and available.get(s, 0) > 0]
    whole = sum(w for _, w, _ in own)
    if not own or not whole:
        return {}
    most = {s: available[s] * r for s, _, r in own}
    if total is None:
        total = math.floor(min(most[s] * whole / w for s, w, _ in own))
    return {s: min(most[s], round(total * w / whole)) for s, w, _ in own}


def mix(spark: SparkSession, sizes: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", total: int | None = None, seed: int = 5) -> tuple[DataFrame, DataFrame]:
    """(mix, shares).

    mix: slot, place (order within the slot), source, key, repeat_no, n_tokens; sorted by slot and place it is the mixed
    sequence. shares: source, target_share, max_repeats, available_tokens, used_tokens, actual_share, repeats, with a row
    for every source that has documents or a target (the null source too).

    Targets of one source given twice are added up; sources without a target are left out of the mix. A source's last
    document is taken if the most of it fits the source's amount.
    """
    per = sizes.groupBy(source).agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    # one row for each source that is named in the targets
    named = targets.groupBy("source").agg(F.sum("target_share").alias("w"), F.max("max_repeats").alias("r"))
    rows = named.join(per.withColumnRenamed(source, "source"), "source", "left").orderBy("source").limit(SOURCES + 1).collect()
    if len(rows) > SOURCES:
        raise ValueError(f"targets name more than {SOURCES} sources")
    give = amounts({r["source"]: r["t"] for r in rows if r["t"]}, [(r["source"], r["w"], r["r"]) for r in rows], total)
    have = {r["source"]: (r["t"], r["n"]) for r in rows if r["t"]}
    names = sorted(give)
    short = total is not None and any(give[r["source"]] < round(total * r["w"] / sum(x["w"] for x in rows if x["source"] in give)) for r in rows if r["source"] in give)
    share = {r["source"]: r["w"] for r in rows}
    own = weights([give[s] if short else share[s] for s in names])
    period = sum(own)
    plan = [(slot, s, j) for slot, (s, j) in enumerate(schedule(own))]
    slots = spark.createDataFrame(pd.DataFrame(plan, columns=["at", "s", "r"]), "at bigint, s int, r bigint") if plan else spark.createDataFrame([], "at bigint, s int, r bigint")
    settings = spark.createDataFrame(
        [(s, i, own[i], int(give[s]), int(have[s][0]), math.ceil(give[s] / have[s][0]), max(1, have[s][1] // BUCKET)) for i, s in enumerate(names)],
        "source string, s int, p bigint, give bigint, size bigint, passes int, buckets int",
    )

    docs = sizes.select(F.col(key).alias("k"), F.col(source).alias("source"), "n_tokens").join(F.broadcast(settings), "source")
    # passes over a source in another order each; buckets of hashes keep a large source from being one ordered group
    copies = docs.withColumn("repeat_no", F.explode(F.sequence(F.lit(0), F.col("passes") - 1))).withColumn("h", F.xxhash64("k", "repeat_no", F.lit(seed)))
    copies = copies.withColumn("b", F.pmod("h", F.col("buckets").cast("bigint")))
    sums = copies.groupBy("s", "repeat_no", "b").agg(F.sum("n_tokens").alias("t"))
    before = Window.partitionBy("s", "repeat_no").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("t").over(before), F.lit(0))).drop("t")
    within = Window.partitionBy("s", "repeat_no", "b").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(offsets, ["s", "repeat_no", "b"])
    placed = placed.withColumn("start", F.col("repeat_no") * F.col("size") + F.col("offset") + F.col("inner"))
    taken = placed.filter(F.col("start") + F.col("n_tokens") / 2 <= F.col("give")).withColumn("j", F.floor(F.col("start") / BLOCK))
    # at most PERIOD rows, whatever the data
    found = taken.withColumn("r", F.col("j") % F.col("p")).join(F.broadcast(slots), ["s", "r"])
    slot = F.expr("j div p") * period + F.col("at")
    mixed = found.select(slot.alias("slot"), (F.col("start") - F.col("j") * BLOCK).alias("place"), "source", F.col("k").alias(key), F.col("repeat_no").cast("bigint").alias("repeat_no"), "n_tokens")

    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("used_tokens"), (F.max("repeat_no") + 1).alias("repeats"))
    every = per.select(F.col(source).alias("source"), F.col("t").alias("available_tokens"))
    joined = every.join(named, every["source"].eqNullSafe(named["source"]), "full").select(F.coalesce(every["source"], named["source"]).alias("source"), F.coalesce("w", F.lit(0.0)).alias("target_share"), F.col("r").alias("max_repeats"), F.coalesce("available_tokens", F.lit(0)).alias("available_tokens"))
    # one row for each source
    shares = joined.join(used, "source", "left").withColumn("whole", F.sum("used_tokens").over(Window.partitionBy(F.lit(1))))
    return mixed, shares.select("source", "target_share", "max_repeats", "available_tokens", F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"), F.coalesce(F.col("used_tokens") / F.col("whole"), F.lit(0.0)).alias("actual_share"), F.coalesce("repeats", F.lit(0)).alias("repeats"))
