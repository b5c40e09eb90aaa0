"""Rows that were delivered more than once: the latest delivery of each key.

Keys are counted first, over two small columns. Rows of keys that occur once never move; the few keys with several
deliveries are sent to all tasks as long as they are few (``BROADCAST``), and sorted by key beyond that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Keys with several deliveries that are broadcast at most (about 32 bytes each).
BROADCAST = 500_000


def latest(df: DataFrame, key: str, at: str | None = None) -> DataFrame:
    """One row per key: the one with the latest ``at``, any of those that are equal in it; a null ``at`` is the earliest.

    Without such a column any row of a key stays. Rows whose key is null all stay. Two small jobs over the key columns run at
    once, to choose the plan.
    """
    if at is None or at not in df.columns:
        return df.dropDuplicates([key])
    per = df.groupBy(key, F.col(at).alias("__at")).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNotNull())
    more = per.groupBy(key).agg(F.max("__at").alias("__last"), F.sum("n").alias("n"), F.max_by("n", F.struct("__at")).alias("ties")).filter("n > 1")
    seen = more.limit(BROADCAST + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("ties"), F.lit(0)).alias("ties")).first()
    if seen.n == 0:
        return df
    if seen.n > BROADCAST:
        newest = Window.partitionBy(key, F.when(F.col(key).isNull(), F.monotonically_increasing_id())).orderBy(F.desc_nulls_last(at))
        return df.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")
    last = F.broadcast(more.select(F.col(key).alias("__key"), "__last"))
    found = df.join(last, F.col(key) == F.col("__key"), "left").filter(F.col("__key").isNull() | F.col(at).eqNullSafe(F.col("__last")))
    if seen.ties > 1:
        # rows that are equal in time too: only they are moved
        once = found.filter("__key is not null").dropDuplicates(["__key"])
        found = found.filter("__key is null").unionByName(once)
    return found.select(df.columns)


def once(df: DataFrame, key: list[str], text: str | None = None) -> DataFrame:
    """Rows that are equal in ``key`` (and in the hash of ``text``) once, any of them; null equals null.

    Only rows of keys that occur several times are moved, as long as those keys are few enough to be broadcast.
    """
    own = df.withColumn("__h", F.xxhash64(text) if text else F.lit(0).cast("bigint"))
    more = own.groupBy(*key, "__h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    n = more.limit(BROADCAST + 1).count()
    if n == 0:
        return df
    if n > BROADCAST:
        return own.dropDuplicates([*key, "__h"]).drop("__h")
    twice = F.broadcast(more.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col("__h").alias("__x"), F.lit(True).alias("__twice")))
    same = F.col("__h") == F.col("__x")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    marked = own.join(twice, same, "left")
    return marked.filter("__twice is null").unionByName(marked.filter("__twice").dropDuplicates([*key, "__h"])).select(df.columns)
