import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagewright.operators import deliveries

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k bigint, at timestamp, v string, n string"


def rows():
    day = lambda i: T0 + dt.timedelta(days=i)
    return [(1, day(0), "old", None), (1, day(2), "new", None), (1, None, "none", None), (2, day(0), "one", "x"), (3, day(1), "tie", None), (3, day(1), "tie", None), (3, day(0), "old", None), (None, day(0), "a", None), (None, day(0), "b", None), (4, None, "p", None), (4, None, "p", None)]


@pytest.mark.parametrize("bound", [500_000, 1])
def test_latest(spark, monkeypatch, bound):
    monkeypatch.setattr(deliveries, "BROADCAST", bound)
    df = spark.createDataFrame(rows(), SCHEMA)
    got = deliveries.latest(df, "k", "at")
    assert got.columns == df.columns
    assert sorted((r.k or 0, r.v) for r in got.collect()) == [(0, "a"), (0, "b"), (1, "new"), (2, "one"), (3, "tie"), (4, "p")]


@pytest.mark.parametrize("bound", [500_000, 1])
def test_once(spark, monkeypatch, bound):
    monkeypatch.setattr(deliveries, "BROADCAST", bound)
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, None), (2, None), (3, "c")], "k int, t string")
    assert sorted(map(tuple, deliveries.once(df, ["k"], "t").collect()), key=str) == sorted([(1, "a"), (1, "b"), (None, "a"), (2, None), (3, "c")], key=str)
    assert deliveries.once(df, ["k", "t"]).count() == 5


def test_latest_without_repeats_is_the_table_itself(spark):
    df = spark.createDataFrame([(1, T0, "a", None)], SCHEMA)
    assert deliveries.latest(df, "k", "at") is df
    assert deliveries.latest(spark.createDataFrame([], SCHEMA), "k", "at").count() == 0
    assert deliveries.latest(df.unionByName(df), "k", "nowhere").count() == 1


def test_texts_of_single_keys_are_not_moved(spark):
    df = spark.createDataFrame([(i, T0, "t", None) for i in range(50)] + [(1, T0 + dt.timedelta(1), "u", None)], SCHEMA)
    plan = deliveries.latest(df, "k", "at").select("k", F.length("v"))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(k" in plan
    final = plan.split("== Physical Plan ==")[1]
    assert "hashpartitioning(k" not in final.split("BroadcastExchange")[0]
