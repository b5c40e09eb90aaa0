import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import mixing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=8))
def test_lag_is_less_than_a_block(n):
    order = mixing.schedule(n)
    assert sorted(order) == [(s, j) for s, k in enumerate(n) for j in range(k)]
    done = [0] * len(n)
    for slot, (s, _) in enumerate(order, 1):
        done[s] += 1
        assert all(abs(done[i] - slot * n[i] / sum(n)) < 1 for i in range(len(n)))


def test_lag_over_a_million_blocks():
    shares = [0.301, 0.123456, 0.075544, 0.2, 0.29, 0.01]
    own = mixing.weights(shares)
    period, place = sum(own), [[] for _ in own]
    assert period <= mixing.PERIOD and np.allclose(np.array(own) / period, shares)
    for slot, (s, _) in enumerate(mixing.schedule(own)):
        place[s].append(slot)
    at = np.arange(1_000_000)
    for s, w in enumerate(own):
        j = np.arange(w * 1_000_000 // period + w)
        slots = j // w * period + np.array(place[s])[j % w]
        done = np.searchsorted(slots, at, side="right")
        assert np.abs(done - (at + 1) * w / period).max() < 1


def test_weights():
    assert mixing.weights([0.5, 0.3, 0.2]) == [5, 3, 2] and mixing.weights([]) == [] and mixing.weights([0.1 + 0.2, 0.7]) == [3, 7]
    fine = mixing.weights([1 / 3, 2 / 3 - 1e-9, 1e-9])
    assert min(fine) == 1 and sum(fine) <= mixing.PERIOD + 3 and abs(fine[0] / sum(fine) - 1 / 3) < 1e-5


def test_documents_larger_than_a_block_run_over_the_next(spark):
    rows = [(i, "a" if i % 2 else "b", 10 * mixing.BLOCK if i < 4 else 300) for i in range(400)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    mixed, _ = mixing.mix(spark, sizes, spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], TARGETS))
    out = mixed.orderBy("slot", "place").collect()
    assert len(out) == 400
    done, worst = {"a": 0, "b": 0}, 0
    for r in out:
        done[r.source] += r.n_tokens
        worst = max(worst, abs(done["a"] - done["b"]))
    assert worst <= 11 * mixing.BLOCK


TARGETS = "source string, target_share double, max_repeats int"


def test_shares_and_repeats(spark):
    rows = [(i, s, 20 + i % 50) for i, s in enumerate(["a"] * 3000 + ["b"] * 1500 + ["c"] * 100 + ["x"] * 30 + [None] * 20)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 3), ("gone", 0.1, 5)], TARGETS)
    mixed, shares = mixing.mix(spark, sizes, targets)
    got = {r.source: r for r in shares.collect()}
    whole = 0.9
    for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert abs(got[s].actual_share - w / whole) < 0.02
    assert got["c"].repeats == 3 and got["a"].repeats == 1
    assert got["gone"].used_tokens == 0 and got["x"].target_share == 0 and None in got
    out = mixed.collect()
    assert len({(r.doc_id, r.repeat_no) for r in out}) == len(out)
    assert max(r.repeat_no for r in out) == 2
    assert {r.source for r in out} == {"a", "b", "c"}


def test_empty(spark):
    sizes = spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    mixed, shares = mixing.mix(spark, sizes, targets)
    assert mixed.count() == 0
    assert [(r.source, r.used_tokens) for r in shares.collect()] == [("a", 0)]


def test_total_beyond_what_there_is():
    assert mixing.amounts({"a": 100, "b": 100}, [("a", 0.9, 1), ("b", 0.1, 5)], 1000) == {"a": 100, "b": 100}
    assert mixing.amounts({}, [("a", 1.0, 1)]) == {}
