import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import packing


def plain(sizes, capacity):
    free, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((j for j, f in enumerate(free) if f >= sizes[i]), len(free))
        if at == len(free):
            free.append(capacity)
        free[at] -= sizes[i]
        out[i] = at
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_equals_plain_first_fit(sizes):
    assert packing.first_fit_decreasing(sizes, 50) == plain(sizes, 50)


LIMITS = "pack_name string, capacity_tokens int, lang string"


def test_pack(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["zh", "en", None]), rng.randint(1, 300)) for i in range(2000)] + [(9000, "zh", 1001)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, lang string, n_tokens bigint")
    limits = spark.createDataFrame([("a", 256, None), ("z", 512, "zh"), ("none", 100, "xx"), ("bad", 0, None), ("a", 256, None)], LIMITS)
    got = packing.pack(sizes, limits, group=500).collect()
    size, lang = {r[0]: r[2] for r in rows}, {r[0]: r[1] for r in rows}
    for name, capacity, langs in (("a", 256, {"zh", "en", None}), ("z", 512, {"zh"})):
        own = [r for r in got if r.pack_name == name]
        used = Counter()
        for r in own:
            used[r.container_id] += r.n_tokens
        assert max(used.values()) <= capacity
        total = Counter()
        for r in own:
            total[r.doc_id] += r.n_tokens
        assert dict(total) == {k: n for k, n in size.items() if lang[k] in langs}
        assert all(r.piece_no == 0 for r in own if size[r.doc_id] <= capacity)
        assert sum(used.values()) / (capacity * len(used)) > 0.95
    assert {r.pack_name for r in got} == {"a", "z"}
    assert packing.pack(sizes.limit(0), limits).count() == 0
    filled = {r.pack_name: r for r in packing.fill(packing.pack(sizes, limits), limits.filter("capacity_tokens > 0").distinct()).collect()}
    assert filled["none"].containers == 0 and filled["none"].used_share is None
