import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import splitting as S


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab 。，.\n字é́😀", max_size=400), st.integers(5, 60), st.integers(0, 4))
def test_round_trip(text, limit, overlap):
    cut = S.split(text, limit, overlap)
    assert all(b - a <= limit for a, b in cut)
    parts = [text[a:b] for a, b in cut]
    assert parts[:1] + [p[overlap:] for p in parts[1:]] == [] if not text else "".join(parts[:1] + [p[overlap:] for p in parts[1:]]) == text


def test_natural_boundaries():
    text = "".join(f"这是第{i}句话，内容不长不短刚刚好。" for i in range(200))
    cut = S.split(text, 300, 20)
    assert all(text[b - 1] == "。" for _, b in cut)
    sizes = [b - a for a, b in cut]
    assert max(sizes[1:-1]) - min(sizes[1:-1]) <= 60


def test_hard_cases():
    assert S.split("", 10, 2) == []
    assert S.split("x" * 10, 10, 2) == [(0, 10)]
    assert len(S.split("x" * 100_000, 1024, 64)) >= 104
    with pytest.raises(ValueError):
        S.split("x", 10, 10)
    for a, b in S.split("e\u0301" * 300, 50, 4)[:-1]:
        assert b % 2 == 0


def test_pieces(spark):
    rows = [(1, "a b. " * 300, "z"), (1, "a b. " * 300, "z"), (2, None, None), (3, "", ""), (4, "x" * 1024, ""), (5, "x" * 1025, "")]
    df = spark.createDataFrame(rows, "chunk_id bigint, content string, piece_no string")
    got = S.pieces(df, "chunk_id", "content").collect()
    assert sorted({r.chunk_id for r in got}) == [1, 5] == sorted(r.chunk_id for r in S.oversized(df, "chunk_id", "content").collect())
    assert [r.n_pieces for r in got if r.chunk_id == 1] == [2, 2]
    assert S.pieces(df.limit(0), "chunk_id", "content").count() == 0
