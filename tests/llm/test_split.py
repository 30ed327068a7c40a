import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import split


def check(t, limit=400, overlap=50):
    c = split.cut_positions(t, limit, overlap)
    s = t.strip()
    if not s:
        assert c == []
        return c
    assert t[c[0] : c[-1]] == s
    assert (len(c) == 2) == (len(s) <= limit)
    for i in range(len(c) - 1):
        begin = c[i] if i == 0 else c[i] - overlap
        assert c[0] <= begin and 0 < c[i + 1] - begin <= limit
    return c


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "word ", "Ende. ", "中", "。", "\n", "\n\n", "\r\n", ", ", "é", "‍", "\U0001f468", "x" * 60, " ", "-"]), max_size=400))
def test_round_trip_and_limits(parts):
    check("".join(parts))


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300), st.integers(2, 40))
def test_any_text_and_limit(t, limit):
    check(t, limit, limit // 4)


def test_strongest_boundary_near_the_middle():
    t = "one two three. " * 20 + "\n\n" + "four five six. " * 20
    assert t[: split.cut_positions(t)[1]].endswith("\n\n") or "\n\n" in t[: split.cut_positions(t)[2]]
    t = "w" * 150 + " " + "v" * 300
    assert split.cut_positions(t) == [0, 151, 451]


def test_breaks_are_taken_wherever_there_are_some():
    rng = random.Random(3)
    for _ in range(30):
        t = "".join(rng.choice(["abc", "defgh", " ", "\n", ". "]) for _ in range(900)).strip()
        for k in check(t)[1:-1]:
            assert re.search(r"\s$", t[:k])


def test_only_break_far_from_the_middle():
    t = "a" * 60 + " " + "b" * 500
    assert 61 in split.cut_positions(t)


def test_marks_stay_with_their_letter():
    t = "é" * 600
    for k in split.cut_positions(t)[1:-1]:
        assert t[k] != "́"


def test_very_long():
    assert len(check("z" * 300_000)) > 850 and check("ab " * 100_000)


def test_bad_overlap():
    with pytest.raises(ValueError):
        split.cut_positions("x", 10, 10)


def test_frame(spark, rows):
    long = "Sentence one is here. " * 40
    df = spark.createDataFrame([(1, long, "p"), (1, long, "p"), (2, "  ", "q"), (3, None, "r"), (4, "short", "s")], "id int, body string, begin string")
    out = split.split_items(df, "body")
    by = {}
    for r in out.collect():
        by.setdefault(r.id, []).append((r.chunk_index, r.piece, r.n_chunks))
    assert set(by) == {1, 4} and by[4] == [(0, "short", 1)]
    pieces = [p for _, p, _ in sorted(by[1])[::2]]
    assert pieces[0] + "".join(p[50:] for p in pieces[1:]) == long.strip() and all(q.startswith(p[-50:]) for p, q in zip(pieces, pieces[1:]))
    assert rows(split.oversized(df, "body")) == [(1, "p"), (1, "p")]
    assert split.split_items(df.limit(0), "body").count() == 0
    with pytest.raises(ValueError, match="piece"):
        split.split_items(df.withColumnRenamed("begin", "piece"), "body")
