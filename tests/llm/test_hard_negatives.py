"""Hard negatives against plain scoring of all pairs, and their SQL."""

import math

import numpy as np
import pytest
from compare import differences, duck

from orderlake.llm import hard_negatives
from orderlake.llm.hard_negatives import SortedLists, mine_negatives
from orderlake.llm.queries import LLM_ORACLES, LLM_QUERIES

SMOKE_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, every=100, positives=5, negatives=5, least=80, dimension=8):
    good = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if None not in (i, label) and v is not None and len(v) == dimension and None not in v
        and all(map(math.isfinite, v))
    ]
    out = []
    for at, (anchor, a, label) in enumerate(good):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, v)), i, other)
            for n, (i, v, other) in enumerate(good)
            if n != at
        ]
        for score, positive, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            inside = sorted(
                x for x in scored if x[2] != label and least * -score <= 100 * -x[0] <= 100 * -score
            )
            out += [
                (anchor, positive, rank, i, -score, -s)
                for rank, (s, i, _) in enumerate(inside[:negatives], 1)
            ]
    return sorted(out)


def found(spark, rows, **options):
    return sorted(map(tuple, mine_negatives(spark.createDataFrame(rows, SCHEMA), **options).collect()))


def some_rows(n=300, labels=4, coarse=False, seed=3):
    """Rows of a few labels; coarse ones have many equal scores."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-2, 3, size=(n, 8)) / 4 if coarse else rng.normal(size=(n, 8))
    return [(i, list(map(float, v)), int(rng.integers(labels))) for i, v in enumerate(x)]


@pytest.mark.parametrize("block", [16, 2048])
@pytest.mark.parametrize("coarse", [False, True])
def test_equal_to_brute_force(spark, block, coarse):
    rows = some_rows(coarse=coarse)
    got = found(spark, rows, every=10, block=block)
    assert got == brute(rows, every=10) and len(got) > 50


def test_a_hot_label_and_equal_vectors(spark):
    rows = some_rows(200)
    rows += [(1000 + i, rows[0][1], 1) for i in range(120)] + [(2000 + i, rows[10][1], 2) for i in range(120)]
    got = found(spark, rows, every=10, block=32)
    assert got == brute(rows, every=10)


def test_other_windows(spark):
    rows = some_rows(150, labels=2)
    options = {"every": 5, "positives": 2, "negatives": 3, "least": 30}
    assert found(spark, rows, **options) == brute(rows, **options)


def test_negative_and_zero_scores(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.9, 0.0], 2),  # a negative positive: no window
        (100, [0.0, 0.0], 3), (101, [1.0, 1.0], 3), (102, [1.0, 2.0], 4),  # all scores are zero
        (200, [1.0, 1.0], 5),  # no positive
    ]
    got = found(spark, rows)
    assert got == brute(rows, dimension=2)
    assert {x[0] for x in got} == {100}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0]
    rows = [
        (0, v, 1), (0, v, 1), (1, v, 1), (2, [1.0, 1.9], 2), (2, [1.0, 1.9], 2), (None, v, 2),
        (3, v, None), (4, None, 2), (5, [1.0, None], 2), (6, [1.0, nan], 2), (7, [inf, 1.0], 2),
        (8, [], 2), (9, [1.0, 2.0, 3.0], 2), (10, [0.0, 0.0], 2), (-100, [0.5, 0.5], 1),
    ]
    got = found(spark, rows)
    assert got == brute(rows, dimension=2)
    assert {x[0] for x in got} == {0, -100}
    beyond = [(11, [1e6, 1.0], 2), (12, [1e300, 1.0], 2)]
    assert found(spark, rows + beyond) == got


def test_extra_columns_and_none(spark):
    frame = spark.createDataFrame(some_rows(40), SCHEMA)
    more = frame.selectExpr("*", "1 id", "2 place", "3 part", "4 rank", "5 score", "6 vector", "7 scores")
    assert sorted(mine_negatives(more, every=5).collect()) == sorted(mine_negatives(frame, every=5).collect())
    assert mine_negatives(frame.limit(0)).collect() == []
    assert mine_negatives(frame.selectExpr("vec_id", "embedding", "cast(null as int) label")).collect() == []


def test_threshold_bounds_what_is_not_seen():
    rng = np.random.default_rng(4)
    values = rng.integers(-50, 50, size=(500, 6))
    lists = SortedLists(values, np.arange(500), np.arange(500), np.zeros(500))
    anchor = np.array([3, -2, 0, 5, -1, 1])
    seen, steps = np.zeros(500, bool), 0
    for rows, scores, threshold in lists.descend(anchor):
        assert not seen[rows].any() and (scores == values[rows] @ anchor).all()
        seen[rows] = True
        steps += 1
        assert seen.all() or (values[~seen] @ anchor).max() <= threshold
    assert seen.all() and steps > 2


def test_search_ends_early():
    """One row stands out: the lists are left before all rows have been scored."""
    values = np.zeros((4000, 3), np.int64)
    values[:, 0] = np.arange(4000)
    values[7] = [9000, 10, 10]
    lists = SortedLists(values, np.arange(4000), np.arange(4000), np.zeros(4000))
    scored = []

    def fits(rows):
        scored.append(len(rows))
        return np.ones(len(rows), bool)

    window, rows, scores = lists.search(
        np.array([5, 1, 0]), fits, np.array([0, 50_000]), np.array([1 << 40, 0]), 1
    )
    assert (window.tolist(), rows.tolist(), scores.tolist()) == ([0], [7], [45_010])
    assert sum(scored) < 100


def test_scores_beyond_doubles():
    values = np.array([[1 << 24, 1 << 24, 1 << 24], [(1 << 24) - 1, 1 << 24, 1 << 24]])
    lists = SortedLists(values, np.arange(2), np.arange(2), np.zeros(2))
    anchor = np.array([1 << 24, (1 << 24) - 1, 1 << 24])
    expected = [sum(x * y for x, y in zip(v, map(int, anchor))) for v in values.tolist()]
    assert lists.scores(np.arange(2), anchor).tolist() == expected
    window, rows, scores = lists.search(
        anchor, lambda r: np.ones(len(r), bool), np.array([0]), np.array([expected[1]]), 5
    )
    assert rows.tolist() == [1] and scores.tolist() == [expected[1]]


def test_steps_change_nothing(spark, monkeypatch):
    rows = some_rows(100, coarse=True)
    monkeypatch.setattr(hard_negatives, "_FIRST_STEP", 1000)
    assert found(spark, rows, every=5) == brute(rows, every=5)


def test_query(spark):
    df = LLM_QUERIES["op13_hard_negatives"](spark, SMOKE_DIR)
    assert df.count() > 0
    assert differences(df, LLM_ORACLES["op13_hard_negatives"], duck(SMOKE_DIR)) is None
