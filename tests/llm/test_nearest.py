"""Approximate nearest neighbours against brute force."""

import numpy as np
import pytest

from orderlake.llm.nearest import (
    balanced_centroids,
    centroid_graph,
    fit_lists,
    lists_of,
    nearest_vectors,
    probes_of,
)
from orderlake.llm.queries import LLM_QUERIES

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, every=100, wanted=10, dimension=16):
    good = [
        (i, np.array(v))
        for i, v in rows
        if i is not None and v is not None and len(v) == dimension and None not in v
        and np.isfinite(v).all() and any(v)
    ]
    out = []
    for at, (query, q) in enumerate(good):
        if query % every == 0:
            near = sorted(
                (np.sqrt(((q - v) ** 2).sum()), i) for n, (i, v) in enumerate(good) if n != at
            )
            out += [(query, r, i, d) for r, (d, i) in enumerate(near[:wanted], 1)]
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, nearest_vectors(frame, **options).collect()))


def spread(n, dimension=16, seed=2):
    return [(i, list(map(float, v))) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, dimension)))]


def crowded(n=400, copies=150):
    """Spread vectors, a crowd of near copies, and equal vectors under many ids."""
    rng = np.random.default_rng(7)
    rows = spread(n)
    rows += [(1000 + i, list(map(float, np.array(rows[0][1]) + 0.01 * rng.normal(size=16)))) for i in range(copies)]
    return rows + [(3000 - i, rows[100][1]) for i in range(copies)]


def recall(got, rows, **options):
    want = {x[:1] + x[2:3] for x in brute(rows, **options)}
    return len(want & {x[:1] + x[2:3] for x in got}) / len(want)


def test_one_list_is_brute_force(spark):
    rows = crowded()
    assert found(spark, rows, list_size=10_000) == brute(rows)


@pytest.mark.parametrize("block", [16, 4096])
def test_recall_ranks_and_scores(spark, block):
    rows = crowded()
    got = found(spark, rows, list_size=16, every=10, block=block)
    assert recall(got, rows, every=10) >= 0.9
    vectors = dict(rows)
    by_query = {}
    for query, rank, i, score in got:
        apart = np.array(vectors[query]) - np.array(vectors[i])
        assert score == np.sqrt((apart * apart).sum())
        by_query.setdefault(query, []).append((rank, score, i))
    for some in by_query.values():
        assert [x[0] for x in sorted(some)] == list(range(1, 11))
        assert sorted(some) == sorted(some, key=lambda x: x[1:])


def test_blocks_change_nothing(spark):
    rows = crowded(200, 60)
    some = {"list_size": 32, "every": 3}
    assert found(spark, rows, block=7, **some) == found(spark, rows, block=4096, **some)


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [1.0, 2.0]) for i in (100, 7, 3, 200, 9)] + [(1, [1.0, 2.5])]
    got = found(spark, rows, wanted=4)
    assert [x[2] for x in got] == [3, 7, 9, 200, 3, 7, 9, 100] and {x[3] for x in got} == {0.0}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [3.0, 4.0]), (200, None), (300, []), (400, [0.0, 0.0]),
        (None, [1.0, 2.0]), (1, [1.0, None]), (2, [1.0, nan]), (3, [inf, 1.0]), (4, [1.0, 2.0, 3.0]),
        (5, [1e200, 1.0]), (6, [-1.0, -2.0]),
    ]
    got = found(spark, rows)
    assert got == brute(rows, dimension=2)
    assert {x[0] for x in got} == {0, 100}
    # Rows that repeat are rows of their own: each finds the other.
    assert [x[2:] for x in got if x[:2] == (0, 1)] == [(0, 0.0)] * 2


def test_extra_columns_and_none(spark):
    frame = spark.createDataFrame(spread(20), SCHEMA)
    more = frame.selectExpr("*", "1 id", "2 place", "3 list", "4 rank", "5 score", "6 vector", "7 b")
    assert nearest_vectors(more).collect() == nearest_vectors(frame).collect()
    assert nearest_vectors(frame.limit(0)).collect() == []
    assert nearest_vectors(frame.filter("vec_id = 0")).collect() == []
    assert nearest_vectors(frame.selectExpr("vec_id", "cast(null as array<float>) embedding")).collect() == []


def test_lists_are_balanced():
    x = np.array([v for _, v in crowded()])
    centroids = balanced_centroids(x, 32)
    assert 24 <= len(centroids) <= 32  # equal vectors share a centroid
    nearest = ((x[:, None] - centroids) ** 2).sum(axis=2).argmin(axis=1)
    assert np.bincount(nearest[:400]).max() < 60
    assert len(balanced_centroids(np.ones((50, 3)), 8)) == 1


def test_graph_finds_what_brute_force_finds():
    x = np.array([v for _, v in spread(3000)])
    index = centroid_graph(balanced_centroids(x, 256))
    some = x[:200]
    true = np.sqrt(((some[:, None] - index.centroids) ** 2).sum(axis=2))
    got = index.distances(some, 1.1)
    assert (got.argmin(axis=1) == true.argmin(axis=1)).mean() >= 0.99
    near = true <= 1.1 * true.min(axis=1, keepdims=True)
    assert np.allclose(got[np.isfinite(got)], true[np.isfinite(got)])
    assert np.isfinite(got[near]).mean() >= 0.97


def test_graph_is_one_piece():
    """Two far crowds, each with more centroids than a node has edges."""
    rng = np.random.default_rng(1)
    index = centroid_graph(np.vstack([rng.normal(size=(40, 4)), 1e6 + rng.normal(size=(40, 4))]), degree=3)
    assert np.isfinite(index.distances(np.zeros((1, 4)), 1e9)).all()


def test_boundary_vectors_are_in_several_lists():
    x = np.array([v for _, v in spread(2000)])
    index = fit_lists(x, 64, 10, 0.05, 4, 0.95)
    sizes = [len(kept) for kept in lists_of(index, x, 0.05, 4)]
    assert set(sizes) <= {1, 2, 3, 4} and 1.0 < np.mean(sizes) < 4.0
    assert index.ratio > 1 and len(probes_of(index, x[:5])) == 5


def test_query(spark):
    """Recall on real rows, and with many lists."""
    from pyspark.sql import functions as F

    path = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{path}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).collect()]
    got = sorted(map(tuple, LLM_QUERIES["op12_nearest_vectors"](spark, path).collect()))
    assert recall(got, rows, dimension=64) >= 0.9
    many = sorted(map(tuple, nearest_vectors(table, list_size=32, every=20).collect()))
    assert recall(many, rows, dimension=64, every=20) >= 0.9
