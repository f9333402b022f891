"""Similar vectors against brute force."""

import numpy as np
import pytest

from orderlake.llm.queries import LLM_QUERIES
from orderlake.llm.vector_dedup import learn_rotation, similar_vectors


def brute(rows, threshold=0.9, dimension=None):
    """(id, links, component, kept) by comparing all pairs in double precision."""
    good = [
        v is not None and len(v) == dimension and None not in v and np.isfinite(v).all() and any(v)
        for _, v in rows
    ]
    units = [np.array(v) / np.linalg.norm(v) if ok else None for (_, v), ok in zip(rows, good)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and units[i] @ units[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), vec_id) if x is not None]
        least[root(i)] = min(known) if known else None
    found = [(vec_id, links[i], least[root(i)]) for i, (vec_id, _) in enumerate(rows)]
    return sorted([(*x, x[0] == x[2]) for x in found], key=str)


def crowd(n, groups, noise, dimension=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dimension))
    near = [centres[i % groups] + noise * rng.normal(size=dimension) for i in range(n)]
    far = rng.normal(size=(n, dimension))
    return [(i, list(map(float, v))) for i, v in enumerate([*near, *far])]


@pytest.mark.parametrize("block", [16, 4096])
def test_equal_to_brute_force(spark, block):
    rows = crowd(200, 5, 0.05)
    rows += [(900 + i, rows[0][1]) for i in range(40)]  # equal vectors
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, similar_vectors(frame, bits=16, segments=4, block=block).collect()), key=str)
    assert got == brute(rows, dimension=16)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, v), (1, v), (2, [2.0, 4.0, 6.0]), (None, v), (None, None), (3, None), (4, []),
        (5, [0.0, 0.0, 0.0]), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 3.0]), (8, [1.0, nan, 3.0]),
        (9, [inf, 2.0, 3.0]), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]), (12, [1e300, 2e300, 3e300]),
        (13, [1e-300, 2e-300, 3e-300]), (14, [-0.0, 1.0, 0.0]), (15, [0.0, 1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    frame = frame.selectExpr("*", "1 AS node", "2 AS keys", "3 AS s", "4 AS id", "5 AS vector")
    got = sorted(map(tuple, similar_vectors(frame, bits=8, segments=4).collect()), key=str)
    scaled = [
        (i, [x / max(map(abs, v)) for x in v])
        if v and None not in v and np.isfinite(v).all() and any(v)
        else (i, v)
        for i, v in rows
    ]
    assert got == brute(scaled, dimension=3)
    assert similar_vectors(frame.limit(0)).collect() == []


def test_recall_on_real_vectors(spark):
    """Pairs at the threshold are few there, so noise makes some, at all distances."""
    rng = np.random.default_rng(3)
    base = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id")
    rows = [(r.vec_id, list(r.embedding)) for r in base.collect()]
    for i in range(300):
        v = np.array(rows[i][1])
        side = rng.normal(size=len(v))
        side -= side @ v * v / (v @ v)
        angle = np.arccos(rng.uniform(0.9, 1))
        made = np.cos(angle) * v / np.linalg.norm(v) + np.sin(angle) * side / np.linalg.norm(side)
        rows.append((10_000 + i, list(map(float, made))))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in similar_vectors(frame).collect()}
    expected = {i: n for i, n, _, _ in brute(rows, dimension=64)}
    assert all(got[i] <= expected[i] for i in got)
    assert sum(got.values()) >= 0.9 * sum(expected.values()) > 0


def test_query_on_real_vectors(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted(map(tuple, LLM_QUERIES["op5_vector_dedup"](spark, sf_dir).collect()), key=str)
    assert got == brute(rows, dimension=64)


def test_bits_are_balanced():
    vectors = np.random.default_rng(2).normal(size=(3000, 16)) * np.linspace(1, 8, 16) + 5
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    learned = learn_rotation(units, 24)
    share = ((units - learned.centre) @ learned.directions >= 0).mean(axis=0)
    assert share.shape == (24,) and (abs(share - 0.5) < 0.15).all()
    inside = learned.directions[:, :16]
    assert np.allclose(inside.T @ inside, np.eye(16))
