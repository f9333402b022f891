"""Approximate nearest neighbours by balanced posting lists.

A bounded sample is cut in two again and again, each time at the median along the line
between the means of its halves, so all lists have as many vectors of the sample, crowds
of near copies too; the means of the last halves are the centroids. Every vector is kept
in the list of its nearest centroid, and a boundary vector also in the lists of the next
ones, if they are nearly as near.

The centroids, a bounded number, are searched through a graph in memory: each is joined
to its nearest ones, leaving out those that are nearer to one already joined, so the
graph has both near and far edges. A search expands, from a few entries, all centroids
that are among the nearest ones seen or within the distance ratio asked for.

A query looks into all lists whose centroid is at most ``ratio`` times as far as the
nearest one. The ratio is learned: the sample's own nearest neighbours are found by brute
force, and it is the ratio at which the share ``reach`` of them lies in a list looked
into. No number of lists is fixed, so a query between many lists sees many.

Lists are cut into blocks of rows and the queries of a list into blocks of queries, by a
hash, so neither a crowded list nor a list that many ask for meets in one task. A block is
compared by one matrix product; whatever may be among the nearest by it is measured again
exactly on the original vectors. A row found in several lists counts once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from orderlake.llm.tables import anew, few_of, fields, written
from orderlake.llm.vectors import block_of, blocks_of, common_dimension, each_of, is_whole, matrix

#: Vectors compared with all centroids, pairs ranked, and pairs measured exactly at once.
_BATCH = 256
_PAIRS = 1 << 20
_EXACT = 1 << 15
#: Relative error of a squared distance that is a difference of products, with room.
_ERROR = 1e-12


@dataclass(frozen=True)
class ListIndex:
    """Centroids, the neighbours of each in the graph, entries to it, and the ratio."""

    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray
    ratio: float = 1.0

    def distances(self, vectors: np.ndarray, ratio: float, nearest: int = 8) -> np.ndarray:
        """Distance of each vector to the centroids that the graph leads to; else infinite.

        All centroids within ``ratio`` of the nearest one are expanded, and the
        ``nearest`` ones whatever the ratio.
        """
        k = len(self.centroids)
        found = np.full((len(vectors), k), np.inf)
        expanded = np.zeros((len(vectors), k), bool)
        nearest = min(nearest, k) - 1
        rows, nodes = np.indices((len(vectors), len(self.entries))).reshape(2, -1)
        nodes = self.entries[nodes]
        while len(rows):
            apart = vectors[rows] - self.centroids[nodes]
            found[rows, nodes] = np.sqrt(np.einsum("ij,ij->i", apart, apart))
            bound = np.maximum(
                ratio * found.min(axis=1), np.partition(found, nearest, axis=1)[:, nearest]
            )
            at, node = np.nonzero((found <= bound[:, None]) & ~expanded & np.isfinite(found))
            expanded[at, node] = True
            seen = np.isfinite(found)
            seen[np.repeat(at, self.neighbours.shape[1]), self.neighbours[node].ravel()] = True
            rows, nodes = np.nonzero(seen & np.isinf(found))
        return found


def _cut_in_two(x: np.ndarray, start: np.random.Generator, rounds: int = 6) -> tuple:
    half = len(x) // 2
    ends = x[start.choice(len(x), 2, replace=False)]
    order = np.arange(len(x))
    for _ in range(rounds):
        order = np.argsort(x @ (ends[1] - ends[0]), kind="stable")
        ends = np.stack([x[order[:half]].mean(axis=0), x[order[half:]].mean(axis=0)])
    return order[:half], order[half:]


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Distinct centroids of at most ``lists`` parts of the sample, of equal size."""
    start = np.random.default_rng(seed)
    parts = [np.arange(len(sample))]
    while 2 * len(parts) <= lists and len(parts[0]) >= 2:
        cut = [(part, _cut_in_two(sample[part], start)) for part in parts]
        parts = [part[side] for part, sides in cut for side in sides if len(side)]
    return np.unique(np.stack([sample[part].mean(axis=0) for part in parts]), axis=0)


def _between(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances; infinite where a square is beyond a double."""
    with np.errstate(over="ignore", invalid="ignore"):
        squared = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T
    return np.sqrt(np.where(np.isnan(squared), np.inf, np.maximum(squared, 0)))


def centroid_graph(centroids: np.ndarray, degree: int = 24, entries: int = 8) -> ListIndex:
    """Join each centroid to its nearest ones that no joined one is nearer to."""
    k = len(centroids)
    apart = _between(centroids, centroids)
    np.fill_diagonal(apart, np.inf)
    joined: list[set[int]] = [set() for _ in range(k)]
    for i in range(k):
        left = apart[i].copy()
        for _ in range(degree):
            j = int(left.argmin())
            if not np.isfinite(left[j]):
                break
            joined[i].add(j)
            joined[j].add(i)
            left[apart[j] < apart[i]] = np.inf
            left[j] = np.inf
    # What the degree has cut off is joined to the rest by its shortest way there.
    reached = np.zeros(k, bool)
    todo = [0]
    while True:
        while todo:
            i = todo.pop()
            if not reached[i]:
                reached[i] = True
                todo += joined[i]
        if reached.all():
            break
        inside, outside = np.flatnonzero(reached), np.flatnonzero(~reached)
        ways = apart[np.ix_(inside, outside)]
        i, j = np.unravel_index(ways.argmin(), ways.shape)
        joined[inside[i]].add(int(outside[j]))
        joined[outside[j]].add(int(inside[i]))
        todo = [int(outside[j])]
    width = max([1, *map(len, joined)])
    neighbours = np.array([[*sorted(x), *[i] * (width - len(x))] for i, x in enumerate(joined)])
    # Entries far from each other: the one that is farthest from those before it.
    first = [0]
    far = apart[0].copy()
    for _ in range(min(entries, k) - 1):
        far[first[-1]] = -1
        first.append(int(np.where(np.isfinite(far), far, -1).argmax()))
        far = np.minimum(far, apart[first[-1]])
    return ListIndex(centroids, neighbours, np.unique(first))


def lists_of(index: ListIndex, vectors: np.ndarray, spread: float, copies: int) -> list[np.ndarray]:
    """Lists that keep each vector: that of its nearest centroid, and of a boundary vector
    up to ``copies`` in all, of distances within 1 + ``spread`` of the nearest."""
    out = []
    for at in range(0, len(vectors), _BATCH):
        found = index.distances(vectors[at : at + _BATCH], 1 + spread)
        order = np.argsort(found, axis=1, kind="stable")[:, :copies]
        near = np.take_along_axis(found, order, axis=1)
        # A list is as near as the nearest one or beyond it, so the first is always kept.
        kept = near <= (1 + spread) * near[:, :1]
        out += [some[own] for some, own in zip(order, kept)]
    return out


def probes_of(index: ListIndex, vectors: np.ndarray) -> list[np.ndarray]:
    """Lists that each query looks into."""
    out: list[np.ndarray] = []
    for at in range(0, len(vectors), _BATCH):
        found = index.distances(vectors[at : at + _BATCH], index.ratio)
        near = found <= index.ratio * found.min(axis=1, keepdims=True)
        out += [np.flatnonzero(row) for row in near]
    return out


def learn_ratio(
    index: ListIndex, sample: np.ndarray, wanted: int, spread: float, copies: int, reach: float,
    asked: int = 256,
) -> float:
    """Ratio at which the share ``reach`` of the neighbours within the sample is found."""
    asked = min(asked, len(sample))
    wanted = min(wanted, len(sample) - 1)
    if wanted < 1 or len(index.centroids) < 2:
        return 1.0
    # The sample comes in the order of a hash: its first rows are as good as any.
    apart = _between(sample[:asked], sample)
    apart[np.arange(asked), np.arange(asked)] = np.inf
    near = np.argpartition(apart, wanted - 1, axis=1)[:, :wanted]
    members = np.zeros((len(sample), len(index.centroids)), bool)
    for i, kept in enumerate(lists_of(index, sample, spread, copies)):
        members[i, kept] = True
    to_lists = _between(sample[:asked], index.centroids)
    nearest = to_lists.min(axis=1, keepdims=True)
    # A query that stands on a centroid finds its neighbours there, at any ratio.
    ratios = np.divide(to_lists, nearest, out=np.ones_like(to_lists), where=nearest > 1e-9)
    needed = np.where(members[near], ratios[:, None, :], np.inf).min(axis=2)
    return float(np.quantile(needed[np.isfinite(needed)], reach)) if np.isfinite(needed).any() else 1.0


def fit_lists(
    sample: np.ndarray, lists: int, wanted: int, spread: float, copies: int, reach: float
) -> ListIndex:
    index = centroid_graph(balanced_centroids(sample, lists))
    ratio = learn_ratio(index, sample, wanted, spread, copies, reach)
    return ListIndex(index.centroids, index.neighbours, index.entries, ratio)


def _nearest_in_block(
    queries: pd.DataFrame, rows: pd.DataFrame, wanted: int, dimension: int
) -> pd.DataFrame:
    """The ``wanted`` nearest rows of each query, other than itself, measured exactly."""
    x, y = matrix(queries["vector"], dimension), matrix(rows["vector"], dimension)
    with np.errstate(over="ignore"):
        xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    ask, place, ids = (a.to_numpy() for a in (queries["place"], rows["place"], rows["id"]))
    found = []
    step = max(1, _PAIRS // max(1, len(y)))
    for at in range(0, len(x), step):
        some = slice(at, at + step)
        with np.errstate(over="ignore", invalid="ignore"):
            sizes = xx[some, None] + yy
            squared, error = sizes - 2 * x[some] @ y.T, _ERROR * sizes
        # One more than wanted, as the query itself may be among the rows.
        if len(y) > wanted + 1:
            worst = np.partition(squared + error, wanted, axis=1)[:, wanted, None]
        else:
            worst = np.inf
        i, j = np.nonzero(~(squared - error > worst))
        i = i + at
        other = ask[i] != place[j]
        i, j = i[other], j[other]
        score = np.empty(len(i))
        for part in range(0, len(i), _EXACT):
            pairs = slice(part, part + _EXACT)
            apart = x[i[pairs]] - y[j[pairs]]
            with np.errstate(over="ignore"):
                score[pairs] = np.sqrt((apart * apart).sum(axis=1))
        order = np.lexsort((place[j], ids[j], score, i))
        i, j, score = i[order], j[order], score[order]
        turn = np.arange(len(i)) - np.searchsorted(i, i)
        kept = turn < wanted
        found.append((i[kept], j[kept], score[kept]))
    i, j, score = (np.concatenate(a) for a in zip(*found))
    return pd.DataFrame(
        {
            "asked": ask[i],
            "query_id": queries["id"].to_numpy()[i],
            "place": place[j],
            "vec_id": ids[j],
            "score": score,
        }
    )


def nearest_vectors(
    vectors: DataFrame,
    every: int = 100,
    wanted: int = 10,
    list_size: int = 512,
    max_lists: int = 1024,
    sample: int = 16384,
    spread: float = 0.02,
    copies: int = 3,
    reach: float = 0.97,
    block: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found of each query, ranked.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but
    the query itself. ``score`` is the Euclidean distance in double precision; the
    smallest comes first, and ties go to the smaller id. A query has ``wanted`` results,
    or as many as its lists hold.

    There are as many lists, a power of two, as of ``list_size`` vectors each cover the
    table, up to ``max_lists``; beyond that lists grow, in blocks. Centroids and ratio are
    learned from ``sample`` vectors, the first by a hash; every vector is indexed.

    A vector that is null, zero, not of the commonest length, or holds null or non-finite
    components takes no part, nor does a row of null id. Rows that repeat are rows of
    their own. Other columns are not looked at. No rows give none.
    """
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    dimension = common_dimension(rows)
    rows = rows.filter(
        F.col("id").isNotNull()
        & is_whole(F.col("vector"), dimension)
        & F.exists("vector", lambda x: x != 0)
    )
    n = rows.count()
    few = rows.filter(few_of(F.lit(0), {0: n}, sample, "id", "vector"))
    learned = few.orderBy(F.xxhash64("id", "vector"), "id").select("vector").limit(sample).toPandas()
    lists = max(1, min(max_lists, n // list_size, len(learned) // 8))
    known = matrix(learned["vector"], dimension) if n else np.zeros((1, 1))
    index = fit_lists(known, lists, wanted, spread, copies, reach)

    def indexed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                x = matrix(part["vector"], dimension)
                asks = (part["id"] % every == 0).to_numpy()
                probes = np.full(len(x), None)
                probes[asks] = np.fromiter(probes_of(index, x[asks]), object, int(asks.sum()))
                yield part.assign(lists=lists_of(index, x, spread, copies), probes=probes)

    numbers = ArrayType(IntegerType())
    schema = StructType([*rows.schema, StructField("lists", numbers), StructField("probes", numbers)])
    placed = rows.mapInPandas(indexed, schema).withColumn("place", F.monotonically_increasing_id())
    table = written(placed, "posting-lists")
    entries = table.select(F.explode("lists").alias("list"), "place", "id", "vector")
    asked = table.select(F.explode("probes").alias("list"), "place", "id", "vector")
    # One row for each list that is looked into; their number is bounded.
    sizes = (
        table.select(F.explode("lists").alias("list"), F.lit(1).alias("of"))
        .union(table.select(F.explode("probes"), F.lit(0)))
        .groupBy("list")
        .agg(F.sum("of").alias("rows"), F.sum(1 - F.col("of")).alias("queries"))
        .filter("rows > 0 and queries > 0")
        .select(
            "list",
            blocks_of(F.col("rows"), block).alias("blocks"),
            blocks_of(F.col("queries"), block).alias("query_blocks"),
        )
    )
    sizes = F.broadcast(written(sizes, "list-sizes"))
    keys = ["list", "b", "q"]
    entries = (
        entries.join(sizes, "list")
        .withColumn("b", block_of("place", "blocks"))
        .withColumn("q", each_of("query_blocks"))
        .select(*keys, "place", "id", "vector")
    )
    asked = (
        asked.join(sizes, "list")
        .withColumn("q", block_of("place", "query_blocks", 1))
        .withColumn("b", each_of("blocks"))
        .select(*keys, "place", "id", "vector")
    )

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame(columns=["asked", "query_id", "place", "vec_id", "score"])
        return _nearest_in_block(queries, rows, wanted, dimension)

    kinds = [(name, LongType()) for name in ("asked", "query_id", "place", "vec_id")]
    found = (
        anew(asked)
        .groupBy(*keys)
        .cogroup(entries.groupBy(*keys))
        .applyInPandas(search, fields(*kinds, ("score", DoubleType())))
    )
    # A row has the same score from each of its lists, and so the same rank.
    order = Window.partitionBy("asked").orderBy("score", "vec_id", "place")
    return (
        found.withColumn("rank", F.dense_rank().over(order))
        .filter(F.col("rank") <= wanted)
        .dropDuplicates(["asked", "rank"])
        .select("query_id", "rank", "vec_id", "score")
    )
