"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Iterative quantisation learns a rotation of the leading principal directions under which
the signs of the coordinates lose least: signs and rotation are fitted to each other in
turns, which spreads the variance over all bits and so balances them. A vector's code is
its signs. The code is cut into segments, and each segment has a table of its keys. Vectors
of a small angle differ in few bits: if in fewer than there are segments, they agree in
one of them, so the ball to look up round a key is the key itself. Pairs of more bits
apart mostly do too. Every pair that meets in a table is reranked by its cosine in
double precision.

The rotation is fitted to ``sample`` vectors, the first by a hash of their id; every
vector is indexed. Recall against brute force is tested.

Equal vectors are one node with a number of copies. A bucket may still hold a large part
of all nodes: it is cut into blocks of about ``block`` rows by a hash, and each pair of
blocks is one group. Its comparisons are one matrix product, and it returns for each row
the number of its links and one row it is connected with, never the pairs. A pair that
meets in several tables counts in the first only, which the codes tell. The comparisons
in a bucket are the square of its size, as the number of links is asked for; rows, tasks
and memory are bounded by the block. For more vectors take more ``bits``, so that the
keys of a segment stay selective.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from orderlake.llm.components import component_labels
from orderlake.llm.tables import few_of, fields, written


@dataclass(frozen=True)
class Quantiser:
    """Centre, and one direction for each bit."""

    centre: np.ndarray
    directions: np.ndarray


def learn_rotation(vectors: np.ndarray, bits: int, rounds: int = 50, seed: int = 3) -> Quantiser:
    """Iterative quantisation of unit vectors; more bits than dimensions are filled up.

    Principal directions beyond the sample's rank, and bits beyond the dimension, get
    random directions, so a code has always ``bits`` bits.
    """
    rng = np.random.default_rng(seed)
    dimension = vectors.shape[1]
    centre = vectors.mean(axis=0) if len(vectors) else np.zeros(dimension)
    used = min(bits, dimension)
    _, basis = np.linalg.eigh(np.cov((vectors - centre).T) if len(vectors) > 1 else np.eye(dimension))
    basis = np.atleast_2d(basis)[:, ::-1][:, :used]
    rotation = np.linalg.qr(rng.normal(size=(used, used)))[0]
    projected = (vectors - centre) @ basis
    for _ in range(rounds if len(vectors) else 0):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        rotation = (left @ right).T
    more = rng.normal(size=(dimension, bits - used))
    return Quantiser(centre, np.hstack([basis @ rotation, more]))


def _usable(vector: Column, dimension: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vector.isNotNull()
        & (F.size(vector) == dimension)
        & F.coalesce(finite, F.lit(False))
        & F.exists(vector, lambda x: x != 0)
    )


def _dimension(rows: DataFrame) -> int:
    """The commonest length of a vector; the shorter one of two as common."""
    first = (
        rows.filter(F.size("vector") > 0)
        .groupBy(F.size("vector").alias("n"))
        .count()
        .orderBy(F.desc("count"), "n")
        .first()
    )
    return first.n if first else 0


def _units(vectors: pd.Series) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _with_keys(nodes: DataFrame, quantiser: Quantiser, segments: int) -> DataFrame:
    """``nodes`` with the keys of their codes, one for each segment."""
    width = quantiser.directions.shape[1] // segments
    powers = (1 << np.arange(width)).astype(np.int64)

    def code(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                x = _units(part["vector"])
                signs = (x - quantiser.centre) @ quantiser.directions >= 0
                keys = signs.reshape(len(x), segments, width) @ powers
                yield part.assign(keys=list(keys))

    keys = StructField("keys", ArrayType(LongType()))
    return nodes.mapInPandas(code, StructType([*nodes.schema, keys]))


def _links_between(group: pd.DataFrame, threshold: float, rows_at_once: int) -> pd.DataFrame:
    """Links of each row of a pair of blocks, and a root of what it is connected with.

    ``side`` is 0 or 1, or 2 for all rows if a block meets itself. A pair that shares a
    key in an earlier table is left to that table.
    """
    table = int(group["s"].iloc[0])
    unit, keys = _units(group["vector"]), np.stack(group["keys"].to_numpy())[:, :table]
    copies, side = group["copies"].to_numpy(), group["side"].to_numpy()
    counts, parent = np.zeros(len(group), np.int64), np.arange(len(group))
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    for at in range(0, len(left), rows_at_once):
        some = left[at : at + rows_at_once]
        i, j = np.nonzero(unit[some] @ unit[right].T >= threshold)
        x, y = some[i], right[j]
        # A block that meets itself shows each pair twice, and each row to itself.
        fresh = (side[x] != 2) | (x < y)
        x, y = x[fresh], y[fresh]
        for t in range(table):
            fresh = keys[x, t] != keys[y, t]
            x, y = x[fresh], y[fresh]
        np.add.at(counts, x, copies[y])
        np.add.at(counts, y, copies[x])
        _join(parent, x, y)
    node = group["node"].to_numpy()
    some = counts > 0
    return pd.DataFrame({"node": node[some], "n": counts[some], "root": node[_roots(parent)[some]]})


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _join(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Put the ends of each link under one root; roots are smallest members."""
    while len(x):
        root = _roots(parent)
        parent[:] = root
        rx, ry = root[x], root[y]
        apart = rx != ry
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        np.minimum.at(parent, np.maximum(rx, ry), np.minimum(rx, ry))


def similar_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    bits: int = 64,
    segments: int = 8,
    sample: int = 4000,
    block: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row of ``vectors``.

    ``n_links`` counts the other rows with a cosine of at least ``threshold`` that were
    found, equal vectors included; ``component_id`` is the smallest id reachable by
    links, the row's own included, and ``kept`` marks the rows that bear it.

    A vector that is null, zero, not of the commonest length, or holds null or
    non-finite components links with nothing. Rows that repeat are rows of their own. A
    null id takes part, but never names a component; a row of null id is kept only if
    its component has no other id. Other columns are not looked at. No rows give none.
    """
    if bits % segments:
        raise ValueError("bits must be a multiple of segments")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    dimension = _dimension(rows)
    rows = rows.withColumn("usable", _usable(F.col("vector"), dimension))
    grouped = (
        rows.filter("usable").groupBy("vector").agg(F.count("*").alias("copies"), F.min("id").alias("first"))
    )
    nodes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")

    # Cut down by the hash first: sorting all would send so many rows of each partition.
    few = nodes.filter(few_of(F.lit(0), {0: nodes.count()}, sample, "vector"))
    learned = few.orderBy(F.xxhash64("vector")).select("vector").limit(sample).toPandas()
    units = _units(learned["vector"]) if len(learned) else np.zeros((0, max(dimension, 1)))
    keyed = _with_keys(
        nodes.select("node", "vector", "copies"), learn_rotation(units, bits), segments
    )
    entries = keyed.select("*", F.posexplode("keys").alias("s", "k"))
    # A bucket of one row has no pair; others are cut into blocks.
    buckets = (
        entries.groupBy("s", "k")
        .agg(F.count("*").alias("size"))
        .filter("size > 1")
        .select("s", "k", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    )
    placed = entries.join(buckets, ["s", "k"]).withColumn(
        "b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    met = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "s",
        "k",
        F.least("b", "o").alias("i"),
        F.greatest("b", "o").alias("j"),
        F.when(F.col("b") == F.col("o"), 2).when(F.col("b") < F.col("o"), 0).otherwise(1).alias("side"),
        "node",
        "vector",
        "copies",
        "keys",
    )
    rows_at_once = max(1, (1 << 20) // block)

    def links(group: pd.DataFrame) -> pd.DataFrame:
        return _links_between(group, threshold, rows_at_once)

    found = written(
        met.groupBy("s", "k", "i", "j").applyInPandas(
            links, fields(("node", LongType()), ("n", LongType()), ("root", LongType()))
        ),
        "vector-links",
    )
    labels = component_labels(found.filter("node != root"), "node", "root")
    counted = found.groupBy("node").agg(F.sum("n").alias("n"))
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    about = (
        named.join(least, "label")
        .join(counted, "node", "left")
        .select(
            "vector",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            "component_id",
        )
    )
    linked = rows.filter("usable").join(about, "vector").select("id", "n_links", "component_id")
    alone = rows.filter(~F.col("usable")).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.union(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
