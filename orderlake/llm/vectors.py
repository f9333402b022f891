"""What operators on tables of vectors share: which vectors take part, and their matrix."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def common_dimension(rows: DataFrame, vector: str = "vector") -> int:
    """The commonest length of a vector, the shorter one of two as common; 0 without any."""
    first = (
        rows.filter(F.size(vector) > 0)
        .groupBy(F.size(vector).alias("n"))
        .count()
        .orderBy(F.desc("count"), "n")
        .first()
    )
    return first.n if first else 0


def is_whole(vector: Column, dimension: int) -> Column:
    """True for a vector of ``dimension`` finite components; never null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dimension) & finite, F.lit(False))


def matrix(vectors: pd.Series, dimension: int, kind: type = np.float64) -> np.ndarray:
    """The vectors as rows of one array, also where there are none."""
    return np.stack(vectors.to_numpy()).astype(kind) if len(vectors) else np.zeros((0, dimension), kind)


def blocks_of(size: Column, block: int) -> Column:
    """Number of blocks of about ``block`` rows that ``size`` rows are cut into."""
    return F.greatest(F.lit(1), F.ceil(size / block)).cast("int")


def block_of(place: str, blocks: str, salt: int = 0) -> Column:
    """Block of a row by a hash of its place."""
    return F.pmod(F.xxhash64(place, F.lit(salt)), F.col(blocks)).cast("int")


def each_of(blocks: str) -> Column:
    """One row for each block."""
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
