"""Hard negatives by Fagin's threshold algorithm.

An anchor is a linear score over the components of a candidate, so candidates are listed
for each component in the order of its value. The algorithm goes down all lists in step,
each from its large or its small end as the sign of the anchor's component says. Whatever
comes into sight is scored in full, by random access to its components. What has not been
seen in any list cannot score more than the sum of the anchor's components times the
values where the lists stand: the threshold.

An anchor first looks for its positives, the best rows of its own label. Each positive has
a window of scores, and the anchor then looks for the best rows of other labels in all its
windows, in one descent. It ends when the threshold is strictly below the last score kept
in each window (strictly, as a tie may go to a smaller id not yet seen), or below the
window.

Candidates are cut into blocks by a hash, each with lists of its own, those of a label
apart for the first search; anchors are cut into blocks too, and each block of anchors
meets each block of candidates. So neither a hot label nor many anchors meet in a task,
and only the few best of each window leave a block. All scores are integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from orderlake.llm.tables import anew, fields, small, written
from orderlake.llm.vectors import block_of, blocks_of, common_dimension, each_of, is_whole, matrix

#: Components beyond this could overflow a score of up to 2^15 of them.
LIMIT = 1 << 24
_LOWEST, _HIGHEST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max
#: Places of every list that are read before scores are looked at, and how that grows.
_FIRST_STEP, _GROWTH = 4, 3


class SortedLists:
    """The rows of a block, and for each component their order by it."""

    def __init__(self, values: np.ndarray, ids: np.ndarray, places: np.ndarray, labels: np.ndarray):
        self.values, self.ids, self.places, self.labels = values, ids, places, labels
        self.rising = np.argsort(values, axis=0, kind="stable")
        self.largest = int(np.abs(values).max(initial=0)) * values.shape[1]
        self.floats = values.astype(np.float64)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact scores: sums below 2^53 are whole in doubles, and faster there."""
        if self.largest * int(np.abs(anchor).max(initial=0)) < 1 << 53:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.values[rows] @ anchor

    def descend(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(rows, their scores, threshold) of what comes into sight, step by step.

        No row that is not yet seen scores more than the threshold. After the last step
        all rows have been seen, and the threshold is lower than any score.
        """
        used = np.flatnonzero(anchor)
        n = len(self.values)
        seen = np.zeros(n, bool)
        if not len(used):
            rows = np.arange(n)
            yield rows, np.zeros(n, np.int64), _LOWEST
            return
        weights, lists = anchor[used], self.rising[:, used]
        falls = weights > 0
        at, step = 0, _FIRST_STEP
        while at < n:
            end = min(n, at + step)
            places = np.where(falls, lists[n - end : n - at][::-1], lists[at:end])
            fresh = np.zeros(n, bool)
            fresh[places.ravel()] = True
            rows = np.flatnonzero(fresh & ~seen)
            seen[rows] = True
            at, step = end, _GROWTH * step
            done = at == n or seen.all()
            stands = self.values[places[-1], used]
            yield rows, self.scores(rows, anchor), _LOWEST if done else int(stands @ weights)
            if done:
                return

    def search(
        self,
        anchor: np.ndarray,
        fits: Callable[[np.ndarray], np.ndarray],
        low: np.ndarray,
        high: np.ndarray,
        wanted: int,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, row, score) of the best rows that ``fits`` in each window.

        Window w takes the scores from ``low[w]`` to ``high[w]``; ties go to the smaller
        id, then to the first row.
        """
        rows, scores = np.zeros(0, np.intp), np.zeros(0, np.int64)
        real = low <= high
        if real.any():
            lowest, highest = low[real].min(), high[real].max()
            for some, own, threshold in self.descend(anchor):
                inside = fits(some) & (own >= lowest) & (own <= highest)
                rows, scores = np.append(rows, some[inside]), np.append(scores, own[inside])
                last = np.sort(scores)
                at = np.searchsorted(last, high, "right") - wanted
                kth = last[np.maximum(at, 0)] if len(last) else low
                full = (at >= 0) & (kth >= low) & (threshold < kth)
                if (full | (threshold < low) | ~real).all():
                    break
        order = np.lexsort((self.places[rows], self.ids[rows], -scores))
        rows, scores = rows[order], scores[order]
        first = np.searchsorted(-scores, -high)
        window, turn = np.indices((len(low), wanted)).reshape(2, -1)
        at = first[window] + turn
        there = at < len(rows)
        window, at = window[there], at[there]
        kept = scores[at] >= low[window]
        return window[kept], rows[at[kept]], scores[at[kept]]


def _search_blocks(
    anchors: pd.DataFrame,
    rows: pd.DataFrame,
    dimension: int,
    wanted: int,
    same_label: bool,
    least: int,
) -> pd.DataFrame:
    """The best rows of a block for each anchor, in each of its windows."""
    lists = SortedLists(
        matrix(rows["vector"], dimension, np.int64),
        *(rows[c].to_numpy() for c in ("id", "place", "label")),
    )
    found = []
    asked = zip(anchors["vector"], anchors["place"], anchors["label"], anchors["scores"])
    for number, (vector, place, label, scores) in enumerate(asked):
        vector = np.asarray(vector, np.int64)
        if same_label:
            low, high = np.array([_LOWEST]), np.array([_HIGHEST])
            fits = lambda r, place=place: lists.places[r] != place
        else:
            # least * positive <= 100 * negative <= 100 * positive
            low = np.array([-(-least * int(s) // 100) for s in scores], np.int64)
            high = np.array(scores, np.int64)
            fits = lambda r, label=label: lists.labels[r] != label
        window, some, own = lists.search(vector, fits, low, high, wanted)
        found.append((np.full(len(some), number), window, some, own))
    number, window, some, scores = (np.concatenate(x) for x in zip(*found))
    return pd.DataFrame(
        {
            "anchor": anchors["place"].to_numpy()[number],
            "window": window,
            "id": lists.ids[some],
            "place": lists.places[some],
            "score": scores,
        }
    )


def _meet(
    anchors: DataFrame, rows: DataFrame, dimension: int, wanted: int, block: int, least: int | None
) -> DataFrame:
    """(anchor, window, id, place, score, turn): the best of all blocks, in turn.

    Without ``least``, an anchor meets all blocks of the rows of its label. With it, it
    meets all blocks of all rows; rows have to have another label, and to lie in a window
    below each of ``scores``.
    """
    keys = ["part", "b", "a"]
    if least is None:
        keys[0] = "label"
        sizes = rows.groupBy("label").agg(F.count("*").alias("rows"))
        asked = anchors.groupBy("label").agg(F.count("*").alias("anchors"))
        blocks = sizes.join(asked, "label").select(
            "label",
            blocks_of(F.col("rows"), block).alias("blocks"),
            blocks_of(F.col("anchors"), block).alias("anchor_blocks"),
        )
        blocks = small(written(blocks, "blocks"))
        rows, anchors = rows.join(blocks, "label"), anchors.join(blocks, "label")
    else:
        sizes = {
            "blocks": blocks_of(F.lit(rows.count()), block),
            "anchor_blocks": blocks_of(F.lit(anchors.count()), block),
            "part": F.lit(0),
        }
        rows, anchors = rows.withColumns(sizes), anchors.withColumns(sizes)
    columns = [c for c in ("place", "id", "label", "vector") if c not in keys]
    rows = (
        rows.withColumn("b", block_of("place", "blocks"))
        .withColumn("a", each_of("anchor_blocks"))
        .select(*keys, *columns)
    )
    anchors = (
        anchors.withColumn("a", block_of("place", "anchor_blocks", 1))
        .withColumn("b", each_of("blocks"))
        .select(*keys, *columns, "scores")
    )

    def search(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(rows):
            return pd.DataFrame(columns=["anchor", "window", "id", "place", "score"])
        return _search_blocks(anchors, rows, dimension, wanted, least is None, least or 0)

    kinds = [("anchor", LongType()), ("window", IntegerType()), ("id", LongType())]
    kinds += [("place", LongType()), ("score", LongType())]
    found = (
        anew(anchors)
        .groupBy(*keys)
        .cogroup(rows.groupBy(*keys))
        .applyInPandas(search, fields(*kinds))
    )
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "place")
    return found.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= wanted)


def mine_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    block: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(``scale`` * x); a row's score is its integer inner
    product with the anchor. Anchors are the rows whose id is divisible by ``every``; the
    positives of an anchor are its first ``positives`` other rows of its label, the
    highest score first, ties by the smaller id. For each of them come the first
    ``negatives`` rows of other labels whose score is at most the positive's and at least
    ``least`` hundredths of it; a negative score has none. Fewer where there are fewer.

    Rows of a null id, label or vector take no part, nor do those whose vector has null or
    non-finite components, another than the commonest length, or a component of 2^24 or
    more after scaling, which a score could not hold; zero vectors do. Rows that repeat
    are rows of their own. Other columns are not looked at. No rows give none.
    """
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(x * scale))
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).alias("raw"),
        scaled.alias("vector"),
    )
    dimension = common_dimension(rows, "raw")
    rows = rows.filter(
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & is_whole(F.col("raw"), dimension)
        & F.forall("vector", lambda x: x.between(-LIMIT, LIMIT))
    )
    placed = rows.select("id", "label", "vector", F.monotonically_increasing_id().alias("place"))
    table = written(placed, "scaled-vectors")
    anchors = table.filter(F.col("id") % every == 0)
    none = F.lit(None).cast("array<bigint>")
    best = written(
        _meet(
            anchors.withColumn("scores", none),
            table,
            dimension,
            positives,
            block,
            None,
        ),
        "positives",
    )
    turns = F.sort_array(F.collect_list(F.struct("turn", "score")))
    scored = best.groupBy("anchor").agg(turns["score"].alias("scores"))
    scored = scored.withColumnRenamed("anchor", "place")
    chosen = best.select(
        "anchor",
        (F.col("turn") - 1).alias("window"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    found = _meet(
        anchors.join(scored, "place"),
        table,
        dimension,
        negatives,
        block,
        least,
    )
    names = anchors.select(F.col("place").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        found.join(chosen, ["anchor", "window"])
        .join(names, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("turn").alias("rank"),
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
