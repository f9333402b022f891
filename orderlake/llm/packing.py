"""Best-fit packing of documents into training sequences, under conflicts.

A sequence (a bin) takes at most one document of each source and of each duplicate
cluster. The longest pieces are placed first. The bins of a shard are kept in order of
their residual room and carry a bitmap of the sources and one of the clusters they hold;
from the tightest bin that has room the search goes on to its successors until one has
neither bit set. If none has, a new bin is opened.

The rows are dealt at random, by a hash of their place, to shards of about
``docs_per_shard`` documents that are packed apart, so neither a hot source nor a large
cluster meets in one task; bins of different shards share no document, so conflicts
cannot arise between them. A shard leaves a few bins open at its end, which is a small
part of its bins.

Near copies are one cluster: texts whose shingles of five words have a Jaccard similarity
of 0.8 or more. As only documents of one shard can meet, they are found there, exactly:
a prefix of each set of shingles, the rarest first, is looked up, and what meets is
compared over all shingles. SimHash classes, which hold other pairs, come from the whole
corpus and are added by ``pack_apart``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Hashable, Iterable
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from orderlake.llm.simhash import simhash_components
from orderlake.llm.tables import fields, id_type, written
from orderlake.llm.text import SPACE_CLASS

CAPACITY = 2048
DOCS_PER_SHARD = 4096
#: Bin ids of a shard begin at its number times this.
BINS_PER_SHARD = 1 << 32
#: Words of a shingle, and the share of shingles (in hundredths) that near copies have in common.
SHINGLE = 5
NEAR = 80
#: Counters of the shingles' approximate frequency, which only orders them.
_COUNTERS = 1 << 20


def best_fit(
    items: Iterable[tuple[int, Hashable, Hashable]], capacity: int
) -> list[tuple[int, int]]:
    """(bin, place in it) of each (size, source, cluster), in the order given.

    A source or cluster of None conflicts with nothing. A size over the capacity gets
    a bin of its own.
    """
    bits: dict[tuple[int, Hashable], int] = {}
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    placed = []

    def bit(kind: int, value: Hashable) -> int:
        if value is None:
            return 0
        return bits.setdefault((kind, value), 1 << len(bits))

    for size, source, cluster in items:
        of_source, of_cluster = bit(0, source), bit(1, cluster)
        at = bisect_left(order, (size, -1))
        while at < len(order):
            number = order[at][1]
            if not (sources[number] & of_source or clusters[number] & of_cluster):
                break
            at += 1
        if at < len(order):
            room, number = order.pop(at)
        else:
            room, number = max(capacity, size), len(sources)
            sources.append(0)
            clusters.append(0)
        sources[number] |= of_source
        clusters[number] |= of_cluster
        placed.append((number, max(capacity, size) - room))
        insort(order, (room - size, number))
    return placed


class Worded:
    """The words of some texts, lower-cased, as numbers: those of text i are
    ``numbers[bounds[i]:bounds[i + 1]]``. A text without words has one empty word."""

    def __init__(self, texts: Iterable[str | None]):
        said = pa.array(texts, pa.large_string(), from_pandas=True).fill_null("")
        said = pc.ascii_trim_whitespace(pc.utf8_lower(said))
        words = pc.ascii_split_whitespace(said)
        self.numbers = words.flatten().dictionary_encode().indices.to_numpy()
        self.bounds = words.offsets.to_numpy()
        self.said = said

    def lengths(self) -> np.ndarray:
        """Words of each text and one end mark."""
        empty = pc.equal(self.said, "").to_numpy(zero_copy_only=False)
        return np.diff(self.bounds) - empty + 1

    def digests(self) -> list[str]:
        """What texts share if they differ in letter case and white space only."""
        bare = pc.replace_substring_regex(self.said, f"[{SPACE_CLASS}]+", " ")
        bare = bare.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        return [hashlib.md5(x).hexdigest() for x in bare]


def _mixed(numbers: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` numbers in a row."""
    mixed = numbers.astype(np.uint64)
    for shift, factor in ((7, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9)):
        mixed ^= mixed >> np.uint64(shift)
        mixed *= np.uint64(factor)
    n = max(0, len(numbers) - width + 1)
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x94D049BB133111EB)
        out += mixed[j : j + n]
    return out


def _shingle_sets(worded: Worded) -> list[np.ndarray]:
    """Distinct shingles of each text, sorted; fewer words than a shingle are one shingle."""
    hashes = _mixed(worded.numbers, SHINGLE)
    sets = []
    for start, end in pairwise(worded.bounds.tolist()):
        if end - start < SHINGLE:
            sets.append(_mixed(worded.numbers[start:end], end - start))
        else:
            own = np.sort(hashes[start : end - SHINGLE + 1])
            sets.append(own[np.r_[True, own[1:] != own[:-1]]])
    return sets


def near_classes(
    texts: Iterable[str | None] | Worded, *clusters: Iterable[Hashable]
) -> list[int]:
    """A number for each text, the same for near copies and for equal clusters but None.

    Links are followed: what is a near copy of a near copy has the same number. Texts
    that are joined already are not compared, so a crowd of copies costs little.
    """
    sets = _shingle_sets(texts if isinstance(texts, Worded) else Worded(texts))
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    first: dict[tuple[Hashable, Hashable], int] = {}
    nodes = []
    for number, kind in enumerate(clusters):
        for i, cluster in enumerate(kind):
            if cluster is not None:
                parent[root(i)] = root(first.setdefault((number, cluster), i))
    for i, own in enumerate(sets):
        same = first.setdefault(("set", own.tobytes()), i)
        parent[root(i)] = root(same)
        if same == i:
            nodes.append(i)
    if not nodes:
        return []
    # Sets with enough in common share an element of these prefixes, in any common order:
    # here by an approximate frequency, then by the hash. Each shingle goes by its place in
    # that order.
    shingles = np.concatenate([sets[i] for i in nodes])
    slots = (shingles % np.uint64(_COUNTERS)).astype(np.intp)
    often = np.minimum(np.bincount(slots, minlength=_COUNTERS), (1 << 16) - 1).astype(np.uint64)
    places = (often[slots] << np.uint64(48)) | (shingles >> np.uint64(16))
    del shingles, slots, often
    prefixes = []
    for own in np.split(places, np.cumsum([len(sets[i]) for i in nodes])[:-1]):
        size = len(own) - -(-NEAR * len(own) // 100) + 1
        prefixes.append(np.partition(own, size - 1)[:size])
    owners = np.repeat(nodes, [len(x) for x in prefixes])
    elements = np.concatenate(prefixes)
    order = np.argsort(elements, kind="stable")
    elements, owners = elements[order], owners[order]
    bounds = np.flatnonzero(np.r_[True, elements[1:] != elements[:-1], True])
    compared: set[tuple[int, int]] = set()
    for k in np.flatnonzero(np.diff(bounds) > 1):
        met = owners[bounds[k] : bounds[k + 1]].tolist()
        for at, i in enumerate(met):
            for j in met[:at]:
                if root(i) == root(j) or (j, i) in compared:
                    continue
                compared.add((j, i))
                sizes = len(sets[i]), len(sets[j])
                if 100 * min(sizes) < NEAR * max(sizes):
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= NEAR * (sum(sizes) - common):
                    parent[root(i)] = root(j)
    return [root(i) for i in range(len(sets))]


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    docs_per_shard: int = DOCS_PER_SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster: Column | None = None,
    classes: DataFrame | None = None,
) -> DataFrame:
    """(id_col, piece, start, length, bin_id, bin_offset) of every piece of every row.

    A text longer than ``capacity`` is cut into pieces that fill a bin each, and a rest.
    ``start`` is where the piece begins in its document, ``bin_offset`` where it begins
    in its bin, both in words; the pieces of a document cover it whole, and the bins
    are filled without gaps. ``cluster`` is any column of what must not share a bin,
    by default the text but for case and white space; near copies share no bin whatever
    their cluster, nor do documents linked by both. ``classes`` (_place, component_id)
    adds classes over the whole corpus; ``docs`` then has a unique number ``_place``.

    A null or empty text is a piece of length 1, its end mark, and all such texts are
    one cluster. A null source conflicts with no other. Null ids and rows that repeat
    are packed row by row; rows that repeat are in one cluster. Other columns are not
    looked at. No rows give no rows. Ties in length go by cluster, source and id.
    """
    shards = max(1, -(-docs.count() // docs_per_shard))
    place = F.monotonically_increasing_id() if classes is None else F.col("_place")
    shard_of = F.pmod(F.xxhash64(place), F.lit(shards))
    measured = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        *([] if cluster is None else [cluster.cast("string").alias("cluster")]),
        F.col(text_col).alias("text"),
        place.alias("place"),
        shard_of.alias("shard"),
    )

    by_text = cluster is None

    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        worded = Worded(shard.pop("text"))
        shard["length"] = worded.lengths()
        if by_text:
            shard["cluster"] = worded.digests()
        kinds = [shard["cluster"], *([shard["component"]] if "component" in shard else [])]
        near = near_classes(worded, *([None if pd.isna(x) else x for x in kind] for kind in kinds))
        del worded
        pa.default_memory_pool().release_unused()
        # Missing ids come as NaN or None: order by what they print as.
        shard = shard.assign(near=near, said=shard["id"].astype(str)).sort_values(
            ["length", "cluster", "source", "said"], ascending=[False, True, True, True]
        )
        base = int(shard["shard"].iloc[0]) * BINS_PER_SHARD
        ids, lengths = shard["id"].to_numpy(), shard["length"].to_numpy()
        sources = [None if pd.isna(x) else x for x in shard["source"]]
        members = Counter(near)
        conflicts = [sources, [x if members[x] > 1 else None for x in shard["near"]]]
        rows: list[tuple] = []
        rests = []
        full = 0
        for i, length in enumerate(map(int, lengths)):
            pieces, rest = divmod(length, capacity)
            for piece in range(pieces):
                rows.append((i, piece, piece * capacity, capacity, full, 0))
                full += 1
            if rest:
                rests.append((rest, i, pieces))
        rests.sort(key=lambda x: -x[0])
        found = best_fit([(r, conflicts[0][i], conflicts[1][i]) for r, i, _ in rests], capacity)
        for (rest, i, piece), (number, offset) in zip(rests, found):
            rows.append((i, piece, piece * capacity, rest, full + number, offset))
        names = ["row", "piece", "start", "length", "bin_id", "bin_offset"]
        out = pd.DataFrame(rows, columns=names)
        out.insert(0, id_col, ids[out["row"].to_numpy(dtype=int)])
        return out.assign(bin_id=out["bin_id"] + base).drop(columns="row")

    schema = fields(
        (id_col, id_type(docs, id_col)),
        ("piece", IntegerType()),
        ("start", LongType()),
        ("length", LongType()),
        ("bin_id", LongType()),
        ("bin_offset", LongType()),
    )
    if classes is None:
        return measured.groupBy("shard").applyInPandas(pack, schema)

    def pack_classes(shard: pd.DataFrame, classes: pd.DataFrame) -> pd.DataFrame:
        of_place = classes.set_index("_place")["component_id"]
        # Both bind: a class takes in the clusters of its members.
        return pack(shard.assign(component=shard["place"].map(of_place).to_numpy()))

    dealt = classes.select("_place", "component_id", shard_of.alias("shard"))
    return (
        measured.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(pack_classes, schema)
    )


def pack_apart(
    docs: DataFrame,
    capacity: int = CAPACITY,
    docs_per_shard: int = DOCS_PER_SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``pack_documents`` with the SimHash classes of ``docs`` kept apart too.

    Rows get a number of their own, so null ids and rows that repeat are classed row by
    row. The texts are written once, and shuffled once.
    """
    numbered = docs.select(
        F.col(id_col), F.col(text_col), F.col(source_col),
        F.monotonically_increasing_id().alias("_place"),
    )
    numbered = written(numbered, "numbered")
    classes = simhash_components(numbered, id_col="_place", text_col=text_col)
    return pack_documents(
        numbered, capacity, docs_per_shard, id_col, text_col, source_col, classes=classes
    )
