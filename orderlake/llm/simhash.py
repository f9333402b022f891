"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has 64 bits: each shingle of its words is hashed, and a bit
is set if it is set in over half the hashes. Documents whose fingerprints differ in
few bits are linked; a document's class is its component of links.

Multi-index hashing finds the links. The fingerprint is cut into segments. If two
fingerprints differ in at most ``d`` bits, they differ in at most ``d / segments``
bits of some segment. So every distinct fingerprint is kept in one table per segment,
and looks up all keys of the small Hamming ball round its own segment; whatever it
meets there is compared over all 64 bits.

Large groups of copies cost no pairs of rows: equal fingerprints are one node. Nodes
one bit apart are joined first, through the 64 neighbours each can have, which is
linear work and already joins most of a crowd of near copies. After that a look-up
key is left out if all nodes that meet there are in one component, and only pairs of
different components are returned. Neither loses a connection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from orderlake.llm.components import component_labels
from orderlake.llm.tables import fields, id_type, written

BITS = 64
SEED = 42
#: Hashes whose bits are counted at once: bounds the memory of very long texts.
_STEP = 1 << 16


def simhash(text: bytes | None, shingle: int = 3) -> int:
    """Fingerprint of one text as an unsigned number; 0 for a text without words.

    A-Z are lower-cased; words are what stands between ASCII white space. A text of
    fewer words than a shingle is one shingle.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    hashes = [
        xxhash.xxh64_intdigest(x, SEED)
        for x in map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    ]
    set_in = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _STEP):
        part = np.array(hashes[at : at + _STEP], ">u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(hashes)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """(id, fp) of every row; ``fp`` is the fingerprint as a signed long."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = np.array([simhash(x, shingle) for x in part.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found.view(np.int64))], names=["id", "fp"]
            )

    ids = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return ids.mapInArrow(batches, fields(("id", id_type(docs, id_col)), ("fp", LongType())))


def ball(bits: int, radius: int) -> list[int]:
    """All masks of ``bits`` bits with at most ``radius`` of them set."""
    masks, grown = {0}, {0}
    for _ in range(radius):
        grown = {m ^ (1 << b) for m in grown for b in range(bits)}
        masks |= grown
    return sorted(masks)


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment; widths differ by one at most."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:])]


def _segment(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND((1 << width) - 1)


def _asked_keys(key: Column, masks: list[int]) -> Column:
    """Keys of the ball round ``key`` that are no smaller than it.

    Of two keys that differ, the smaller one asks, so each pair meets once.
    """
    around = F.array(*[key.bitwiseXOR(F.lit(m)) for m in masks])
    return F.filter(around, lambda k: k >= key)


def _at(number: int, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.struct(F.lit(number).alias("s"), k.alias("k")))


def _distance(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def _one_bit_links(nodes: DataFrame) -> DataFrame:
    """Links of nodes one bit apart: each node asks for those with one bit more."""
    one = [F.lit(np.int64(np.uint64(1 << b)).item()) for b in range(BITS)]
    more = F.array(
        *[F.when(F.col("fp").bitwiseAND(m) == 0, F.col("fp").bitwiseOR(m)) for m in one]
    )
    asked = nodes.select(F.col("fp").alias("a"), F.explode(F.array_compact(more)).alias("b"))
    return asked.join(nodes.select(F.col("fp").alias("b")), "b").select("a", "b")


def _index_links(nodes: DataFrame, max_distance: int, segments: int) -> DataFrame:
    """Links between different components of ``nodes`` (fp, label), by the segment tables."""
    fp = F.col("fp")
    tables, probes = [], []
    for number, (low, width) in enumerate(segment_bounds(segments)):
        key = _segment(fp, low, width)
        tables.append(_at(number, F.array(key)))
        probes.append(_at(number, _asked_keys(key, ball(width, max_distance // segments))))
    table = nodes.select("fp", "label", F.explode(F.flatten(F.array(*tables))).alias("at"))
    probe = nodes.select("fp", "label", F.explode(F.flatten(F.array(*probes))).alias("at"))
    table = table.select("fp", "label", "at.s", "at.k")
    probe = probe.select("fp", "label", "at.s", "at.k")
    # A key is worth a look if it has entries, and its visitors are of more than one
    # component. Entries ask for their own key too, so visitors are all there is.
    open_keys = (
        probe.groupBy("s", "k")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .filter("least != most")
        .select("s", "k")
    )
    table = table.join(open_keys, ["s", "k"], "left_semi")
    x, y = probe.alias("x"), table.alias("y")
    return x.join(
        y,
        (F.col("x.s") == F.col("y.s"))
        & (F.col("x.k") == F.col("y.k"))
        & (F.col("x.label") != F.col("y.label"))
        & (_distance(F.col("x.fp"), F.col("y.fp")) <= max_distance),
    ).select(
        F.least("x.label", "y.label").alias("a"), F.greatest("x.label", "y.label").alias("b")
    ).distinct()


def _relabel(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes (fp, label) with the labels that further links between labels give them."""
    labels = component_labels(links).select(
        F.col("node").alias("label"), F.col("label").alias("_label")
    )
    return nodes.join(labels, "label", "left").select(
        "fp", F.coalesce("_label", "label").alias("label")
    )


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_distance: int = 3,
    segments: int = 2,
) -> DataFrame:
    """(id_col, fingerprint, component_id) of every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits. Fingerprints of at most
    ``max_distance`` differing bits are linked; ``component_id`` is the smallest id
    among all rows that can be reached by links, the row itself included.

    A null or word-free text has fingerprint zero and is linked like any other. Rows
    that repeat stay as they are. A null id stays null and never names a component, so
    a component of null ids only has a null ``component_id``. Other columns are not
    looked at. No rows give no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(
        rows.groupBy("fp").agg(F.min("id").alias("first")).select("fp", "first"), "nodes"
    )
    labelled = nodes.select("fp", F.col("fp").alias("label"))
    if max_distance >= 1:
        labelled = written(_relabel(labelled, _one_bit_links(nodes.select("fp"))), "close")
    if max_distance >= 2:
        labelled = _relabel(labelled, _index_links(labelled, max_distance, segments))
    named = nodes.join(labelled, "fp")
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "label").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
