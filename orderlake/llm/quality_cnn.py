"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

A byte enters with two features: its value, and how far back the eight bytes that end
with it were last seen in the same text (never, near, within a paragraph, farther). A
filter sees ``WIDTH`` positions. As both features are categories, a filter is a table
of weights for each position it sees, and running it is a few look-ups a byte.

The filters run over the whole text. Their activations are max-pooled within chunks
that overlap by half, and a document is described by the mean, the largest and the
smallest of its chunks, which one logistic unit turns into a probability. All layers
are learned together by gradient descent (Adam) on a sample of the labelled rows.

The sample is what bounds the driver's work: ``per_class`` rows of each label, of texts
up to ``max_text_bytes``, the first by a hash of their id. Scoring runs in the tasks,
over all rows and whole texts, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from orderlake.llm.tables import SLACK, crc_part, few_of, fields, first_of_each

WIDTH = 5
FILTERS = 8
#: Half a chunk; chunks begin at every half and overlap by half.
HALF = 128
GRAM = 8
#: Categories of the second feature: not seen before, and seen within so many bytes.
NEAR = (64, 512)
KINDS = len(NEAR) + 2
PAD = 256 * KINDS
#: Positions that are worked on at once; a multiple of HALF.
BLOCK = HALF << 10


@dataclass(frozen=True)
class Network:
    """Filter tables (position, byte and kind, filter), their biases, and the last unit."""

    tables: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float


def seen_before(data: np.ndarray) -> np.ndarray:
    """For each byte the category of the distance to the last equal GRAM of bytes."""
    kinds = np.zeros(len(data), np.uint16)
    n = len(data) - GRAM + 1
    if n < 2:
        return kinds
    full = np.zeros(n, np.uint32)
    for j in range(GRAM):
        full = full * np.uint32(0x01000193) + data[j : j + n]
    full *= np.uint32(0x9E3779B1)
    # Sorting 16 bits is a radix sort; two stable passes order by all 32.
    order = np.argsort(full.astype(np.uint16), kind="stable")
    high = (full >> np.uint32(16)).astype(np.uint16)
    order = order[np.argsort(high[order], kind="stable")]
    before, after = order[:-1], order[1:]
    same = full[before] == full[after]
    at, gap = after[same], (after - before)[same]
    kinds[at + GRAM - 1] = 1 + np.searchsorted(NEAR, gap, "left")
    return kinds


def symbols(text: bytes | None) -> np.ndarray:
    """The text as the network's input: padded in front, never empty."""
    data = np.frombuffer(text or b"", np.uint8)
    pads = np.full(WIDTH - 1 + (not len(data)), PAD, np.intp)
    return np.concatenate([pads, data.astype(np.intp) * KINDS + seen_before(data)])


def _activations(net: Network, part: np.ndarray, n: int) -> np.ndarray:
    z = net.tables[0].take(part[:n], axis=0)
    for j in range(1, WIDTH):
        z += net.tables[j].take(part[j : j + n], axis=0)
    return z


def _halves(net: Network, inputs: np.ndarray, where: bool = False):
    """Largest activation of each filter in each half chunk, and where it is if asked."""
    total = len(inputs) - WIDTH + 1
    tops, places = [], []
    for at in range(0, total, BLOCK):
        n = min(BLOCK, total - at)
        z = _activations(net, inputs[at : at + n + WIDTH - 1], n)
        starts = np.arange(0, n, HALF)
        tops.append(np.maximum.reduceat(z, starts, axis=0))
        if where:
            places += [at + s + z[s : s + HALF].argmax(axis=0) for s in starts]
    return np.concatenate(tops), np.array(places)


def _pooled(net: Network, halves: np.ndarray) -> np.ndarray:
    chunks = np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves
    return np.maximum(chunks + net.bias, 0)


def score(net: Network, text: bytes | None) -> float:
    chunks = _pooled(net, _halves(net, symbols(text))[0])
    features = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])
    return float(1 / (1 + np.exp(-(features @ net.weights + net.offset))))


def train(
    texts: list[bytes],
    labels: list[int],
    passes: int = 9600,
    batch: int = 16,
    rate: float = 0.01,
    decay: float = 1e-4,
    seed: int = 7,
) -> Network:
    """A network fitted to the sample; both labels weigh the same.

    Without any text the network is blank and scores 0.5 everywhere.
    """
    rng = np.random.default_rng(seed)
    params = {
        "bytes": rng.normal(0, 0.1, (WIDTH, 257, FILTERS)),
        "kinds": rng.normal(0, 0.1, (WIDTH, KINDS, FILTERS)),
        "bias": np.zeros(FILTERS),
        "weights": rng.normal(0, 0.1, 3 * FILTERS),
        "offset": np.zeros(1),
    }
    if not texts:
        params["weights"][:] = 0
        return _network(params)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    inputs, wanted = [symbols(t) for t in texts], np.array(labels)
    share = np.bincount(wanted, minlength=2) / len(wanted)
    importance = np.array([1 / max(2 * s, 1e-9) for s in share])[wanted]
    order: list[int] = []
    steps = max(1, passes // batch)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order += list(rng.permutation(len(inputs)))
        chosen, order = order[:batch], order[batch:]
        grads = {k: np.zeros_like(v) for k, v in params.items()}
        net = _network(params)
        for i in chosen:
            _add_gradient(net, inputs[i], wanted[i], importance[i] / len(chosen), grads)
        now = rate * (1 - (step - 1) / steps)
        for k, (m, v) in moments.items():
            m += 0.1 * (grads[k] - m)
            v += 0.001 * (grads[k] ** 2 - v)
            params[k] -= now * (
                m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + decay * params[k]
            )
    return _network(params)


def _network(params: dict[str, np.ndarray]) -> Network:
    pairs = params["bytes"][:, :256, None, :] + params["kinds"][:, None, :, :]
    flat = pairs.reshape(WIDTH, 256 * KINDS, FILTERS)
    tables = np.concatenate([flat, params["bytes"][:, 256:]], axis=1)
    return Network(
        tables.astype(np.float32),
        params["bias"].astype(np.float32),
        params["weights"].copy(),
        float(params["offset"][0]),
    )


def _add_gradient(
    net: Network, inputs: np.ndarray, wanted: int, importance: float, grads: dict
) -> None:
    halves, places = _halves(net, inputs, where=True)
    chunks = _pooled(net, halves)
    n, each = len(chunks), np.arange(FILTERS)
    features = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])
    error = importance * (1 / (1 + np.exp(-(features @ net.weights + net.offset))) - wanted)
    grads["weights"] += error * features
    grads["offset"] += error
    down = np.zeros((n, FILTERS))
    mean, most, least = error * net.weights.reshape(3, FILTERS)
    down += mean / n
    down[chunks.argmax(axis=0), each] += most
    down[chunks.argmin(axis=0), each] += least
    down *= chunks > 0
    grads["bias"] += down.sum(axis=0)
    if len(halves) > 1:
        places = np.where(halves[:-1] >= halves[1:], places[:-1], places[1:])
    filters = np.broadcast_to(each, places.shape)
    for j in range(WIDTH):
        seen = inputs[places + j]
        np.add.at(grads["bytes"][j], (np.minimum(seen // KINDS, 256), filters), down)
        real = seen < PAD
        np.add.at(
            grads["kinds"][j], ((seen % KINDS)[real], filters[real]), down[real]
        )


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int,
    max_text_bytes: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    held_out: int = 0,
) -> list[tuple[bytes, int]]:
    """At most ``per_class`` (text, label) pairs of each label, none of them held out.

    The first ones by a hash of the id, so the same whatever the order of the rows.
    An id with both labels, a null id, label or text is no example. The labels are
    counted first, so that the ids to look for in the texts are a bounded list.
    """
    marks = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter((crc_part("id", folds) != held_out) & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("id", "label")
    )
    counts = {r.label: r.n for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ids = marks.filter(few_of(F.col("label"), counts, per_class, "id"))
    # Some SLACK * per_class of each label are left, so this bound is never met.
    ids = ids.limit(4 * SLACK * per_class)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    found = texts.filter(F.length("text") <= max_text_bytes).join(F.broadcast(ids), "id")
    rows = first_of_each(found, "label", per_class).collect()
    return [(bytes(r.text), r.label) for r in rows]


def add_scores(
    docs: DataFrame, net: Network, threshold: float = 0.3, text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` and ``predicted`` behind them.

    A null text is scored as an empty one. Rows that repeat are scored one by one; keys
    are not looked at. Columns of ``docs`` of these two names give way.
    """
    passed = [c for c in docs.columns if c not in ("score", "predicted") or c == text_col]
    rows = docs.select(F.col(f"`{text_col}`").cast("binary").alias("_scored"), *[f"`{c}`" for c in passed])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            scores = np.array([score(net, x.as_py()) for x in part.column(0)], np.float64)
            found = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], *found], names=[*part.schema.names[1:], "score", "predicted"]
            )

    added = fields(("score", DoubleType()), ("predicted", IntegerType()))
    return rows.mapInArrow(batches, StructType([*rows.schema.fields[1:], *added.fields]))


def score_documents(
    docs: DataFrame,
    net: Network,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 5,
    held_out: int = 0,
) -> DataFrame:
    """(id_col, held_out, score, predicted) of every row of ``docs``, as in add_scores.

    A null id was never learned from and counts as held out.
    """
    rows = docs.select(
        F.col(id_col),
        F.coalesce(crc_part(id_col, folds) == held_out, F.lit(True)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    return add_scores(rows, net, threshold).drop("text")


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 1000,
    max_text_bytes: int = 1 << 20,
    threshold: float = 0.3,
) -> DataFrame:
    """Train on the labels that are not held out, then score all of ``docs``."""
    return score_documents(docs, fitted(docs, labels, per_class, max_text_bytes), threshold)


def fitted(
    docs: DataFrame, labels: DataFrame, per_class: int = 1000, max_text_bytes: int = 1 << 20
) -> Network:
    """A network trained on the sample of ``docs`` and their labels."""
    sample = labelled_sample(docs, labels, per_class, max_text_bytes)
    return train([text for text, _ in sample], [label for _, label in sample])
