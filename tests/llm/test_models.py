"""The learned operators: held-out accuracy, odd rows, what may not be learned from."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import language_id, quality_cnn
from orderlake.llm.language_id import identify_languages, infer, language_sample, learn
from orderlake.llm.quality_cnn import classify_quality, labelled_sample, seen_before, symbols
from orderlake.llm.queries import LLM_QUERIES

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def held_out(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def test_quality_on_held_out_rows(spark, docs, labels):
    got = LLM_QUERIES["op3_quality_cnn"](spark, SMALL).collect()
    marks = {r.doc_id: r.quality for r in labels.collect()}
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    assert all(r.held_out == held_out(r.doc_id, 5, 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    unseen = [(r.predicted, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    assert len(unseen) > 50 and np.mean([p == q for p, q in unseen]) >= 0.95
    assert np.mean([p for p, q in unseen if q == 1]) >= 0.97


def test_quality_sample_is_bounded_and_held_out(docs, labels):
    sample = labelled_sample(docs, labels, 20, 1 << 20)
    assert sum(y for _, y in sample) == 20 and len(sample) == 40
    # A held-out text may have a copy that is not; no text may come from a held-out row.
    texts = {r.text for r in docs.collect() if not held_out(r.doc_id, 5, 0)}
    assert all(x.decode() in texts for x, _ in sample)
    more = labels.union(labels.withColumn("quality", 1 - F.col("quality")))
    assert labelled_sample(docs, more, 20, 1 << 20) == []  # both labels: no example
    assert labelled_sample(docs, labels, 20, 3) == []


def test_quality_of_odd_rows(odd_docs, no_docs, labels):
    got = classify_quality(odd_docs, labels.limit(0))
    assert [r.score for r in got.collect()] == [0.5] * odd_docs.count()
    assert classify_quality(no_docs, labels).collect() == []
    assert got.filter("doc_id IS NULL").filter("held_out").count() == 2
    net = quality_cnn.train([b"good text", b"##"], [1, 0], passes=64)
    scored = quality_cnn.add_scores(odd_docs, net)
    assert scored.columns[-2:] == ["score", "predicted"] and "label" in scored.columns
    again = {r.doc_id: r.score for r in scored.filter("doc_id IS NOT NULL").collect()}
    assert again[2] == again[3] == quality_cnn.score(net, b"")


def test_blocks_do_not_change_a_score(monkeypatch):
    net = quality_cnn.train([b"some good text here", b"$$$ %%%"], [1, 0], passes=64)
    text = bytes(np.random.default_rng(1).integers(32, 127, 10_000, dtype=np.uint8))
    whole = quality_cnn.score(net, text)
    monkeypatch.setattr(quality_cnn, "BLOCK", quality_cnn.HALF)
    assert quality_cnn.score(net, text) == whole


def test_gradient_matches_differences():
    rng = np.random.default_rng(5)
    params = {
        "bytes": rng.normal(0, 0.3, (quality_cnn.WIDTH, 257, quality_cnn.FILTERS)),
        "kinds": rng.normal(0, 0.3, (quality_cnn.WIDTH, quality_cnn.KINDS, quality_cnn.FILTERS)),
        "bias": rng.normal(0, 0.3, quality_cnn.FILTERS),
        "weights": rng.normal(0, 0.3, 3 * quality_cnn.FILTERS),
        "offset": np.zeros(1),
    }
    text = bytes(rng.integers(97, 105, 700, dtype=np.uint8))
    grads = {k: np.zeros_like(v) for k, v in params.items()}
    quality_cnn._add_gradient(quality_cnn._network(params), symbols(text), 1, 1.0, grads)

    def loss():
        return -np.log(quality_cnn.score(quality_cnn._network(params), text))

    for name in params:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        step = 1e-3
        params[name][at] += step
        up = loss()
        params[name][at] -= 2 * step
        assert (up - loss()) / (2 * step) == pytest.approx(grads[name][at], rel=0.05, abs=1e-4)
        params[name][at] += step


def test_distance_to_what_was_seen():
    data = np.frombuffer(b"abcdefgh" * 3 + b"z" * 600 + b"abcdefgh", np.uint8)
    kinds = seen_before(data)
    assert not kinds[:15].any() and (kinds[15:24] == 1).all()
    assert kinds[-1] == 3 and not kinds[24:31].any()


def test_language_of_held_out_rows(spark, docs):
    got = LLM_QUERIES["op8_language_id"](spark, SMALL).collect()
    real = {r.doc_id: r.lang for r in docs.collect()}
    assert sorted(r.doc_id for r in got) == sorted(real)
    assert all(r.held_out == held_out(r.doc_id, 4, 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == real[r.doc_id] for r in unseen]) >= 0.98


def test_languages_of_odd_rows(odd_docs, no_docs):
    got = identify_languages(odd_docs).collect()
    assert len(got) == odd_docs.count()
    known = {"en", "de", "fr"}
    assert all(r.lang_pred in known | {"und"} for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (2, 3, 4)} == {"und"}
    assert all(r.held_out for r in got if r.doc_id is None)
    assert identify_languages(no_docs).collect() == []
    assert infer(learn([]), "text") == ("und", 0.0)


def test_language_sample_leaves_the_held_out(docs):
    sample = language_sample(docs, 15, 1 << 20)
    counts = {lang: sum(x == lang for _, x in sample) for _, lang in sample}
    assert set(counts.values()) == {15}
    texts = {r.text for r in docs.collect() if not held_out(r.doc_id, 4, 2)}
    assert all(text in texts for text, _ in sample)
    unseen = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    assert language_sample(unseen, 15, 1 << 20) == []


def test_mixtures_are_taken_apart(docs):
    model = learn(language_sample(docs, 60, 1 << 20))
    by_lang = {}
    for r in docs.filter("n_chars > 1500").orderBy("doc_id").collect():
        by_lang.setdefault(r.lang, r.text[:1500])
    mixed = by_lang["en"] + " " + by_lang["de"][:500]
    language, share = infer(model, mixed)
    assert language == "en" and 0.6 < share < 0.9
    counts = language_id.gram_counts(mixed)
    slots = np.flatnonzero(counts)
    found, _ = language_id._proportions(model.likelihood[slots], counts[slots].astype(float))
    two = sorted(zip(found, model.languages))[-2:]
    assert [name for _, name in two] == ["de", "en"]


def test_repeats_are_seen_in_long_texts():
    """A text of random bytes, twice: the second half was all seen before, far back."""
    half = np.random.default_rng(5).integers(0, 256, 150_000).astype(np.uint8)
    kinds = seen_before(np.concatenate([half, half]))
    assert (kinds[150_000 + 7 :] == 3).mean() > 0.999
    assert (kinds[:150_000] > 0).mean() < 0.001
