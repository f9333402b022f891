"""Near copies in packing: found exactly, and never in one bin."""

import itertools
import random

import pytest

from orderlake.llm.packing import near_classes, pack_apart, pack_documents
from orderlake.llm.queries import LLM_QUERIES
from orderlake.llm.simhash import simhash_components

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(x, y):
    return len(x & y) / len(x | y) >= 0.8


def brute(texts):
    sets, parent = list(map(shingles, texts)), list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, j in itertools.combinations(range(len(texts)), 2):
        if similar(sets[i], sets[j]):
            parent[root(j)] = root(i)
    return [root(i) for i in range(len(texts))]


def same_parts(x, y):
    return len(set(zip(x, y))) == len(set(x)) == len(set(y))


def made(seed, n):
    """Originals and copies with words changed, from very close to far."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", " ", "A b", "a  B"]
    while len(texts) < n:
        words = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 6, 30, 120, 400]))
        for changes in (0, 1, 2, 3, len(words) // 40, len(words) // 25):
            copy = list(words)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_near_classes_equal_brute_force(seed):
    texts = made(seed, 300)
    got = near_classes(texts)
    assert same_parts(got, brute(texts)) and len(set(got)) < len(texts)
    assert near_classes([]) == []
    assert len(set(near_classes(["a", "b", "c", "d"], ["x", None, "x", None], [None, 1, 1, None]))) == 2


def test_no_bin_holds_near_copies(spark):
    texts = made(3, 200)
    docs = spark.createDataFrame(
        [(None if i < 2 else i, t, f"s{i}") for i, t in enumerate(texts)],
        "doc_id bigint, text string, source string",
    )
    number = dict(enumerate(brute(texts)))
    for pack in (pack_documents, pack_apart):
        packed = pack(docs).collect()
        assert sum(r.length for r in packed) == sum(len((t or "").split()) + 1 for t in texts)
        known = [(r.bin_id, number[r.doc_id]) for r in packed if r.doc_id is not None]
        assert len(known) == len(set(known)) == len(texts) - 2


def test_no_bin_holds_two_of_a_class_of_real_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    classes = {r.doc_id: r.component_id for r in simhash_components(docs).collect()}
    packed = {(r.bin_id, r.doc_id) for r in LLM_QUERIES["op2_packing"](spark, SF).collect()}
    held = [(b, classes[d]) for b, d in packed]
    assert len(held) == len(set(held))
    for _, group in itertools.groupby(sorted(packed), lambda x: x[0]):
        for (_, x), (_, y) in itertools.combinations(group, 2):
            assert not similar(sets[x], sets[y])
