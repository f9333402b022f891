"""Fingerprints and components against brute force."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from orderlake.llm.components import component_labels
from orderlake.llm.queries import LLM_QUERIES
from orderlake.llm.simhash import ball, segment_bounds, simhash, simhash_components


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    n = min(3, len(words))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def brute_classes(rows, distance=3):
    """(row number) -> smallest id of its component; rows are (id, fingerprint)."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= distance:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(known) if known else None
    return [least[root(i)] for i in range(len(rows))]


def check(docs):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    expected = sorted(
        ((i, f"{fp:016x}", c) for (i, fp), c in zip(rows, brute_classes(rows))), key=str
    )
    got = sorted(map(tuple, simhash_components(docs).collect()), key=str)
    assert got == expected


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_no_rows(no_docs):
    assert simhash_components(no_docs).collect() == []


def test_real_rows(some_docs):
    check(some_docs)


def test_query_returns_every_document(spark, some_docs):
    assert LLM_QUERIES["op1_simhash"](spark, "/root/testdata/sf0.001").count() == some_docs.count()


def test_long_text_equals_brute_force():
    rng = random.Random(4)
    text = " ".join(rng.choice("abcdefgh") for _ in range(70_000))
    assert simhash(text.encode()) == brute_fingerprint(text)


def test_crowd_of_near_fingerprints(spark, monkeypatch):
    """Fingerprints of a chain, of a dense ball and at distance four, by brute force."""
    import orderlake.llm.simhash as module

    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(150):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    at = rng.getrandbits(64)
    for step in range(12):
        fps.add(at)
        at ^= sum(1 << b for b in rng.sample(range(64), 2 + step % 3))
    fps |= {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1, 1 << 63, 7, 15}
    rows = list(enumerate(sorted(fps)))
    signed = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in rows]
    frame = spark.createDataFrame(signed, "id bigint, fp bigint")
    monkeypatch.setattr(module, "fingerprints", lambda *_: frame)
    got = {r.doc_id: r.component_id for r in simhash_components(frame, "doc_id").collect()}
    assert [got[i] for i, _ in rows] == brute_classes(rows)


def test_segments_and_balls():
    assert segment_bounds(3) == [(0, 21), (21, 21), (42, 22)]
    assert len(ball(32, 1)) == 33 and len(ball(8, 2)) == 1 + 8 + 28


def test_components_of_long_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 300)]
    links += [(400, 401), (401, 400), (500, 500), (None, 3), (4, None)]
    got = component_labels(spark.createDataFrame(links, "a bigint, b bigint"))
    labels = {r.node: r.label for r in got.collect()}
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 300)}
    assert labels == expected | {400: 400, 401: 400, 500: 500}
    assert got.count() == len(labels)
    assert component_labels(got.filter(F.lit(False)), "node", "label").count() == 0
