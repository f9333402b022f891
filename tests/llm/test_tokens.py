"""Token operators against the libraries, and round trips."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orderlake.llm import token_files
from orderlake.llm.piece_tokens import ChunkTable, decode_pieces, encode_pieces, piece_digests
from orderlake.llm.rans import LANES, CorruptSegment, Segment, encode_segment, quantised
from orderlake.llm.token_files import read_token_files, token_digests, write_token_files
from orderlake.llm.word_tokens import WordTable
from orderlake.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = list(" \t\n▁abİΣσςßÿÀé　漢🙂\x00 ﻿0A…\r\x85 '.,!\x1c\u0301ć½²ªµ×÷Ⅷ٣") + (
    "<|endoftext|> <|startoftext|> 's 'LL don't Å K <s> </s> <unk> <0x41> the".split() + ["  ", "    "]
)


def odd_texts(n):
    rng = random.Random(2)
    return ["", " ", "▁", "\n\na", " a  b "] + [
        "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 40))) for _ in range(n)
    ]


def test_words_equal_the_library():
    table, texts = WordTable(WORDS, size=50), odd_texts(4000)
    expected = [x.ids for x in table.library.encode_batch(texts, add_special_tokens=False)]
    got = table.encode_all([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == expected
    assert table.encode_all([None]) == [b""]


def test_pieces_equal_the_library():
    table, texts = ChunkTable(PIECES, size=50), odd_texts(4000)
    expected = table.library.encode(texts, add_bos=True, add_eos=True)
    got = [np.frombuffer(x, "<u4").tolist() for x in table.encode_all(texts)]
    assert got == expected
    assert table.encode_all([None]) == table.encode_all([""])


def rows(docs):
    return docs.select("doc_id", "text").collect()


@pytest.mark.parametrize("which", ["odd_docs", "some_docs", "no_docs"])
def test_piece_query(which, request):
    docs = request.getfixturevalue(which)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for row in rows(docs):
        ids = library.encode(row.text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        said = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        expected.append((row.doc_id, len(ids), digest, said))
    got = map(tuple, piece_digests(docs, PIECES).collect())
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_pieces_there_and_back(some_docs):
    ids = encode_pieces(some_docs, PIECES)
    back = {r.doc_id: r.text for r in decode_pieces(ids, PIECES).collect()}
    assert back == {r.doc_id: r.text for r in rows(some_docs)}


@pytest.mark.parametrize("which", ["odd_docs", "some_docs", "no_docs"])
@pytest.mark.parametrize("segment", [50, 1 << 22])
def test_token_files(spark, which, segment, request):
    docs = request.getfixturevalue(which)
    path = scratch_path(spark, "files")
    write_token_files(docs, path, WORDS, segment_tokens=segment)
    library = Tokenizer.from_file(WORDS)
    expected, at = [], 0
    in_order = sorted(rows(docs), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    for row in in_order:
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 1]
        expected.append((row.doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    got = token_digests(spark, path)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected
    assert sum(len(r.ids) for r in read_token_files(spark, path).collect()) == at


def test_damage_is_noticed(spark):
    data = bytearray(encode_segment(np.arange(5000, dtype=np.uint32) % 77))
    for at in (0, 9, 60, len(data) - 1):
        broken = bytes(data[:at]) + bytes([data[at] ^ 1]) + bytes(data[at + 1 :])
        with pytest.raises(CorruptSegment):
            Segment(broken).all()
    with pytest.raises(CorruptSegment):
        Segment(bytes(data[:-3])).all()
    with pytest.raises(CorruptSegment):
        Segment(b"TR")


@pytest.mark.parametrize("n", [0, 1, LANES, LANES + 1, 3 * LANES - 1, 700_001])
def test_segments_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.2, n) % 49_408).astype(np.uint32)
    segment = Segment(encode_segment(ids, block_tokens=1 << 18))
    assert (segment.all() == ids).all() and segment.n_ids == n
    if n > 1 << 18:  # blocks alone, in any order
        assert (segment.block(2) == ids[2 << 18 : 3 << 18]).all()
        assert (segment.block(0) == ids[: 1 << 18]).all()


def test_wide_and_single_ids_round_trip():
    for ids in (np.array([0, 2**32 - 1, 5] * 999, np.uint32), np.full(9999, 7, np.uint32)):
        assert (Segment(encode_segment(ids)).all() == ids).all()
    counts = np.array([10**12] + [1] * 60_000)
    freq = quantised(counts)
    assert freq.sum() == 1 << 20 and freq.min() == 1


def test_bases_of_parts(spark):
    files = spark.createDataFrame(
        [(3, 0, 5), (0, 1, 7), (0, 0, 2), (3, 1, 1)], "part int, seq int, n_tokens bigint"
    )
    got = {(r.part, r.seq): r.base for r in token_files._bases(files).collect()}
    assert got == {(0, 0): 0, (0, 1): 2, (3, 0): 9, (3, 1): 14}
