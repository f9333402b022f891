"""SentencePiece ids and back, through a table of distinct chunks.

The model marks white space with U+2581 and has no piece that holds the mark anywhere
but in front. So no piece crosses from one marked word to the next: a text is a row of
chunks, each some marks and then no mark, and its ids are those of its chunks joined in
order. Each distinct chunk of a batch is segmented once, by the sentencepiece library,
and its ids are put back wherever the chunk stands. A task keeps the chunks it has seen
in a table of bounded size that is cleared when full, so memory is bounded and nothing
is dropped. At scale this costs no shuffle at all, where a table of all distinct chunks
would have to be joined with every position of the corpus.

Whether a model has the property is checked when it is loaded.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType

from orderlake.llm.tables import fields, id_type

MARK = "▁"
#: A chunk: marks, spaces or both, then what is neither.
CHUNK = re.compile(f"[ {MARK}]+[^ {MARK}]*|[^ {MARK}]+")
#: Entries of a task's table.
TABLE_SIZE = 400_000


class ChunkTable:
    """Encoder and decoder of one model, with the chunks seen so far."""

    def __init__(self, model_file: str, size: int = TABLE_SIZE) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = size
        #: Ids of each chunk, as little-endian unsigned 32-bit integers.
        self.seen: dict[str, bytes] = {}
        pieces = map(self.library.id_to_piece, range(self.library.get_piece_size()))
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a piece of this model crosses a white-space mark")
        self.lead = self._lead()
        self.begin, self.end = (
            np.uint32(i).astype("<u4").tobytes()
            for i in (self.library.bos_id(), self.library.eos_id())
        )

    def _lead(self) -> str:
        """A chunk whose ids stand in front of any other without touching it.

        The library puts a mark in front of every text. A line feed behind that mark
        shields a chunk from it; the line feed's ids are then cut off again.
        """
        lead = "\n"
        self.lead_ids = self.library.encode(lead)
        for probe in ("a", " a", "  a", f"{MARK}a", "é", "  "):
            if self.library.encode(lead + probe)[: len(self.lead_ids)] != self.lead_ids:
                raise ValueError("this model joins a line feed with what follows it")
        return lead

    def _chunks(self, text: str) -> list[str]:
        """Chunks of a text, with the mark that the library puts in front of it.

        A chunk that begins with one space stands in the list without it.
        """
        if not text:
            return []
        if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        found = CHUNK.findall(f" {text}")
        return [c[1:] if c[0] == " " and c[1:2] not in ("", " ", MARK) else c for c in found]

    def _learn(self, split: list[list[str]]) -> None:
        """Segment the chunks that the table lacks, each once."""
        found: set[str] = set().union(*split)
        if len(self.seen) + len(found) > self.size:
            self.seen = {c: self.seen[c] for c in found & self.seen.keys()}
        new = list(found - self.seen.keys())
        skip, lead = len(self.lead_ids), self.lead
        whole = [lead + c if c[0] in (" ", MARK) else f"{lead} {c}" for c in new]
        for chunk, ids in zip(new, self.library.encode(whole, num_threads=1)):
            self.seen[chunk] = array("I", ids[skip:]).tobytes()

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as packed integers; a null text is an empty one.

        A bounded number of characters at a time, so that the table stays bounded but
        for the chunks of one text.
        """
        packed: list[bytes] = []
        some: list[list[str]] = []
        weight = 0

        def flush() -> None:
            self._learn(some)
            of = self.seen.__getitem__
            packed.extend(b"".join([self.begin, *map(of, x), self.end]) for x in some)
            some.clear()

        for text in texts:
            some.append(self._chunks(text or ""))
            weight += len(text or "")
            if weight > 10 * self.size:
                flush()
                weight = 0
        flush()
        return packed

    def decode(self, packed: bytes) -> str:
        return self.library.decode(np.frombuffer(packed, "<u4").tolist())


@lru_cache(maxsize=2)
def chunk_table(model_file: str) -> ChunkTable:
    """The table of this Python worker."""
    return ChunkTable(model_file)


def encode_pieces(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, ids) of every row: what the library's encode gives, with begin and end ids.

    A null text is encoded as an empty one. Null and repeated ids are passed on, row by
    row; other columns are not looked at. ``model_file`` must exist on every executor.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model_file)
        for part in parts:
            packed = table.encode_all(part.column(1).to_pylist())
            ends = np.cumsum([0] + [len(x) // 4 for x in packed], dtype=np.int32)
            ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))],
                names=[id_col, "ids"],
            )

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    schema = fields((id_col, id_type(docs, id_col)), ("ids", ArrayType(IntegerType())))
    return rows.mapInArrow(batches, schema)


def decode_pieces(tokens: DataFrame, model_file: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, text) of every row of (id_col, ids); null ids give a null text."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model_file)
        for part in parts:
            texts = [None if x is None else table.library.decode(x) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts, pa.string())], names=[id_col, "text"]
            )

    schema = fields((id_col, id_type(tokens, id_col)), ("text", StringType()))
    return tokens.select(id_col, "ids").mapInArrow(batches, schema)


def piece_digests(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of every row, by encoding and decoding.

    The digests are made where the ids are, so neither ids nor texts leave their task.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model_file)
        for part in parts:
            packed = table.encode_all(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(x) // 4 for x in packed], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in packed]),
                    pa.array([hashlib.sha256(table.decode(x).encode()).hexdigest() for x in packed]),
                ],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    schema = fields(
        (id_col, id_type(docs, id_col)),
        ("n_tokens", LongType()),
        ("ids_sha256", StringType()),
        ("decoded_sha256", StringType()),
    )
    return rows.mapInArrow(batches, schema)
