"""Token-id files: documents in order of their ids, as rANS segments.

The rows are range-partitioned by id, ties by their place in the table, so one id that
holds many rows is still spread. A task walks through its documents in order, encodes
them, and closes a segment whenever it holds ``segment_tokens`` ids; so its memory does
not depend on the size of its partition, but for the length of one text. A segment has
its own frequency table, which its blocks share.

The files are a Parquet dataset, so that Spark writes and commits them wherever it can
write: each row is one segment with the place it has in the order (``part``, ``seq``)
and the ids and lengths of its documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType

from orderlake.llm.rans import CorruptSegment, Segment, encode_segment
from orderlake.llm.tables import fields, id_type
from orderlake.llm.word_tokens import word_table

SEGMENT_TOKENS = 1 << 22


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending id order.

    A null text is an empty one, so only ``end_id`` stands for it. Null ids come first;
    rows with the same id stand in the order of the table. ``path`` must not exist and
    ``tokenizer_file`` must exist on every executor. No rows give an empty dataset.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(tokenizer_file)
        end = np.uint32(end_id).astype("<u4").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        ids, packed, held = [], [], 0

        def segment() -> pa.RecordBatch:
            data = encode_segment(np.frombuffer(b"".join(packed), "<u4"))
            lengths = [len(x) // 4 for x in packed]
            return pa.RecordBatch.from_pydict(
                {
                    "part": [part],
                    "seq": [seq],
                    "n_tokens": [held],
                    "doc_ids": [ids],
                    "doc_tokens": [lengths],
                    "data": [data],
                },
                schema=arrow,
            )

        arrow = None
        for batch in parts:
            if arrow is None:
                arrow = pa.schema(
                    [
                        ("part", pa.int32()),
                        ("seq", pa.int32()),
                        ("n_tokens", pa.int64()),
                        ("doc_ids", pa.list_(batch.column(0).type)),
                        ("doc_tokens", pa.list_(pa.int32())),
                        ("data", pa.binary()),
                    ]
                )
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packed.append(table.encode_all([text.as_py()])[0] + end)
                ids.append(doc_id)
                held += len(packed[-1]) // 4
                if held >= segment_tokens:
                    yield segment()
                    seq += 1
                    ids, packed, held = [], [], 0
        if packed:
            yield segment()

    kind = id_type(docs, id_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("binary").alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    ordered = (
        rows.repartitionByRange("id", "place").sortWithinPartitions("id", "place").select("id", "text")
    )
    schema = fields(
        ("part", IntegerType()),
        ("seq", IntegerType()),
        ("n_tokens", LongType()),
        ("doc_ids", ArrayType(kind)),
        ("doc_tokens", ArrayType(IntegerType())),
        ("data", BinaryType()),
    )
    # Segments are megabytes large: close a row group after a few of them.
    ordered.mapInArrow(batches, schema).write.option("parquet.block.row.count.limit", 4).parquet(path)


def _bases(files: DataFrame) -> DataFrame:
    """(part, seq, base): ids in all segments before each. Whole parts are added up first."""
    totals = files.select("part", "seq", "n_tokens")
    by_part = totals.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = by_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    segments = totals.select(
        "part", "seq", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("ahead")
    )
    return segments.join(parts, "part").select(
        "part", "seq", (F.col("first") + F.col("ahead")).alias("base")
    )


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, part, seq, offset, ids) of every document, decoded and checked."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, lengths, offsets, tokens in _decoded(parts):
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.full(len(ids), row[0], np.int32)),
                    pa.array(np.full(len(ids), row[1], np.int32)),
                    pa.array(offsets),
                    pa.LargeListArray.from_arrays(
                        pa.array(np.append(offsets, len(tokens))), pa.array(tokens.astype(np.int64))
                    ).cast(pa.list_(pa.int64())),
                ],
                names=[id_col, "part", "seq", "offset", "ids"],
            )

    schema = fields(
        (id_col, kind),
        ("part", IntegerType()),
        ("seq", IntegerType()),
        ("offset", LongType()),
        ("ids", ArrayType(LongType())),
    )
    return files.select("part", "seq", "doc_ids", "doc_tokens", "data").mapInArrow(batches, schema)


def _decoded(parts: Iterator[pa.RecordBatch]):
    """(part, seq), document ids, lengths, offsets and all ids of each segment."""
    for batch in parts:
        for i in range(batch.num_rows):
            part, seq, ids, lengths, data = (batch.column(c)[i] for c in range(5))
            tokens = Segment(data.as_py()).all()
            sizes = np.array(lengths.values, np.int64)
            ends = np.cumsum(sizes)
            if len(tokens) != (ends[-1] if len(ends) else 0):
                raise CorruptSegment("lengths of documents")
            yield (part.as_py(), seq.as_py()), ids.values, sizes, ends - sizes, tokens


def token_digests(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of every document, from the files alone.

    The digests are made where a segment is decoded; only they are joined with the
    number of ids ahead of the segment, never its bytes.
    """
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, sizes, offsets, tokens in _decoded(parts):
            data = memoryview(tokens.astype("<u4").tobytes())
            sums = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(offsets, sizes)]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.full(len(ids), row[0], np.int32)),
                    pa.array(np.full(len(ids), row[1], np.int32)),
                    pa.array(offsets),
                    pa.array(sizes),
                    pa.array(sums, pa.int64()),
                ],
                names=[id_col, "part", "seq", "offset", "n_tokens", "ids_crc32"],
            )

    schema = fields(
        (id_col, kind),
        ("part", IntegerType()),
        ("seq", IntegerType()),
        ("offset", LongType()),
        ("n_tokens", LongType()),
        ("ids_crc32", LongType()),
    )
    found = files.select("part", "seq", "doc_ids", "doc_tokens", "data").mapInArrow(batches, schema)
    return found.join(_bases(files), ["part", "seq"]).select(
        id_col, (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
