"""Tables that the operators of this package read and write on their way.

Intermediate tables cut the lineage: they lie in the folder that all executors
share (``spark.checkpoint.dir``), so a lost executor costs the tasks it ran and
nothing before them. What is read twice is written once.
"""

from __future__ import annotations

import os
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from orderlake.session import scratch_path


def import_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    They find it anyway where it is installed or the job was started in its folder.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    import_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back."""
    spark = df.sparkSession
    import_on_workers(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def anew(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own, for a cogroup with a frame of the same origin."""
    return df.toDF(*df.columns)


#: Rows that a table may have to be sent whole to every task.
SMALL = 100_000


def small(table: DataFrame) -> DataFrame:
    """``table`` marked for a broadcast if it has few rows; else Spark deals it out by key.

    For tables that were written, whose rows are counted from the files, and of rows
    whose own size is bounded.
    """
    return F.broadcast(table) if table.count() <= SMALL else table


#: Rows that a sample is chosen among, for each row it is to have.
SLACK = 4
_HASHES = 1 << 30


def few_of(group: Column, counts: dict, wanted: int, *keys: str) -> Column:
    """Condition that leaves about SLACK * ``wanted`` rows of each group, by a hash.

    ``counts`` has the rows of each group; smaller groups are left whole. What a sample
    is then taken from does not grow with the rows or their partitions.
    """
    turn = F.pmod(F.xxhash64(*keys), F.lit(_HASHES))
    share = {name: min(1.0, SLACK * wanted / max(1, n)) for name, n in counts.items()}
    left = [(group == F.lit(name)) & (turn < int(x * _HASHES)) for name, x in share.items()]
    return reduce(Column.__or__, left, F.lit(False))


def first_of_each(rows: DataFrame, group: str, wanted: int) -> DataFrame:
    """The first ``wanted`` (group, text) of each group of (group, id, text) by a hash of
    the id; a row that repeats counts once."""
    once = rows.groupBy(group, "id", F.xxhash64("text").alias("digest")).agg(
        F.first("text").alias("text")
    )
    turn = Window.partitionBy(group).orderBy(F.xxhash64("id"), "id", "digest")
    placed = once.withColumn("place", F.row_number().over(turn))
    return placed.filter(F.col("place") <= wanted).orderBy(group, "place").select(group, "text")


def id_type(df: DataFrame, column: str) -> DataType:
    return df.schema[column].dataType


def fields(*parts: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in parts])


def crc_part(id_column: str, parts: int) -> Column:
    """Remainder of crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % parts
