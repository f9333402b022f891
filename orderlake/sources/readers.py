"""Sources: Kafka, streamed Parquet, and batch scans of lake datasets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.config import LakeConfig

#: Error conditions of a Parquet read that mean "nothing was written yet".
_NO_PATH = "PATH_NOT_FOUND"
_NO_FILES = ("UNABLE_TO_INFER_SCHEMA", "_LEGACY_ERROR_TEMP_1134")


def kafka_source_options(
    bootstrap_servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Read the topic from its start and fail rather than skip lost messages.

    The bounds limit what one micro-batch takes and into how many tasks it is split.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Transport messages of a topic; needs the Spark Kafka connector."""
    options = kafka_source_options(
        bootstrap_servers, topic, max_offsets_per_trigger, min_partitions
    )
    return spark.readStream.format("kafka").options(**options).load()


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files_per_trigger: int | None = 10,
) -> DataFrame:
    """New files of a Parquet dataset as a stream.

    None lifts the rate limit: one batch takes all files that are there.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def scan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A whole Parquet dataset; a declared schema saves the footer reads."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_if_available(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Like :func:`scan`, but a missing or still empty dataset has no rows."""
    try:
        return scan(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != _NO_PATH:
            raise
        return spark.createDataFrame([], schema)


def is_written(spark: SparkSession, path: str, schema: StructType) -> bool:
    """Whether there is a dataset with rows at the path."""
    return not scan_if_available(spark, path, schema).isEmpty()


def require_checkpoint(
    spark: SparkSession, checkpoint: str, dataset: str, schema: StructType
) -> None:
    """Refuse to start a stream anew beside what it wrote to ``dataset`` before.

    For streams that write a folder for each micro-batch: they would number those from
    the start again and overwrite the first ones.
    """
    try:
        spark.read.text(f"{checkpoint}/metadata")
    except AnalysisException as error:
        if error.getCondition() != _NO_PATH:
            raise
        if is_written(spark, LakeConfig.stream_part(dataset), schema):
            raise ValueError(
                f"{dataset} holds rows of a stream whose checkpoint {checkpoint} is gone"
            ) from error


def scan_parts(spark: SparkSession, dataset: str, schema: StructType) -> DataFrame:
    """A dataset as a whole: what batches and what streams have written.

    The parts are read one by one, as a stream's part goes by its commit log.
    """
    parts = [
        scan_if_available(spark, part(dataset), schema)
        for part in (LakeConfig.batch_part, LakeConfig.stream_part)
    ]
    return parts[0].unionByName(parts[1])


def scan_final(
    spark: SparkSession, dataset: str, schema: StructType, keys: list[str]
) -> DataFrame:
    """A dataset of aggregates: a stream's row stands for the batch's of the same key.

    A stream that runs beside a batch build counts the batch's events too, so its
    final windows are whole; until then the batch's row is what there is.
    """
    names = schema.fieldNames()
    streamed = scan_if_available(spark, LakeConfig.stream_part(dataset), schema).select(names)
    built = scan_if_available(spark, LakeConfig.batch_part(dataset), schema)
    return built.join(streamed.select(keys), keys, "left_anti").select(
        built.columns
    ).unionByName(streamed)


def ensure_dataset(
    spark: SparkSession, path: str, schema: StructType, partition_column: str
) -> None:
    """Make an empty dataset where none is, so that a stream can start on it."""
    try:
        scan(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != _NO_PATH:
            raise
        empty = spark.createDataFrame([], schema)
        empty.write.mode("append").partitionBy(partition_column).parquet(path)


def scan_pruned(
    spark: SparkSession,
    path: str,
    columns: list[str],
    *,
    partition_column: str | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Only the named columns of a dataset, and only some dates if asked.

    ``since`` and ``until`` (inclusive dates) bound the partition column, so
    whole directories drop out of the scan. Raises FileNotFoundError where no
    data file exists.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in (_NO_PATH, *_NO_FILES):
            raise FileNotFoundError(f"no Parquet files in {path}") from error
        raise
    if since is not None:
        df = df.filter(F.col(partition_column) >= F.lit(since).cast("date"))
    if until is not None:
        df = df.filter(F.col(partition_column) <= F.lit(until).cast("date"))
    return df.select(columns)
