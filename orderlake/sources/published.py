"""Several tables replaced together, on plain Parquet.

Every refresh writes complete new copies into a folder no reader uses, then adds
one row to a small commit table. Readers take the highest committed number, so
they see all tables of a refresh or none, and a run that dies half-way leaves
nothing visible. Folders are reused in a ring, which bounds storage without any
deleting. One writer at a time.

Meant for reporting tables, whose size is windows times currencies and not the
number of events.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.sources.readers import scan, scan_if_available

_COMMITS = "generation bigint, committed_at timestamp"


def current_generation(spark: SparkSession, root: str) -> int:
    """Number of the last commit, 0 before the first one."""
    schema = StructType.fromDDL(_COMMITS)
    commits = scan_if_available(spark, f"{root}/commits", schema)
    last = commits.agg(F.max("generation").alias("last")).first().last
    return last or 0


def _folder(root: str, generation: int, keep: int, table: str) -> str:
    return f"{root}/slot{generation % keep}/{table}"


def read_published(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    keep: int = 3,
    generation: int | None = None,
) -> DataFrame:
    """The table as last committed; no rows before the first commit.

    ``generation`` saves looking the number up again for each of several tables,
    and makes sure they belong together.
    """
    if generation is None:
        generation = current_generation(spark, root)
    if generation == 0:
        return spark.createDataFrame([], schema)
    return scan(spark, _folder(root, generation, keep, table), schema)


def stage_tables(
    spark: SparkSession,
    root: str,
    generation: int,
    frames: dict[str, DataFrame],
    keep: int = 3,
) -> dict[str, DataFrame]:
    """Write a generation without showing it to readers.

    The tables are independent jobs, so they are submitted side by side.
    """
    if keep < 2:
        raise ValueError("keep at least two generations")

    def write(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, df = item
        folder = _folder(root, generation, keep, name)
        df.write.mode("overwrite").parquet(folder)
        return name, scan(spark, folder, df.schema)

    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        return dict(pool.map(write, frames.items()))


def commit_generation(spark: SparkSession, root: str, generation: int) -> None:
    """Show the staged generation to readers, by one appended file."""
    spark.range(1).select(
        F.lit(generation).cast("bigint").alias("generation"),
        F.current_timestamp().alias("committed_at"),
    ).coalesce(1).write.mode("append").parquet(f"{root}/commits")
