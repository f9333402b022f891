"""Tables and views of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake.operators.reports import row_counts


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make each frame readable from SQL under its name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def table_row_counts(
    spark: SparkSession, database: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(dataset, row_count) of every table and view listed, in order of their names.

    Without a database these are the current one's and the session's views. A named
    database has its own only, though the catalog lists the session's views with it.
    Nothing listed gives no rows.
    """
    listed = spark.catalog.listTables(database, pattern)
    if database is not None:
        listed = [t for t in listed if not t.isTemporary]

    def quoted(table) -> str:
        parts = [] if table.isTemporary else [table.catalog, *table.namespace]
        return ".".join(f"`{part.replace('`', '``')}`" for part in [*parts, table.name])

    frames = {t.name: spark.table(quoted(t)) for t in sorted(listed, key=lambda t: t.name)}
    if not frames:
        return spark.createDataFrame([], "dataset string, row_count bigint")
    return row_counts(frames)
