"""Columns that are computed once per row, whatever reads them later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add expensive columns behind a boundary that no expression crosses.

    Spark moves a filter below the projection it follows by pasting the projected
    expressions into it. With a parse among them, every term of the filter would
    parse again. It does not do so across a generator, so the finished columns
    pass through one that yields exactly one row per input row. The work itself
    stays in the projection below, which is compiled; a generator may not be.
    """
    worked = df.select("*", *[column.alias(name) for name, column in columns.items()])
    passed = worked.select(*df.columns, F.explode(F.array(F.struct(*columns))).alias("_passed"))
    return passed.select(
        *df.columns, *[F.col("_passed")[name].alias(name) for name in columns]
    )
