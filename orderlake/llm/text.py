"""Column helpers for words and lines, in built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, as trim characters and as the body of a character class.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = " \\x09-\\x0D"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often it is used.

    Inside a function over arrays nothing is shared, so a value that a lambda uses
    would otherwise be computed again for each element.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, f"[{SPACE_CLASS}]+")
    )


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))
