"""Count reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import AGE_BRACKETS, bracket


def count_by(
    df: DataFrame, keys: Sequence[str | Column], where: Column | str | None = None, name: str = "row_count"
) -> DataFrame:
    """COUNT(*) per key, after an optional filter."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_by_bracket(
    df: DataFrame,
    value: Column,
    brackets: Sequence[tuple] = AGE_BRACKETS,
    label: str = "bracket",
    name: str = "row_count",
    other: str = "Unknown",
) -> DataFrame:
    """COUNT(*) per bracket of a number, sorted by bracket label."""
    return count_by(df, [bracket(value, brackets, other).alias(label)], name=name).orderBy(label)
