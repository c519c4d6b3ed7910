"""Column expressions used by the load steps. All of them stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The age brackets every report uses (inclusive ends, open top).
AGE_BRACKETS = [(0, 20, "0-20"), (21, 40, "21-40"), (41, 60, "41-60"), (61, None, "61+")]


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Select, rename and reorder: ``{new_name: old_name_or_expression}``."""
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(name) for name, src in mapping.items()])


def blank_to(col: Column, default: str) -> Column:
    """NULL and the empty string both become the default."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def zero_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(0))


def bracket(col: Column, brackets: Sequence[tuple] = AGE_BRACKETS, other: str = "Unknown") -> Column:
    """Label of the bracket a number lies in; NULL and anything outside goes to ``other``.

    A bracket with an open top starts strictly above the end of the bracket before it.
    """
    expr = None
    previous_end = None
    for low, high, label in brackets:
        if high is not None:
            hit = col.between(low, high)
        elif previous_end is not None:
            hit = col > previous_end
        else:
            hit = col >= low
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
        previous_end = high
    return expr.otherwise(other)


def normalise(col: Column, case: str = "upper") -> Column:
    trimmed = F.trim(col)
    return F.upper(trimmed) if case == "upper" else F.lower(trimmed)


def weekday_name(day: Column) -> Column:
    return F.upper(F.date_format(day, "EEEE"))


def day_of_month(day: Column) -> Column:
    return F.dayofmonth(day)


def with_run_columns(df: DataFrame, id_col: str, ts_col: str, **literals: object) -> DataFrame:
    """Add a row uuid, the current time and constant columns."""
    stamped = df.withColumn(id_col, F.uuid()).withColumn(ts_col, F.current_timestamp())
    for name, value in literals.items():
        stamped = stamped.withColumn(name, F.lit(value))
    return stamped


def on_date(ts: Column, day: str) -> Column:
    """A timestamp lies on a date; written as a range, so that the filter reaches the Parquet scan."""
    start = F.lit(day).cast("date")
    return (ts >= start.cast("timestamp_ntz")) & (ts < F.date_add(start, 1).cast("timestamp_ntz"))
