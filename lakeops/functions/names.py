"""Dotted object names: ``catalog``, ``catalog.schema`` or ``catalog.schema.table``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_parts(col: Column) -> Column:
    """Parts of a dotted name with blank parts dropped."""
    return F.filter(F.transform(F.split(col, r"\."), lambda part: F.trim(part)), lambda part: part != F.lit(""))


def classify_name(col: Column) -> Column:
    """CATALOG, SCHEMA or TABLE by the number of parts, INVALID for any other number and for NULL."""
    count = F.size(name_parts(col))
    return (
        F.when(count == 1, "CATALOG").when(count == 2, "SCHEMA").when(count == 3, "TABLE").otherwise("INVALID")
    )


def with_name_parts(df: DataFrame, name_col: str) -> DataFrame:
    """Add object_type, catalog_name, schema_name and table_name."""
    parts = name_parts(F.col(name_col))
    return df.select(
        "*",
        classify_name(F.col(name_col)).alias("object_type"),
        F.get(parts, 0).alias("catalog_name"),
        F.get(parts, 1).alias("schema_name"),
        F.get(parts, 2).alias("table_name"),
    )


def table_key(catalog: Column, schema: Column, table: Column) -> Column:
    return F.lower(F.concat_ws(".", catalog, schema, table))
