"""Which tables exist: of the lake and of the session catalog."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.snapshot import Lake

INVENTORY_SCHEMA = "catalog_name STRING, schema_name STRING, table_name STRING"


def lake_inventory(lake: Lake) -> DataFrame:
    """(catalog_name, schema_name, table_name) of every lake table."""
    return lake.spark.createDataFrame([tuple(name.split(".")) for name in lake.names()], INVENTORY_SCHEMA)


def list_schemas(spark: SparkSession, catalog: str) -> DataFrame:
    quoted = catalog.replace("`", "``")
    return spark.sql(f"SHOW SCHEMAS IN `{quoted}`").select(F.col("namespace").alias("schema_name"))


def list_tables(spark: SparkSession, catalog: str, schema: str) -> DataFrame:
    """Tables of one schema; temporary views, which Spark lists with them, are left out."""
    quoted = ".".join(f"`{part.replace('`', '``')}`" for part in (catalog, schema))
    return (
        spark.sql(f"SHOW TABLES IN {quoted}")
        .where("NOT isTemporary")
        .select(F.lit(catalog).alias("catalog_name"), F.lit(schema).alias("schema_name"), "tableName")
        .withColumnRenamed("tableName", "table_name")
    )


def table_inventory(spark: SparkSession, catalog: str = "spark_catalog", lake: Lake | None = None) -> DataFrame:
    """Tables of the session catalog, plus those of a lake when given.

    The catalog answers per schema; the schemas are asked side by side and their names become one frame.
    """
    schemas = [row.schema_name for row in list_schemas(spark, catalog).collect()]

    def names(schema: str) -> list[tuple]:
        return [tuple(row) for row in list_tables(spark, catalog, schema).collect()]

    with ThreadPoolExecutor(max_workers=16) as pool:
        rows = [row for found in pool.map(names, schemas) for row in found]
    known = spark.createDataFrame(rows, INVENTORY_SCHEMA)
    return known if lake is None else known.unionByName(lake_inventory(lake))
