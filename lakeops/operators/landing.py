"""Write a frame once to the shared folder and go on from the files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeops.session import scratch_path


def landed(df: DataFrame, label: str = "landed") -> tuple[DataFrame, str]:
    """The same rows read back from Parquet in the shared folder, and the path to delete when they are used up.

    Used where a frame feeds several jobs: they all see the same rows, and a lost executor costs a re-read of files
    instead of the whole lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
