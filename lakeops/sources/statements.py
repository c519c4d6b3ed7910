"""Files of named SQL statements (``name = <three quotes> text; <three quotes>``) as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The file format. A comment runs from # to the end of its line, statements end with a semicolon.
COMMENT_PATTERN = r"#[^\n]*\n"
TRIPLE_QUOTE = '"""'


def read_statement_library(spark: SparkSession, *files: str) -> DataFrame:
    """(file, pos, sql_var, sql_text) of all statements; in one file the last statement of a name wins.

    ``;`` and ``#`` end a statement or start a comment wherever they stand, also inside a literal.
    """
    text = spark.read.text(list(files), wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value")
    )
    return last_per_name(split_statements(text))


def split_statements(text: DataFrame) -> DataFrame:
    """Statements of (file, value) rows, one output row per statement."""
    bare = F.replace(F.regexp_replace("value", COMMENT_PATTERN, ""), F.lit(TRIPLE_QUOTE), F.lit(""))
    pieces = text.select("file", F.posexplode(F.split(bare, ";")).alias("pos", "piece"))
    pair = F.split("piece", "=", 2)
    squeezed = r"^\s+|\s+$"
    return pieces.where(F.trim(F.regexp_replace("piece", r"\s", "")) != "").select(
        "file",
        "pos",
        F.regexp_replace(F.get(pair, 0), squeezed, "").alias("sql_var"),
        F.regexp_replace(F.get(pair, 1), squeezed, "").alias("sql_text"),
    )


def last_per_name(statements: DataFrame) -> DataFrame:
    latest = F.max_by(F.struct("pos", "sql_text"), "pos").alias("last")
    return statements.groupBy("file", "sql_var").agg(latest).select("file", "last.pos", "sql_var", "last.sql_text")
