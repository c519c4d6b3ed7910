"""From raw documents to token ids: the stages of a training corpus, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import table, temporary_path, temporary_table
from lakeops.llm.decontaminate import contaminated
from lakeops.llm.jaccard import jaccard_groups
from lakeops.llm.pieces import encode_pieces
from lakeops.llm.pii import fit_classifier, masked, with_spans
from lakeops.llm.quality import KEEP_AT, score_column, three_grades, train
from lakeops.paths import delete


def _packed(docs: DataFrame) -> DataFrame:
    """Rows as one column ``row`` beside doc_id and text, so that no other column's name can clash with a stage's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.struct("*").alias("row"))


def _id(column: str) -> Column:
    """A doc_id to join on: a null one becomes a number."""
    return F.coalesce(F.col(column).cast("long"), F.lit(-(2**63))).alias("id")


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose chance of the top grade is at least KEEP_AT, by a model trained on the labels of ``docs``' own ids.

    Each row is decided by its text alone, so null and empty texts, copies and repeated rows fare alike; without labels all stay.
    """
    model = train(docs, three_grades(table(spark, sf_dir, "labels")), 3)
    rows = _packed(docs).withColumn("s", score_column(spark, model, F.col("text")))
    return rows.where(F.col("s.top_tail") >= KEEP_AT).select(_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the lowest doc_id (null last), then the lowest hash of its text.

    Texts without words have no near copies. Of rows equal in doc_id and text one stays, with or without words.
    """
    found = temporary_table(jaccard_groups(docs), "near-duplicates")
    found = found.select(_id("doc_id"), F.col("text_key").alias("h"), "group_key", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key").alias("rank"))
    first = found.where("group_key is not null").groupBy("group_key").agg(F.min("rank").alias("first"))
    gone = found.join(first, "group_key").where(F.col("rank") != F.col("first")).select("id", "h").distinct()
    rows = _packed(docs).withColumn("h", F.xxhash64("text")).withColumn("id", _id("doc_id"))
    kept = rows.join(gone, ["id", "h"], "left_anti")
    repeated = found.groupBy("id", "h").count().where("count > 1").select("id", "h").join(gone, ["id", "h"], "left_anti")
    if not repeated.isEmpty():
        one = kept.join(repeated, ["id", "h"], "left_semi").dropDuplicates(["id", "h"])
        kept = kept.join(repeated, ["id", "h"], "left_anti").union(one)
    return kept.select(_columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item. Rows of one id are told apart by their text; rows without an id count like others."""
    found = temporary_table(contaminated(docs, table(spark, sf_dir, "benchmark")), "decontamination")
    bad = found.select(_id("doc_id"), F.col("row_key").alias("h")).distinct()
    rows = _packed(docs).withColumn("h", F.xxhash64("text")).withColumn("id", _id("doc_id"))
    return rows.join(bad, ["id", "h"], "left_anti").select(_columns(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data in their texts replaced by masks, and n_chars, where there is one, counted anew. A null text stays null."""
    rows = with_spans(_packed(docs), fit_classifier(docs))
    changed = F.size("_spans") > 0
    rows = rows.withColumn("_text", masked(F.col("text"), F.col("_spans")))
    out = []
    for c in docs.columns:
        column = F.col("row").getField(c)
        if c == "text":
            column = F.when(changed, F.col("_text")).otherwise(column)
        elif c == "n_chars":
            column = F.when(changed, F.length("_text").cast(docs.schema[c].dataType)).otherwise(column)
        out.append(column.alias(c))
    return rows.select(out)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row's text."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", pieces),
]
#: The stages train a model, score passages and follow links; SQL cannot express them. tests/llm/test_pipeline.py holds each stage and run() against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is written to the shared folder and read again as the next input; it goes when that
    one's result is written, and the last when the driver ends."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = temporary_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
