"""Gates, ids and row-level rules."""

import pytest
from pyspark.sql import functions as F

from lakeops.operators.quality import (
    QualityGateFailed,
    append_gated,
    assign_ids,
    gate,
    in_set,
    not_null,
    sql_check,
    violation_counts,
)
from lakeops.operators.writes import TableSpec, ensure_tables, rows_df

DDL = "id INT, kind STRING"
ROWS = [(1, "a"), (2, None), (None, "z")]


def checks():
    return {"kind_allowed": in_set("kind", ["a", "b"]), "id_required": not_null("id")}


def test_gate_raises_with_counts(spark):
    with pytest.raises(QualityGateFailed, match="id_required: 1 rows, kind_allowed: 1 rows"):
        gate(rows_df(spark, ROWS, DDL), checks())
    good, bad = gate(rows_df(spark, ROWS[:2], DDL), checks())
    assert good.count() == 2 and bad is None
    with pytest.raises(ValueError, match="on_fail"):
        gate(rows_df(spark, ROWS, DDL), checks(), "ignore")


def test_quarantine_splits_and_keeps_every_row(spark, lake):
    df = rows_df(spark, ROWS, DDL)
    ensure_tables(lake, [TableSpec("d.s.good", df.schema), TableSpec("d.s.bad", df.schema)])
    kept, set_aside = append_gated(df, lake.table("d.s.good"), checks(), lake.table("d.s.bad"))
    assert kept.row_counts[0] == 2 and set_aside.row_counts[0] == 1
    bad = lake.read("d.s.bad").first()
    assert bad.broken_rules == ["kind_allowed", "id_required"]
    with pytest.raises(QualityGateFailed):
        append_gated(df, lake.table("d.s.good"), checks())
    assert lake.read("d.s.good").count() == 2


def test_quarantine_of_a_source_that_changes(spark, lake):
    df = spark.range(2000).select(F.col("id").cast("int").alias("id"), F.when(F.rand() < 0.5, "a").otherwise("z").alias("kind"))
    ensure_tables(lake, [TableSpec("d.s.good", df.schema), TableSpec("d.s.bad", df.schema)])
    append_gated(df, lake.table("d.s.good"), checks(), lake.table("d.s.bad"))
    ids = [r.id for name in ("d.s.good", "d.s.bad") for r in lake.read(name).select("id").collect()]
    assert sorted(ids) == list(range(2000))


def test_null_passes_a_sql_check(spark):
    counts = violation_counts(rows_df(spark, ROWS, DDL), {"low": sql_check("id < 2")}).first()
    assert counts.row_count == 1


def test_ids_are_dense_with_a_heavy_key_and_equal_rows(spark):
    # A third of the rows share one value and are equal in every column.
    df = spark.range(9000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("k"))
    numbered = assign_ids(df, "id", start=10, order=["k"])
    ids = sorted(r.id for r in numbered.collect())
    assert ids == list(range(11, 9011))
    in_order = [r.k for r in numbered.orderBy("id").collect()]
    assert in_order == sorted(in_order)


def test_ids_of_nothing(spark):
    assert assign_ids(spark.range(0).toDF("k"), "id").count() == 0


def test_ids_move_no_rows_by_their_file(spark):
    # the offsets of files and parts are sent to the rows: a shuffle by file would bring a whole file to one task
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for order in (None, ["k"]):
            numbered = assign_ids(spark.range(100).toDF("k"), "n", order=order)
            assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
            assert sorted(r.n for r in numbered.collect()) == list(range(1, 101))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
