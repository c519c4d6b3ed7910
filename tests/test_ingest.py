"""File ingest: once per file, schema growth by name, replay, refusals."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from lakeops.operators.writes import TableSpec, append, ensure_tables, rows_df
from lakeops.streaming.ingest import csv_headers, infer_stream_schema, ingest_files, store_schema, stored_schema


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def target_of(lake, ddl, name="dev.bronze.t"):
    ensure_tables(lake, [TableSpec(name, lake.spark.createDataFrame([], ddl).schema)])
    return lake.table(name)


def rows(target):
    return sorted((tuple(r) for r in target.read().collect()), key=repr)


def test_demo_file_is_loaded_once(spark, lake, scratch):
    src = scratch("src")
    people = "Alice,alice@a.test,30,US\nBob,bob@b.test,25,ID\nCarl,carl@c.test,35,NZ\n"
    put(src, "sample.csv", "Name,Email,Age,Countrycode\n" + people)
    target = target_of(lake, "Name STRING, Email STRING")
    checkpoint = scratch("checkpoint")
    done = ingest_files(spark, src, target, checkpoint)
    assert [d.row_counts for d in done] == [(3, 0, 0)]
    assert done[0].operation == "STREAMING UPDATE"
    assert target.read().columns == ["Name", "Email", "Age", "Countrycode"]
    assert ingest_files(spark, src, target, checkpoint) == []
    assert target.read().count() == 3


def test_columns_are_matched_by_name(spark, lake, scratch):
    src, checkpoint = scratch("src"), scratch("checkpoint")
    put(src, "a b[1]{x}%20+.csv", "id,name\n1,x\n2,\n")
    put(src, "c,d.csv", 'name,extra,id\n"y, ""q""",e,3\n')
    target = target_of(lake, "id STRING, name STRING")
    ingest_files(spark, src, target, checkpoint, options={"escape": '"'})
    assert rows(target) == sorted([("1", "x", None), ("2", None, None), ("3", 'y, "q"', "e")], key=repr)


def test_new_columns_are_refused_without_schema_growth(spark, lake, scratch):
    src, checkpoint = scratch("src"), scratch("checkpoint")
    put(src, "a.csv", "id\n1\n")
    target = target_of(lake, "id STRING")
    ingest_files(spark, src, target, checkpoint, merge_schema=False)
    put(src, "b.csv", "id,more\n2,m\n")
    with pytest.raises(Exception, match="new columns"):
        ingest_files(spark, src, target, checkpoint, merge_schema=False)
    assert rows(target) == [("1",)]
    ingest_files(spark, src, target, checkpoint)
    assert rows(target) == [("1", None), ("2", "m")]


def test_a_value_of_another_type_fails_instead_of_becoming_null(spark, lake, scratch):
    src, checkpoint = scratch("src"), scratch("checkpoint")
    put(src, "a.csv", "id,n\n1,10\n")
    target = target_of(lake, "id INT, n INT")
    ingest_files(spark, src, target, checkpoint, infer_types=True)
    put(src, "b.csv", "id,n\n2,ten\n")
    with pytest.raises(Exception):
        ingest_files(spark, src, target, checkpoint, infer_types=True)
    assert rows(target) == [(1, 10)]


def test_json_fields_grow_and_nested_fields_too(spark, lake, scratch):
    src, checkpoint = scratch("src"), scratch("checkpoint")
    put(src, "a.json", '{"id":1,"o":{"x":1}}\n{"id":2}\n')
    target = target_of(lake, "id BIGINT")
    ingest_files(spark, src, target, checkpoint, "json", infer_types=True)
    put(src, "b.json", '{"id":3,"o":{"y":"q"},"t":[1]}\n')
    ingest_files(spark, src, target, checkpoint, "json", infer_types=True)
    got = {r.id: (r.o.asDict() if r.o else None, r.t) for r in target.read().collect()}
    assert got == {1: ({"x": 1, "y": None}, None), 2: (None, None), 3: ({"x": None, "y": "q"}, [1])}


def test_replayed_batch_is_skipped(spark, lake, scratch):
    src, checkpoint = scratch("src"), scratch("checkpoint")
    put(src, "a.csv", "id\n1\n")
    target = target_of(lake, "id STRING")
    # A run that died after its table commit: the batch is in the log, the stream does not know.
    append(rows_df(spark, [("1",)], "id STRING"), target, operation="STREAMING UPDATE", txn=(checkpoint, 0))
    assert ingest_files(spark, src, target, checkpoint) == []
    assert rows(target) == [("1",)]
    put(src, "b.csv", "id\n2\n")
    assert len(ingest_files(spark, src, target, checkpoint)) == 1
    assert rows(target) == [("1",), ("2",)]


def test_small_batches_load_everything(spark, lake, scratch):
    src = scratch("src")
    for i in range(7):
        put(src, f"{i}.csv", f"id\n{i}\n")
    target = target_of(lake, "id STRING")
    done = ingest_files(spark, src, target, scratch("checkpoint"), max_files=2)
    assert len(done) == 4
    assert target.read().count() == 7


def test_headers_one_per_file(spark, scratch):
    src = scratch("src")
    for i in range(5):
        put(src, f"{i}.csv", f"h{i},x\n" + "1,2\n" * 50_000)
    files = [os.path.join(src, f) for f in os.listdir(src)]
    assert sorted(csv_headers(spark, files)) == [f"h{i},x" for i in range(5)]


def test_header_after_blank_lines_and_comments_and_in_gzip(spark, lake, scratch):
    src = scratch("src")
    put(src, "a.csv", "\n# note\nid,n\n1,a\n")
    with gzip.open(os.path.join(src, "b.csv.gz"), "wt") as f:
        f.write("n,id\nb,2\n")
    target = lake.table("dev.bronze.t")
    ingest_files(spark, src, target, scratch("checkpoint"), options={"comment": "#"})
    assert sorted((r.id, r.n) for r in target.read().collect()) == [("1", "a"), ("2", "b")]


def test_schema_is_kept_between_runs(spark, scratch):
    src, kept = scratch("src"), scratch("schema")
    put(src, "a.csv", "id,when\n1,2024-01-01\n")
    assert stored_schema(spark, kept) is None
    schema = infer_stream_schema(spark, src, "csv", True, kept)
    assert [f.dataType.simpleString() for f in schema.fields] == ["int", "date"]
    put(src, "b.csv", "id,more\n2,x\n")
    schema = infer_stream_schema(spark, src, "csv", True, kept)
    assert schema.names == ["id", "when", "more"]
    assert stored_schema(spark, kept) == schema
    with pytest.raises(ValueError, match="format"):
        ingest_files(spark, src, None, "x", "xml")


def test_store_schema_keeps_generations(spark, scratch):
    kept = scratch("schema")
    for ddl in ("a INT", "a INT, b STRING"):
        store_schema(spark, kept, spark.createDataFrame([], ddl).schema)
    assert stored_schema(spark, kept).names == ["a", "b"]


def test_ingested_rows_equal_the_source(spark, lake, scratch):
    src = scratch("src")
    df = spark.range(1000).select(F.col("id").cast("string"), F.repeat(F.lit("ä,\"x"), 3).alias("t"))
    df.repartition(9).write.csv(src, header=True)
    target = target_of(lake, "id STRING, t STRING")
    ingest_files(spark, src, target, scratch("checkpoint"), options={"escape": "\\"})
    assert target.read().exceptAll(df).count() == 0 and target.read().count() == 1000
