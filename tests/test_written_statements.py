"""MERGE, UPDATE and DELETE as text, numbered appends, drifting files and tasks side by side on awkward input."""

import threading

import pytest
from pyspark.sql import functions as F

from lakeops import paths
from lakeops.operators.changes import DuplicateMergeKeys, delete_where
from lakeops.operators.upkeep import analyze_files
from lakeops.operators.writes import TableSpec, append, ensure_tables, with_dense_ids
from lakeops.plans.parsed import ParsedWrite, UnsupportedStatement
from lakeops.plans.steps import StepFailed, run_pipeline, run_statement, with_views
from lakeops.sources.snapshot import CommitConflict
from lakeops.streaming.ingest import ingest_files, read_drifting

DDL = "id BIGINT, v STRING, n INT"


def build(lake, rows, name="dev.silver.t", parts=1, **spec):
    df = lake.spark.createDataFrame(rows, DDL)
    ensure_tables(lake, [TableSpec(name, df.schema, **spec)])
    if rows:
        append(df.repartition(parts), lake.table(name))
    return lake.table(name)


def run(lake, text, target="dev.silver.t"):
    return run_statement(lake, text, target, "APPEND", {})


def rows(target):
    return sorted(map(tuple, target.read().collect()), key=lambda r: tuple((x is None, x) for x in r))


def source(lake, data):
    lake.mount("dev.bronze.s", lake.spark.createDataFrame(data, DDL))


def test_merge_takes_the_first_clause_that_holds(lake):
    target = build(lake, [(1, "a", 1), (2, "b", 2), (3, "c", None), (None, "null", 9)])
    source(lake, [(1, "A", 10), (2, "B", None), (3, "C", 30), (4, "D", 40), (None, "N", 50)])
    done = run(
        lake,
        """MERGE INTO dev.silver.t USING dev.bronze.s ON dev.silver.t.id = dev.bronze.s.id
        WHEN MATCHED AND dev.bronze.s.n IS NULL THEN DELETE
        WHEN MATCHED AND dev.silver.t.n > 0 THEN UPDATE SET dev.silver.t.v = dev.bronze.s.v
        WHEN MATCHED AND dev.silver.t.n = 1 THEN DELETE
        WHEN NOT MATCHED AND id IS NOT NULL THEN INSERT *""",
    )
    assert done.row_counts == (1, 1, 1)
    assert rows(target) == [(1, "A", 1), (3, "c", None), (4, "D", 40), (None, "null", 9)]


def test_merge_star_and_conditions_without_equality(lake):
    target = build(lake, [(k, "old", k) for k in range(6)], parts=3)
    source(lake, [(100, "new", 2), (200, "new", 9)])
    run(lake, "MERGE INTO dev.silver.t t USING dev.bronze.s s ON t.n BETWEEN s.n - 1 AND s.n WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT (id, n) VALUES (s.id, s.n + 1)")
    assert rows(target) == [(0, "old", 0), (3, "old", 3), (4, "old", 4), (5, "old", 5), (100, "new", 2), (100, "new", 2), (200, None, 10)]


def test_merge_refuses_several_partners_unless_it_deletes(lake):
    target = build(lake, [(1, "a", 1), (2, "b", 2)])
    source(lake, [(1, "x", 1), (1, "y", 1), (7, "z", 1)])
    with pytest.raises(DuplicateMergeKeys):
        run(lake, "MERGE INTO dev.silver.t t USING dev.bronze.s s ON t.id = s.id WHEN MATCHED THEN UPDATE SET v = s.v")
    assert target.latest_version() == 1
    done = run(lake, "MERGE INTO dev.silver.t t USING dev.bronze.s s ON t.id = s.id WHEN MATCHED THEN DELETE WHEN NOT MATCHED THEN INSERT *")
    assert done.row_counts == (1, 0, 1) and rows(target) == [(2, "b", 2), (7, "z", 1)]


@pytest.mark.parametrize("with_delete", [False, True])
def test_merge_by_source_sees_target_columns_only(lake, with_delete):
    target = build(lake, [(1, "a", 1), (2, "b", 2), (3, "c", 3)], parts=2)
    source(lake, [(2, "s", 20), (2, "s", 20)] if with_delete else [(2, "s", 20)])
    matched = "DELETE" if with_delete else "UPDATE SET n = s.n"
    run(lake, f"MERGE INTO dev.silver.t t USING dev.bronze.s s ON t.id = s.id WHEN MATCHED THEN {matched} WHEN NOT MATCHED BY SOURCE AND n = 1 THEN UPDATE SET v = concat(v, '!') WHEN NOT MATCHED BY SOURCE THEN DELETE")
    assert rows(target) == ([(1, "a!", 1)] if with_delete else [(1, "a!", 1), (2, "b", 20)])


def test_merge_into_an_empty_table_and_from_nothing(lake):
    target = build(lake, [])
    source(lake, [])
    text = "MERGE INTO dev.silver.t t USING dev.bronze.s s ON t.id = s.id WHEN MATCHED THEN DELETE WHEN NOT MATCHED THEN INSERT *"
    assert run(lake, text).row_counts == (0, 0, 0)
    source(lake, [(1, "a", 1), (1, "a", 1)])
    assert run(lake, text).row_counts == (2, 0, 0) and len(rows(target)) == 2


def test_update_and_delete_with_subqueries(lake):
    target = build(lake, [(1, "a", 1), (2, "b", None), (3, "c", 3)], parts=3)
    source(lake, [(1, "x", 5), (3, "y", 6)])
    done = run(lake, "UPDATE dev.silver.t AS t SET n = (SELECT max(s.n) FROM dev.bronze.s s WHERE s.id = t.id), v = 'it''s' WHERE EXISTS (SELECT 1 FROM dev.bronze.s WHERE dev.bronze.s.id = t.id);")
    assert done.row_counts == (0, 2, 0) and rows(target) == [(1, "it's", 5), (2, "b", None), (3, "it's", 6)]
    done = run(lake, "/* out */ DELETE FROM dev.silver.t WHERE id NOT IN (SELECT id FROM dev.silver.t WHERE n = 5)")
    assert done.row_counts == (0, 0, 2) and rows(target) == [(1, "it's", 5)]
    assert run(lake, "UPDATE dev.silver.t SET n = n + 1").row_counts == (0, 1, 0)
    assert run(lake, "DELETE FROM dev.silver.t").row_counts == (0, 0, 1) and rows(target) == []


def test_statements_that_cannot_be_carried_out_are_refused(lake):
    build(lake, [(1, "a", 1)])
    source(lake, [(1, "x", 5)])
    with pytest.raises(StepFailed, match="target"):
        run(lake, "DELETE FROM dev.silver.t", "dev.silver.other")
    for text in ("UPDATE dev.silver.t SET nope.x = 1", "UPDATE dev.silver.t SET n = 1, n = 2", "MERGE INTO dev.silver.t t USING dev.bronze.s s ON t.id = s.id WHEN MATCHED THEN UPDATE SET s.v = 'x'"):
        with pytest.raises(UnsupportedStatement):
            run(lake, text)
    with pytest.raises(ValueError, match="nope"):
        run(lake, "UPDATE dev.silver.t SET nope = 1")
    with pytest.raises(UnsupportedStatement):
        ParsedWrite(lake.spark, with_views(lake, "SELECT * FROM dev.silver.t"))


def test_qualified_columns_in_queries(lake):
    build(lake, [(1, "a", 1), (2, "b", 5)])
    from lakeops.plans.steps import lake_sql

    assert lake_sql(lake, "SELECT max(dev.silver.t.n) AS m FROM dev.silver.t").first().m == 5
    assert lake_sql(lake, "SELECT `dev`.`silver`.`t`.`v` FROM dev.silver.t WHERE dev.silver.t.id = 2").first().v == "b"


# -- numbered appends ----------------------------------------------------------------------------------------------


def test_dense_ids_of_filtered_scans_and_equal_rows(spark, scratch):
    path = scratch("ids")
    spark.range(0, 1000, 1, 7).select(F.lit("same").alias("v")).write.parquet(path)
    found = with_dense_ids(spark.read.parquet(path), "id", 5).agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()
    assert tuple(found) == (6, 1005, 1000)


def test_given_ids_stay_and_deleted_ones_are_not_given_again(lake):
    target = build(lake, [], identity="id")
    spark = lake.spark
    append(spark.createDataFrame([(50, "given", 1)], DDL), target)
    append(spark.createDataFrame([("x", 1), ("y", 2)], "v STRING, n INT").where("n > 1"), target)
    assert [r[0] for r in rows(target)] == [50, 51]
    delete_where(target, "id = 51")
    append(spark.createDataFrame([("z", 1)], "v STRING, n INT"), target)
    append(spark.createDataFrame([], "v STRING, n INT"), target)
    assert [r[0] for r in rows(target)] == [50, 52]


def test_two_numbering_writers_share_no_id(lake):
    target = build(lake, [], identity="id")
    spark = lake.spark

    def write(k):
        append(spark.range(100).select(F.lit(str(k)).alias("v"), F.lit(k).alias("n")), lake.table(target.name))

    threads = [threading.Thread(target=write, args=(k,)) for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert [r[0] for r in rows(target)] == list(range(1, 301))


def test_a_version_has_one_writer(lake):
    target = build(lake, [])
    state, won = target.state(), []

    def commit(k):
        try:
            won.append(target.commit(state.version, state, "WRITE", {"numOutputRows": k}, state.live).version)
        except CommitConflict:
            pass

    threads = [threading.Thread(target=commit, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert won == [1] and target.state().version == 1
    assert [n for n in paths.child_names(lake.spark, target.log_dir) if "tmp" in n] == []


# -- drift ---------------------------------------------------------------------------------------------------------


def put(spark, folder, name, text):
    spark.createDataFrame([(line,) for line in text.split("\n")], "value STRING").coalesce(1).write.mode("append").text(f"{folder}/{name}")
    return [p for p in paths.matching(spark, f"{folder}/{name}/part-*")]


def test_types_widen_or_are_rescued(spark, scratch):
    folder = scratch("drift")
    first = put(spark, folder, "a", "id,day,flag,free\n1,2024-01-01,true,x\n2,,false,")
    rows1, schema = read_drifting(spark, first, "csv", None, "rest", infer_types=True)
    assert [f.dataType.simpleString() for f in schema.fields] == ["int", "date", "boolean", "string", "string"]
    assert [r.rest for r in rows1.collect()] == [None, None]
    second = put(spark, folder, "b", "id,day,more\n9999999999,soon,1.5\n,2024-02-30,")
    rows2, wider = read_drifting(spark, second, "csv", schema, "rest", infer_types=True)
    assert [f.dataType.simpleString() for f in wider.fields] == ["bigint", "date", "boolean", "string", "double", "string"]
    got = sorted(map(tuple, rows2.collect()), key=repr)
    assert got == sorted([(9999999999, None, None, None, 1.5, '{"day":"soon"}'), (None, None, None, None, None, '{"day":"2024-02-30"}')], key=repr)
    third = put(spark, folder, "c", "id\nmany")
    rows3, same = read_drifting(spark, third, "csv", wider, "rest", infer_types=True)
    assert same.simpleString() == wider.simpleString() and rows3.first().rest == '{"id":"many"}'
    with pytest.raises(ValueError):
        read_drifting(spark, third, "parquet", None, "rest")


def test_nested_json_and_empty_columns_drift(spark, lake, scratch):
    folder, target = scratch("nested"), lake.table("dev.bronze.nested")
    put(spark, folder, "a", '{"id": 1, "in": {"x": "a"}, "none": null}')
    ingest_files(spark, f"{folder}/*", target, scratch("cp"), "json", schema_loc=f"{folder}-schema", infer_types=True, rescue="rest")
    put(spark, folder, "b", '{"id": "two", "in": {"x": "b"}, "none": 5}')
    ingest_files(spark, f"{folder}/*", target, scratch("cp2"), "json", schema_loc=f"{folder}-schema", infer_types=True, rescue="rest")
    assert ("two" in str(target.read().select("rest").collect())) and target.read().where("rest IS NOT NULL").count() == 1


# -- statistics and stages -----------------------------------------------------------------------------------------


def test_statistics_of_nulls_and_nothing(lake):
    empty = build(lake, [], "dev.silver.empty")
    found, read = analyze_files(empty, ["id", "v"])
    assert read == 0 and [(r.row_count, r.null_count, r.min_value) for r in found.collect()] == [(0, 0, None)] * 2
    target = build(lake, [(None, None, 1), (None, "x", None)])
    found, _ = analyze_files(target, ["id", "v", "n"])
    got = {r.column_name: (r.row_count, r.null_count, r.distinct_approx, r.min_value, r.median_approx) for r in found.collect()}
    assert got == {"id": (2, 2, 0, None, None), "v": (2, 1, 1, "x", None), "n": (2, 1, 1, "1", 1.0)}
    assert analyze_files(target, ["id", "v", "n"])[1] == 0


def test_a_failing_task_lets_its_neighbours_finish_and_stops_what_follows(lake):
    from lakeops.checks.steps import LOG_TABLE, config_frame, context, library_file

    build(lake, [(1, "a", 1)])
    build(lake, [], "dev.gold.a")
    build(lake, [], "dev.gold.b")
    path = library_file(lake.spark, {"good": "SELECT * FROM dev.silver.t", "bad": "SELECT nope FROM dev.silver.t"})
    steps = []
    for task, name, target in (("A", "good", "dev.gold.a"), ("B", "bad", "dev.gold.b"), ("C", "good", "dev.gold.b")):
        steps += [(task, 1, "GOLD", "SQLLOAD", {"sql_path": path}, "", ""), (task, 2, "GOLD", "SQL", {"sql_var": name, "sql_parms": ""}, target, "APPEND")]
    ctx = context(lake, config_frame(lake.spark, steps))
    with pytest.raises(StepFailed, match="task B"):
        run_pipeline(ctx, [[("B", "GOLD"), ("A", "GOLD")], ("C", "GOLD")])
    assert lake.read("dev.gold.a").count() == 1 and lake.read("dev.gold.b").count() == 0
    status = {(r.etls_table_name, r.etls_status) for r in lake.read(LOG_TABLE).collect()}
    assert status == {("a", "SUCCESS"), ("b", "FAILED")}


def test_many_dropped_files_are_planned_in_one_call(lake):
    import time

    from lakeops.sources.snapshot import among

    target = build(lake, [(k, "a", k) for k in range(40)], parts=4)
    live = target.live_files()
    gone = [f"lk_commit=1-gone/part-{k:05d}-it's \\ a, name.parquet" for k in range(20_000)] + live[1:]
    state = target.state()
    state = type(state)(**{**state.asDict(), "dropped": gone})
    start = time.time()
    scan = target.scan_state(state)
    assert scan.select("id").inputFiles() and time.time() - start < 5
    one = lake.spark.read.parquet(f"{target.data_dir}/{live[0]}").count()
    assert scan.count() == one < 40 and target.file_sizes(state).count() == 1
    assert lake.spark.createDataFrame([("a",), ("b",)], "e STRING").where(among(lake.spark, F.col("e"), ["b", "c"])).collect()[0].e == "b"


def test_a_diff_lists_only_what_differs(lake, monkeypatch):
    from lakeops.operators.changes import diff_versions

    target = build(lake, [(k, "a", k) for k in range(30)], parts=3)
    append(lake.spark.createDataFrame([(100, "b", 1)], DDL), target)
    listed = []
    whole = type(target).files_below
    monkeypatch.setattr(type(target), "files_below", lambda self, entries, schema: listed.append(list(entries)) or whole(self, entries, schema))
    assert [tuple(r) for r in diff_versions(target, 1, 2, ["id"]).collect()] == [(100, "inserted")]
    assert [len(e) for e in listed] == [0, 1]
    delete_where(target, "id = 3")
    assert [tuple(r) for r in diff_versions(target, 2, 3, ["id"]).collect()] == [(3, "deleted")]
