"""Versions, metrics, constraints and change operations on versioned tables."""

import pytest
from pyspark.sql import functions as F

from lakeops.operators.changes import (
    DuplicateMergeKeys,
    change_counts,
    delete_where,
    diff_frames,
    diff_versions,
    merge,
    update_where,
)
from lakeops.operators.writes import TableSpec, append, append_select, ensure_tables, overwrite, rows_df
from lakeops.sources.snapshot import CommitConflict, ConstraintViolation, Lake, UnknownOperation, row_counts

DDL = "id BIGINT, kind STRING, n INT"
ROWS = [(1, "a", 10), (2, "b", None), (3, None, 30), (4, "a", 40), (5, "c", 50)]


def build(lake, rows=ROWS, ddl=DDL, name="dev.silver.t", **spec):
    df = rows_df(lake.spark, rows, ddl)
    ensure_tables(lake, [TableSpec(name, df.schema, **spec)])
    target = lake.table(name)
    if rows:
        append(df, target)
    return target


def contents(target, version=None):
    return sorted((tuple(r) for r in target.read(version).collect()), key=repr)


def test_append_reports_exact_rows_and_versions(lake):
    target = build(lake)
    done = append(rows_df(lake.spark, [(6, "z", 1)], DDL), target)
    assert (done.prev_version, done.version, done.row_counts) == (1, 2, (1, 0, 0))
    assert target.read().count() == 6
    assert contents(target, 1) == sorted(ROWS, key=repr)


def test_empty_append_keeps_the_table(lake):
    target = build(lake)
    done = append(rows_df(lake.spark, [], DDL), target)
    assert done.row_counts == (0, 0, 0)
    assert contents(target) == sorted(ROWS, key=repr)


def test_empty_table_reads_as_empty(lake):
    target = build(lake, rows=[])
    assert target.read().columns == ["id", "kind", "n"]
    assert target.read().count() == 0


def test_schema_growth(lake):
    target = build(lake)
    with pytest.raises(ValueError, match="extra"):
        append(rows_df(lake.spark, [(7, 1.5)], "id BIGINT, extra DOUBLE"), target)
    append(rows_df(lake.spark, [(7, 1.5)], "id BIGINT, extra DOUBLE"), target, merge_schema=True)
    assert contents(target)[-1] == (7, None, None, 1.5)
    assert target.read().where("extra IS NULL").count() == 5


def test_type_widening_reads_old_files(lake):
    target = build(lake)
    append(rows_df(lake.spark, [(8, 3_000_000_000)], "id BIGINT, n BIGINT"), target, merge_schema=True)
    assert target.read().agg(F.sum("n")).first()[0] == 3_000_000_130
    with pytest.raises(ValueError, match="cannot take"):
        append(rows_df(lake.spark, [(8, "x")], "id BIGINT, n STRING"), target, merge_schema=True)


def test_append_by_position_counts_columns(lake):
    target = build(lake)
    with pytest.raises(ValueError, match="2 target columns"):
        append_select(rows_df(lake.spark, [(1,)], "x BIGINT"), target, ["id", "n"])


def test_delete_keeps_null_conditions(lake):
    target = build(lake)
    done = delete_where(target, "n > 20")
    assert done.row_counts == (0, 0, 3)
    assert contents(target) == [(1, "a", 10), (2, "b", None)]
    assert delete_where(target, "n > 1000").row_counts == (0, 0, 0)
    assert delete_where(target).row_counts == (0, 0, 2)
    assert target.read().count() == 0


def test_delete_rewrites_only_files_with_hits(lake):
    target = build(lake)
    before = set(target.live_files())
    append(rows_df(lake.spark, [(100, "q", 1)], DDL).coalesce(1), target)
    added = set(target.live_files()) - before
    delete_where(target, "id = 100")
    assert before <= set(target.live_files())
    assert not added & set(target.live_files())


def test_update_counts_changed_rows(lake):
    target = build(lake)
    done = update_where(target, {"n": "n + 1", "kind": "'u'"}, "kind = 'a'")
    assert done.row_counts == (0, 2, 0)
    assert contents(target) == sorted([(1, "u", 11), (4, "u", 41), *ROWS[1:3], ROWS[4]], key=repr)
    assert update_where(target, {"n": "0"}).row_counts == (0, 5, 0)
    with pytest.raises(ValueError, match="nope"):
        update_where(target, {"nope": "1"})


def test_merge_inserts_updates_deletes(lake):
    target = build(lake)
    source = rows_df(lake.spark, [(1, "s", 100), (4, "s", 400), (9, "s", 900), (None, "s", 0)], DDL)
    done = merge(target, source, ["id"], delete_when="t.n = 40")
    assert done.row_counts == (2, 1, 1)
    assert contents(target) == sorted(
        [(1, "s", 100), ROWS[1], ROWS[2], ROWS[4], (9, "s", 900), (None, "s", 0)], key=repr
    )


def test_merge_twice_equals_merge_once(lake):
    target = build(lake)
    source = rows_df(lake.spark, [(1, "s", 100), (9, "s", 900)], DDL)
    merge(target, source, ["id"])
    once = contents(target)
    assert merge(target, source, ["id"]).row_counts == (0, 2, 0)
    assert contents(target) == once


def test_merge_refuses_repeated_source_keys(lake):
    target = build(lake)
    version = target.latest_version()
    with pytest.raises(DuplicateMergeKeys):
        merge(target, rows_df(lake.spark, [(1, "x", 1), (1, "y", 2)], DDL), ["id"])
    assert target.latest_version() == version


def test_merge_insert_only_and_partial_clauses(lake):
    target = build(lake)
    source = rows_df(lake.spark, [(1, "s", 100), (9, "s", 900)], DDL)
    done = merge(target, source, ["id"], update=None, insert={"id": "s.id", "n": "s.n * 2"})
    assert done.row_counts == (1, 0, 0)
    assert (9, None, 1800) in contents(target) and (1, "a", 10) in contents(target)
    done = merge(target, source, ["id"], update={"n": "t.n + s.n"}, insert=None, update_when="s.n < 500")
    assert done.row_counts == (0, 1, 0)
    assert (1, "a", 110) in contents(target)


def test_merge_with_repeated_target_keys(lake):
    target = build(lake, rows=[(1, "a", 1)] * 50 + [(2, "b", 2)])
    done = merge(target, rows_df(lake.spark, [(1, "s", 9), (3, "s", 9)], DDL), ["id"])
    assert done.row_counts == (1, 50, 0)
    assert target.read().where("id = 1 AND n = 9").count() == 50


def test_merge_into_empty_table(lake):
    target = build(lake, rows=[])
    assert merge(target, rows_df(lake.spark, ROWS, DDL), ["id"]).row_counts == (5, 0, 0)
    assert contents(target) == sorted(ROWS, key=repr)


def test_diff_against_brute_force(lake):
    before = [(i, f"k{i % 3}", i) for i in range(60)]
    after = [(i, f"k{i % 3}", i if i % 7 else i + 1) for i in range(10, 75)]
    frames = [rows_df(lake.spark, rows, DDL) for rows in (before, after)]
    got = {r.id: r.change for r in diff_frames(*frames, ["id"]).collect()}
    old, new = ({r[0]: r for r in rows} for rows in (before, after))
    want = {
        key: "deleted" if key not in new else "inserted" if key not in old else "updated"
        for key in old.keys() | new.keys()
        if old.get(key) != new.get(key)
    }
    assert got == want


def test_diff_sees_a_value_move_between_null_columns(lake):
    a = rows_df(lake.spark, [(1, None, "x")], "id INT, p STRING, q STRING")
    b = rows_df(lake.spark, [(1, "x", None)], "id INT, p STRING, q STRING")
    assert [r.change for r in diff_frames(a, b, ["id"]).collect()] == ["updated"]


def test_diff_of_a_version_with_itself_is_empty(lake):
    target = build(lake)
    assert change_counts(diff_versions(target, 1, 1, ["id"])).first() == (0, 0, 0)


def test_constraints_stop_the_commit(lake):
    target = build(lake, constraints={"small": "n < 100"})
    append(rows_df(lake.spark, [(6, "x", None)], DDL), target)  # NULL passes a check
    version = target.latest_version()
    with pytest.raises(ConstraintViolation, match=r"small \(2 rows\)"):
        append(rows_df(lake.spark, [(7, "x", 100), (8, "x", 200), (9, "x", 5)], DDL), target)
    with pytest.raises(ConstraintViolation):
        update_where(target, {"n": "n * 10"}, "n IS NOT NULL")
    assert target.latest_version() == version
    assert target.read().count() == 6


def test_required_columns_are_enforced(lake):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("kind", T.StringType())])
    ensure_tables(lake, [TableSpec("dev.silver.req", schema)])
    with pytest.raises(ConstraintViolation, match="id_required"):
        append(rows_df(lake.spark, [(None, "x")], "id BIGINT, kind STRING"), lake.table("dev.silver.req"))


def test_partition_overwrite_leaves_other_partitions_alone(lake):
    rows = [(1, "a b/%", 1), (2, "x", 2), (3, None, 3), (4, "ü", 4), (5, "{[x]}*?", 5)]
    target = build(lake, rows=rows, partition_by=["kind"])
    before = {e for e in target.live_files() if "kind=x" not in e}
    overwrite(rows_df(lake.spark, [(9, "x", 9)], DDL), target, partition={"kind": "x"})
    assert contents(target) == sorted([rows[0], rows[2], rows[3], rows[4], (9, "x", 9)], key=repr)
    assert before <= set(target.live_files())
    with pytest.raises(ValueError, match="outside"):
        overwrite(rows_df(lake.spark, [(9, "y", 9)], DDL), target, partition={"kind": "x"})
    overwrite(rows_df(lake.spark, [(10, "a b/%", 10), (11, None, 11)], DDL), target, dynamic=True)
    assert contents(target) == sorted([(10, "a b/%", 10), (11, None, 11), rows[3], rows[4], (9, "x", 9)], key=repr)
    delete_where(target, "kind = 'ü'")
    update_where(target, {"n": "n + 1"}, "kind = '{[x]}*?'")
    assert contents(target) == sorted(
        [(10, "a b/%", 10), (11, None, 11), (5, "{[x]}*?", 6), (9, "x", 9)], key=repr
    )


def test_partition_filter_is_pruned(lake):
    target = build(lake, rows=[(i, f"k{i}", i) for i in range(6)], partition_by=["kind"])
    plan = target.read().where("kind = 'k1' AND n > 0").select("id")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
    assert "GreaterThan(n,0)" in plan


def test_unknown_operations_are_refused(lake):
    target = build(lake)
    with pytest.raises(UnknownOperation):
        target.commit(1, target.state(), "CLONE", {}, [])
    with pytest.raises(UnknownOperation):
        row_counts("OPTIMIZE", {})


def test_two_writers_one_wins(lake):
    target = build(lake)
    state = target.state()
    target.commit(state.version, state, "WRITE", {"numOutputRows": 0}, state.live)
    with pytest.raises(CommitConflict):
        target.commit(state.version, state, "WRITE", {"numOutputRows": 0}, state.live)


def test_many_small_appends_are_compacted_on_the_way(spark, lake, monkeypatch):
    monkeypatch.setattr("lakeops.operators.writes._AUTO_COMPACT_AT", 4)
    target = build(lake, rows=[], properties={"auto_compact": "true", "optimize_write": "true"})
    for i in range(6):
        done = append(rows_df(spark, [(i, "x", i)], DDL), target)
        assert done.row_counts == (1, 0, 0)
    assert "OPTIMIZE" in {r.operation for r in target.history().collect()}
    assert len(target.live_files()) < 6
    assert sorted(r.id for r in target.read().collect()) == list(range(6))


def test_merge_on_text_and_time_keys(spark, lake):
    ddl = "k STRING, at TIMESTAMP, n INT"
    rows = [(f"k{i}", f"2024-01-0{i} 10:00:00", i) for i in range(1, 6)]

    def frame(rows):
        return rows_df(spark, rows, ddl.replace("TIMESTAMP", "STRING")).withColumn("at", F.col("at").cast("timestamp"))

    ensure_tables(lake, [TableSpec("d.s.keys", frame(rows).schema)])
    target = lake.table("d.s.keys")
    append(frame(rows), target)
    source = frame([("k2", "2024-01-02 10:00:00", 20), ("k3", "2024-01-09 10:00:00", 30), ("zz", None, 0)])
    assert merge(target, source, ["k", "at"]).row_counts == (2, 1, 0)
    assert {(r.k, r.n) for r in target.read().collect()} == {
        ("k1", 1), ("k2", 20), ("k3", 3), ("k4", 4), ("k5", 5), ("k3", 30), ("zz", 0)
    }


def test_merge_with_only_null_keys(spark, lake):
    target = build(lake)
    assert merge(target, rows_df(spark, [(None, "s", 1)], DDL), ["id"]).row_counts == (1, 0, 0)
    assert target.read().count() == 6


def test_concurrent_appends_all_land(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    target = build(lake, rows=[])
    with ThreadPoolExecutor(max_workers=4) as pool:
        done = list(pool.map(lambda i: append(rows_df(spark, [(i, "x", i)], DDL), target), range(8)))
    assert sorted(d.version for d in done) == list(range(1, 9))
    assert sorted(r.id for r in target.read().collect()) == list(range(8))


def test_session_catalog_inventory(spark):
    from lakeops.sources.inventory import table_inventory

    spark.range(1).createOrReplaceTempView("only_a_view")
    names = {r.table_name for r in table_inventory(spark).collect()}
    assert "only_a_view" not in names


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from lakeops.session import shared_folder

    def session(master, folder):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}-{folder}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    assert shared_folder(session("spark://host:7077", "hdfs://nn/shared/")) == "hdfs://nn/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", None))
    assert shared_folder(session("local[2]", None)).startswith("/")


def test_names_locations_and_drop(spark, scratch):
    elsewhere = scratch("elsewhere")
    lake = Lake(spark, scratch("root"), {"dev.gold.far": elsewhere})
    for name in ("dev.gold.near", "DEV.gold.Far", "other.gold.t"):
        build(lake, name=name)
    assert lake.names() == ["dev.gold.far", "dev.gold.near", "other.gold.t"]
    assert lake.table("dev.gold.far").base.startswith(elsewhere)
    assert lake.drop_all("dev") == 2
    assert lake.names() == ["other.gold.t"]
    with pytest.raises(ValueError, match="catalog.schema.table"):
        lake.table("dev.gold")


def test_replace_empties_but_keeps_history(lake):
    target = build(lake)
    ensure_tables(lake, [TableSpec(target.name, target.schema())], replace=True)
    assert target.read().count() == 0
    assert target.read(1).count() == 5
    assert [r.operation for r in target.history().collect()] == ["REPLACE TABLE", "WRITE", "CREATE TABLE"]


def test_small_changes_keep_the_folder_and_list_dropped_files(spark, lake):
    df = spark.range(0, 1000, 1, 10).select("id", F.format_string("ü k{%d", F.col("id") % 2).alias("k"))
    ensure_tables(lake, [TableSpec("d.s.t", df.schema)])
    target = lake.table("d.s.t")
    append(df, target)
    folder = target.state().live
    assert len(folder) == 1 and len(target.live_files()) == 10
    delete_where(target, "id < 5")  # one file of ten
    state = target.state()
    assert state.live[0] == folder[0] and len(state.dropped) == 1
    update_where(target, {"k": "'x'"}, "id = 250")
    append(df.where("id = 1"), target)
    assert len(target.state().dropped) == 2
    assert target.read().count() == 996 and target.read(1).count() == 1000
    assert target.read().where("k = 'x'").count() == 1
    assert not set(target.state().dropped) & set(target.live_files())
    assert target.file_sizes().count() == len(target.live_files())
    # More than half of the folder goes: now its remaining files are listed instead.
    delete_where(target, "id BETWEEN 300 AND 899")
    state = target.state()
    assert folder[0] not in state.live and state.dropped == []
    assert sorted(r.id for r in target.read().collect()) == sorted([*range(5, 300), *range(900, 1000), 1])
    changes = {(r.id, r.change) for r in diff_versions(target, 2, 3, ["id"]).collect()}
    assert changes == {(250, "updated")}


def test_dropped_files_of_partitions_with_odd_names(spark, lake):
    df = spark.range(0, 400, 1, 4).select("id", F.format_string("ü b/{%d%%", F.col("id") % 4).alias("k"))
    ensure_tables(lake, [TableSpec("d.s.odd", df.schema, partition_by=["k"])])
    target = lake.table("d.s.odd")
    append(df, target)
    delete_where(target, "k = 'ü b/{1%' AND id < 10")
    state = target.state()
    assert len(state.live) == 2 and len(state.dropped) == 1
    assert sorted(r.id for r in target.read().collect()) == [i for i in range(400) if i not in (1, 5, 9)]
    overwrite(df.where("id = 2"), target, dynamic=True)
    assert target.read().count() == 298
    merge(target, df.where("id IN (2, 3)").withColumn("id", F.col("id") + 0), ["id"], delete_when="t.id = 3")
    assert target.read().count() == 297
