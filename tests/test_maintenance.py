"""Compaction, layout, vacuum, planning and maintenance runs."""

import datetime as dt
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from lakeops.operators.changes import delete_where
from lakeops.operators.upkeep import RetentionTooShort, _with_buckets, analyze, compact, key_ranges, overlap_depth, recluster, stored_files, vacuum, zorder
from lakeops.sources.snapshot import CommitConflict
from lakeops.operators.writes import TableSpec, append, ensure_tables, write_clustered
from lakeops.plans.maintenance import (
    InvalidRules,
    due,
    expand_rules,
    maintenance_plan,
    parse_rules,
    pick_rule,
    run_maintenance,
    selected_tables,
)
from lakeops.operators.audit import run_summary
from lakeops.sources.control import RULES_SCHEMA, maint_log_spec

LOG = "ops.meta.maint_logs"


def numbers(spark, n=4000, parts=20):
    cols = [F.col("id"), (F.col("id") * 7919 % n).alias("a"), F.concat(F.lit("s"), F.col("id") % 50).alias("s")]
    return spark.range(0, n, 1, parts).select(*cols, F.expr("date_add(date'2024-01-01', cast(id % 90 as int))").alias("d"))


def build(lake, df, name="dev.bronze.n", **spec):
    ensure_tables(lake, [TableSpec(name, df.schema, **spec)])
    append(df, lake.table(name))
    return lake.table(name)


def same_rows(target, df):
    return target.read().exceptAll(df).count() == 0 and df.exceptAll(target.read()).count() == 0


def test_compaction_keeps_rows_and_history(spark, lake):
    df = numbers(spark)
    target = build(lake, df)
    assert len(target.live_files()) == 20
    done = compact(target)
    assert done.metrics["numFilesBefore"] == 20 and done.metrics["numFilesAfter"] <= 2
    assert same_rows(target, df)
    assert target.read(1).count() == 4000
    again = compact(target, target_bytes=1)  # nothing is small any more
    assert again.metrics["numFilesBefore"] == again.metrics["numFilesAfter"]


def test_compaction_in_rounds(spark, lake):
    df = numbers(spark, 2000, 40)
    target = build(lake, df)
    size = target.file_sizes().agg(F.max("length")).first()[0]
    done = compact(target, target_bytes=4 * size, round_files=15)
    assert done.metrics["numFilesBefore"] == 40 and done.metrics["numFilesAfter"] < 20
    assert done.version > 2 and same_rows(target, df)


def test_compaction_at_rest_makes_no_version(spark, lake):
    target = build(lake, numbers(spark, 900, 1), partition_by=["s"])
    start = target.latest_version()
    assert compact(target).version == start == target.latest_version()
    plain = build(lake, numbers(spark, 900, 6), "dev.bronze.p")
    first = compact(plain)
    assert compact(plain).version == first.version and len(plain.live_files()) == 1


def test_files_that_fit_no_better_stay(spark, lake):
    target = build(lake, numbers(spark, 4000, 4))
    size = target.file_sizes().agg(F.max("length")).first()[0]
    assert compact(target, target_bytes=int(size / 0.7)).version == target.latest_version() == 1
    append(numbers(spark, 30, 1), target)
    done = compact(target, target_bytes=int(size / 0.7) + size // 2)
    assert done.metrics == {"numFilesBefore": 5, "numFilesAfter": 4} and len(target.live_files()) == 4
    assert target.read().count() == 4030


def test_compaction_of_partitions_in_rounds(spark, lake):
    df = numbers(spark, 600, 1).withColumn("s", F.col("s").substr(1, 2))
    target = build(lake, df, partition_by=["s"])
    for _ in range(3):
        append(df, target)
    done = compact(target, round_files=5)
    assert done.metrics["numFilesAfter"] == len(target.live_files()) == df.select("s").distinct().count()
    assert target.read().count() == 2400
    assert compact(target, round_files=5).version == done.version


def test_compaction_follows_an_append_and_loses_nothing(spark, lake, monkeypatch):
    for change, works in (("append", True), ("delete", False)):
        df = numbers(spark, 1000, 8)
        target = build(lake, df, f"dev.bronze.{change}")
        whole = type(target).write_folder

        def slow(self, rows, state, *args, **options):
            monkeypatch.setattr(type(target), "write_folder", whole)
            other = lake.table(target.name)
            if change == "append":
                append(numbers(spark, 10, 1), other)
            else:
                delete_where(other, "id = 3")
            return whole(self, rows, state, *args, **options)

        monkeypatch.setattr(type(target), "write_folder", slow)
        if works:
            compact(target)
            assert target.read().count() == 1010 and len(target.live_files()) == 1
        else:
            with pytest.raises(CommitConflict):
                compact(target)
            assert target.read().count() == 999


@pytest.mark.parametrize("n_files", [1, 6, 700])
def test_zorder_is_the_same_way_for_any_number_of_files(spark, lake, n_files):
    df = numbers(spark, 3000, 6).withColumn("s", F.concat(F.lit("x" * 60), "s"))
    target = build(lake, df)
    zorder(target, ["id", "s"], n_files=n_files)
    assert same_rows(target, df)
    assert n_files * 0.6 <= len(target.live_files()) <= n_files
    version = target.latest_version()
    assert zorder(target, ["id", "s"], n_files=n_files).version == version
    append(df.limit(1), target)
    assert zorder(target, ["id", "s"], n_files=n_files).version == version + 2


def test_zorder_of_many_columns_and_types(spark, lake):
    df = numbers(spark, 600, 3).select(
        "*",
        F.col("id").cast("double").alias("f"),
        F.when(F.col("id") % 3 == 0, F.lit("nan").cast("double")).otherwise(F.col("a")).alias("n"),
        F.col("d").cast("timestamp").alias("t"),
        F.col("id").cast("decimal(20,4)").alias("m"),
        (F.col("id") % 2 == 0).alias("b"),
        F.lit(None).cast("string").alias("z"),
        F.encode(F.col("s"), "UTF-8").alias("y"),
    )
    target = build(lake, df)
    zorder(target, ["f", "n", "t", "m", "b", "z", "s", "y", "d"], n_files=5, bits=8)
    assert same_rows(target, df)


def test_reclustering_picks_the_overlapping_stretch(spark, lake):
    df = spark.range(0, 8000, 1, 4).select(F.col("id").alias("k"), F.lit("x" * 20).alias("v"))
    target = build(lake, df, cluster_by=["k"])
    assert overlap_depth(target) == 1
    settled = set(target.live_files())
    append(spark.range(3000, 3500, 1, 2).select(F.col("id").alias("k"), F.lit("y").alias("v")), target)
    assert overlap_depth(target) == 2
    assert recluster(target, limit=2).version == target.latest_version() == 2
    recluster(target)
    assert overlap_depth(target) == 1 and len(settled & set(target.live_files())) == 3
    assert recluster(target).version == 3
    assert target.read().count() == 8500


def test_a_hot_key_may_fill_several_files(spark, lake):
    df = spark.range(0, 9000, 1, 3).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("k"), "id")
    target = build(lake, df, cluster_by=["k"])
    size = target.file_sizes().agg(F.sum("length")).first()[0]
    recluster(target, target_bytes=size // 6)
    assert overlap_depth(target) == 1 and same_rows(target, df)
    largest = target.scan_state(target.state()).groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    assert largest < 3600
    version = target.latest_version()
    assert recluster(target, target_bytes=size // 6).version == version


def test_reclustering_of_nulls_and_nothing(spark, lake):
    df = spark.range(0, 300, 1, 3).select(F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("k"), "id")
    target = build(lake, df, cluster_by=["k", "id"])
    recluster(target)
    assert same_rows(target, df) and overlap_depth(target) == 1
    empty = build(lake, df.limit(0), "dev.bronze.none", cluster_by=["k"])
    assert recluster(empty).version == empty.latest_version() and overlap_depth(empty) == 0


def test_compaction_leaves_large_files(spark, lake):
    target = build(lake, numbers(spark, parts=1))
    large = target.live_files()
    size = target.file_sizes().first().length
    append(numbers(spark, 40, 4), target)
    compact(target, target_bytes=size)
    assert set(large) <= set(target.live_files())
    assert target.read().count() == 4040


def test_compaction_clusters_by_the_tables_keys(spark, lake):
    df = numbers(spark, 2000, 10)
    target = build(lake, df, cluster_by=["s"])
    compact(target)
    assert same_rows(target, df)
    (path,) = target.live_files()
    in_file = [r.s for r in spark.read.parquet(f"{target.data_dir}/{path}").collect()]
    assert in_file == sorted(in_file)


def test_zorder_narrows_each_column(spark, lake):
    df = numbers(spark, 20_000, 16)
    target = build(lake, df)

    def span(column):
        state = target.state()
        files = target.scan_state(state).groupBy("_metadata.file_path")
        return files.agg((F.max(column) - F.min(column)).alias("w")).agg(F.avg("w")).first()[0]

    before = span("a")
    zorder(target, ["id", "a"], n_files=16)
    assert same_rows(target, df)
    assert len(target.live_files()) == 16
    assert span("a") < before / 2 and span("id") < 20_000 / 2


def test_zorder_spreads_one_heavy_value(spark, lake):
    df = spark.range(12_000).select(F.when(F.col("id") < 9000, 1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("s"))
    target = build(lake, df)
    zorder(target, ["k", "s"], n_files=8)
    state = target.state()
    largest = target.scan_state(state).groupBy("_metadata.file_path").count().agg(F.max("count"))
    assert largest.first()[0] < 3000
    assert same_rows(target, df)


def test_zorder_of_partitions_and_nulls(spark, lake):
    df = numbers(spark, 1000, 4).withColumn("a", F.when(F.col("a") > 500, F.col("a")))
    target = build(lake, df, partition_by=["s"])
    zorder(target, ["a", "d"], n_files=4)
    assert same_rows(target, df)
    with pytest.raises(ValueError, match="nope"):
        zorder(target, ["nope"])


def test_vacuum_deletes_only_what_nobody_reads(spark, lake):
    df = numbers(spark, 100, 5)
    target = build(lake, df)
    delete_where(target, "id < 30")
    compact(target)
    now = F.current_timestamp()
    candidates, removed = vacuum(target, None, dry_run=True)
    assert candidates.count() == 0 and removed == 0
    later = now + F.expr("INTERVAL '8' DAY")
    stored = stored_files(target).count()
    candidates, _ = vacuum(target, 168, dry_run=True, now=later)
    assert candidates.count() > 0
    assert stored_files(target).count() == stored
    rows = target.read().count()
    _, removed = vacuum(target, 168, now=later)
    assert removed == stored - len(target.live_files()) == stored - stored_files(target).count()
    assert target.read().count() == rows == 70


def test_vacuum_keeps_versions_inside_the_retention(spark, lake):
    target = build(lake, numbers(spark, 100, 5))
    delete_where(target, "id < 30")
    six_days = F.current_timestamp() + F.expr("INTERVAL '6' DAY")
    assert vacuum(target, 168, now=six_days)[1] == 0
    assert target.read(1).count() == 100


@pytest.mark.parametrize("hours", [0, 24, 167])
def test_short_retention_is_refused(spark, lake, hours):
    target = build(lake, numbers(spark, 10, 1))
    with pytest.raises(RetentionTooShort):
        vacuum(target, hours, dry_run=True)


def test_statistics(spark, lake):
    target = build(lake, numbers(spark, 500, 3))
    row = analyze(target, ["id", "s"]).first()
    assert (row.version, row.row_count, row.file_count) == (1, 500, 3)
    assert row.size_bytes == target.file_sizes().agg(F.sum("length")).first()[0]


def test_clustered_write_keeps_keys_together(spark, scratch):
    path = scratch("clustered")
    df = numbers(spark)
    write_clustered(df, path, ["s"])
    back = spark.read.parquet(path)
    assert back.exceptAll(df).count() == 0 and back.count() == 4000
    files_per_key = back.groupBy("s").agg(F.count_distinct("_metadata.file_path").alias("n")).agg(F.max("n")).first()[0]
    assert files_per_key == 1


# -- rules ---------------------------------------------------------------------------------------------------------


def rule(tmc_id, name, flag="I", freq="DAILY", zorder_cols=None, hours=None, group=1, active="Y"):
    return (tmc_id, group, flag, freq, name, zorder_cols, hours, None, active)


def rules_of(spark, *rows):
    return spark.createDataFrame(list(rows), RULES_SCHEMA)


def inventory_of(spark, *names):
    return spark.createDataFrame(
        [tuple(n.split(".")) for n in names], "catalog_name STRING, schema_name STRING, table_name STRING"
    )


def test_exclude_wins_at_any_level(spark):
    inventory = inventory_of(spark, "c.s.t1", "c.s.t2", "c.u.t3")
    rules = rules_of(spark, rule(1, "C"), rule(2, "c.S", "E"), rule(3, "c.s.t1", "I"))
    picked = pick_rule(expand_rules(parse_rules(rules), inventory)).collect()
    assert [r.table_key for r in picked] == ["c.u.t3"]


def test_highest_frequency_wins_and_ties_go_to_the_lowest_id(spark):
    inventory = inventory_of(spark, "c.s.t")
    rules = rules_of(
        spark,
        rule(5, "c.s.t", freq="weekly", zorder_cols=["z"], hours=300),
        rule(4, "c", freq="MONTHLY", hours=200),
        rule(9, "c.s", freq="WEEKLY", hours=400),
        rule(3, "c", freq="MANUAL"),
    )
    (row,) = selected_tables(rules, inventory, F.lit("2024-01-01").cast("date")).collect()
    assert (row.tmc_id, row.freq, row.zorder_cols, row.retention_hours) == (5, "WEEKLY", ["z"], 300)
    assert row.is_due  # a Monday
    plain = pick_rule(expand_rules(parse_rules(rules), inventory)).first()
    assert plain.tmc_id == 5


def test_collapsing_rules_changes_nothing(spark):
    names = [f"c{i % 3}.s{i % 5}.t{i}" for i in range(30)]
    inventory = inventory_of(spark, *names)
    freqs = ["DAILY", "WEEKLY", "MONTHLY", "MANUAL"]
    rows = [rule(100 + i, f"c{i % 3}", freq=freqs[i % 4]) for i in range(12)]
    rows += [rule(200 + i, f"C{i % 3}.s{i % 5}", "E" if i == 4 else "I", freqs[(i + 1) % 4]) for i in range(15)]
    rows += [rule(300 + i, n, "E" if i % 9 == 0 else "I", freqs[i % 4]) for i, n in enumerate(names * 2)]
    rules = rules_of(spark, *rows)
    whole = due(pick_rule(expand_rules(parse_rules(rules), inventory)), F.lit("2024-01-01").cast("date"), "MONDAY", 1)
    short = selected_tables(rules, inventory, F.lit("2024-01-01").cast("date"))
    assert {(r.table_key, r.tmc_id, r.is_due) for r in whole.collect()} == {
        (r.table_key, r.tmc_id, r.is_due) for r in short.collect()
    }


def test_groups_and_inactive_rules(spark):
    inventory = inventory_of(spark, "c.s.t", "c.s.u")
    rules = rules_of(spark, rule(1, "c.s.t", group=1), rule(2, "c.s.u", group=2), rule(3, "c", "E", active="N"))
    today = F.lit("2024-01-02").cast("date")
    assert maintenance_plan(rules, inventory, today).count() == 6
    plan = maintenance_plan(rules, inventory, today, ops=["analyze", "OPTIMIZE"], group_id=2)
    assert [(r.table_key, r.op) for r in plan.orderBy("op_seq").collect()] == [("c.s.u", "OPTIMIZE"), ("c.s.u", "ANALYZE")]
    with pytest.raises(ValueError, match="REINDEX"):
        maintenance_plan(rules, inventory, today, ops=["REINDEX"])


def run(lake, rules, **settings):
    ids = {"job_run_id": "1", "task_run_id": "2", "job_id": "j", "job_name": "care", "task_name": "t"}
    run_maintenance(lake, rules, LOG, ids, dt.date(2024, 1, 2), **settings)
    log = run_summary(lake.read(LOG), "1", "2")
    return {(r.tml_operation, r.tml_table_name): r for r in log.collect()}


def test_run_logs_file_counts_and_failures(spark, lake):
    ensure_tables(lake, [maint_log_spec(LOG)])
    good, bad = build(lake, numbers(spark), "dev.b.good"), build(lake, numbers(spark), "dev.b.bad")
    rules = rules_of(spark, rule(1, "dev.b", hours=24), rule(0, "dev.b.bad", zorder_cols=["none"], hours=200), rule(2, "x"))
    log = run(lake, rules)
    assert log[("OPTIMIZE", "good")].tml_status == "SUCCESS"
    assert log[("OPTIMIZE", "good")].tml_file_count_before == 20 and log[("OPTIMIZE", "good")].tml_file_count_after <= 2
    assert log[("OPTIMIZE", "bad")].tml_status == "FAILED" and "none" in log[("OPTIMIZE", "bad")].tml_error_message
    assert log[("VACUUM", "good")].tml_status == "SKIPPED" and "24 hours" in log[("VACUUM", "good")].tml_error_message
    assert log[("VACUUM", "bad")].tml_status == log[("ANALYZE", "bad")].tml_status == "SUCCESS"
    assert log[("PLAN", None)].tml_status == "FAILED" and log[("PLAN", None)].tml_catalog_name == "x"
    assert all(r.tml_start_ts <= r.tml_end_ts for r in log.values())
    assert good.read().count() == bad.read().count() == 4000


def test_dry_run_changes_nothing(spark, lake):
    ensure_tables(lake, [maint_log_spec(LOG)])
    target = build(lake, numbers(spark), "dev.b.t")
    version = target.latest_version()
    log = run(lake, rules_of(spark, rule(1, "dev.b.t")), dry_run=True)
    assert {k: r.tml_status for k, r in log.items()} == {(op, "t"): "SKIPPED" for op in ("OPTIMIZE", "VACUUM", "ANALYZE")}
    assert target.latest_version() == version and len(target.live_files()) == 20


def test_invalid_names_stop_the_run(spark, lake):
    ensure_tables(lake, [maint_log_spec(LOG)])
    with pytest.raises(InvalidRules, match="a.b.c.d"):
        run(lake, rules_of(spark, rule(1, "a.b.c.d")))
    assert lake.read(LOG).count() == 0


def test_vacuum_removes_dropped_files_of_a_live_folder(spark, lake):
    target = build(lake, numbers(spark, 1000, 10))
    delete_where(target, "id < 5")
    (dropped,) = target.state().dropped
    later = F.current_timestamp() + F.expr("INTERVAL '8' DAY")
    assert [r.entry for r in vacuum(target, 168, dry_run=True, now=later)[0].collect()] == [dropped]
    assert vacuum(target, 168, now=F.current_timestamp())[1] == 0
    assert vacuum(target, 168, now=later)[1] == 1
    assert target.read().count() == 995
    delete_where(target, "id BETWEEN 200 AND 204")
    compact(target)
    assert target.read().count() == 990


def test_compaction_of_a_few_small_files_keeps_the_large_folder(spark, lake):
    target = build(lake, numbers(spark, 20_000, 4))
    folder = target.state().live[0]
    size = target.file_sizes().agg(F.min("length")).first()[0]
    append(numbers(spark, 30, 3), target)
    compact(target, target_bytes=size)
    assert folder in target.state().live and target.read().count() == 20_030


def test_key_ranges_sort_no_rows(spark, lake):
    df = numbers(spark, 400, 4)
    target = build(lake, df, cluster_by=["s", "id"])
    ranges = key_ranges(target, target.state(), ["s", "id"])
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    files = target.scan_state(target.state()).groupBy("_metadata.file_path").agg(F.min(F.struct("s", "id")), F.max(F.struct("s", "id")))
    assert sorted((tuple(r.low), tuple(r.high)) for r in ranges.collect()) == sorted((tuple(r[1]), tuple(r[2])) for r in files.collect())


def test_reclustered_files_are_no_larger_than_a_task_sorts(spark, lake, monkeypatch):
    df = numbers(spark, 4000, 4)
    target = build(lake, df, cluster_by=["s", "id"])
    monkeypatch.setattr("lakeops.operators.upkeep.SORTED_BYTES", target.file_sizes().agg(F.sum("length")).first()[0] // 9)
    recluster(target)
    assert same_rows(target, df) and len(target.live_files()) >= 8 and overlap_depth(target) == 1


def test_buckets_by_binary_search(spark):
    values = [None, "", "a", "b", "bb", "c", "z", "\U0001f600"]
    bounds = ["a", "b", "c"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, n int")
    got = _with_buckets(df, ["v", "n"], {"v": F.lit(bounds), "n": F.lit([3, 5])}, ["x", "y"], 2).collect()
    assert [r.x for r in got] == [0 if v is None else bisect_right(bounds, v) for v in values]
    assert [r.y for r in got] == [bisect_right([3, 5], i) for i in range(len(values))]
