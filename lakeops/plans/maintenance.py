"""Maintenance planning: rules to tables to operations, then running them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import day_of_month, weekday_name
from lakeops.functions.names import table_key, with_name_parts
from lakeops.operators.audit import log_maintenance, maintenance_rows
from lakeops.operators.quality import check_rules
from lakeops.operators.upkeep import (
    DEFAULT_TARGET_BYTES,
    MIN_RETENTION_HOURS,
    RetentionTooShort,
    analyze,
    compact,
    live_file_count,
    stored_files,
    vacuum,
    zorder,
)
from lakeops.sources.control import read_rules
from lakeops.sources.inventory import lake_inventory
from lakeops.sources.snapshot import Lake

# Operations in the order they run on a table, and how frequencies rank.
OPERATIONS = ("OPTIMIZE", "VACUUM", "ANALYZE")
FREQUENCY_RANK = {"DAILY": 3, "WEEKLY": 2, "MONTHLY": 1, "MANUAL": 0}

_KEYS = ("lk_catalog", "lk_schema", "lk_table")


class InvalidRules(ValueError):
    """Active rules carry names that are not 1 to 3 dotted parts."""


def parse_rules(rules: DataFrame, default_hours: int = MIN_RETENTION_HOURS, group_id: int | None = None) -> DataFrame:
    """Active rules with clean text, object type, name parts and a retention."""
    clean = read_rules(rules, group_id).select(
        "tmc_id",
        F.trim("tmc_name").alias("tmc_name"),
        F.upper("tmc_freq").alias("freq"),
        F.upper("tmc_inc_excl_flag").alias("inc_excl"),
        F.col("tmc_opt_zorder_cols").alias("zorder_cols"),
        F.coalesce("tmc_vac_retention_hours", F.lit(default_hours)).alias("retention_hours"),
        F.col("tmc_description").alias("description"),
    )
    return with_name_parts(clean, "tmc_name")


def _lowered(df: DataFrame) -> DataFrame:
    names = ("catalog_name", "schema_name", "table_name")
    return df.select("*", *[F.lower(F.col(n)).alias(k) for n, k in zip(names, _KEYS)])


def expand_rules(parsed: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per rule and table it covers. Names match without case.

    Catalog and schema rules meet the inventory in equi joins; table rules pass through as they are, so a table that
    does not exist is noticed when it is due.
    """
    tables = _lowered(inventory.select("catalog_name", "schema_name", "table_name"))
    rule_names = ("catalog_name", "schema_name", "table_name")
    keyed = _lowered(parsed)
    attributes = [c for c in parsed.columns if c not in (*rule_names, "object_type", "tmc_name")]

    def covered(level: str, keys: Sequence[str]) -> DataFrame:
        of_level = keyed.where(F.col("object_type") == level).select(*keys, *attributes)
        return tables.join(of_level, list(keys)).select(*attributes, *rule_names, F.lit(level).alias("rule_level"))

    direct = keyed.where("object_type = 'TABLE'").select(*attributes, *rule_names, F.lit("TABLE").alias("rule_level"))
    expanded = covered("CATALOG", _KEYS[:1]).unionByName(covered("SCHEMA", _KEYS[:2])).unionByName(direct)
    key = table_key(F.col("catalog_name"), F.col("schema_name"), F.col("table_name"))
    return expanded.withColumn("table_key", key)


def unmatched_rules(parsed: DataFrame, inventory: DataFrame) -> DataFrame:
    """Catalog and schema rules that name nothing in the inventory."""
    tables = _lowered(inventory)
    keyed = _lowered(parsed)

    def missing(level: str, keys: Sequence[str]) -> DataFrame:
        known = tables.select(*keys).distinct()
        return keyed.where(F.col("object_type") == level).join(known, list(keys), "left_anti")

    rest = missing("CATALOG", _KEYS[:1]).select(parsed.columns)
    return rest.unionByName(missing("SCHEMA", _KEYS[:2]).select(parsed.columns))


def _rank(freq: Column) -> Column:
    ranked = F.lit(-1)
    for name, rank in FREQUENCY_RANK.items():
        ranked = F.when(freq == name, rank).otherwise(ranked)
    return ranked


def _best(key: Sequence[str], df: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Per key: the row with the highest frequency rank (lowest rule id on ties) and the include/exclude flags.

    A plain aggregation with map-side combine, so a table or catalog that very many rules name stays one small row
    per task before the shuffle.
    """
    order = F.struct((-_rank(F.col("freq"))).alias("r"), F.col("tmc_id").alias("i"))
    chosen = F.min_by(F.struct(*payload), order).alias("chosen")
    return df.groupBy(*key).agg(
        chosen,
        F.bool_or(F.col("inc_excl") == "E").alias("excluded"),
        F.bool_or(F.col("inc_excl") == "I").alias("included"),
    )


_PICKED = (
    "tmc_id",
    "freq",
    "zorder_cols",
    "retention_hours",
    "description",
    "catalog_name",
    "schema_name",
    "table_name",
)


def drop_excluded(expanded: DataFrame) -> DataFrame:
    """Expanded rows of tables no exclude rule covers, whatever the level of that rule."""
    excluded = expanded.where("inc_excl = 'E'").select("table_key").distinct()
    return expanded.join(excluded, "table_key", "left_anti")


def pick_rule(expanded: DataFrame) -> DataFrame:
    """One row per table that is included and not excluded: the rule with the highest frequency, taken whole."""
    best = _best(["table_key"], expanded, _PICKED)
    return best.where("included AND NOT excluded").select("table_key", "chosen.*")


def collapse_rules(parsed: DataFrame) -> DataFrame:
    """At most one include and one exclude rule per named object.

    Of the include rules with the same object only the highest-ranked can win for any table below it, and one exclude
    rule excludes as well as many. Rules are collapsed before they meet the inventory, so the join gives at most six
    rows per table however many rules repeat a catalog.
    """
    keyed = _lowered(parsed)
    payload = [c for c in parsed.columns if c != "inc_excl"]
    order = F.struct((-_rank(F.col("freq"))).alias("r"), F.col("tmc_id").alias("i"))
    grouped = keyed.groupBy("object_type", "inc_excl", *_KEYS).agg(
        F.min_by(F.struct(*payload), order).alias("chosen")
    )
    return grouped.select("inc_excl", "chosen.*").select(parsed.columns)


def due(plan: DataFrame, run_date: Column, weekly_day: str, monthly_dom: int) -> DataFrame:
    """Add ``is_due``: DAILY always, WEEKLY on the weekday, MONTHLY on the day of month, anything else never."""
    is_due = (
        F.when(F.col("freq") == "DAILY", True)
        .when(F.col("freq") == "WEEKLY", weekday_name(run_date) == weekly_day.upper())
        .when(F.col("freq") == "MONTHLY", day_of_month(run_date) == monthly_dom)
        .otherwise(False)
    )
    return plan.withColumn("is_due", is_due)


def existing_only(targets: DataFrame, inventory: DataFrame) -> DataFrame:
    return _lowered(targets).join(_lowered(inventory).select(*_KEYS).distinct(), list(_KEYS), "left_semi").drop(*_KEYS)


def missing_only(targets: DataFrame, inventory: DataFrame) -> DataFrame:
    return _lowered(targets).join(_lowered(inventory).select(*_KEYS).distinct(), list(_KEYS), "left_anti").drop(*_KEYS)


def selected_tables(
    rules: DataFrame,
    inventory: DataFrame,
    run_date: Column,
    weekly_day: str = "MONDAY",
    monthly_dom: int = 1,
    default_hours: int = MIN_RETENTION_HOURS,
    group_id: int | None = None,
) -> DataFrame:
    """Tables the rules select, with the rule picked and ``is_due``."""
    parsed = collapse_rules(parse_rules(rules, default_hours, group_id))
    return due(pick_rule(expand_rules(parsed, inventory)), run_date, weekly_day, monthly_dom)


def with_operations(tables: DataFrame, ops: Sequence[str] = OPERATIONS) -> DataFrame:
    """One row per table and chosen operation, ``op_seq`` giving the order on a table."""
    chosen = {op.strip().upper() for op in ops}
    unknown = chosen - set(OPERATIONS)
    if unknown:
        raise ValueError(f"unknown operations: {', '.join(sorted(unknown))}")
    steps = [F.struct(F.lit(i).alias("op_seq"), F.lit(op).alias("op")) for i, op in enumerate(OPERATIONS) if op in chosen]
    return tables.select("*", F.inline(F.array(*steps)))


def maintenance_plan(
    rules: DataFrame,
    inventory: DataFrame,
    run_date: Column,
    weekly_day: str = "MONDAY",
    monthly_dom: int = 1,
    default_hours: int = MIN_RETENTION_HOURS,
    ops: Sequence[str] = OPERATIONS,
    group_id: int | None = None,
) -> DataFrame:
    """Operations to run on a date: rules, expansion, exclusion, pick, due, operations."""
    tables = selected_tables(rules, inventory, run_date, weekly_day, monthly_dom, default_hours, group_id)
    return with_operations(tables.where("is_due").drop("is_due"), ops)


def plan_summary(rules: DataFrame, inventory: DataFrame, run_date: Column, **when) -> DataFrame:
    """One row: active_rules, invalid_names, candidate_tables, due_tables."""
    names = ("active_rules", "invalid_names", "candidate_tables", "due_tables")

    def tallied(df: DataFrame, **flags: Column) -> DataFrame:
        return df.select(*[flags.get(name, F.lit(False)).cast("bigint").alias(name) for name in names])

    of_rules = tallied(
        parse_rules(rules), active_rules=F.lit(True), invalid_names=F.col("object_type") == "INVALID"
    )
    of_tables = tallied(
        selected_tables(rules, inventory, run_date, **when), candidate_tables=F.lit(True), due_tables=F.col("is_due")
    )
    return of_rules.unionByName(of_tables).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def plan_events(rules: DataFrame, inventory: DataFrame, due_tables: DataFrame) -> DataFrame:
    """Planning log rows: rules that match nothing (FAILED) and due tables that are gone (SKIPPED)."""
    lost = unmatched_rules(parse_rules(rules), inventory).select(
        F.lit("PLAN").alias("operation"),
        "catalog_name",
        "schema_name",
        F.lit(None).cast("string").alias("table_name"),
        F.lit("FAILED").alias("status"),
        F.concat(F.lower("object_type"), F.lit(" not found")).alias("error_message"),
    )
    gone = missing_only(due_tables, inventory).select(
        F.lit("PLAN").alias("operation"),
        "catalog_name",
        "schema_name",
        "table_name",
        F.lit("SKIPPED").alias("status"),
        F.lit("table does not exist").alias("error_message"),
    )
    return lost.unionByName(gone)


def dry_run_events(plan: DataFrame) -> DataFrame:
    """The log rows a dry run of a plan gives: every operation SKIPPED."""
    short = (F.col("op") == "VACUUM") & (F.col("retention_hours") < MIN_RETENTION_HOURS)
    return plan.select(
        F.col("op").alias("operation"),
        "catalog_name",
        "schema_name",
        "table_name",
        F.lit("SKIPPED").alias("status"),
        F.when(short, _short_retention(F.col("retention_hours"))).otherwise("dry run, nothing executed").alias(
            "error_message"
        ),
    )


def _short_retention(hours: Column) -> Column:
    return F.concat(
        F.lit("retention of "), hours.cast("string"), F.lit(f" hours is below the minimum of {MIN_RETENTION_HOURS}")
    )


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _run_operation(lake: Lake, step, target_bytes: int) -> tuple:
    """Run one operation on one table; the log event tells how it went."""
    name = f"{step.catalog_name}.{step.schema_name}.{step.table_name}"
    start, status, message, before, after = _now(), "SUCCESS", "", 0, 0
    try:
        table = lake.table(name)
        if step.op == "OPTIMIZE":
            done = zorder(table, step.zorder_cols, target_bytes=target_bytes) if step.zorder_cols else compact(
                table, target_bytes
            )
            before, after = done.metrics["numFilesBefore"], done.metrics["numFilesAfter"]
        elif step.op == "VACUUM":
            before = stored_files(table).count()
            _, removed = vacuum(table, step.retention_hours)
            after = before - removed
        else:
            analyze(table)
            before = after = live_file_count(table)
    except RetentionTooShort as short:
        status, message = "SKIPPED", str(short)
    except Exception as error:  # one broken table must not stop the others
        status, message = "FAILED", f"{type(error).__name__}: {error}"
    return (
        step.op,
        step.catalog_name,
        step.schema_name,
        step.table_name,
        status,
        message,
        start,
        _now(),
        before,
        after,
    )


def run_maintenance(
    lake: Lake,
    rules: DataFrame,
    log_table: str,
    run: dict[str, str],
    run_date: dt.date,
    weekly_day: str = "MONDAY",
    monthly_dom: int = 1,
    default_hours: int = MIN_RETENTION_HOURS,
    ops: Sequence[str] = OPERATIONS,
    dry_run: bool = False,
    group_id: int | None = None,
    target_bytes: int = DEFAULT_TARGET_BYTES,
    parallel_tables: int = 1,
) -> DataFrame:
    """Plan and run maintenance on the lake; returns the log events, which are also appended to the log table.

    Invalid rule names stop the run. A failing table is logged and the rest go on. Only the list of due operations is
    collected; the work on each table is Spark jobs.
    """
    bad = [row.tmc_name for row in check_rules(rules).select("tmc_name").collect()]
    if bad:
        raise InvalidRules(f"rule names must be catalog, catalog.schema or catalog.schema.table: {bad}")
    spark = lake.spark
    inventory = lake_inventory(lake)
    today = F.lit(run_date).cast("date")
    tables = selected_tables(rules, inventory, today, weekly_day, monthly_dom, default_hours, group_id)
    due_tables = tables.where("is_due").drop("is_due")
    stamp = _now()
    planning = plan_events(rules if group_id is None else read_rules(rules, group_id), inventory, due_tables)
    plan = with_operations(existing_only(due_tables, inventory), ops)
    untimed = planning.unionByName(dry_run_events(plan)) if dry_run else planning
    events = untimed.select(
        "*",
        F.lit(stamp).alias("start_ts"),
        F.lit(stamp).alias("end_ts"),
        F.lit(0).alias("file_count_before"),
        F.lit(0).alias("file_count_after"),
    )
    if not dry_run:
        by_table: dict[str, list] = {}
        for step in plan.orderBy("table_key", "op_seq").collect():
            by_table.setdefault(step.table_key, []).append(step)

        def look_after(item) -> list[tuple]:
            return [_run_operation(lake, step, target_bytes) for step in item[1]]

        with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
            done = [event for group in pool.map(look_after, by_table.items()) for event in group]
        events = events.unionByName(maintenance_rows(spark, done))
    log_maintenance(lake, log_table, events, run)
    return events
