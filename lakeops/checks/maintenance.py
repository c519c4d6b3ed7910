"""Checks of maintenance planning and of the operations on tables.

The inventory is one table per customer with a balance (catalog = region, schema = nation). Rules stand on all three
levels; customers without a balance are tables that rules name but that do not exist.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import functions as F

from lakeops.checks.registry import check, new_lake, table
from lakeops.checks.tables import made
from lakeops.operators.changes import delete_where
from lakeops.operators.upkeep import (
    analyze,
    analyze_files,
    column_stats,
    compact,
    files_by_probe,
    overlap_depth,
    recluster,
    stored_files,
    vacuum,
    vacuum_candidates,
    zorder,
)
from lakeops.operators.writes import append, ensure_tables, overwrite
from lakeops.plans.maintenance import (
    drop_excluded,
    dry_run_events,
    due,
    existing_only,
    expand_rules,
    maintenance_plan,
    missing_only,
    parse_rules,
    pick_rule,
    plan_events,
    plan_summary,
    run_maintenance,
    selected_tables,
)
from lakeops.sources.control import RULES_SCHEMA, maint_log_spec

RUN_DATE = "2024-01-01"  # a Monday
WHEN = {"weekly_day": "monday", "monthly_dom": 2}


def _run_date():
    return F.lit(RUN_DATE).cast("date")


def places(spark, sf):
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def customer_inventory(spark, sf):
    return places(spark, sf).where("c_acctbal >= 0").select(
        F.lower("r_name").alias("catalog_name"),
        F.lower("n_name").alias("schema_name"),
        F.lower(F.translate("c_name", "#", "_")).alias("table_name"),
    )


def maintenance_rules(spark, sf):
    """Catalog rules from region, schema rules from nation, table rules from customer."""
    region_key, nation_key, segment = F.col("r_regionkey"), F.col("n_nationkey"), F.col("c_mktsegment")
    none = F.lit(None)

    def rule(tmc_id, group, flag, freq, name, zorder_cols, hours, active):
        return [
            tmc_id.cast("bigint").alias("tmc_id"),
            group.cast("int").alias("tmc_group_id"),
            flag.alias("tmc_inc_excl_flag"),
            freq.alias("tmc_freq"),
            name.alias("tmc_name"),
            zorder_cols.cast("array<string>").alias("tmc_opt_zorder_cols"),
            hours.cast("int").alias("tmc_vac_retention_hours"),
            none.cast("string").alias("tmc_description"),
            active.alias("tmc_active_flag"),
        ]

    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == region_key)
    catalogs = table(spark, sf, "region").select(
        *rule(
            region_key,
            none,
            F.lit("i"),
            F.element_at(F.array(*[F.lit(x) for x in ("DAILY", "weekly", "MONTHLY", "MANUAL", "WEEKLY")]), region_key + 1),
            F.concat(F.lit(" "), "r_name", F.when(region_key == 4, "_OLD").otherwise(" ")),
            none,
            none,
            F.lit("Y"),
        )
    )
    schemas = nations.select(
        *rule(
            nation_key + 100,
            nation_key,
            F.when(nation_key.isin(3, 7, 11), "E").otherwise("I"),
            F.element_at(F.array(*[F.lit(x) for x in ("DAILY", "WEEKLY", "MONTHLY", "MANUAL")]), nation_key % 4 + 1),
            F.concat_ws(".", "r_name", "n_name"),
            none,
            F.lit(200),
            F.when(nation_key == 20, "N").otherwise("Y"),
        )
    )
    freq = (
        F.when(segment == "BUILDING", "DAILY")
        .when(segment == "AUTOMOBILE", "WEEKLY")
        .when(segment == "MACHINERY", "MONTHLY")
        .otherwise("MANUAL")
    )
    tables = places(spark, sf).select(
        *rule(
            F.col("c_custkey") + 1000,
            nation_key,
            F.when(segment == "HOUSEHOLD", "E").otherwise("I"),
            freq,
            F.concat_ws(".", "r_name", "n_name", F.translate("c_name", "#", "_")),
            F.when(F.col("c_acctbal") > 5000, F.array(F.lit("c_custkey"))),
            F.when(F.col("c_acctbal") < 1000, 24).when(F.col("c_acctbal") > 2000, 336),
            F.when(F.col("c_acctbal") > 9000, "N").otherwise("Y"),
        )
    )
    return catalogs.unionByName(schemas).unionByName(tables)


_CTES = """places AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey),
  inventory AS (SELECT lower(r_name) AS catalog_name, lower(n_name) AS schema_name,
    lower(replace(c_name, '#', '_')) AS table_name FROM places WHERE c_acctbal >= 0),
  rules AS (
    SELECT CAST(r_regionkey AS BIGINT) AS tmc_id, 'CATALOG' AS object_type, 'I' AS inc_excl,
      CASE r_regionkey WHEN 0 THEN 'DAILY' WHEN 1 THEN 'WEEKLY' WHEN 2 THEN 'MONTHLY' WHEN 3 THEN 'MANUAL'
        ELSE 'WEEKLY' END AS freq,
      CASE WHEN r_regionkey = 4 THEN r_name || '_OLD' ELSE r_name END AS cat, CAST(NULL AS VARCHAR) AS sch,
      CAST(NULL AS VARCHAR) AS tab, 168 AS retention_hours, FALSE AS has_zorder FROM region
    UNION ALL
    SELECT n_nationkey + 100, 'SCHEMA', CASE WHEN n_nationkey IN (3, 7, 11) THEN 'E' ELSE 'I' END,
      CASE n_nationkey % 4 WHEN 0 THEN 'DAILY' WHEN 1 THEN 'WEEKLY' WHEN 2 THEN 'MONTHLY' ELSE 'MANUAL' END,
      r_name, n_name, NULL, 200, FALSE
      FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 20
    UNION ALL
    SELECT c_custkey + 1000, 'TABLE', CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'E' ELSE 'I' END,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'DAILY' WHEN 'AUTOMOBILE' THEN 'WEEKLY' WHEN 'MACHINERY' THEN 'MONTHLY'
        ELSE 'MANUAL' END, r_name, n_name, replace(c_name, '#', '_'),
      CASE WHEN c_acctbal < 1000 THEN 24 WHEN c_acctbal > 2000 THEN 336 ELSE 168 END, c_acctbal > 5000
      FROM places WHERE c_acctbal <= 9000),
  expanded AS (
    SELECT tmc_id, object_type AS rule_level, inc_excl, freq, retention_hours, has_zorder, catalog_name, schema_name,
      table_name FROM rules JOIN inventory ON object_type = 'CATALOG' AND lower(cat) = catalog_name
    UNION ALL
    SELECT tmc_id, object_type, inc_excl, freq, retention_hours, has_zorder, catalog_name, schema_name, table_name
      FROM rules JOIN inventory ON object_type = 'SCHEMA' AND lower(cat) = catalog_name AND lower(sch) = schema_name
    UNION ALL
    SELECT tmc_id, object_type, inc_excl, freq, retention_hours, has_zorder, cat, sch, tab FROM rules
      WHERE object_type = 'TABLE'),
  keyed AS (SELECT *, lower(catalog_name || '.' || schema_name || '.' || table_name) AS table_key,
    CASE freq WHEN 'DAILY' THEN 3 WHEN 'WEEKLY' THEN 2 WHEN 'MONTHLY' THEN 1 ELSE 0 END AS freq_rank FROM expanded),
  kept AS (SELECT * FROM keyed WHERE table_key NOT IN (SELECT table_key FROM keyed WHERE inc_excl = 'E')),
  picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_key ORDER BY freq_rank DESC, tmc_id)
    AS place FROM kept) WHERE place = 1),
  dues AS (SELECT *, CASE WHEN freq = 'DAILY' THEN TRUE
    WHEN freq = 'WEEKLY' THEN upper(dayname(DATE '2024-01-01')) = 'MONDAY'
    WHEN freq = 'MONTHLY' THEN day(DATE '2024-01-01') = 2 ELSE FALSE END AS is_due FROM picked),
  known AS (SELECT catalog_name || '.' || schema_name || '.' || table_name AS table_key FROM inventory)"""


def _sql(select):
    return f"WITH {_CTES} {select}"


@check("maint_expand", _sql("SELECT tmc_id, rule_level, inc_excl, freq, table_key FROM keyed"))
def maint_expand(spark, sf):
    expanded = expand_rules(parse_rules(maintenance_rules(spark, sf)), customer_inventory(spark, sf))
    return expanded.select("tmc_id", "rule_level", "inc_excl", "freq", "table_key")


@check("maint_exclude", _sql("SELECT tmc_id, rule_level, freq, table_key FROM kept"))
def maint_exclude(spark, sf):
    expanded = expand_rules(parse_rules(maintenance_rules(spark, sf)), customer_inventory(spark, sf))
    return drop_excluded(expanded).select("tmc_id", "rule_level", "freq", "table_key")


@check("maint_pick", _sql("SELECT table_key, tmc_id, freq, retention_hours, has_zorder FROM picked"))
def maint_pick(spark, sf):
    expanded = expand_rules(parse_rules(maintenance_rules(spark, sf)), customer_inventory(spark, sf))
    return pick_rule(expanded).select(
        "table_key", "tmc_id", "freq", "retention_hours", F.col("zorder_cols").isNotNull().alias("has_zorder")
    )


@check("maint_due", _sql("SELECT table_key, freq, is_due FROM dues"))
def maint_due(spark, sf):
    expanded = expand_rules(parse_rules(maintenance_rules(spark, sf)), customer_inventory(spark, sf))
    return due(pick_rule(expanded), _run_date(), "MONDAY", 2).select("table_key", "freq", "is_due")


@check(
    "maint_exists",
    _sql("""SELECT 'there' AS side, table_key FROM dues WHERE is_due AND table_key IN (SELECT table_key FROM known)
    UNION ALL SELECT 'gone', table_key FROM dues WHERE is_due AND table_key NOT IN (SELECT table_key FROM known)"""),
)
def maint_exists(spark, sf):
    inventory = customer_inventory(spark, sf)
    tables = selected_tables(maintenance_rules(spark, sf), inventory, _run_date(), **WHEN).where("is_due")
    there = existing_only(tables, inventory).select(F.lit("there").alias("side"), "table_key")
    return there.unionByName(missing_only(tables, inventory).select(F.lit("gone").alias("side"), "table_key"))


@check(
    "maint_plan",
    _sql("""SELECT table_key, tmc_id, freq, retention_hours, has_zorder, op, op_seq FROM dues,
    (VALUES (0, 'OPTIMIZE'), (1, 'VACUUM'), (2, 'ANALYZE')) o(op_seq, op) WHERE is_due"""),
)
def maint_plan(spark, sf):
    plan = maintenance_plan(maintenance_rules(spark, sf), customer_inventory(spark, sf), _run_date(), **WHEN)
    return plan.select(
        "table_key",
        "tmc_id",
        "freq",
        "retention_hours",
        F.col("zorder_cols").isNotNull().alias("has_zorder"),
        "op",
        "op_seq",
    )


@check(
    "plan_counts",
    _sql("""SELECT (SELECT count(*) FROM rules) AS active_rules, CAST(0 AS BIGINT) AS invalid_names,
    (SELECT count(*) FROM dues) AS candidate_tables, (SELECT CAST(count_if(is_due) AS BIGINT) FROM dues) AS due_tables"""),
)
def plan_counts(spark, sf):
    return plan_summary(maintenance_rules(spark, sf), customer_inventory(spark, sf), _run_date(), **WHEN)


@check(
    "maint_plan_events",
    _sql("""SELECT 'FAILED' AS status, lower(cat) AS catalog_name, lower(sch) AS schema_name,
      CAST(NULL AS VARCHAR) AS table_name FROM rules r WHERE object_type = 'CATALOG'
      AND NOT EXISTS (SELECT 1 FROM inventory i WHERE i.catalog_name = lower(r.cat))
    UNION ALL SELECT 'FAILED', lower(cat), lower(sch), NULL FROM rules r WHERE object_type = 'SCHEMA' AND NOT EXISTS
      (SELECT 1 FROM inventory i WHERE i.catalog_name = lower(r.cat) AND i.schema_name = lower(r.sch))
    UNION ALL SELECT 'SKIPPED', lower(catalog_name), lower(schema_name), lower(table_name) FROM dues
      WHERE is_due AND table_key NOT IN (SELECT table_key FROM known)"""),
)
def maint_plan_events(spark, sf):
    rules, inventory = maintenance_rules(spark, sf), customer_inventory(spark, sf)
    tables = selected_tables(rules, inventory, _run_date(), **WHEN).where("is_due")
    names = [F.lower(c).alias(c) for c in ("catalog_name", "schema_name", "table_name")]
    return plan_events(rules, inventory, tables).select("status", *names)


@check(
    "maint_dry_run",
    _sql("""SELECT op AS operation, table_key, 'SKIPPED' AS status, CASE WHEN op = 'VACUUM' AND retention_hours < 168
      THEN 'retention of ' || retention_hours || ' hours is below the minimum of 168'
      ELSE 'dry run, nothing executed' END AS error_message
    FROM dues, (VALUES ('OPTIMIZE'), ('VACUUM'), ('ANALYZE')) o(op) WHERE is_due"""),
)
def maint_dry_run(spark, sf):
    plan = maintenance_plan(maintenance_rules(spark, sf), customer_inventory(spark, sf), _run_date(), **WHEN)
    key = F.lower(F.concat_ws(".", "catalog_name", "schema_name", "table_name"))
    return dry_run_events(plan).select("operation", key.alias("table_key"), "status", "error_message")


# -- running on tables ---------------------------------------------------------------------------------------------


@check(
    "maint_run_log",
    """WITH tables AS (SELECT DISTINCT lower(c_mktsegment) AS name FROM customer)
    SELECT 'OPTIMIZE' AS operation, name AS table_name, CASE name WHEN 'machinery' THEN 'FAILED' ELSE 'SUCCESS' END
      AS status FROM tables WHERE name <> 'household'
    UNION ALL SELECT 'VACUUM', name, CASE name WHEN 'building' THEN 'SKIPPED' ELSE 'SUCCESS' END FROM tables
      WHERE name <> 'household'
    UNION ALL SELECT 'ANALYZE', name, 'SUCCESS' FROM tables WHERE name <> 'household'
    UNION ALL SELECT 'PLAN', 'gone', 'SKIPPED'
    UNION ALL SELECT 'PLAN', NULL, 'FAILED'""",
)
def maint_run_log(spark, sf):
    lake = new_lake(spark, "care")
    customers = table(spark, sf, "customer")
    for (segment,) in customers.select("c_mktsegment").distinct().collect():
        append(customers.where(F.col("c_mktsegment") == segment), made(lake, f"dev.bronze.{segment}", customers))
    ensure_tables(lake, [maint_log_spec("ops.meta.maint_logs")])
    rules = [
        (1, 1, "I", "DAILY", "dev.bronze", None, None, None, "Y"),
        (2, 1, "E", "DAILY", "dev.bronze.household", None, None, None, "Y"),
        (0, 1, "I", "DAILY", "dev.bronze.building", ["c_custkey", "c_acctbal"], 24, None, "Y"),
        (0, 1, "I", "DAILY", "dev.bronze.machinery", ["no_such_column"], 200, None, "Y"),
        (3, 1, "I", "DAILY", "dev.bronze.gone", None, None, None, "Y"),
        (4, 1, "I", "DAILY", "lost", None, None, None, "Y"),
        (5, 1, "I", "MONTHLY", "ops.meta", None, None, None, "Y"),
    ]
    run = {"job_run_id": "11", "task_run_id": "12", "job_id": "1", "job_name": "care", "task_name": "tables"}
    run_maintenance(
        lake,
        spark.createDataFrame(rules, RULES_SCHEMA),
        "ops.meta.maint_logs",
        run,
        dt.date(2024, 1, 2),
        parallel_tables=4,
    )
    log = lake.read("ops.meta.maint_logs")
    return log.select(
        F.col("tml_operation").alias("operation"),
        F.col("tml_table_name").alias("table_name"),
        F.col("tml_status").alias("status"),
    )


def _spread_lines(spark, sf, label):
    """A lineitem table of many small files."""
    lines = table(spark, sf, "lineitem")
    target = made(new_lake(spark, label), "dev.bronze.lineitem", lines)
    append(lines.repartition(24), target)
    append(lines.where("l_quantity > 40"), target)
    return target


@check("compact", "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_quantity > 40")
def compacted(spark, sf):
    target = _spread_lines(spark, sf, "compact")
    done = compact(target)
    if not done.metrics["numFilesAfter"] < done.metrics["numFilesBefore"]:
        raise AssertionError(f"files did not become fewer: {done.metrics}")
    return target.read()


@check("zorder", "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_quantity > 40")
def z_ordered(spark, sf):
    target = _spread_lines(spark, sf, "zorder")
    zorder(target, ["l_partkey", "l_shipdate", "l_returnflag"], n_files=8)
    return target.read()


@check(
    "compact_partitioned",
    """SELECT p_brand, count(*) AS part_count, CAST(1 AS BIGINT) AS files FROM part GROUP BY p_brand""",
)
def compacted_partitions(spark, sf):
    parts = table(spark, sf, "part")
    target = made(new_lake(spark, "compact-part"), "dev.bronze.part", parts, partition_by=["p_brand"])
    for half in ("p_size <= 25", "p_size > 25"):
        append(parts.where(half), target)
    compact(target)
    state = target.state()
    scan = target.scan_state(state)
    return scan.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("part_count"), F.count_distinct("_metadata.file_path").alias("files")
    )


@check(
    "vacuum_candidates",
    """WITH o AS (SELECT *, CAST((year(o_orderdate) - 1990) * 12 + month(o_orderdate) AS BIGINT) AS v FROM orders),
      log AS (SELECT v, max(o_orderdate) AS committed_at, max(o_orderkey) AS carried FROM o GROUP BY v),
      retained AS (SELECT * FROM log WHERE committed_at > TIMESTAMP '1998-06-15'
                   OR v = (SELECT max(v) FROM log WHERE committed_at <= TIMESTAMP '1998-06-15'))
    SELECT 'lk_commit=' || v || '/part-' || o_orderkey AS entry, o_orderkey AS length FROM o
    WHERE o_orderdate < TIMESTAMP '1998-06-15' AND (v NOT IN (SELECT v FROM retained)
        OR (v % 12 > 6 AND o_orderkey = (SELECT carried FROM log l WHERE l.v = o.v)))
      AND NOT EXISTS (SELECT 1 FROM retained r WHERE r.v = o.v + 1 AND o.o_orderkey =
                      (SELECT carried FROM log l WHERE l.v = o.v))""",
)
def vacuum_listing(spark, sf):
    # Every order is a file of the commit of its month; a commit also keeps one file of the commit before it.
    version = ((F.year("o_orderdate") - 1990) * 12 + F.month("o_orderdate")).cast("bigint")
    orders = table(spark, sf, "orders").withColumn("v", version)
    files = orders.select(
        F.format_string("lk_commit=%d/part-%d", "v", "o_orderkey").alias("entry"),
        F.col("o_orderkey").alias("length"),
        F.col("o_orderdate").cast("timestamp").alias("modified"),
    )
    months = orders.groupBy("v").agg(
        F.max("o_orderdate").cast("timestamp").alias("committed_at"), F.max("o_orderkey").alias("carried")
    )
    before = months.select((F.col("v") + 1).alias("v"), F.col("carried").alias("carried_before"))
    kept_file = F.format_string("lk_commit=%d/part-%d", F.col("v") - 1, "carried_before")
    log = months.join(before, "v", "left").select(
        F.col("v").alias("version"),
        "committed_at",
        F.array_compact(
            F.array(F.format_string("lk_commit=%d", "v"), F.when(F.col("carried_before").isNotNull(), kept_file))
        ).alias("live"),
        # From the second half of a year on, a commit has dropped its own carried file.
        F.when(F.col("v") % 12 > 6, F.array(F.format_string("lk_commit=%d/part-%d", "v", "carried")))
        .otherwise(F.array().cast("array<string>"))
        .alias("dropped"),
    )
    return vacuum_candidates(files, log, F.lit("1998-06-15").cast("timestamp")).select("entry", "length")


@check(
    "column_stats",
    """SELECT column_name, row_count, null_count, min_value, max_value FROM (
      SELECT 'l_orderkey' AS column_name, count(*) AS row_count, CAST(count_if(l_orderkey IS NULL) AS BIGINT) AS null_count,
        CAST(min(l_orderkey) AS VARCHAR) AS min_value, CAST(max(l_orderkey) AS VARCHAR) AS max_value FROM lineitem
      UNION ALL SELECT 'l_returnflag', count(*), CAST(count_if(l_returnflag = 'A') AS BIGINT),
        min(CASE WHEN l_returnflag <> 'A' THEN l_returnflag END), max(l_returnflag) FROM lineitem
      UNION ALL SELECT 'l_linenumber', count(*), 0, CAST(min(l_linenumber) AS VARCHAR),
        CAST(max(l_linenumber) AS VARCHAR) FROM lineitem)""",
)
def statistics(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("A")))
    return column_stats(lines, ["l_orderkey", "l_returnflag", "l_linenumber"]).drop("distinct_approx")


@check(
    "time_travel",
    """SELECT 'first' AS at, s_suppkey, s_acctbal FROM supplier
    UNION ALL SELECT 'second', s_suppkey, s_acctbal * 2 FROM supplier WHERE s_acctbal > 0""",
)
def time_travel(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    target = made(new_lake(spark, "travel"), "dev.bronze.supplier", suppliers)
    first = append(suppliers, target).version
    doubled = suppliers.where("s_acctbal > 0").withColumn("s_acctbal", F.col("s_acctbal") * 2)
    second = overwrite(doubled, target).version
    append(suppliers, target)
    at_first = target.read(first).select(F.lit("first").alias("at"), "s_suppkey", "s_acctbal")
    return at_first.unionByName(target.read(second).select(F.lit("second").alias("at"), "s_suppkey", "s_acctbal"))


# -- layouts that a plain copy does not have -----------------------------------------------------------------------

_PROBES = [
    ("low dates", "d", "2024-01-01", "2024-01-03"),
    ("one date", "d", "2024-01-20", "2024-01-20"),
    ("last dates", "d", "2024-01-28", "2024-02-28"),
    ("low keys", "k", "a long prefix that all keys share / 0", "a long prefix that all keys share / 1"),
    ("high keys", "k", "a long prefix that all keys share / 8", "a long prefix that all keys share / 9"),
]


@check(
    "zorder_probes",
    f"""WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS d,
                'a long prefix that all keys share / ' || CAST(event_id % 10 AS VARCHAR) || ' / ' || CAST(user_id AS VARCHAR) AS k FROM events),
      p(probe, col, low, high) AS (VALUES {", ".join(str(p) for p in _PROBES)})
    SELECT files, probe, (SELECT count(*) FROM e WHERE CASE col WHEN 'd' THEN d ELSE k END BETWEEN low AND high) AS row_count,
      TRUE AS skips_half, TRUE AS idle FROM p, (VALUES (40), (2100)) f(files)""",
)
def zorder_probes(spark, sf):
    """Z-order by text keys with a long common prefix, in few files and in more than 2,000: files that probes of each column meet."""
    events = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("d"),
        F.concat(F.lit("a long prefix that all keys share / "), F.col("event_id") % 10, F.lit(" / "), F.col("user_id")).alias("k"),
        "event_id",
    )
    out = None
    for files in (40, 2100):
        target = made(new_lake(spark, f"probes-{files}"), "dev.bronze.events", events)
        append(events.repartition(6), target)
        first = zorder(target, ["d", "k"], n_files=files)
        again = zorder(target, ["d", "k"], n_files=files)
        found = files_by_probe(target, _PROBES).select(
            F.lit(files).alias("files"), "probe", "row_count", (F.col("files_hit") * 2 <= F.col("files")).alias("skips_half")
        )
        found = found.withColumn("idle", F.lit(again.version == first.version))
        out = found if out is None else out.unionByName(found)
    return out


@check(
    "compact_idle",
    """WITH b AS (SELECT p_brand, count(*) AS part_count FROM part GROUP BY p_brand)
    SELECT b.*, CAST(1 AS BIGINT) AS files, CAST(1 AS BIGINT) AS versions_first, CAST(0 AS BIGINT) AS versions_second FROM b""",
)
def compact_idle(spark, sf):
    """Many small files per partition become one; partitions of one small file, and the table at rest, are left alone."""
    parts = table(spark, sf, "part")
    target = made(new_lake(spark, "compact-idle"), "dev.bronze.part", parts, partition_by=["p_brand"])
    append(parts.where("p_brand <= 'Brand#3'"), target)
    for low, high in ((0, 20), (21, 35), (36, 50)):
        append(parts.where(f"p_brand > 'Brand#3' AND p_size BETWEEN {low} AND {high}"), target)
    alone = {e for e in target.live_files() if _brand(e) <= "Brand#3"}
    start = target.latest_version()
    first = compact(target)
    second = compact(target)
    if not alone <= set(target.live_files()):
        raise AssertionError("partitions of one file were rewritten")
    state = target.state()
    files = target.scan_state(state).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("part_count"), F.count_distinct("_metadata.file_path").alias("files")
    )
    versions = {"versions_first": first.version - start, "versions_second": second.version - first.version}
    return files.select("*", *[F.lit(v).cast("bigint").alias(n) for n, v in versions.items()])


def _brand(entry):
    return unquote(unquote(entry.split("/")[1])).split("=", 1)[1]


@check(
    "clustered_overlap",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, TRUE AS deep_before, CAST(1 AS BIGINT) AS depth_after,
      CAST(1 AS BIGINT) AS depth_at_end, CAST(0 AS BIGINT) AS versions_at_rest, TRUE AS others_kept FROM lineitem""",
)
def clustered_overlap(spark, sf):
    """Files with overlapping key ranges are rewritten by range, and only these: depth of overlap before and after, and again after
    an append that overlaps a part of the keys."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    target = made(new_lake(spark, "overlap"), "dev.bronze.lineitem", lines, cluster_by=["l_shipdate", "l_orderkey"])
    ends = lines.agg(F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high")).first()
    late = F.col("l_shipdate") > F.lit(ends["low"] + (ends["high"] - ends["low"]) * 0.8)
    append(lines.where(~late).repartition(5), target)
    append(lines.where(late & (F.col("l_linenumber") < 4)).repartition(3), target)
    before = overlap_depth(target)
    recluster(target, target_bytes=target.file_sizes().agg(F.max("length")).first()[0] // 2)
    after = overlap_depth(target)
    state = target.state()
    early = {r.entry for r in target.scan_state(state).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.max(late).alias("l")).where("NOT l").select(F.substring_index("f", "/data/", -1).alias("entry")).collect()}
    append(lines.where(late & (F.col("l_linenumber") >= 4)), target)
    second = recluster(target, target_bytes=1 << 20)
    third = recluster(target)
    kept = early <= set(target.live_files())
    facts = {"deep_before": F.lit(before > 4), "others_kept": F.lit(kept and bool(early))}
    numbers = {"depth_after": after, "depth_at_end": overlap_depth(target), "versions_at_rest": third.version - second.version}
    facts |= {n: F.lit(v).cast("bigint") for n, v in numbers.items()}
    return target.read().select("*", *[v.alias(n) for n, v in facts.items()])


@check(
    "vacuum_run",
    """SELECT customer.*, TRUE AS deleted_some, CAST(0 AS BIGINT) AS left_over, TRUE AS old_version_gone
    FROM customer WHERE c_acctbal >= 0 OR c_acctbal IS NULL""",
)
def vacuum_run(spark, sf):
    """A vacuum that deletes: the table reads as before, files of old versions only are gone, and a second run finds none."""
    customers = table(spark, sf, "customer")
    target = made(new_lake(spark, "vacuum-run"), "dev.bronze.customer", customers)
    append(customers.repartition(6), target)
    delete_where(target, "c_acctbal < 0")
    compact(target)
    later = F.current_timestamp() + F.expr("INTERVAL '9' DAY")
    _, deleted = vacuum(target, 168, now=later)
    _, again = vacuum(target, 168, now=later)
    stored, live = stored_files(target).select("entry"), target.file_sizes().select("entry")
    left = stored.exceptAll(live).count()
    try:
        gone = target.read(1).count() < 0
    except Exception:
        gone = True
    facts = {"deleted_some": F.lit(deleted >= 6 and again == 0), "left_over": F.lit(left).cast("bigint"), "old_version_gone": F.lit(gone)}
    return target.read().select("*", *[v.alias(n) for n, v in facts.items()])


@check(
    "analyze_run",
    """WITH o AS (SELECT * FROM orders WHERE o_orderkey % 5 <> 3),
      s AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS dc, count(DISTINCT o_orderpriority) AS dp, median(o_totalprice) AS m FROM o)
    SELECT 'o_custkey' AS column_name, n AS row_count, CAST(0 AS BIGINT) AS null_count, (SELECT CAST(min(o_custkey) AS VARCHAR) FROM o) AS min_value,
      (SELECT CAST(max(o_custkey) AS VARCHAR) FROM o) AS max_value, TRUE AS distinct_near, TRUE AS median_near, CAST(2 AS BIGINT) AS files_read, n AS table_rows FROM s
    UNION ALL SELECT 'o_orderpriority', n, (SELECT count(*) FROM o WHERE o_orderkey % 11 = 0), (SELECT min(o_orderpriority) FROM o WHERE o_orderkey % 11 <> 0),
      (SELECT max(o_orderpriority) FROM o WHERE o_orderkey % 11 <> 0), TRUE, TRUE, 2, n FROM s
    UNION ALL SELECT 'o_orderkey', n, 0, (SELECT CAST(min(o_orderkey) AS VARCHAR) FROM o), (SELECT CAST(max(o_orderkey) AS VARCHAR) FROM o), TRUE, TRUE, 2, n FROM s""",
)
def analyze_run(spark, sf):
    """Column statistics merged from sketches per file: after two files more, and a deletion that rewrites some, only new files are read."""
    orders = table(spark, sf, "orders").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")))
    target = made(new_lake(spark, "analyze-run"), "dev.bronze.orders", orders)
    cols = ["o_custkey", "o_orderpriority", "o_orderkey"]
    key = F.col("o_orderkey")
    append(orders.where(key % 5 < 2).repartition(5), target)
    _, first = analyze_files(target, cols)
    append(orders.where(key % 5 == 3).coalesce(1), target)
    append(orders.where(key % 5 == 2).coalesce(1), target)
    _, second = analyze_files(target, cols)
    append(orders.where(key % 5 == 4).coalesce(1), target)
    delete_where(target, "o_orderkey % 5 = 3")
    third, again = analyze_files(target, cols)
    if (first, again) != (5, 1):
        raise AssertionError(f"{first} and {again} files were read")
    exact = target.read().agg(
        *[F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(cols)],
        *[F.percentile(c, F.array(F.lit(0.45), F.lit(0.55))).alias(f"q{i}") for i, c in ((0, "o_custkey"), (2, "o_orderkey"))],
    ).first()
    near = {c: (exact[f"d{i}"], exact[f"q{i}"] if i != 1 else None) for i, c in enumerate(cols)}
    distinct_near, median_near = F.lit(True), F.lit(True)
    for c, (d, q) in near.items():
        mine = F.col("column_name") == c
        distinct_near = F.when(mine, F.abs(F.col("distinct_approx") - d) <= 0.08 * d + 1).otherwise(distinct_near)
        if q:
            median_near = F.when(mine, F.col("median_approx").between(q[0], q[1])).otherwise(median_near)
    table_rows = analyze(target).first()["row_count"]
    return third.select(
        "column_name", "row_count", "null_count", "min_value", "max_value", distinct_near.alias("distinct_near"), median_near.alias("median_near"),
        F.lit(second).cast("bigint").alias("files_read"), F.lit(table_rows).cast("bigint").alias("table_rows"),
    )
