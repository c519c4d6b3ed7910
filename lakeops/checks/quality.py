"""Checks of data-quality rules, ids, audit logs and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.checks.registry import check, new_lake, table
from lakeops.operators.audit import load_report, load_status_rows, maintenance_log_rows, run_summary
from lakeops.operators.changes import delete_where
from lakeops.operators.quality import (
    append_gated,
    assign_ids,
    check_rules,
    check_steps,
    duplicate_keys,
    gate,
    in_set,
    not_null,
    sql_check,
    violation_counts,
    violations,
)
from lakeops.operators.writes import TableSpec, append, ensure_tables
from lakeops.session import scratch_path
from lakeops.sources.control import retention_rules
from lakeops.sources.snapshot import ConstraintViolation


def step_config(spark, sf):
    """One config row per part: type from p_type, details complete or broken by p_size."""
    kind = F.col("p_type")
    brand = F.col("p_brand")
    size = F.col("p_size")
    func_type = (
        F.when(kind == "STANDARD", "sql")
        .when(kind == "ECONOMY", "SQL")
        .when(kind == "MEDIUM", "SQLLOAD")
        .when(kind == "PROMO", "NOTEBOOK")
        .when(kind == "LARGE", "Notebook")
        .otherwise("BRONZE")
    )
    details = (
        F.when(size > 45, "not json")
        .when(size > 40, "{}")
        .when((size > 35) & func_type.isin("sql", "SQL"), F.to_json(F.struct(brand.alias("sql_var"))))
        .when(size > 30, F.to_json(F.struct(F.lit(" ").alias("sql_var"), F.lit("").alias("sql_path"))))
        .otherwise(
            F.to_json(
                F.struct(
                    F.col("p_name").alias("sql_var"),
                    F.lit("").alias("sql_parms"),
                    F.concat(F.lit("/lib/"), brand).alias("sql_path"),
                    F.concat(F.lit("jobs/"), "p_name").alias("notebook_path"),
                )
            )
        )
    )
    layer = F.when(size % 3 == 0, "BRONZE").when(size % 3 == 1, "SILVER").otherwise("GOLD")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("emc_id"),
        F.upper("p_brand").alias("emc_task_id"),
        F.col("p_size").cast("string").alias("emc_seq"),
        layer.alias("emc_target_layer"),
        func_type.alias("emc_func_type"),
        details.alias("emc_func_dtls"),
        F.when(size > 20, F.concat(F.lit("dev.gold."), "p_name")).alias("emc_target"),
        F.when(size > 25, "APPEND").when(size > 5, "OVERWRITE").when(size > 1, "").alias("emc_out_mode"),
        F.when(size % 4 > 0, size % 4 * 3).alias("emc_table_retention"),
        F.when(F.col("p_retailprice") > 905, "Y").otherwise("N").alias("emc_active"),
    )


STEP_CONFIG_SQL = """SELECT p_partkey AS emc_id, upper(p_brand) AS emc_task_id, CAST(p_size AS VARCHAR) AS emc_seq,
  CASE p_size % 3 WHEN 0 THEN 'BRONZE' WHEN 1 THEN 'SILVER' ELSE 'GOLD' END AS emc_target_layer,
  CASE p_type WHEN 'STANDARD' THEN 'sql' WHEN 'ECONOMY' THEN 'SQL' WHEN 'MEDIUM' THEN 'SQLLOAD'
    WHEN 'PROMO' THEN 'NOTEBOOK' WHEN 'LARGE' THEN 'Notebook' ELSE 'BRONZE' END AS emc_func_type,
  CASE WHEN p_size > 20 THEN 'dev.gold.' || p_name END AS emc_target,
  CASE WHEN p_size > 25 THEN 'APPEND' WHEN p_size > 5 THEN 'OVERWRITE' WHEN p_size > 1 THEN '' END AS emc_out_mode,
  CASE WHEN p_size % 4 > 0 THEN p_size % 4 * 3 END AS emc_table_retention,
  CASE WHEN p_retailprice > 905 THEN 'Y' ELSE 'N' END AS emc_active, p_size, p_name, p_brand FROM part"""


@check(
    "dq_step_details",
    f"""SELECT emc_id, emc_task_id, emc_seq, emc_func_type, problem FROM (
      SELECT *, CASE WHEN p_size > 45 THEN 'details are not JSON'
        WHEN upper(emc_func_type) = 'SQL' AND p_size > 40 THEN 'sql_var is missing'
        WHEN upper(emc_func_type) = 'SQL' AND p_size > 35 THEN 'sql_parms is missing'
        WHEN upper(emc_func_type) = 'SQL' AND p_size > 30 THEN 'sql_var is missing'
        WHEN emc_func_type = 'SQLLOAD' AND p_size > 30 THEN 'sql_path is missing'
        WHEN upper(emc_func_type) = 'NOTEBOOK' AND p_size > 30 THEN 'notebook_path is missing'
        WHEN emc_func_type = 'BRONZE' THEN 'function type is not known' END AS problem
      FROM ({STEP_CONFIG_SQL})) WHERE problem IS NOT NULL""",
)
def dq_step_details(spark, sf):
    return check_steps(step_config(spark, sf))


@check(
    "retention_rules",
    f"""SELECT min(emc_id) AS tmc_id, 'I' AS tmc_inc_excl_flag, 'MONTHLY' AS tmc_freq, lower(emc_target) AS tmc_name,
          max(emc_table_retention) * 730 AS tmc_vac_retention_hours FROM ({STEP_CONFIG_SQL})
        WHERE emc_active = 'Y' AND emc_table_retention IS NOT NULL AND emc_target IS NOT NULL
        GROUP BY lower(emc_target)""",
)
def retention_of_targets(spark, sf):
    rules = retention_rules(step_config(spark, sf))
    return rules.select("tmc_id", "tmc_inc_excl_flag", "tmc_freq", "tmc_name", "tmc_vac_retention_hours")


@check(
    "dq_allowed",
    f"""SELECT emc_id, rule FROM (
      SELECT emc_id, 'func_type' AS rule FROM ({STEP_CONFIG_SQL})
        WHERE emc_func_type NOT IN ('SQLLOAD', 'NOTEBOOK', 'SQL')
      UNION ALL SELECT emc_id, 'out_mode' FROM ({STEP_CONFIG_SQL})
        WHERE emc_out_mode IS NOT NULL AND emc_out_mode NOT IN ('', 'APPEND')
      UNION ALL SELECT emc_id, 'active' FROM ({STEP_CONFIG_SQL}) WHERE emc_active <> 'Y')""",
)
def dq_allowed(spark, sf):
    rules = {
        "func_type": in_set("emc_func_type", ["SQLLOAD", "NOTEBOOK", "SQL"]),
        "out_mode": in_set("emc_out_mode", ["", "APPEND"]),
        "active": sql_check("emc_active = 'Y'"),
    }
    return violations(step_config(spark, sf), rules, ["emc_id"])


@check(
    "dq_not_null",
    """SELECT rule, row_count FROM (
      SELECT 'type_required' AS rule, CAST(count_if(event_type = 'error') AS BIGINT) AS row_count FROM events
      UNION ALL SELECT 'value_required', CAST(count_if(value > 100) AS BIGINT) FROM events
      UNION ALL SELECT 'user_required', 0 FROM (SELECT 1))""",
)
def dq_not_null(spark, sf):
    events = table(spark, sf, "events").select(
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") <= 100, F.col("value")).alias("value"),
        "user_id",
    )
    rules = {"type_required": "event_type", "value_required": "value", "user_required": "user_id"}
    return violation_counts(events, {rule: not_null(col) for rule, col in rules.items()})


@check(
    "dq_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def dq_unique(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    "dq_rule_names",
    """SELECT c_custkey AS tmc_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'a.b.c.' || c_name ELSE ' . ' END AS tmc_name
       FROM customer WHERE c_acctbal <= 9000 AND (c_mktsegment = 'BUILDING' OR c_mktsegment = 'FURNITURE')""",
)
def dq_rule_names(spark, sf):
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", F.concat(F.lit("a.b.c."), "c_name"))
        .when(segment == "FURNITURE", " . ")
        .when(segment == "AUTOMOBILE", "cat")
        .otherwise(F.concat(F.lit("cat..sch."), "c_name"))
    )
    rules = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("tmc_id"),
        name.alias("tmc_name"),
        F.when(F.col("c_acctbal") > 9000, "N").otherwise("Y").alias("tmc_active_flag"),
    )
    return check_rules(rules)


@check(
    "dq_quarantine",
    """SELECT 'good' AS side, doc_id, '' AS reasons FROM documents WHERE n_chars >= 100 AND lang IN ('en', 'fr')
       UNION ALL SELECT 'bad', doc_id, CASE WHEN n_chars < 100 AND lang NOT IN ('en', 'fr') THEN 'language,short'
         WHEN n_chars < 100 THEN 'short' ELSE 'language' END
       FROM documents WHERE n_chars < 100 OR lang NOT IN ('en', 'fr')""",
)
def dq_quarantine(spark, sf):
    rules = {"language": in_set("lang", ["en", "fr"]), "short": F.col("n_chars") < 100}
    good, bad = gate(table(spark, sf, "documents"), rules, "quarantine")
    return good.select(F.lit("good").alias("side"), "doc_id", F.lit("").alias("reasons")).unionByName(
        bad.select(F.lit("bad").alias("side"), "doc_id", F.array_join("broken_rules", ",").alias("reasons"))
    )


@check(
    "assign_ids",
    """SELECT 100 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey, o_orderdate FROM orders""",
)
def ordered_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return assign_ids(orders, "id", start=100, order=["o_orderdate", "o_orderkey"])


@check(
    "assign_ids_unordered",
    "SELECT count(*) AS row_count, count(*) AS ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id FROM lineitem",
)
def unordered_ids(spark, sf):
    numbered = assign_ids(table(spark, sf, "lineitem"), "id")
    return numbered.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("id").alias("ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


def order_results(spark, sf):
    """One step result per order: targets by priority, failures where the status is P."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("dev.gold."), F.lower(F.translate("o_orderpriority", " -", "__"))).alias("target"),
        F.col("o_orderkey").alias("prev_version"),
        F.when(F.col("o_orderkey") < 10, 0).otherwise(F.col("o_orderkey") + 1).alias("new_version"),
        F.col("o_custkey").alias("rows_inserted"),
        F.lit(0).alias("rows_updated"),
        F.lit(1).alias("rows_deleted"),
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("start_ts"),
        F.col("o_orderdate").cast("timestamp").alias("end_ts"),
        F.to_date("o_orderdate").alias("etl_date"),
        F.lit("nightly").alias("jobname"),
        F.col("o_orderkey").cast("string").alias("jobrunid"),
        F.lit("7").alias("jobid"),
        F.lit("8").alias("taskrunid"),
        F.lit("gold").alias("taskname"),
        F.lit("etl").alias("userid"),
        F.lit("orders_job").alias("notebook"),
    )


LOAD_STATUS_SQL = """SELECT CAST(o_orderdate AS DATE) AS etls_load_date, 'dev' AS etls_catalog, 'gold' AS etls_schema,
    lower(replace(replace(o_orderpriority, ' ', '_'), '-', '_')) AS etls_table_name,
    CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END AS etls_prev_ver,
    CASE WHEN o_orderstatus = 'P' OR o_orderkey < 10 THEN NULL ELSE o_orderkey + 1 END AS etls_new_ver,
    CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS etls_rows_inserted,
    CAST(0 AS BIGINT) AS etls_rows_updated,
    CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS BIGINT) AS etls_rows_deleted,
    'nightly' AS etls_jobname, CAST(o_orderkey AS VARCHAR) AS etls_jobrunid, '7' AS etls_jobid, '8' AS etls_taskrunid,
    'gold' AS etls_taskname, 'orders_job' AS etls_notebook, 'etl' AS etls_run_by,
    CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'SUCCESS' END AS etls_status FROM orders"""


@check("load_status", LOAD_STATUS_SQL)
def load_status(spark, sf):
    rows = load_status_rows(order_results(spark, sf))
    return rows.drop("etls_log_id", "etls_start_timestamp", "etls_end_timestamp")


@check(
    "load_report",
    f"""SELECT etls_load_date, etls_catalog, etls_schema, etls_table_name, count(*) AS steps,
          CAST(sum(etls_rows_inserted) AS BIGINT) AS rows_inserted, CAST(sum(etls_rows_updated) AS BIGINT) AS rows_updated,
          CAST(sum(etls_rows_deleted) AS BIGINT) AS rows_deleted, CAST(count_if(etls_status = 'FAILED') AS BIGINT) AS failures
        FROM ({LOAD_STATUS_SQL}) GROUP BY 1, 2, 3, 4""",
)
def load_reports(spark, sf):
    return load_report(load_status_rows(order_results(spark, sf)))


def order_events(spark, sf):
    """One maintenance event per order."""
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.when(status == "O", "OPTIMIZE").when(status == "F", "VACUUM").otherwise("ANALYZE").alias("operation"),
        F.lit("dev").alias("catalog_name"),
        F.col("o_orderpriority").alias("schema_name"),
        F.col("o_orderkey").cast("string").alias("table_name"),
        F.when(F.col("o_totalprice") > 400000, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("o_totalprice") > 400000, "too large").otherwise("").alias("error_message"),
        F.col("o_orderdate").cast("timestamp").alias("start_ts"),
        F.col("o_orderdate").cast("timestamp").alias("end_ts"),
        F.col("o_custkey").alias("file_count_before"),
        F.lit(1).alias("file_count_after"),
    )


_RUN = {
    "job_id": "1",
    "job_name": "care",
    "job_run_id": "11",
    "task_run_id": "12",
    "task_name": "tables",
    "run_by": "ops",
}


@check(
    "maint_log",
    """SELECT CASE o_orderstatus WHEN 'O' THEN 'OPTIMIZE' WHEN 'F' THEN 'VACUUM' ELSE 'ANALYZE' END AS tml_operation,
         'dev' AS tml_catalog_name, o_orderpriority AS tml_schema_name, CAST(o_orderkey AS VARCHAR) AS tml_table_name,
         CASE WHEN o_totalprice > 400000 THEN 'FAILED' ELSE 'SUCCESS' END AS tml_status,
         CASE WHEN o_totalprice > 400000 THEN 'too large' ELSE '' END AS tml_error_message, 'ops' AS tml_run_by,
         '1' AS tml_job_id, 'care' AS tml_job_name, '11' AS tml_job_run_id, '12' AS tml_task_run_id,
         'tables' AS tml_task_name, CAST(o_custkey AS INTEGER) AS tml_file_count_before, 1 AS tml_file_count_after
       FROM orders""",
)
def maint_log(spark, sf):
    rows = maintenance_log_rows(order_events(spark, sf), _RUN)
    return rows.drop("tml_uuid", "tml_timestamp", "tml_start_ts", "tml_end_ts")


@check(
    "run_summary",
    """SELECT o_orderkey AS event, o_orderstatus AS tml_job_run_id, o_orderpriority AS tml_task_run_id, o_orderdate AS at
       FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
)
def run_summaries(spark, sf):
    log = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event"),
        F.col("o_orderstatus").alias("tml_job_run_id"),
        F.col("o_orderpriority").alias("tml_task_run_id"),
        F.col("o_orderdate").alias("tml_timestamp"),
    )
    return run_summary(log, "F", "1-URGENT").withColumnRenamed("tml_timestamp", "at")


@check(
    "identity_append",
    """WITH o AS (SELECT o_orderkey % 3 AS part, count(*) AS row_count FROM orders GROUP BY 1),
      s AS (SELECT part, row_count, coalesce(CAST(sum(row_count) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before FROM o)
    SELECT part, CASE part WHEN 2 THEN row_count - 10 ELSE row_count END AS row_count, CASE part WHEN 2 THEN row_count - 10 ELSE row_count END AS ids,
      before + 1 AS first_id, CASE part WHEN 2 THEN before + row_count - 10 ELSE before + row_count END AS last_id, CAST(0 AS BIGINT) AS given_again
    FROM s UNION ALL SELECT 3, 5, 5, (SELECT count(*) FROM orders) + 1, (SELECT count(*) FROM orders) + 5, 0""",
)
def identity_append(spark, sf):
    """Appends number their rows on from the largest id ever given, also after the rows with the largest ids have been deleted."""
    orders = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 3).alias("part"))
    lake = new_lake(spark, "identity")
    layout = orders.select(F.lit(None).cast("bigint").alias("id"), "o_orderkey", "part").schema
    ensure_tables(lake, [TableSpec("dev.bronze.orders", layout, identity="id")])
    target = lake.table("dev.bronze.orders")
    for part in range(3):
        append(orders.where(F.col("part") == part).repartition(4), target)
    last = target.read().agg(F.max("id")).first()[0]
    delete_where(target, F.col("id") > last - 10)
    path = scratch_path(spark, "five-orders")
    orders.orderBy("o_orderkey").limit(5).withColumn("part", F.lit(3).cast(orders.schema["part"].dataType)).repartition(2).write.parquet(path)
    append(spark.read.parquet(path), target)  # a scan is numbered as it lies
    again = target.read().groupBy("id").count().where("count > 1").count()
    return target.read().groupBy("part").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("id").alias("ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.lit(again).cast("bigint").alias("given_again"),
    )


@check(
    "append_quarantine",
    """SELECT doc_id, lang, CASE WHEN n_chars < 100 AND lang NOT IN ('en', 'fr') THEN 'language,short' WHEN n_chars < 100 THEN 'short'
         WHEN lang NOT IN ('en', 'fr') THEN 'language' ELSE '' END AS reasons, (SELECT count(*) FROM documents WHERE n_chars >= 100 AND lang IN ('en', 'fr')) AS appended
    FROM documents""",
)
def append_quarantine(spark, sf):
    """Good rows go to their table and broken ones, with their reasons, to the quarantine table; a broken write leaves both as they were."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    lake = new_lake(spark, "quarantine-run")
    ensure_tables(lake, [TableSpec("dev.bronze.docs", docs.schema), TableSpec("dev.bronze.bad", docs.schema, constraints={"never": "doc_id < 0"})])
    good, bad = lake.table("dev.bronze.docs"), lake.table("dev.bronze.bad")
    rules = {"language": in_set("lang", ["en", "fr"]), "short": F.col("n_chars") < 100}
    try:
        append_gated(docs, good, rules, bad)
        raise AssertionError("the quarantine table takes no rows")
    except ConstraintViolation:
        pass
    if good.latest_version() != 0:
        raise AssertionError("good rows were committed without the bad ones")
    ensure_tables(lake, [TableSpec("dev.bronze.bad", docs.schema)], replace=True)
    kept, _ = append_gated(docs, good, rules, bad)
    reasons = F.array_join("broken_rules", ",").alias("reasons")
    rows = good.read().select("doc_id", "lang", F.lit("").alias("reasons")).unionByName(bad.read().select("doc_id", "lang", reasons))
    return rows.withColumn("appended", F.lit(kept.row_counts[0]).cast("bigint"))
