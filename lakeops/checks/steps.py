"""Checks of the config scan, statement libraries, SQL and job steps and the medallion run."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.checks.quality import STEP_CONFIG_SQL, step_config
from lakeops.checks.registry import check, new_lake, table
from lakeops.functions.columns import bracket
from lakeops.operators.writes import TableSpec, append, ensure_tables
from lakeops.plans.steps import RunContext, StepFailed, bind_statements, job, lake_sql, run_pipeline, run_task
from lakeops.session import scratch_path
from lakeops.sources.control import config_spec, load_status_spec, read_steps, step_order
from lakeops.sources.statements import read_statement_library

LOG_TABLE = "dev.meta.load_status"
CONFIG_TABLE = "dev.meta.config"


def config_frame(spark, steps):
    """Config rows (a handful) from (task, seq, layer, type, details, target, out mode)."""
    rows = [
        (i, task, str(seq), layer, kind, json.dumps(details), target, mode, "Y")
        for i, (task, seq, layer, kind, details, target, mode) in enumerate(steps, 1)
    ]
    frame = spark.createDataFrame(
        rows,
        "emc_id BIGINT, emc_task_id STRING, emc_seq STRING, emc_target_layer STRING, emc_func_type STRING, "
        "emc_func_dtls STRING, emc_target STRING, emc_out_mode STRING, emc_active STRING",
    )
    return frame.withColumn("emc_func_dtls", F.parse_json("emc_func_dtls"))


def library_file(spark, statements):
    """A statement library in the shared folder."""
    text = "# statements of this run\n" + "\n".join(f'{k} = """\n{v};\n"""' for k, v in statements.items())
    path = scratch_path(spark, "library")
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.text(path)
    return path


def context(lake, config, etl_date="2024-01-31", **settings):
    ensure_tables(lake, [load_status_spec(LOG_TABLE)])
    return RunContext(
        lake,
        config,
        etl_date,
        LOG_TABLE,
        jobid="1",
        jobname="events",
        jobrunid="r1",
        taskname="load",
        taskrunid="t1",
        userid="etl",
        **settings,
    )


@check(
    "config_scan",
    f"""SELECT emc_id, emc_task_id, emc_seq, emc_func_type, emc_out_mode FROM ({STEP_CONFIG_SQL})
        WHERE emc_task_id = 'BRAND#7' AND emc_target_layer = 'GOLD' AND emc_active = 'Y'""",
)
def config_scan(spark, sf):
    steps = read_steps(step_config(spark, sf), "brand#7", "gold")
    return steps.select("emc_id", "emc_task_id", "emc_seq", "emc_func_type", "emc_out_mode")


@check(
    "step_order",
    f"""SELECT emc_id, CAST(row_number() OVER (PARTITION BY emc_task_id, emc_target_layer
                 ORDER BY TRY_CAST(emc_seq AS INTEGER), emc_seq, emc_id) AS INTEGER) AS numeric_place,
               CAST(row_number() OVER (PARTITION BY emc_task_id, emc_target_layer ORDER BY emc_seq, emc_id) AS INTEGER)
                 AS text_place
        FROM ({STEP_CONFIG_SQL})""",
)
def step_places(spark, sf):
    task = Window.partitionBy("emc_task_id", "emc_target_layer")
    return step_config(spark, sf).select(
        "emc_id",
        F.row_number().over(task.orderBy(*step_order(), "emc_id")).alias("numeric_place"),
        F.row_number().over(task.orderBy(*step_order(numeric=False), "emc_id")).alias("text_place"),
    )


@check(
    "statement_library",
    """SELECT 'part_' || p_partkey AS sql_var,
         'SELECT ''' || p_name || ''' AS name,' || chr(10) || '  a = ' || p_size || ' AS same FROM t' AS sql_text
       FROM part""",
)
def statement_library(spark, sf):
    path = scratch_path(spark, "library")
    text = F.format_string(
        '# part %d = ignored; "not this"\npart_%d = """\n\nSELECT \'%s\' AS name,\n  a = %d AS same FROM t;\n"""\n',
        "p_partkey",
        "p_partkey",
        "p_name",
        "p_size",
    )
    # Many small files, as libraries are: one file is read as one row.
    table(spark, sf, "part").select(text.alias("value")).write.option("maxRecordsPerFile", 100).text(path)
    return read_statement_library(spark, path).select("sql_var", "sql_text")


@check(
    "bind_statements_all",
    f"""WITH steps AS ({STEP_CONFIG_SQL}),
      library AS (SELECT p_brand, p_name, 'SELECT ' || max(p_partkey) AS sql_text FROM part GROUP BY p_brand, p_name)
    SELECT emc_id, CASE WHEN upper(emc_func_type) = 'SQL' AND p_size <= 30 THEN sql_text END AS sql_text,
      CASE WHEN p_size > 45 THEN 'details are not JSON'
           WHEN upper(emc_func_type) = 'SQL' AND p_size > 40 THEN 'sql_var is missing'
           WHEN upper(emc_func_type) = 'SQL' AND p_size > 35 THEN 'sql_parms is missing'
           WHEN upper(emc_func_type) = 'SQL' AND p_size > 30 THEN 'sql_var is missing'
           WHEN emc_func_type = 'SQLLOAD' AND p_size > 30 THEN 'sql_path is missing'
           WHEN upper(emc_func_type) = 'NOTEBOOK' AND p_size > 30 THEN 'notebook_path is missing'
           WHEN emc_func_type = 'BRONZE' THEN 'function type is not known' END AS problem
    FROM steps s LEFT JOIN library l ON s.p_brand = l.p_brand AND s.p_name = l.p_name""",
)
def statement_binding_of_all(spark, sf):
    library = (
        table(spark, sf, "part")
        .groupBy("p_brand", F.col("p_name").alias("sql_var"))
        .agg(F.concat(F.lit("SELECT "), F.max("p_partkey").cast("string")).alias("sql_text"))
        .withColumn("sql_path", F.concat(F.lit("/lib/"), "p_brand"))
    )
    steps = step_config(spark, sf)
    path = F.try_variant_get(F.try_parse_json("emc_func_dtls"), "$.sql_path", "string")
    bound = bind_statements(steps.withColumn("sql_path", path), library)
    text = F.when(F.upper("emc_func_type") == "SQL", F.col("sql_text"))
    return bound.select("emc_id", text.alias("sql_text"), "problem")


# -- SQL and job steps over events ---------------------------------------------------------------------------------

SILVER = """INSERT INTO dev.silver.events (event_id, kind, load_date, value)
SELECT event_id, COALESCE(NULLIF(event_type, 'error'), 'DF'), CAST(ts AS DATE), value
FROM dev.bronze.events WHERE CAST(ts AS DATE) = '{etl_date}' AND value >= {floor}"""
GOLD = """INSERT INTO dev.gold.events (kind, event_count)
SELECT kind, COUNT(*) FROM dev.silver.events WHERE load_date <= '{etl_date}' GROUP BY kind"""

SILVER_DDL = "event_id BIGINT, kind STRING, load_date DATE, value DOUBLE"
GOLD_DDL = "kind STRING, event_count STRING"
BRACKET_DDL = "value_bracket STRING, event_count BIGINT"


def _layout(spark, ddl):
    columns = [c.split() for c in ddl.split(", ")]
    return spark.range(0).selectExpr(*[f"cast(null as {kind}) AS {name}" for name, kind in columns]).schema


def _events_lake(spark, sf, label, mount=True):
    lake = new_lake(spark, label)
    if mount:
        lake.mount("dev.bronze.events", table(spark, sf, "events"))
    ensure_tables(
        lake,
        [
            TableSpec("dev.silver.events", _layout(spark, SILVER_DDL), partition_by=["load_date"]),
            TableSpec("dev.gold.events", _layout(spark, GOLD_DDL)),
            TableSpec("dev.gold.value_brackets", _layout(spark, BRACKET_DDL)),
        ],
    )
    return lake


def _silver_steps(path, parms='{"floor": 0}'):
    return [
        ("SILVER1", 1, "SILVER", "SQLLOAD", {"sql_path": path}, "", "APPEND"),
        ("SILVER1", 2, "SILVER", "SQL", {"sql_var": "silver", "sql_parms": parms}, "dev.silver.events", "APPEND"),
    ]


@check(
    "sql_step_silver",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'DF' ELSE event_type END AS kind,
         CAST(ts AS DATE) AS load_date, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND value >= 20""",
)
def sql_step_silver(spark, sf):
    lake = _events_lake(spark, sf, "silver")
    path = library_file(spark, {"silver": SILVER})
    run_task(context(lake, config_frame(spark, _silver_steps(path, '{"floor": 20}')), "2024-01-10"), "silver1", "silver")
    return lake.read("dev.silver.events")


@check(
    "sql_step_gold",
    """SELECT event_type AS kind, CAST(count(*) AS VARCHAR) AS event_count FROM events
       WHERE CAST(ts AS DATE) <= DATE '2024-01-20' GROUP BY event_type""",
)
def sql_step_gold(spark, sf):
    lake = _events_lake(spark, sf, "gold")
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("kind"), F.to_date("ts").alias("d"))
    lake.mount("dev.silver.events", events.withColumnRenamed("d", "load_date"))
    steps = [
        ("GOLD1", 1, "GOLD", "SQLLOAD", {"sql_path": library_file(spark, {"gold": GOLD})}, "", "APPEND"),
        ("GOLD1", 2, "GOLD", "SQL", {"sql_var": "gold", "sql_parms": ""}, "dev.gold.events", "OVERWRITE"),
    ]
    ctx = context(lake, config_frame(spark, steps), "2024-01-20")
    run_task(ctx, "gold1", "gold")
    run_task(ctx, "gold1", "gold")  # OVERWRITE: the second run replaces the first
    return lake.read("dev.gold.events")


@job("value_brackets")
def value_brackets(ctx, params):
    """Events per value bracket."""
    rows = ctx.lake.read(params["source"]).where(F.col("value") >= float(params["floor"]))
    return rows.groupBy(bracket(F.col("value")).alias("value_bracket")).agg(F.count(F.lit(1)).alias("event_count"))


_BRACKETS_SQL = """CASE WHEN value BETWEEN 0 AND 20 THEN '0-20' WHEN value BETWEEN 21 AND 40 THEN '21-40'
    WHEN value BETWEEN 41 AND 60 THEN '41-60' WHEN value > 60 THEN '61+' ELSE 'Unknown' END"""


@check(
    "job_step_brackets",
    f"SELECT {_BRACKETS_SQL} AS value_bracket, count(*) AS event_count FROM events WHERE value >= 10 GROUP BY 1",
)
def job_step_brackets(spark, sf):
    lake = _events_lake(spark, sf, "brackets")
    details = {"notebook_path": "../jobs/value_brackets", "parms": {"source": "dev.bronze.events", "floor": "0"}}
    steps = [("BRACKETS", 1, "GOLD", "NOTEBOOK", details, "dev.gold.value_brackets", "OVERWRITE")]
    run_task(context(lake, config_frame(spark, steps), parms_ovrd='{"floor": "10"}'), "brackets", "gold")
    return lake.read("dev.gold.value_brackets")


@check(
    "run_task_log",
    """SELECT 'events' AS etls_table_name, DATE '2024-01-12' AS etls_load_date, CAST(0 AS BIGINT) AS etls_prev_ver,
         CAST(1 AS BIGINT) AS etls_new_ver, count(*) AS etls_rows_inserted, 'SUCCESS' AS etls_status,
         'r1' AS etls_jobrunid FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12'
       UNION ALL SELECT 'value_brackets', DATE '2024-01-12', 0, NULL, 0, 'FAILED', 'r1' FROM (SELECT 1)""",
)
def run_task_log(spark, sf):
    lake = _events_lake(spark, sf, "log")
    path = library_file(spark, {"silver": SILVER})
    steps = [
        *_silver_steps(path),
        ("SILVER1", 3, "SILVER", "SQL", {"sql_var": "lost", "sql_parms": ""}, "dev.gold.value_brackets", ""),
        ("SILVER1", 10, "SILVER", "SQL", {"sql_var": "silver", "sql_parms": ""}, "dev.gold.events", ""),
    ]
    try:
        run_task(context(lake, config_frame(spark, steps), "2024-01-12"), "silver1", "silver")
        raise AssertionError("the third step must fail")
    except StepFailed:
        pass
    return lake.read(LOG_TABLE).select(
        "etls_table_name",
        "etls_load_date",
        "etls_prev_ver",
        "etls_new_ver",
        "etls_rows_inserted",
        "etls_status",
        "etls_jobrunid",
    )


MEDALLION_SILVER = SILVER.replace("= '{etl_date}'", "<= '{etl_date}'")


@check(
    "medallion",
    f"""WITH silver AS (SELECT CASE WHEN event_type = 'error' THEN 'DF' ELSE event_type END AS kind, value FROM events
                        WHERE CAST(ts AS DATE) <= DATE '2024-01-31'),
      gold AS (SELECT kind, count(*) AS n FROM silver GROUP BY kind),
      brackets AS (SELECT {_BRACKETS_SQL} AS label, count(*) AS n FROM silver GROUP BY 1)
    SELECT 'gold' AS section, kind AS label, n FROM gold
    UNION ALL SELECT 'brackets', label, n FROM brackets
    UNION ALL SELECT 'audit', 'dev.bronze.events SUCCESS', (SELECT count(*) FROM events)
    UNION ALL SELECT 'audit', 'dev.silver.events SUCCESS', (SELECT count(*) FROM silver)
    UNION ALL SELECT 'audit', 'dev.gold.events SUCCESS', (SELECT count(*) FROM gold)
    UNION ALL SELECT 'audit', 'dev.gold.value_brackets SUCCESS', (SELECT count(*) FROM brackets)""",
)
def medallion(spark, sf):
    lake = _events_lake(spark, sf, "medallion", mount=False)
    path = library_file(spark, {"silver": MEDALLION_SILVER, "gold": GOLD})
    ingest = {
        "notebook_path": "jobs/ingest_files",
        "parms": {
            "format": "PARQUET",
            "source_path": f"{sf}/events.parquet",
            "checkpoint": scratch_path(spark, "checkpoint-medallion"),
            "emc_target": "dev.bronze.events",
        },
    }
    brackets = {"notebook_path": "jobs/value_brackets", "parms": {"source": "dev.silver.events", "floor": "0"}}
    steps = [
        ("EVENTS", 1, "BRONZE", "NOTEBOOK", ingest, "dev.bronze.events", "APPEND"),
        *_silver_steps(path),
        ("GOLD1", 1, "GOLD", "SQLLOAD", {"sql_path": path}, "", "APPEND"),
        ("GOLD1", 2, "GOLD", "SQL", {"sql_var": "gold", "sql_parms": ""}, "dev.gold.events", "OVERWRITE"),
        ("BRACKETS", 1, "GOLD", "NOTEBOOK", brackets, "dev.gold.value_brackets", "OVERWRITE"),
    ]
    ensure_tables(lake, [config_spec(CONFIG_TABLE)])
    append(config_frame(spark, steps), lake.table(CONFIG_TABLE))
    tasks = [("EVENTS", "BRONZE"), ("SILVER1", "SILVER"), ("GOLD1", "GOLD"), ("BRACKETS", "GOLD")]
    run_pipeline(context(lake, lake.read(CONFIG_TABLE)), tasks)
    gold = lake.read("dev.gold.events").select(
        F.lit("gold").alias("section"), F.col("kind").alias("label"), F.col("event_count").cast("bigint").alias("n")
    )
    grouped = lake.read("dev.gold.value_brackets").select(F.lit("brackets"), "value_bracket", "event_count")
    name = F.concat_ws(".", "etls_catalog", "etls_schema", "etls_table_name")
    audit = lake.read(LOG_TABLE).select(F.lit("audit"), F.concat_ws(" ", name, "etls_status"), "etls_rows_inserted")
    return gold.union(grouped).union(audit)


# -- any Spark SQL in a step ---------------------------------------------------------------------------------------


def _run_query_step(spark, sf, label, sources, text):
    """Run one query as a SQL step of a task, from a statement library into a target table."""
    lake = new_lake(spark, label)
    for source in sources:
        lake.mount(f"dev.bronze.{source}", table(spark, sf, source))
    target = "dev.gold.result"
    ensure_tables(lake, [TableSpec(target, lake_sql(lake, text).schema)])
    path = library_file(spark, {"result": text})
    steps = [
        ("ANY", 1, "GOLD", "SQLLOAD", {"sql_path": path}, "", ""),
        ("ANY", 2, "GOLD", "SQL", {"sql_var": "result", "sql_parms": ""}, target, "APPEND"),
    ]
    run_task(context(lake, config_frame(spark, steps)), "any", "gold")
    return lake.read(target)


def _pass_through(name, sources, text, oracle=None):
    plain = oracle or text.replace("dev.bronze.", "")
    check(f"step_{name}", plain)(lambda spark, sf: _run_query_step(spark, sf, name, sources, text))


_pass_through(
    "join_aggregate",
    ["orders", "customer"],
    """SELECT c_mktsegment, o_orderstatus, count(*) AS order_count, count(DISTINCT o_custkey) AS customers
    FROM dev.bronze.orders JOIN dev.bronze.customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderstatus""",
)
_pass_through(
    "literal_name",
    ["orders"],
    """/* dev.bronze.orders */ SELECT 'dev.bronze.orders' AS source, -- dev.bronze.orders
    "it's dev.bronze.orders" AS note, o_orderkey FROM `dev`.`bronze`.`orders` WHERE o_custkey IN
    (SELECT max(o_custkey) FROM Dev.bronze.orders GROUP BY o_orderdate)""",
    """SELECT 'dev.bronze.orders' AS source, 'it''s dev.bronze.orders' AS note, o_orderkey FROM orders WHERE o_custkey IN
    (SELECT max(o_custkey) FROM orders GROUP BY o_orderdate)""",
)
_pass_through(
    "left_join",
    ["customer", "orders"],
    """SELECT c_custkey, count(o_orderkey) AS order_count, max(o_orderkey) AS last_order
    FROM dev.bronze.customer LEFT JOIN dev.bronze.orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
    GROUP BY c_custkey""",
)
_pass_through(
    "semi_anti_join",
    ["documents", "labels"],
    """SELECT 'labelled' AS side, doc_id FROM dev.bronze.documents LEFT SEMI JOIN dev.bronze.labels USING (doc_id)
    UNION ALL
    SELECT 'bare' AS side, doc_id FROM dev.bronze.documents LEFT ANTI JOIN dev.bronze.labels USING (doc_id)""",
    """SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'labelled' ELSE 'bare' END AS side, doc_id
    FROM documents""",
)
_pass_through(
    "band_join",
    ["lineitem", "orders"],
    """SELECT o_orderpriority, count(*) AS line_count FROM dev.bronze.lineitem JOIN dev.bronze.orders
    ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL '400' DAY
    GROUP BY o_orderpriority""",
)
_pass_through(
    "windows",
    ["orders"],
    """SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place,
    sum(o_custkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running,
    lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS status_before
    FROM dev.bronze.orders""",
    """SELECT o_orderkey, CAST(row_number() OVER w AS INTEGER) AS place, CAST(sum(o_custkey) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
    AND CURRENT ROW) AS BIGINT) AS running, lag(o_orderstatus) OVER w AS status_before FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
_pass_through(
    "rollup_cube",
    ["lineitem"],
    """SELECT 'rollup' AS kind, l_returnflag, l_linestatus, count(*) AS line_count FROM dev.bronze.lineitem
    GROUP BY ROLLUP (l_returnflag, l_linestatus)
    UNION ALL SELECT 'cube' AS kind, l_returnflag, l_linestatus, count(*) FROM dev.bronze.lineitem
    GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
_pass_through(
    "set_operations",
    ["customer", "orders"],
    """SELECT 'except' AS kind, k FROM (SELECT c_custkey AS k FROM dev.bronze.customer
      EXCEPT SELECT o_custkey FROM dev.bronze.orders)
    UNION ALL SELECT 'intersect' AS kind, k FROM (SELECT c_custkey AS k FROM dev.bronze.customer WHERE c_acctbal < 0
      INTERSECT SELECT o_custkey FROM dev.bronze.orders)
    UNION ALL SELECT 'union' AS kind, k FROM (SELECT c_nationkey AS k FROM dev.bronze.customer
      UNION SELECT c_custkey FROM dev.bronze.customer)""",
)
_pass_through(
    "correlated",
    ["orders"],
    """SELECT o_orderkey, o_custkey FROM dev.bronze.orders o WHERE o_orderdate =
    (SELECT max(i.o_orderdate) FROM dev.bronze.orders i WHERE i.o_custkey = o.o_custkey)""",
)
_pass_through(
    "explode",
    ["documents"],
    """SELECT lang, word, count(*) AS uses FROM dev.bronze.documents LATERAL VIEW explode(split(text, ' ')) w AS word
    GROUP BY lang, word""",
    """SELECT lang, word, count(*) AS uses FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY lang, word""",
)
_pass_through(
    "text_and_dates",
    ["events"],
    """SELECT upper(substring(event_type, 1, 3)) AS kind, date_format(ts, 'yyyy-MM') AS month, dayofmonth(ts) AS dom,
    count(*) AS event_count, max(length(props)) AS longest FROM dev.bronze.events
    GROUP BY upper(substring(event_type, 1, 3)), date_format(ts, 'yyyy-MM'), dayofmonth(ts)""",
    """SELECT upper(substring(event_type, 1, 3)) AS kind, strftime(ts, '%Y-%m') AS month,
    CAST(day(ts) AS INTEGER) AS dom, count(*) AS event_count, CAST(max(length(props)) AS INTEGER) AS longest FROM events GROUP BY 1, 2, 3""",
)
_pass_through(
    "json_fields",
    ["events"],
    """SELECT from_json(props, 'k INT').k AS k, count(*) AS event_count, min(event_id) AS first_event
    FROM dev.bronze.events GROUP BY from_json(props, 'k INT').k""",
    """SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS event_count, min(event_id) AS first_event
    FROM events GROUP BY 1""",
)


# -- writes as text ------------------------------------------------------------------------------------------------


def _run_write_step(spark, sf, label, target, sources, text):
    """Run one MERGE, UPDATE or DELETE as a SQL step over a copy of a table in several files; its rows with the counts of the audit row."""
    lake = new_lake(spark, label)
    for source in sources:
        lake.mount(f"dev.bronze.{source}", table(spark, sf, source))
    name = f"dev.silver.{target}"
    rows = table(spark, sf, target)
    ensure_tables(lake, [TableSpec(name, rows.schema)])
    key = rows.columns[0]
    for part in range(3):
        append(rows.where(F.pmod(F.col(key), F.lit(3)) == part), lake.table(name))
    steps = [
        ("ANY", 1, "SILVER", "SQLLOAD", {"sql_path": library_file(spark, {"change": text})}, "", ""),
        ("ANY", 2, "SILVER", "SQL", {"sql_var": "change", "sql_parms": ""}, name, "APPEND"),
    ]
    run_task(context(lake, config_frame(spark, steps)), "any", "silver")
    log = lake.read(LOG_TABLE).first()
    counts = {n: log[f"etls_rows_{n}"] for n in ("inserted", "updated", "deleted")}
    return lake.read(name).select("*", *[F.lit(v).cast("bigint").alias(f"rows_{n}") for n, v in counts.items()])


_MERGE_SOURCE = """SELECT o_custkey AS k, count(*) AS n FROM dev.bronze.orders GROUP BY o_custkey
    UNION ALL SELECT c_custkey + 1000000 AS k, CAST(0 AS BIGINT) AS n FROM dev.bronze.customer WHERE c_acctbal < 0
    UNION ALL SELECT NULL AS k, CAST(0 AS BIGINT) AS n FROM dev.bronze.customer WHERE c_custkey = 5"""
_MERGE_TEXT = f"""-- changes of the day
MERGE INTO dev.silver.customer AS t USING ({_MERGE_SOURCE}) AS s ON t.c_custkey = s.k AND t.c_nationkey <> 7
WHEN MATCHED AND s.n > 14 THEN DELETE
WHEN MATCHED AND t.c_acctbal < 0 THEN UPDATE SET t.c_mktsegment = 'DEBT dev.silver.customer', c_acctbal = t.c_acctbal + s.n
WHEN MATCHED THEN UPDATE SET c_name = concat(t.c_name, '!')
WHEN NOT MATCHED AND s.n = 0 THEN INSERT (c_custkey, c_name) VALUES (s.k, 'new')
WHEN NOT MATCHED BY SOURCE AND c_nationkey = 7 THEN UPDATE SET c_mktsegment = 'SEVEN'
WHEN NOT MATCHED BY SOURCE AND c_nationkey = 8 THEN DELETE"""


@check(
    "step_merge_text",
    f"""WITH s AS ({_MERGE_SOURCE.replace('dev.bronze.', '')}),
      j AS (SELECT customer.*, s.k, s.n, CASE WHEN k IS NOT NULL AND n > 14 THEN 'deleted' WHEN k IS NOT NULL AND c_acctbal < 0 THEN 'debt'
              WHEN k IS NOT NULL THEN 'named' WHEN c_nationkey = 7 THEN 'seven' WHEN c_nationkey = 8 THEN 'deleted' ELSE 'kept' END AS a
            FROM customer LEFT JOIN s ON c_custkey = k AND c_nationkey <> 7),
      i AS (SELECT k FROM s WHERE n = 0 AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = k AND c_nationkey <> 7)),
      c AS (SELECT (SELECT count(*) FROM i) AS rows_inserted, count(*) FILTER (a IN ('debt', 'named', 'seven')) AS rows_updated,
              count(*) FILTER (a = 'deleted') AS rows_deleted FROM j)
    SELECT c_custkey, CASE WHEN a = 'named' THEN concat(c_name, '!') ELSE c_name END AS c_name, c_nationkey,
      CASE WHEN a = 'debt' THEN c_acctbal + n ELSE c_acctbal END AS c_acctbal,
      CASE WHEN a = 'debt' THEN 'DEBT dev.silver.customer' WHEN a = 'seven' THEN 'SEVEN' ELSE c_mktsegment END AS c_mktsegment, c.*
    FROM j, c WHERE a <> 'deleted'
    UNION ALL SELECT k, 'new', NULL, NULL, NULL, c.* FROM i, c""",
)
def step_merge_text(spark, sf):
    return _run_write_step(spark, sf, "merge-text", "customer", ["orders", "customer"], _MERGE_TEXT)


@check(
    "step_update_text",
    """WITH u AS (SELECT orders.*, o_orderkey % 3 <> 1 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS hit
              FROM orders)
    SELECT o_orderkey, o_custkey, CASE WHEN hit THEN 'it''s X' ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN hit THEN (SELECT max(c_acctbal) FROM customer) ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority,
      CAST(0 AS BIGINT) AS rows_inserted, (SELECT count(*) FROM u WHERE hit) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted FROM u""",
)
def step_update_text(spark, sf):
    text = """UPDATE dev.silver.orders SET dev.silver.orders.o_orderstatus = "it's X",
      o_totalprice = (SELECT max(dev.bronze.customer.c_acctbal) FROM dev.bronze.customer)
    WHERE dev.silver.orders.o_orderkey % 3 <> 1
      AND o_custkey IN (SELECT c_custkey FROM dev.bronze.customer WHERE c_mktsegment = 'BUILDING')"""
    return _run_write_step(spark, sf, "update-text", "orders", ["customer"], text)


@check(
    "step_delete_subquery",
    """WITH d AS (SELECT orders.*, NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
                AND o_orderdate < (SELECT max(ts) FROM events) AS hit FROM orders)
    SELECT d.* EXCLUDE (hit), CAST(0 AS BIGINT) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
      (SELECT count(*) FROM d WHERE hit) AS rows_deleted FROM d WHERE NOT hit""",
)
def step_delete_subquery(spark, sf):
    text = """DELETE FROM dev.silver.orders AS o WHERE NOT EXISTS
      (SELECT 1 FROM dev.bronze.customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)
      AND o.o_orderdate < (SELECT max(ts) FROM dev.bronze.events)"""
    return _run_write_step(spark, sf, "delete-subquery", "orders", ["customer", "events"], text)


@check(
    "medallion_beside",
    f"""WITH gold AS (SELECT event_type AS kind, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'DF' ELSE event_type END AS event_type FROM events) GROUP BY 1),
      brackets AS (SELECT {_BRACKETS_SQL} AS label, count(*) AS n FROM events GROUP BY 1)
    SELECT 'gold' AS section, kind AS label, n FROM gold
    UNION ALL SELECT 'brackets', label, n FROM brackets
    UNION ALL SELECT 'audit', 'dev.bronze.orders SUCCESS', (SELECT count(*) FROM orders)
    UNION ALL SELECT 'audit', 'dev.silver.events SUCCESS', (SELECT count(*) FROM events)
    UNION ALL SELECT 'audit', 'dev.gold.events SUCCESS', (SELECT count(*) FROM gold)
    UNION ALL SELECT 'audit', 'dev.gold.value_brackets SUCCESS', (SELECT count(*) FROM brackets)
    UNION ALL SELECT 'overlap', 'bronze and silver', 1""",
)
def medallion_beside(spark, sf):
    """Bronze and silver tasks that do not depend on each other run side by side, the two gold tasks after both."""
    lake = _events_lake(spark, sf, "beside")
    path = library_file(spark, {"silver": MEDALLION_SILVER, "gold": GOLD})
    ensure_tables(lake, [TableSpec("dev.bronze.orders", table(spark, sf, "orders").schema)])
    parms = {"format": "PARQUET", "source_path": f"{sf}/orders.parquet", "checkpoint": scratch_path(spark, "checkpoint-beside"), "emc_target": "dev.bronze.orders"}
    brackets = {"notebook_path": "jobs/value_brackets", "parms": {"source": "dev.silver.events", "floor": "0"}}
    steps = [
        ("ORDERS", 1, "BRONZE", "NOTEBOOK", {"notebook_path": "jobs/ingest_files", "parms": parms}, "dev.bronze.orders", "APPEND"),
        *_silver_steps(path),
        ("GOLD1", 1, "GOLD", "SQLLOAD", {"sql_path": path}, "", "APPEND"),
        ("GOLD1", 2, "GOLD", "SQL", {"sql_var": "gold", "sql_parms": ""}, "dev.gold.events", "OVERWRITE"),
        ("BRACKETS", 1, "GOLD", "NOTEBOOK", brackets, "dev.gold.value_brackets", "OVERWRITE"),
    ]
    stages = [[("ORDERS", "BRONZE"), ("SILVER1", "SILVER")], [("GOLD1", "GOLD"), ("BRACKETS", "GOLD")]]
    run_pipeline(context(lake, config_frame(spark, steps), "2024-12-31"), stages)
    log = lake.read(LOG_TABLE)
    name = F.concat_ws(".", "etls_catalog", "etls_schema", "etls_table_name")
    first = log.where("etls_schema IN ('bronze', 'silver')")
    together = first.agg((F.max("etls_start_timestamp") < F.min("etls_end_timestamp")).cast("bigint").alias("n"))
    gold = lake.read("dev.gold.events").select(F.lit("gold").alias("section"), F.col("kind").alias("label"), F.col("event_count").cast("bigint").alias("n"))
    grouped = lake.read("dev.gold.value_brackets").select(F.lit("brackets"), "value_bracket", "event_count")
    audit = log.select(F.lit("audit"), F.concat_ws(" ", name, "etls_status"), "etls_rows_inserted")
    return gold.union(grouped).union(audit).union(together.select(F.lit("overlap"), F.lit("bronze and silver"), "n"))
