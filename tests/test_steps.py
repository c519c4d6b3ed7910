"""Config-driven runs over the small demo tables."""

import json

import pytest
from pyspark.sql import functions as F

from lakeops.functions.columns import AGE_BRACKETS
from lakeops.operators.counts import count_by_bracket
from lakeops.operators.writes import TableSpec, append, append_select, ensure_tables, rows_df
from lakeops.plans.steps import RunContext, StepFailed, job, lake_sql, run_pipeline, run_statement, run_task
from lakeops.sources.control import config_spec, load_status_spec
from lakeops.sources.snapshot import ConstraintViolation

LOG = "dev_etl.etl_meta.load_status"
CONFIG = "dev_etl.etl_meta.config"

BRONZE_DDL = "test_id STRING, test_name STRING, test_age INT, test_country STRING, test_email STRING, test_load_date DATE"
SILVER_DDL = BRONZE_DDL.replace("test_", "dst_")
PEOPLE = [  # age, country, load date
    (15, "UK", "2022-10-20"),
    (25, "US", "2022-10-20"),
    (35, "UK", "2022-10-20"),
    (45, "NZ", "2022-10-20"),
    (44, "", "2022-10-20"),
    (15, "UK", "2022-10-21"),
    (25, "US", "2022-10-21"),
    (35, "UK", "2022-10-21"),
]
LIBRARY = '''
# statements of the demo
silverload = """
INSERT INTO dev_etl.silver.test (dst_email, dst_id, dst_name, dst_age, dst_country, dst_load_date)
SELECT test_email, test_id, test_name, test_age, COALESCE(NULLIF(test_country, ''), 'DF'), test_load_date
FROM dev_etl.bronze.test WHERE test_load_date = '{etl_date}';
"""
goldload = """
INSERT INTO dev_etl.gold.test
SELECT dst_country, CAST(COUNT(*) AS STRING) FROM dev_etl.silver.test
WHERE dst_load_date = '{etl_date}' GROUP BY dst_country ;
"""
'''


@job("age_counts")
def age_counts(ctx, params):
    assert params["key1"] == "value1" and params["etl_date"] == ctx.etl_date
    counts = count_by_bracket(ctx.lake.read("dev_etl.silver.test"), F.col("dst_age"), AGE_BRACKETS)
    return counts.select(F.col("bracket").alias("dga_age_bracket"), F.col("row_count").cast("int").alias("dga_count"))


@pytest.fixture
def demo(spark, lake, scratch):
    specs = {
        "bronze.test": BRONZE_DDL,
        "silver.test": SILVER_DDL,
        "gold.test": "dgt_country STRING, dgt_count STRING",
        "gold.agg_age": "dga_age_bracket STRING, dga_count INT",
    }
    ensure_tables(
        lake,
        [TableSpec(f"dev_etl.{n}", spark.createDataFrame([], ddl).schema) for n, ddl in specs.items()]
        + [config_spec(CONFIG), load_status_spec(LOG)],
    )
    people = [(f"{i:07d}", f"Name{i}", age, c, f"Name{i}@x.test", d) for i, (age, c, d) in enumerate(PEOPLE, 1)]
    text = rows_df(spark, people, BRONZE_DDL.replace("DATE", "STRING"))
    append(text.withColumn("test_load_date", F.col("test_load_date").cast("date")), lake.table("dev_etl.bronze.test"))
    path = scratch("library")
    spark.createDataFrame([(LIBRARY,)], "value STRING").coalesce(1).write.text(path)
    return lake, path


def configure(lake, *steps):
    rows = [
        (i, task, str(seq), layer, kind, json.dumps(details), target, mode, "Y")
        for i, (task, seq, layer, kind, details, target, mode) in enumerate(steps, 1)
    ]
    names = "emc_task_id emc_seq emc_target_layer emc_func_type emc_func_dtls emc_target emc_out_mode emc_active"
    df = rows_df(lake.spark, rows, "emc_id BIGINT, " + ", ".join(f"{n} STRING" for n in names.split()))
    append(df.withColumn("emc_func_dtls", F.parse_json("emc_func_dtls")), lake.table(CONFIG))
    return lake.read(CONFIG)


def context(lake, config, **settings):
    return RunContext(lake, config, "2022-10-20", LOG, jobrunid="r", taskrunid="t", **settings)


def demo_steps(path):
    job_details = {"notebook_path": "../demo/age_counts", "parms": {"key1": "valuex", "key2": "v2"}, "timeout": 240}
    return [
        ("SILVERLOAD1", 1, "SILVER", "SQLLOAD", {"sql_path": path}, "", "APPEND"),
        ("SILVERLOAD1", 2, "SILVER", "SQL", {"sql_var": "silverload", "sql_parms": ""}, "dev_etl.silver.test", "APPEND"),
        ("GOLDLOAD1", 1, "GOLD", "SQLLOAD", {"sql_path": path}, "", "APPEND"),
        ("GOLDLOAD1", 2, "GOLD", "SQL", {"sql_var": "goldload", "sql_parms": ""}, "dev_etl.gold.test", "OVERWRITE"),
        ("NOTEBOOK2", 1, "GOLD", "NOTEBOOK", job_details, "dev_etl.gold.agg_age", "OVERWRITE"),
    ]


def as_dict(lake, name):
    return {r[0]: r[1] for r in lake.read(name).collect()}


def test_demo_day(demo):
    lake, path = demo
    ctx = context(lake, configure(lake, *demo_steps(path)), parms_ovrd='{"key1":"value1"}')
    tasks = [("silverload1", "silver"), ("goldload1", "gold"), ("notebook2", "gold")]
    run_pipeline(ctx, tasks)
    silver = lake.read("dev_etl.silver.test")
    assert silver.count() == 5
    assert silver.where("dst_id = '0000005'").first().dst_country == "DF"
    assert as_dict(lake, "dev_etl.gold.test") == {"UK": "2", "US": "1", "NZ": "1", "DF": "1"}
    assert as_dict(lake, "dev_etl.gold.agg_age") == {"0-20": 1, "21-40": 2, "41-60": 2}
    log = {r.etls_table_name + r.etls_schema: r for r in lake.read(LOG).collect()}
    assert log["testsilver"].etls_rows_inserted == 5 and log["testgold"].etls_rows_inserted == 4
    assert all(r.etls_status == "SUCCESS" and r.etls_start_timestamp <= r.etls_end_timestamp for r in log.values())
    # A second run appends silver again; OVERWRITE gold is replaced.
    run_pipeline(ctx, tasks)
    assert lake.read("dev_etl.silver.test").count() == 10
    assert as_dict(lake, "dev_etl.gold.test") == {"UK": "4", "US": "2", "NZ": "2", "DF": "2"}
    assert lake.read(LOG).count() == 6


def test_config_constraints_hold(demo):
    lake, path = demo
    with pytest.raises(ConstraintViolation, match="layer_allowed"):
        configure(lake, ("T", 1, "PLATINUM", "SQLLOAD", {"sql_path": path}, "", ""))


def test_failure_is_logged_and_stops_the_task(demo):
    lake, path = demo
    sql = {"sql_var": "silverload", "sql_parms": ""}
    config = configure(
        lake,
        ("T", 1, "SILVER", "SQLLOAD", {"sql_path": path}, None, ""),
        ("T", 2, "SILVER", "SQL", {"sql_var": "nothing", "sql_parms": ""}, "dev_etl.gold.test", ""),
        ("T", 10, "SILVER", "SQL", sql, "dev_etl.silver.test", ""),
    )
    with pytest.raises(StepFailed, match="no statement named nothing"):
        run_task(context(lake, config), "t", "silver")
    (row,) = lake.read(LOG).collect()
    assert (row.etls_status, row.etls_prev_ver, row.etls_new_ver, row.etls_rows_inserted) == ("FAILED", 0, None, 0)
    assert lake.read("dev_etl.silver.test").count() == 0
    # In text order '10' runs before '2', so the good step is done before the bad one fails.
    with pytest.raises(StepFailed):
        run_task(context(lake, config, numeric_order=False, log_loads=False), "t", "silver")
    assert lake.read("dev_etl.silver.test").count() == 5
    assert lake.read(LOG).count() == 1


def test_a_later_library_replaces_the_first(demo, scratch):
    lake, path = demo
    other = scratch("library")
    lake.spark.createDataFrame([('x = """select 1"""',)], "value STRING").coalesce(1).write.text(other)
    config = configure(
        lake,
        ("T", 1, "SILVER", "SQLLOAD", {"sql_path": path}, "", ""),
        ("T", 2, "SILVER", "SQLLOAD", {"sql_path": other}, "", ""),
        ("T", 3, "SILVER", "SQL", {"sql_var": "silverload", "sql_parms": ""}, "dev_etl.silver.test", ""),
    )
    with pytest.raises(StepFailed, match="no statement named silverload"):
        run_task(context(lake, config), "T", "SILVER")


@pytest.mark.parametrize(
    "step, message",
    [
        (("T", 1, "GOLD", "SQL", {"sql_var": " ", "sql_parms": ""}, "dev_etl.gold.test", ""), "sql_var is missing"),
        (("T", 1, "GOLD", "SQL", {"sql_var": "x"}, "dev_etl.gold.test", ""), "sql_parms is missing"),
        (("T", 1, "GOLD", "NOTEBOOK", {}, "dev_etl.gold.test", ""), "notebook_path is missing"),
        (("T", 1, "GOLD", "NOTEBOOK", {"notebook_path": "x/none"}, "dev_etl.gold.test", ""), "no job is registered"),
        (("T", 1, "GOLD", "SQLLOAD", {"sql_path": "/no/such/file"}, "", ""), "does not exist"),
    ],
)
def test_incomplete_steps_fail(demo, step, message):
    lake, _ = demo
    with pytest.raises(StepFailed, match=message):
        run_task(context(lake, configure(lake, step)), "T", "GOLD")


def test_statements_of_each_kind(demo):
    lake, _ = demo
    target = "dev_etl.silver.test"
    run_statement(lake, "insert into dev_etl.silver.test select * from dev_etl.bronze.test", target, "", {})
    by_name = "INSERT INTO dev_etl.gold.test BY NAME SELECT '9' AS dgt_count, 'XX' AS dgt_country"
    run_statement(lake, by_name, "dev_etl.gold.test", "", {})
    assert as_dict(lake, "dev_etl.gold.test") == {"XX": "9"}
    done = run_statement(lake, "DELETE FROM dev_etl.silver.test WHERE dst_age > 40;", target, "", {})
    assert done.row_counts == (0, 0, 2)
    done = run_statement(lake, "dst_country = 'UK'", target, "", {"op": "UPDATE", "set": {"dst_age": "dst_age + 1"}})
    assert done.row_counts == (0, 4, 0)
    source = "SELECT dst_id, 'M' AS dst_name FROM dev_etl.silver.test WHERE dst_country = 'US' UNION ALL SELECT '99', 'N'"
    done = run_statement(lake, source, target, "", {"op": "merge", "keys": ["dst_id"]})
    assert done.row_counts == (1, 2, 0)
    done = run_statement(lake, "VALUES ('A', '1')", None, "", {})
    assert done is None
    overwrite = "INSERT OVERWRITE TABLE dev_etl.gold.test (dgt_country, dgt_count) VALUES ('A', '1')"
    assert run_statement(lake, overwrite, "dev_etl.gold.test", "", {}).row_counts == (1, 0, 0)
    assert as_dict(lake, "dev_etl.gold.test") == {"A": "1"}


def test_names_in_literals_and_comments_stay(demo):
    lake, _ = demo
    text = r"""SELECT 'dev_etl.bronze.test' AS a, "x''dev_etl.bronze.test" AS b, r'\' AS c, 'it\'s dev_etl.bronze.test' AS d
    FROM `dev_etl`.`bronze`.`test` /* dev_etl.bronze.test */ LIMIT 1 -- dev_etl.bronze.test"""
    assert tuple(lake_sql(lake, text).first()) == ("dev_etl.bronze.test", "x''dev_etl.bronze.test", "\\", "it's dev_etl.bronze.test")
    insert = "-- a note\n/* more */ INSERT INTO dev_etl.silver.test SELECT * FROM dev_etl.bronze.test"
    assert run_statement(lake, insert, "dev_etl.silver.test", "", {}).row_counts == (8, 0, 0)


def test_a_name_that_two_files_define_is_refused(demo, scratch):
    lake, _ = demo
    folder = scratch("library")
    text = '{} = """INSERT INTO dev_etl.gold.test VALUES (1, 1)"""'
    lake.spark.createDataFrame([(text.format(n),) for n in ("q", "q", "other")], "value STRING").repartition(3).write.option("maxRecordsPerFile", 1).text(folder)
    steps = [("T", 1, "GOLD", "SQLLOAD", {"sql_path": folder}, "", "")]
    steps += [("T", k, "GOLD", "SQL", {"sql_var": v, "sql_parms": ""}, "dev_etl.gold.test", "") for k, v in ((2, "other"), (3, "q"))]
    with pytest.raises(StepFailed, match="several files define the statement q"):
        run_task(context(lake, configure(lake, *steps)), "T", "GOLD")
    assert lake.read("dev_etl.gold.test").count() == 1


@pytest.mark.parametrize("text", ["DROP TABLE dev_etl.gold.test", "CREATE TABLE x AS SELECT 1", "OPTIMIZE x"])
def test_other_statements_are_refused_before_they_run(demo, text):
    lake, _ = demo
    with pytest.raises(StepFailed, match="must be a query"):
        run_statement(lake, text, "dev_etl.gold.test", "", {})
    with pytest.raises(StepFailed, match="target is"):
        run_statement(lake, "INSERT INTO dev_etl.silver.test VALUES (1)", "dev_etl.gold.test", "", {})


def test_partition_overwrite_step(spark, lake):
    schema = spark.createDataFrame([], "day STRING, n INT").schema
    ensure_tables(lake, [TableSpec("d.s.days", schema, partition_by=["day"])])
    append_select(rows_df(spark, [("a", 1), ("b", 2)], "x STRING, y INT"), lake.table("d.s.days"))
    details = {"partition_overwrite": True}
    run_statement(lake, "INSERT INTO d.s.days SELECT 'b', 20", "d.s.days", "OVERWRITE", details)
    assert as_dict(lake, "d.s.days") == {"a": 1, "b": 20}


def test_lake_sql_takes_named_values(demo):
    lake, _ = demo
    text = "SELECT count(*) AS n FROM dev_etl.bronze.test t WHERE t.test_country = :c"
    assert lake_sql(lake, text, {"c": "UK"}).first().n == 4


def test_storage_location_places_the_target(spark, scratch):
    from lakeops.sources.control import storage_locations
    from lakeops.sources.snapshot import Lake

    elsewhere = scratch("elsewhere")
    config = rows_df(
        spark,
        [("D.s.far", f" {elsewhere} "), ("d.s.near", ""), (None, elsewhere)],
        "emc_target STRING, emc_target_storage_loc STRING",
    )
    lake = Lake(spark, scratch("root"), storage_locations(config))
    assert lake.locations == {"d.s.far": elsewhere}
    assert lake.table("d.s.far").base.startswith(elsewhere)
    assert not lake.table("d.s.near").base.startswith(elsewhere)
