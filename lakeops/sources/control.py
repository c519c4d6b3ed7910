"""Schemas of the control and log tables, and the scans over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.writes import TableSpec


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "variant": T.VariantType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _fields(text: str) -> T.StructType:
    """``name type [required]`` per line."""
    fields = []
    for line in text.strip().splitlines():
        name, type_name, *rest = line.split()
        fields.append(T.StructField(name, _TYPES[type_name], not rest))
    return T.StructType(fields)


# Column names, types and required columns of the four control tables.
CONFIG_SCHEMA = _fields(
    """
    emc_id bigint
    emc_task_id string required
    emc_seq string required
    emc_target_layer string required
    emc_func_type string required
    emc_func_dtls variant required
    emc_target string
    emc_out_mode string
    emc_table_retention int
    emc_target_storage_loc string
    emc_active string required
    emc_desc string
    """
)
# Row counts are BIGINT: one load of a large table overflows INT.
LOAD_STATUS_SCHEMA = _fields(
    """
    etls_log_id string
    etls_load_date date required
    etls_catalog string
    etls_schema string
    etls_table_name string required
    etls_prev_ver bigint
    etls_new_ver bigint
    etls_rows_inserted bigint
    etls_rows_updated bigint
    etls_rows_deleted bigint
    etls_jobname string
    etls_jobrunid string
    etls_jobid string
    etls_taskrunid string
    etls_taskname string
    etls_notebook string
    etls_run_by string
    etls_end_timestamp timestamp
    etls_start_timestamp timestamp
    etls_status string required
    """
)
RULES_SCHEMA = _fields(
    """
    tmc_id bigint
    tmc_group_id int
    tmc_inc_excl_flag string required
    tmc_freq string required
    tmc_name string required
    tmc_opt_zorder_cols array<string>
    tmc_vac_retention_hours int
    tmc_description string
    tmc_active_flag string
    """
)
MAINT_LOG_SCHEMA = _fields(
    """
    tml_uuid string
    tml_timestamp timestamp
    tml_operation string
    tml_catalog_name string
    tml_schema_name string
    tml_table_name string
    tml_status string
    tml_error_message string
    tml_run_by string
    tml_start_ts timestamp
    tml_end_ts timestamp
    tml_job_id string required
    tml_job_name string required
    tml_job_run_id string required
    tml_task_run_id string required
    tml_task_name string required
    tml_file_count_before int
    tml_file_count_after int
    """
)

# What the control columns may hold.
LAYERS = ("BRONZE", "SILVER", "GOLD")
FUNC_TYPES = ("SQLLOAD", "NOTEBOOK", "SQL")
OUT_MODES = ("", "APPEND", "OVERWRITE")
YES_NO = ("Y", "N")
INCLUDE_EXCLUDE = ("I", "E")
FREQUENCIES = ("DAILY", "WEEKLY", "MONTHLY", "MANUAL")


def _one_of(column: str, values: tuple) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def config_spec(name: str) -> TableSpec:
    return TableSpec(
        name,
        CONFIG_SCHEMA,
        comment="Steps to run per task and layer",
        cluster_by=("emc_task_id", "emc_target_layer", "emc_func_type", "emc_active"),
        constraints={
            "layer_allowed": _one_of("emc_target_layer", LAYERS),
            "func_type_allowed": _one_of("emc_func_type", FUNC_TYPES),
            "out_mode_allowed": _one_of("emc_out_mode", OUT_MODES),
            "active_allowed": _one_of("emc_active", YES_NO),
        },
        identity="emc_id",
    )


def load_status_spec(name: str) -> TableSpec:
    return TableSpec(
        name,
        LOAD_STATUS_SCHEMA,
        comment="One row per executed step with a target",
        cluster_by=("etls_catalog", "etls_schema", "etls_table_name", "etls_status"),
        properties={"optimize_write": "true", "auto_compact": "true"},
    )


def rules_spec(name: str) -> TableSpec:
    return TableSpec(
        name,
        RULES_SCHEMA,
        comment="Include and exclude rules for table maintenance",
        constraints={
            "flag_allowed": _one_of("tmc_inc_excl_flag", INCLUDE_EXCLUDE),
            "freq_allowed": _one_of("tmc_freq", FREQUENCIES),
            "active_allowed": _one_of("tmc_active_flag", YES_NO),
        },
        identity="tmc_id",
    )


def maint_log_spec(name: str) -> TableSpec:
    return TableSpec(name, MAINT_LOG_SCHEMA, comment="One row per maintenance operation")


def read_steps(config: DataFrame, task: str, layer: str, numeric: bool = True) -> DataFrame:
    """Active steps of one task and layer in run order. The arguments are upper-cased, stored values are not."""
    mine = (
        (F.col("emc_task_id") == task.upper())
        & (F.col("emc_target_layer") == layer.upper())
        & (F.col("emc_active") == "Y")
    )
    return order_steps(config.where(mine), numeric)


def step_order(numeric: bool = True) -> list[Column]:
    """Sort columns of the run order. The sequence is text; by default '2' comes before '10', else after it."""
    return [F.col("emc_seq").try_cast("int"), F.col("emc_seq")] if numeric else [F.col("emc_seq")]


def order_steps(steps: DataFrame, numeric: bool = True) -> DataFrame:
    return steps.orderBy(*step_order(numeric))


def read_rules(rules: DataFrame, group_id: int | None = None) -> DataFrame:
    """Active maintenance rules, of one group when given."""
    active = rules.where("tmc_active_flag = 'Y'")
    return active if group_id is None else active.where(F.col("tmc_group_id") == group_id)


HOURS_PER_MONTH = 730


def retention_rules(config: DataFrame, freq: str = "MONTHLY") -> DataFrame:
    """Maintenance rules for the targets of active steps that name a retention (months), one per target.

    The longest retention of a target counts. Union them with the control table's rules to have the retention of the
    step table drive the vacuum.
    """
    kept = config.where("emc_active = 'Y' AND emc_table_retention IS NOT NULL AND trim(emc_target) <> ''")
    longest = kept.groupBy(F.lower(F.trim("emc_target")).alias("tmc_name")).agg(
        F.min("emc_id").alias("tmc_id"), F.max("emc_table_retention").alias("months")
    )
    values = {
        "tmc_id": F.col("tmc_id"),
        "tmc_inc_excl_flag": F.lit("I"),
        "tmc_freq": F.lit(freq),
        "tmc_name": F.col("tmc_name"),
        "tmc_vac_retention_hours": F.col("months") * HOURS_PER_MONTH,
        "tmc_active_flag": F.lit("Y"),
    }
    return longest.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RULES_SCHEMA.fields]
    )


def storage_locations(config: DataFrame) -> dict[str, str]:
    """Root folder of each target that names one, for ``Lake(locations=...)``; a few config rows are collected."""
    placed = config.where("trim(emc_target_storage_loc) <> '' AND trim(emc_target) <> ''")
    rows = placed.select(F.lower(F.trim("emc_target")).alias("t"), F.trim("emc_target_storage_loc").alias("p"))
    return {row.t: row.p for row in rows.distinct().collect()}
