"""Data-quality checks: one pass over a table reports every broken rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.names import classify_name
from lakeops.functions.params import detail, has_detail
from lakeops.operators.landing import landed
from lakeops.operators.writes import append, identity_column, is_parquet_scan, prepare_append, publish_append, with_dense_ids
from lakeops.paths import delete
from lakeops.session import scratch_path
from lakeops.sources.snapshot import CommitResult, ConstraintViolation, SnapshotTable

# A check is a condition that is true on a broken row.


class QualityGateFailed(ValueError):
    """Rows broke a check and the gate was set to raise."""


def in_set(col: str, values: Sequence) -> Column:
    """Broken when the value is not allowed; NULL passes, as in a SQL CHECK."""
    return F.coalesce(~F.col(col).isin(*values), F.lit(False))


def not_null(col: str) -> Column:
    return F.col(col).isNull()


def sql_check(rule: str) -> Column:
    """Broken when a SQL CHECK expression is false; NULL passes."""
    return ~F.coalesce(F.expr(rule), F.lit(True))


def with_broken_rules(df: DataFrame, checks: Mapping[str, Column], name: str = "broken_rules") -> DataFrame:
    """Add the array of broken rule names (empty on a good row)."""
    flags = [F.when(F.coalesce(broken, F.lit(False)), F.lit(rule)) for rule, broken in checks.items()]
    return df.withColumn(name, F.array_compact(F.array(*flags)))


def violations(df: DataFrame, checks: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """One row per broken rule and row: the kept columns plus ``rule``."""
    return with_broken_rules(df, checks, "lk_rules").select(*keep, F.explode("lk_rules").alias("rule"))


def violation_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows broken per rule, all rules in one scan: columns rule, row_count."""
    totals = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(rule) for rule, c in checks.items()])
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("row_count")) for rule in checks])
    return totals.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def gate(df: DataFrame, checks: Mapping[str, Column], on_fail: str = "raise") -> tuple[DataFrame, DataFrame | None]:
    """Pass the frame on when no check fires; else raise, or split it into (good, bad with reasons).

    ``on_fail`` is "raise" or "quarantine".
    """
    if on_fail == "quarantine":
        flagged = with_broken_rules(df, checks)
        good = flagged.where(F.size("broken_rules") == 0).drop("broken_rules")
        return good, flagged.where(F.size("broken_rules") > 0)
    if on_fail != "raise":
        raise ValueError(f"on_fail must be raise or quarantine, not {on_fail!r}")
    broken = {row.rule: row.row_count for row in violation_counts(df, checks).collect() if row.row_count}
    if broken:
        raise QualityGateFailed(", ".join(f"{rule}: {count} rows" for rule, count in sorted(broken.items())))
    return df, None


def append_gated(
    df: DataFrame, target: SnapshotTable, checks: Mapping[str, Column], quarantine: SnapshotTable | None = None
) -> tuple[CommitResult, CommitResult | None]:
    """Append good rows; broken rows go to the quarantine table, or fail the append when there is none.

    Without a quarantine table the checks ride on the write, so the rows are read once. With one the flagged rows are
    written once to the shared folder and both appends read them there, so a source that gives other rows each time
    neither loses nor repeats any.
    """
    if quarantine is None:
        try:
            return append(df, target, checks=checks), None
        except ConstraintViolation as broken:
            raise QualityGateFailed(str(broken)) from broken
    flagged, path = landed(with_broken_rules(df, checks), "gated")
    try:
        good = flagged.where(F.size("broken_rules") == 0).drop("broken_rules")
        bad = flagged.where(F.size("broken_rules") > 0)
        if identity_column(target.state()):
            return append(good, target), append(bad, quarantine, merge_schema=True)
        # both are written before either is committed, so that a write that fails leaves neither behind
        kept, held = prepare_append(good, target), prepare_append(bad, quarantine, merge_schema=True)
        return publish_append(target, kept), publish_append(quarantine, held)
    finally:
        delete(df.sparkSession, path)


def check_steps(config: DataFrame) -> DataFrame:
    """Config rows whose details do not fit their function type: emc_id, emc_task_id, emc_seq, problem."""
    return with_step_problem(config).where("problem IS NOT NULL").select(
        "emc_id", "emc_task_id", "emc_seq", "emc_func_type", "problem"
    )


def with_step_problem(config: DataFrame) -> DataFrame:
    """Add ``problem``: what is wrong with the details of a step, NULL when nothing is."""
    is_text = config.schema["emc_func_dtls"].dataType.simpleString() == "string"
    details = F.try_parse_json("emc_func_dtls") if is_text else F.col("emc_func_dtls")
    kind = F.upper("emc_func_type")

    def blank(key: str) -> Column:
        return F.trim(F.coalesce(detail(details, key), F.lit(""))) == ""

    problem = (
        F.when(details.isNull(), "details are not JSON")
        .when((kind == "SQL") & blank("sql_var"), "sql_var is missing")
        .when((kind == "SQL") & ~has_detail(details, "sql_parms"), "sql_parms is missing")
        .when((kind == "SQLLOAD") & blank("sql_path"), "sql_path is missing")
        .when((kind == "NOTEBOOK") & blank("notebook_path"), "notebook_path is missing")
        .when(F.coalesce(~kind.isin("SQL", "SQLLOAD", "NOTEBOOK"), F.lit(True)), "function type is not known")
    )
    return config.withColumn("problem", problem)


def check_rules(rules: DataFrame) -> DataFrame:
    """Active maintenance rules whose name is not 1 to 3 dotted parts."""
    return (
        rules.where("tmc_active_flag = 'Y'")
        .where(classify_name(F.col("tmc_name")) == "INVALID")
        .select("tmc_id", "tmc_name")
    )


def assign_ids(df: DataFrame, id_col: str, start: int = 0, order: Sequence[str] | None = None) -> DataFrame:
    """Dense ids start+1, start+2, … without a single-task sort.

    A Parquet scan is numbered as it lies; other rows are written once to the shared folder. A row's address (file and
    position) is fixed from then on, so lost tasks recompute the same ids. With ``order`` the rows are range-partitioned by the order columns
    plus that address, which also cuts a value, or a pile of equal rows, that is too large for one task. An id is
    the number of rows in the parts before plus the position within the part.
    """
    spark = df.sparkSession
    columns = df.columns
    rows = df if is_parquet_scan(df) else landed(df, "ids-input")[0]
    if not order:
        return with_dense_ids(rows, id_col, start)
    address = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    keyed = rows.select(*columns, address.alias("lk_address"))
    rows = keyed.repartitionByRange(*order, "lk_address").sortWithinPartitions(*order, "lk_address")
    position = F.monotonically_increasing_id()
    parts = rows.select(
        *columns,
        F.shiftright(position, 33).cast("int").alias("lk_part"),
        position.bitwiseAND(F.lit((1 << 33) - 1)).alias("lk_pos"),
    )
    path = scratch_path(spark, "ids")
    parts.write.parquet(path)
    placed = spark.read.schema(parts.schema).parquet(path)
    sizes = placed.groupBy("lk_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("lk_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    # a row per write task, sent to all: a shuffle would bring the rows of a part to one task
    numbered = placed.join(F.broadcast(sizes.select("lk_part", (before + start).alias("lk_before"))), "lk_part")
    return numbered.select((F.col("lk_before") + F.col("lk_pos") + 1).alias(id_col), *columns)
