"""Appends, overwrites and table definitions over versioned tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.changes import touched_files, without_files
from lakeops.operators.landing import landed
from lakeops.operators.schemas import merge_schemas
from lakeops.operators.upkeep import by_range, compact
from lakeops.paths import delete
from lakeops.sources.snapshot import CommitConflict, CommitResult, Lake, SnapshotTable, schema_of


def rows_df(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """Literal rows as a DataFrame (for control data, not for data tables)."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def _fit(df: DataFrame, state: Row, merge_schema: bool) -> tuple[DataFrame, Row]:
    """Match a frame to the table by name; new columns are added or refused."""
    schema = schema_of(state)
    known = {name.lower() for name in schema.names}
    extra = [name for name in df.columns if name.lower() not in known]
    if extra and not merge_schema:
        raise ValueError(f"columns not in the table: {', '.join(extra)}")
    if merge_schema:
        merged = merge_schemas(schema, df.schema)
        state = Row(**{**state.asDict(), "schema_json": merged.json()})
        schema = merged
    return df.to(schema), state


# Defaults of ``append``: how often it follows other writers, and of ``auto_compact``: the live entries at which it sets in.
_APPEND_ATTEMPTS = 50
_AUTO_COMPACT_AT = 50


def _auto_compact(target: SnapshotTable, state: Row) -> None:
    """Merge the files of many small appends, for tables with the property ``auto_compact``."""
    wanted = dict(state.properties or {}).get("auto_compact") == "true"
    if wanted and len(state.live) >= _AUTO_COMPACT_AT:
        try:
            compact(target)
        except CommitConflict:
            pass  # someone else is writing; a later append tries again


def _definition(state: Row) -> tuple:
    return state.schema_json, state.partition_by, state.constraints


def append(
    df: DataFrame,
    target: SnapshotTable,
    merge_schema: bool = False,
    operation: str = "WRITE",
    txn: tuple[str, int] | None = None,
    checks: Mapping[str, Column] | None = None,
    attempts: int = _APPEND_ATTEMPTS,
) -> CommitResult:
    """Add rows, columns matched by name; columns the frame lacks become NULL, but for the table's identity column.

    ``checks`` are counted while the rows are written; when one fires nothing is committed. Other writers' commits are followed up to
    ``attempts`` times.
    """
    identity = identity_column(target.state())
    if identity and identity.lower() not in {name.lower() for name in df.columns}:
        return _append_numbered(df, target, identity, merge_schema, operation, txn, checks, attempts)
    return publish_append(target, prepare_append(df, target, merge_schema, checks), operation, txn, attempts)


@dataclass(frozen=True)
class PreparedAppend:
    """Rows that are written but belong to no version yet: the version they were written for, the one they make and their folder."""

    base: Row
    state: Row
    entry: str
    rows: int


def prepare_append(
    df: DataFrame, target: SnapshotTable, merge_schema: bool = False, checks: Mapping[str, Column] | None = None
) -> PreparedAppend:
    base = target.state()
    fitted, state = _fit(df, base, merge_schema)
    entry, counts = target.write_folder(fitted, state, checks=checks)
    return PreparedAppend(base, state, entry, counts["rows_written"])


def publish_append(
    target: SnapshotTable,
    done: PreparedAppend,
    operation: str = "WRITE",
    txn: tuple[str, int] | None = None,
    attempts: int = _APPEND_ATTEMPTS,
) -> CommitResult:
    """Commit prepared rows, after other writers' commits if need be."""
    state, added, metrics = done.state, [done.entry] if done.rows else [], {"numOutputRows": done.rows}
    for _ in range(attempts):
        try:
            result = target.commit(state.version, state, operation, metrics, [*state.live, *added], txn)
            _auto_compact(target, state)
            return result
        except CommitConflict:
            # An append depends on no other row, so it can follow any commit that kept the table's definition.
            newest = target.state()
            if _definition(newest) != _definition(done.base):
                raise
            state = Row(**{**newest.asDict(), "schema_json": done.state.schema_json})
    raise CommitConflict(f"{target.name}: other writers committed first {attempts} times")


def identity_column(state: Row) -> str | None:
    """The column that appends number where they do not give it themselves."""
    return dict(state.properties or {}).get("identity")


_HIGH_WATER = "identity_last"


def _last_id(target: SnapshotTable, state: Row, column: str) -> int:
    """The largest id ever given, also where its row has been deleted since."""
    kept = int(dict(state.properties or {}).get(_HIGH_WATER, 0))
    return max(kept, target.read_state(state).agg(F.max(f"`{column}`")).first()[0] or 0)


def is_parquet_scan(df: DataFrame) -> bool:
    """Whether a frame is nothing but Parquet files, so that its rows have fixed addresses."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation" and "Parquet" in plan.relation().fileFormat().getClass().getSimpleName()


def with_dense_ids(rows: DataFrame, column: str, after: int) -> DataFrame:
    """Rows of Parquet files with the ids after + 1, after + 2, … in order of file and place.

    An id is the number of rows in the files before, from their footers, plus the row's place in its file. The table of files, a row
    per file, is sent to every task: joined by a shuffle, all rows of a file would meet in one.
    """
    file = F.col("_metadata.file_path")
    files = rows.groupBy(file.alias("lk_file")).agg(F.count(F.lit(1)).alias("lk_rows"))
    before = F.sum("lk_rows").over(Window.orderBy("lk_file").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("lk_rows")
    files = files.select("lk_file", before.alias("lk_before"))
    names = [F.col(f"`{name}`") for name in rows.columns]
    placed = rows.select(*names, file.alias("lk_file"), F.col("_metadata.row_index").alias("lk_place")).join(F.broadcast(files), "lk_file")
    return placed.select((F.lit(after) + F.col("lk_before") + F.col("lk_place") + 1).cast("bigint").alias(column), *names)


def _append_numbered(df, target, column, merge_schema, operation, txn, checks, attempts) -> CommitResult:
    """Append with dense ids on from the largest id ever given. Files are numbered as they lie, in one write; any other frame is
    landed first, so that a task that runs again numbers the same rows. When another writer commits first, the rows are numbered anew."""
    rows, landed_at = (df, None) if is_parquet_scan(df) else landed(df, "identity")
    try:
        for _ in range(attempts):
            base = target.state()
            last = _last_id(target, base, column)
            fitted, state = _fit(with_dense_ids(rows, column, last), base, merge_schema)
            entry, counts = target.write_folder(fitted, state, checks=checks)
            written = counts["rows_written"]
            state = Row(**{**state.asDict(), "properties": {**(state.properties or {}), _HIGH_WATER: str(last + written)}})
            try:
                return target.commit(state.version, state, operation, {"numOutputRows": written}, [*state.live, *([entry] if written else [])], txn)
            except CommitConflict:
                delete(target.spark, f"{target.data_dir}/{entry}")
        raise CommitConflict(f"{target.name}: other writers committed first {attempts} times")
    finally:
        if landed_at:
            delete(target.spark, landed_at)


append_by_name = append


def append_select(df: DataFrame, target: SnapshotTable, columns: Sequence[str] | None = None) -> CommitResult:
    """Add rows by position, as INSERT INTO t (columns) SELECT does; columns not listed become NULL."""
    names = list(columns) if columns else schema_of(target.state()).names
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} target columns but the query gives {len(df.columns)}")
    return append(df.toDF(*names), target)


def overwrite(
    df: DataFrame,
    target: SnapshotTable,
    partition: Mapping[str, object] | None = None,
    merge_schema: bool = False,
    operation: str = "WRITE",
    txn: tuple[str, int] | None = None,
    dynamic: bool = False,
) -> CommitResult:
    """Replace all rows, or only some partitions.

    ``partition`` names the partition column values to replace (rows outside them are refused); ``dynamic`` replaces
    the partitions the new rows fall in. The files of other partitions stay live untouched, so a rerun of one load
    date neither reads nor rewrites any other date.
    """
    state = target.state()
    fitted, state = _fit(df, state, merge_schema)
    kept: list[str] = []
    dropped: list[str] = []
    if partition:
        missing = [name for name in partition if name not in (state.partition_by or [])]
        if missing:
            raise ValueError(f"not partition columns of {target.name}: {', '.join(missing)}")
        inside = F.lit(True)
        for name, value in partition.items():
            inside = inside & F.col(name).eqNullSafe(F.lit(value))
        stray = F.count_if(~inside)
        kept, dropped = without_files(target, state, touched_files(target, state, inside))
        entry, counts = target.write_folder(fitted, state, counts={"stray": stray})
        if counts["stray"]:
            raise ValueError(f"{counts['stray']} rows lie outside {dict(partition)}; nothing was committed")
    else:
        entry, counts = target.write_folder(fitted, state)
        if dynamic and state.partition_by:
            new = {_partition_folder(e) for e in target.files_below([entry], schema_of(state))}
            replaced = [e for e in target.live_files(state) if _partition_folder(e) in new]
            kept, dropped = without_files(target, state, replaced)
    live = [*kept, entry] if counts["rows_written"] else kept
    metrics = {"numOutputRows": counts["rows_written"]}
    return target.commit(state.version, state, operation, metrics, live, txn, dropped)


def _partition_folder(entry: str) -> str:
    return "/".join(entry.split("/")[1:-1])


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], parts: int | None = None) -> None:
    """Write in ``parts`` files (the shuffle partitions by default), each a range of the keys and sorted by them.

    Equal keys lie in one file, unless a key has more rows than an average file. ``df`` is read three times (to count keys, to
    sample the ranges' bounds, to write), so it should be a scan or something as cheap.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_range(df, keys, parts, F.monotonically_increasing_id()).write.parquet(path)


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    comment: str = ""
    partition_by: Sequence[str] = ()
    cluster_by: Sequence[str] = ()
    constraints: Mapping[str, str] = field(default_factory=dict)
    properties: Mapping[str, str] = field(default_factory=dict)
    identity: str | None = None

    def all_constraints(self) -> dict[str, str]:
        required = {f"{f.name}_required": f"`{f.name}` IS NOT NULL" for f in self.schema.fields if not f.nullable}
        return {**required, **dict(self.constraints)}

    def all_properties(self) -> dict[str, str]:
        extra = {"comment": self.comment} if self.comment else {}
        if self.identity:
            extra["identity"] = self.identity
        return {**dict(self.properties), **extra}


def ensure_tables(lake: Lake, specs: Iterable[TableSpec], replace: bool = False) -> list[str]:
    """Create the tables that are missing (or all, emptied, with ``replace``); names of the ones made."""
    made = []
    for spec in specs:
        table = lake.table(spec.name)
        if table.exists() and not replace:
            continue
        table.create(
            spec.schema,
            spec.partition_by,
            spec.cluster_by,
            spec.all_constraints(),
            spec.all_properties(),
            replace=replace,
        )
        made.append(table.name)
    return made


def describe_tables(lake: Lake, names: Iterable[str]) -> DataFrame:
    """Column list of some tables as a DataFrame: table, position, column, type, comment."""
    rows = []
    for name in names:
        for position, f in enumerate(schema_of(lake.table(name).state()).fields):
            rows.append((name.lower(), position, f.name, f.dataType.simpleString(), f.metadata.get("comment", "")))
    return lake.spark.createDataFrame(
        rows, "table_name STRING, position INT, column_name STRING, type_name STRING, comment STRING"
    )


def ensure_catalog_tables(
    spark: SparkSession, specs: Iterable[TableSpec], replace: bool = False, location: str | None = None
) -> None:
    """The same definitions as Parquet tables of the session catalog (last two name parts).

    ``location`` is where schemas that do not exist yet are placed.
    """
    placed = f" LOCATION '{location}'" if location else ""
    for spec in specs:
        schema_name, table_name = spec.name.split(".")[-2:]
        full = f"`{schema_name}`.`{table_name}`"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema_name}`{placed}")
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
        comment = spec.comment.replace("'", "''")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet COMMENT '{comment}'")
