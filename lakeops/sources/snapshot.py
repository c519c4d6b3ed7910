"""Versioned Parquet tables: immutable commit folders plus one small log row per version.

``data/lk_commit=<version>-<token>/`` holds the files one commit wrote and is never changed afterwards.
``log/<version>.json`` holds one row: operation, metrics, schema and ``live``, the folders that make up the table at
that version. Where only part of a folder is still current, the smaller side is listed: its files in ``dropped``
beside the folder, or the files left as ``live`` entries of their own. File entries are URL-encoded, as Spark shows
them in ``_metadata.file_path``. Reading a version is a plain
``spark.read.parquet`` over its live entries, so partition pruning, filter pushdown and column pruning are Spark's
own. A version file is created only when it does not exist, so of two writers the second fails and can try again.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql.classic.column import Column as ClassicColumn
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops import paths

COMMIT_KEY = "lk_commit"

LOG_SCHEMA = (
    "version BIGINT, operation STRING, metrics MAP<STRING,BIGINT>, live ARRAY<STRING>, dropped ARRAY<STRING>, "
    "schema_json STRING, "
    "partition_by ARRAY<STRING>, cluster_by ARRAY<STRING>, constraints MAP<STRING,STRING>, "
    "properties MAP<STRING,STRING>, batches MAP<STRING,BIGINT>, committed_at TIMESTAMP"
)

# Operation names and the metric each one reports as inserted, updated and deleted rows.
OPERATION_METRICS = {
    "WRITE": ("numOutputRows", None, None),
    "STREAMING UPDATE": ("numOutputRows", None, None),
    "DELETE": (None, None, "numDeletedRows"),
    "UPDATE": (None, "numUpdatedRows", None),
    "MERGE": ("numTargetRowsInserted", "numTargetRowsUpdated", "numTargetRowsDeleted"),
}
# Commits that change the layout or the definition but no rows.
LAYOUT_OPERATIONS = ("CREATE TABLE", "REPLACE TABLE", "OPTIMIZE")


class ConstraintViolation(ValueError):
    """Rows break a table constraint; nothing was committed."""


class CommitConflict(RuntimeError):
    """Another writer committed first; the rows of this one are not part of the table."""


class UnknownOperation(ValueError):
    """The operation is not one of the change-tracked writes."""


@dataclass(frozen=True)
class CommitResult:
    operation: str
    prev_version: int
    version: int
    metrics: dict = field(default_factory=dict)

    @property
    def row_counts(self) -> tuple[int, int, int]:
        return row_counts(self.operation, self.metrics)


def row_counts(operation: str, metrics: Mapping[str, int]) -> tuple[int, int, int]:
    """(inserted, updated, deleted) of one commit."""
    if operation not in OPERATION_METRICS:
        raise UnknownOperation(f"no row counts for operation {operation!r}")
    return tuple(int(metrics.get(name, 0)) if name else 0 for name in OPERATION_METRICS[operation])


def entry_of(uri: Column) -> Column:
    """Entry of a file (the part below ``data/``) from ``_metadata.file_path``."""
    return F.substring_index(uri, "/data/", -1)


def among(spark: SparkSession, column: Column, entries: Sequence[str]) -> Column:
    """Whether a column is one of some entries. They go to the JVM as one text, not one literal each, and become a hash set there."""
    jvm = spark._jvm
    words = jvm.org.apache.commons.lang3.StringUtils.split("\n".join(entries), "\n")
    return ClassicColumn(column._jc.isInCollection(jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(words)))


def folder_of(entry: str) -> str:
    return entry.split("/", 1)[0]


class SnapshotTable:
    """One versioned table at a base path."""

    def __init__(self, spark: SparkSession, base: str, name: str | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self.name = name or self.base.rsplit("/", 1)[-1]
        self.data_dir = f"{self.base}/data"
        self.log_dir = f"{self.base}/log"

    # -- reading ---------------------------------------------------------------------------------------------

    def latest_version(self) -> int | None:
        row = self._newest()
        return None if row is None else row.version

    def exists(self) -> bool:
        return any(name.endswith(".json") for name in paths.child_names(self.spark, self.log_dir))

    def _log_file(self, version: int) -> str:
        return f"{self.log_dir}/{version:012d}.json"

    def _log_row(self, version: int) -> Row | None:
        """One log row; None when its writer did not finish it."""
        text = paths.read_text(self.spark, self._log_file(version))
        return Row(**json.loads(text)) if text.endswith("\n") else None

    def _newest(self) -> Row | None:
        versions = [int(n[:-5]) for n in paths.child_names(self.spark, self.log_dir) if n.endswith(".json")]
        for version in sorted(versions, reverse=True):
            row = self._log_row(version)
            if row is not None:
                return row
        return None

    def state(self, version: int | None = None) -> Row:
        """The log row of one version, the newest by default. One small file is read, no Spark job is run."""
        if version is None:
            row = self._newest()
            if row is None:
                raise ValueError(f"table {self.name} does not exist at {self.base}")
            return row
        row = self._log_row(version) if paths.exists(self.spark, self._log_file(version)) else None
        if row is None:
            raise ValueError(f"table {self.name} has no version {version}")
        return row

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).json(self.log_dir)

    def history(self) -> DataFrame:
        """One row per version, newest first."""
        return (
            self.log()
            .select("version", "committed_at", "operation", "metrics", F.size("live").alias("live_entries"))
            .orderBy(F.desc("version"))
        )

    def schema(self, state: Row | None = None) -> T.StructType:
        return schema_of(self.state() if state is None else state)

    def _located(self, entry: str) -> str:
        return f"{self.data_dir}/{paths.literal(unquote(entry))}"

    def scan(self, entries: Sequence[str], schema: T.StructType, spark: SparkSession | None = None) -> DataFrame:
        """Raw scan of folders or files; keeps Spark's hidden ``_metadata`` column reachable."""
        reader = (spark or self.spark).read.schema(schema).option("basePath", self.data_dir)
        return reader.parquet(*[self._located(entry) for entry in entries])

    def scan_state(self, state: Row) -> DataFrame:
        """Raw scan of a version. Spark leaves out the dropped files when it plans the scan."""
        scan = self.scan(state.live, schema_of(state))
        return scan.where(~among(self.spark, entry_of(F.col("_metadata.file_path")), state.dropped)) if state.dropped else scan

    def read(self, version: int | None = None) -> DataFrame:
        return self.read_state(self.state(version))

    def read_state(self, state: Row) -> DataFrame:
        schema = schema_of(state)
        return _columns_of(self.scan_state(state), schema) if state.live else self._no_rows(schema)

    def read_entries(self, entries: Sequence[str], schema: T.StructType) -> DataFrame:
        return _columns_of(self.scan(entries, schema), schema) if entries else self._no_rows(schema)

    def _no_rows(self, schema: T.StructType) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def live_files(self, state: Row | None = None) -> list[str]:
        """Entries of the single files of a version, listed from storage (no data is read)."""
        state = self.state() if state is None else state
        gone = set(state.dropped)
        return [entry for entry in self.files_below(state.live, schema_of(state)) if entry not in gone]

    def files_below(self, entries: Sequence[str], schema: T.StructType) -> list[str]:
        if not entries:
            return []
        return sorted(uri.rsplit("/data/", 1)[1] for uri in self.scan(entries, schema).inputFiles())

    def file_sizes(self, state: Row | None = None) -> DataFrame:
        """(entry, length) of every live file as a DataFrame; the contents are not read."""
        state = self.state() if state is None else state
        if not state.live:
            return self.spark.range(0).selectExpr("cast(null as string) AS entry", "cast(null as bigint) AS length")
        files = paths.list_files(self.spark, *[self._located(entry) for entry in state.live])
        listed = files.where(F.col("path").endswith(".parquet")).select(entry_of(F.col("uri")).alias("entry"), "length")
        return listed.where(~among(self.spark, F.col("entry"), state.dropped)) if state.dropped else listed

    # -- writing ---------------------------------------------------------------------------------------------

    def create(
        self,
        schema: T.StructType,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        constraints: Mapping[str, str] | None = None,
        properties: Mapping[str, str] | None = None,
        replace: bool = False,
    ) -> CommitResult:
        """Version 0 of a new table, or a new empty version of an existing one with ``replace``."""
        latest = self.latest_version()
        if latest is not None and not replace:
            raise ValueError(f"table {self.name} exists")
        nullable = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
        definition = Row(
            schema_json=nullable.json(),
            partition_by=list(partition_by),
            cluster_by=list(cluster_by),
            constraints=dict(constraints or {}),
            properties=dict(properties or {}),
            batches={},
            dropped=[],
        )
        operation = "CREATE TABLE" if latest is None else "REPLACE TABLE"
        return self.commit(latest if latest is not None else -1, definition, operation, {}, [])

    def write_folder(
        self,
        df: DataFrame,
        state: Row,
        counts: Mapping[str, object] | None = None,
        cut=None,
        arranged: bool = False,
        checks: Mapping[str, Column] | None = None,
    ) -> tuple[str, dict]:
        """Write one new commit folder and return its entry with the counts taken on the way.

        ``counts`` are aggregates over ``df``; ``cut`` drops rows after they were counted; ``arranged`` says that the
        frame is already laid out for the partition columns; ``checks`` are conditions that are true on a broken row,
        as constraints are the other way round. The counts and the
        constraint checks ride on the write itself, in its last stage, where Spark counts each task once even when
        lost executors make it run again.
        """
        partition_by = list(state.partition_by or [])
        if partition_by and not arranged:
            # Adaptive execution cuts an oversized partition value into several tasks.
            df = df.hint("rebalance", *partition_by)
        elif not arranged and dict(state.properties or {}).get("optimize_write") == "true":
            df = df.hint("rebalance")
        broken = {
            name: ~F.coalesce(F.expr(rule), F.lit(True)) for name, rule in dict(state.constraints or {}).items()
        }
        broken.update({name: F.coalesce(rule, F.lit(False)) for name, rule in (checks or {}).items()})
        before = Observation(f"before-{uuid.uuid4().hex}") if counts else None
        after = Observation(f"after-{uuid.uuid4().hex}")
        if before is not None:
            df = df.observe(before, *[expr.alias(name) for name, expr in counts.items()])
        kept = df if cut is None else df.where(cut)
        tallies = [F.count_if(rule).alias(f"broken_{i}") for i, rule in enumerate(broken.values())]
        kept = kept.observe(after, F.count(F.lit(1)).alias("rows_written"), *tallies)
        kept = kept.select(*[F.col(f"`{name}`") for name in schema_of(state).names])
        entry = f"{COMMIT_KEY}={state.version + 1}-{uuid.uuid4().hex[:8]}"
        kept.write.partitionBy(*partition_by).parquet(f"{self.data_dir}/{entry}")
        taken = {**after.get, **(before.get if before is not None else {})}
        failed = [
            f"{name} ({taken[f'broken_{i}']} rows)"
            for i, name in enumerate(broken)
            if taken.get(f"broken_{i}", 0)
        ]
        if failed:
            raise ConstraintViolation(f"{self.name}: {', '.join(failed)}")
        return entry, {name: int(value or 0) for name, value in taken.items()}

    def commit(
        self,
        prev_version: int,
        definition: Row,
        operation: str,
        metrics: Mapping[str, int],
        live: Iterable[str],
        txn: tuple[str, int] | None = None,
        dropped: Iterable[str] = (),
    ) -> CommitResult:
        """Publish a version. Fails when the version is already taken.

        Files dropped before stay dropped as long as their folder is live.
        """
        if operation not in OPERATION_METRICS and operation not in LAYOUT_OPERATIONS:
            raise UnknownOperation(f"cannot commit operation {operation!r}")
        version = prev_version + 1
        live = sorted(live)
        folders = {entry for entry in live if "/" not in entry}
        row = {
            "version": version,
            "operation": operation,
            "metrics": {k: int(v) for k, v in metrics.items()},
            "live": live,
            "dropped": sorted({e for e in (*definition.dropped, *dropped) if folder_of(e) in folders}),
            "schema_json": definition.schema_json,
            "partition_by": list(definition.partition_by or []),
            "cluster_by": list(definition.cluster_by or []),
            "constraints": dict(definition.constraints or {}),
            "properties": dict(definition.properties or {}),
            "batches": {**(definition.batches or {}), **({txn[0]: txn[1]} if txn else {})},
            "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        }
        if not paths.write_new(self.spark, self._log_file(version), json.dumps(row) + "\n"):
            raise CommitConflict(f"{self.name}: version {version} was committed by another writer")
        return CommitResult(operation, prev_version, version, dict(metrics))


def _columns_of(scan: DataFrame, schema: T.StructType) -> DataFrame:
    return scan.select(*[F.col(f"`{name}`") for name in schema.names])


def schema_of(state: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(state.schema_json))


class Lake:
    """Names ``catalog.schema.table`` mapped to versioned tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, locations: Mapping[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.locations = {name.lower(): base.rstrip("/") for name, base in (locations or {}).items()}
        self.mounts: dict[str, DataFrame] = {}

    def mount(self, name: str, df: DataFrame) -> None:
        """Give a frame that lives elsewhere a name steps can read."""
        self.mounts[name.lower()] = df

    def table(self, name: str) -> SnapshotTable:
        parts = [part.strip().lower() for part in name.split(".") if part.strip()]
        if len(parts) != 3:
            raise ValueError(f"table name must be catalog.schema.table: {name!r}")
        key = ".".join(parts)
        base = f"{self.locations.get(key, self.root)}/{'/'.join(parts)}"
        return SnapshotTable(self.spark, base, key)

    def exists(self, name: str) -> bool:
        return self.table(name).exists()

    def names(self) -> list[str]:
        """Full names of all tables, from folder names only."""
        roots = [self.root, *sorted(set(self.locations.values()))]
        found = set()
        for root in roots:
            for path in paths.matching(self.spark, f"{root}/*/*/*/log"):
                found.add(".".join(path.rstrip("/").split("/")[-4:-1]))
        return sorted(found)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        if version is None and name.lower() in self.mounts:
            return self.mounts[name.lower()]
        return self.table(name).read(version)

    def drop(self, name: str) -> bool:
        return paths.delete(self.spark, self.table(name).base)

    def drop_all(self, catalog: str) -> int:
        """Remove every table of a catalog."""
        doomed = [name for name in self.names() if name.split(".")[0] == catalog.strip().lower()]
        for name in doomed:
            self.drop(name)
        return len(doomed)


def read_table(spark: SparkSession, source: Lake | None, name: str, version: int | None = None) -> DataFrame:
    """A table by name: from the lake when it holds it, else from the session catalog."""
    if source is not None and len(name.split(".")) == 3 and source.exists(name):
        return source.read(name, version)
    if version is not None:
        raise ValueError(f"{name} keeps no versions")
    return spark.table(name)


def table_history(lake: Lake, name: str) -> DataFrame:
    return lake.table(name).history()
