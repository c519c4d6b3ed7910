"""Config-driven steps: statement libraries, SQL steps, registered jobs, and running them with an audit trail."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from lakeops import paths
from lakeops.functions.params import detail, merge_params, params_map, render
from lakeops.operators.audit import log_load
from lakeops.operators.changes import delete_where, merge, update_where
from lakeops.operators.quality import with_step_problem
from lakeops.operators.writes import append, append_by_name, append_select, overwrite
from lakeops.plans.parsed import ParsedWrite
from lakeops.sources.control import order_steps, read_steps, step_order
from lakeops.sources.snapshot import CommitResult, Lake, SnapshotTable, schema_of
from lakeops.sources.statements import read_statement_library
from lakeops.streaming.ingest import ingest_files

Job = Callable[["RunContext", Mapping[str, str]], "DataFrame | CommitResult | Sequence[CommitResult] | None"]
_JOBS: dict[str, Job] = {}


class StepFailed(RuntimeError):
    """A step failed; the steps after it were not run."""


def job(name: str) -> Callable[[Job], Job]:
    """Register a Python function ``(context, params)`` as the job of NOTEBOOK steps whose path ends in ``name``."""

    def register(function: Job) -> Job:
        _JOBS[name.strip("/").lower()] = function
        return function

    return register


def find_job(path: str) -> Job:
    wanted = path.strip("/").lower()
    for name in (wanted, wanted.rsplit("/", 1)[-1]):
        if name in _JOBS:
            return _JOBS[name]
    raise StepFailed(f"no job is registered for {path!r}")


@dataclass
class RunContext:
    """Everything a run needs besides its steps."""

    lake: Lake
    config: DataFrame
    etl_date: str
    log_table: str | None = None
    parms_ovrd: str = ""
    jobid: str = ""
    jobname: str = ""
    jobrunid: str = ""
    taskname: str = ""
    taskrunid: str = ""
    userid: str = ""
    notebook: str = ""
    log_loads: bool = True
    numeric_order: bool = True
    interface: str = ""

    @property
    def spark(self) -> SparkSession:
        return self.lake.spark

    def common(self) -> dict[str, str]:
        names = ("etl_date", "jobname", "jobrunid", "jobid", "taskrunid", "taskname", "userid")
        return {**{name: getattr(self, name) for name in names}, "Interface": self.interface}


# -- binding steps to statements -----------------------------------------------------------------------------------


def with_library_path(steps: DataFrame, numeric: bool = True) -> DataFrame:
    """Add ``sql_path``: the library the newest SQLLOAD step before a step made current.

    The window covers the steps of one task and layer, a handful of config rows.
    """
    details = _details(steps)
    in_task = Window.partitionBy("emc_task_id", "emc_target_layer").orderBy(*step_order(numeric))
    before = in_task.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    loaded = F.when(F.upper("emc_func_type") == "SQLLOAD", detail(details, "sql_path"))
    return steps.withColumn("sql_path", F.last(loaded, ignorenulls=True).over(before))


def _details(steps: DataFrame):
    is_text = steps.schema["emc_func_dtls"].dataType.simpleString() == "string"
    return F.try_parse_json("emc_func_dtls") if is_text else F.col("emc_func_dtls")


def bind_statements(steps: DataFrame, library: DataFrame) -> DataFrame:
    """Steps with the statement they name: left join on (sql_path, sql_var), one row per step.

    ``library`` has sql_path, sql_var and sql_text. ``problem`` tells a missing name, and one that several files of a
    library folder define.
    """
    checked = with_step_problem(steps).withColumn("sql_var", F.trim(detail(_details(steps), "sql_var")))
    named = library.groupBy("sql_path", "sql_var").agg(F.min("sql_text").alias("sql_text"), F.count(F.lit(1)).alias("lk_n"))
    bound = checked.join(named, ["sql_path", "sql_var"], "left")
    is_sql = F.upper("emc_func_type") == "SQL"
    missing = F.when(is_sql & F.col("sql_text").isNull(), F.concat(F.lit("no statement named "), F.col("sql_var")))
    repeated = F.when(is_sql & (F.col("lk_n") > 1), F.concat(F.lit("several files define the statement "), F.col("sql_var")))
    return bound.withColumn("problem", F.coalesce("problem", missing, repeated)).drop("lk_n")


def render_steps(bound: DataFrame, common: Mapping[str, str], parms_ovrd: str = "") -> DataFrame:
    """Add ``statement`` (rendered SQL) and ``parms`` (merged job parameters as JSON)."""
    details = _details(bound)
    given = params_map(F.coalesce(detail(details, "sql_parms"), F.lit("")))
    # The three run placeholders are filled first, in this order.
    run_values = F.create_map(*[F.lit(x) for n in ("etl_date", "jobrunid", "taskrunid") for x in (n, common.get(n, ""))])
    statement = render(render(F.col("sql_text"), run_values), given)
    merged = merge_params(F.coalesce(detail(details, "parms"), F.lit("")), F.lit(parms_ovrd))
    with_run = merge_params(merged, F.lit(json.dumps(dict(common))))
    bad = F.when(
        (F.upper("emc_func_type") == "SQL") & F.col("sql_text").isNotNull() & given.isNull(), "sql_parms is not JSON"
    )
    is_job = F.upper("emc_func_type") == "NOTEBOOK"
    return (
        bound.withColumn("problem", F.coalesce("problem", bad))
        .withColumn("statement", statement)
        .withColumn("parms", F.when(is_job, with_run))
    )


def load_libraries(spark: SparkSession, steps: DataFrame) -> DataFrame:
    """Statements of every library the SQLLOAD steps name: sql_path, sql_var, sql_text."""
    details = _details(steps)
    named = steps.where(F.upper("emc_func_type") == "SQLLOAD").select(detail(details, "sql_path").alias("p"))
    library = None
    for path in sorted({row.p for row in named.distinct().collect() if row.p and row.p.strip()}):
        if not paths.exists(spark, path):
            continue
        part = read_statement_library(spark, path).select(F.lit(path).alias("sql_path"), "sql_var", "sql_text")
        library = part if library is None else library.unionByName(part)
    if library is None:
        return spark.range(0).selectExpr(*[f"cast(null as string) AS {c}" for c in ("sql_path", "sql_var", "sql_text")])
    return library


# -- SQL over lake tables ------------------------------------------------------------------------------------------


# Literals and comments are taken whole, so that only names outside of them are looked at.
_TOKEN = re.compile(
    r"\b[rR](?:'[^']*'|\"[^\"]*\")|'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|--[^\n]*|/\*.*?\*/"
    r"|(?P<name>(?:`[^`]+`|\w+)(?:\s*\.\s*(?:`[^`]+`|\w+))*)",
    re.DOTALL,
)
_PART = re.compile(r"`[^`]+`|\w+")
_LEADING = re.compile(r"^(?:\s+|--[^\n]*(?:\n|$)|/\*.*?\*/)+", re.DOTALL)


def lake_sql(lake: Lake, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Run a query whose ``catalog.schema.table`` names are lake tables.

    Each lake table the text names, with or without backticks, becomes a temporary view called by its full name. Only
    names that occur in the text are looked up. Literals, comments and everything else are Spark SQL as they stand.
    """
    text = with_views(lake, text)
    return lake.spark.sql(text, args=dict(args)) if args else lake.spark.sql(text)


def with_views(lake: Lake, text: str) -> str:
    """The text with every lake table it names as a temporary view; in a longer name (``table.column``) the first three parts are the table."""
    known: dict[str, bool] = {}

    def view(token: re.Match) -> str:
        parts = _PART.findall(token["name"] or "")
        if len(parts) < 3:
            return token[0]
        name = ".".join(part.strip("`").lower() for part in parts[:3])
        if name not in known:
            known[name] = name in lake.mounts or lake.exists(name)
            if known[name]:
                lake.read(name).createOrReplaceTempView(f"`{name}`")
        return ".".join([f"`{name}`", *parts[3:]]) if known[name] else token[0]

    return _TOKEN.sub(view, text)


# The head of a statement tells the kind of write; the rest is a query or condition Spark parses itself.
_INSERT_HEAD = re.compile(
    r"^\s*insert\s+(?P<mode>into|overwrite)\s+(?:table\s+)?(?P<name>[\w.`]+)\s*"
    r"(?:(?P<by_name>by\s+name)|\((?P<columns>[^()]*)\))?\s*(?P<query>(?:(?:select|with|values|from|table)\b|\().*)$",
    re.IGNORECASE | re.DOTALL,
)
_WRITE_HEAD = re.compile(r"^\s*(merge|update|delete)\b", re.IGNORECASE)
_QUERY_HEAD = re.compile(r"^\s*(select|with|values|from|table|\()", re.IGNORECASE)


def _plain(name: str) -> str:
    return name.replace("`", "").lower()


def run_statement(lake: Lake, text: str, target: str | None, out_mode: str, details: Mapping) -> CommitResult | None:
    """Run one rendered statement as a change-tracked write into the target.

    INSERT, MERGE, UPDATE and DELETE statements say what they do. A plain query is written to the target by the step's out mode, or
    by ``op`` in the details: ``MERGE`` (the query is the source; ``keys``, ``update``, ``insert``, ``delete_when``,
    ``update_when``), ``UPDATE`` (the text is the condition; ``set``) or ``DELETE`` (the text is the condition).
    With ``partition_overwrite`` in the details an OVERWRITE replaces only the partitions the new rows fall in.
    Without a target a query is only run. Anything else is refused before it runs.
    """
    text = _LEADING.sub("", text).strip().rstrip(";").strip()
    operation = str(details.get("op") or "").upper()
    overwriting = (out_mode or "").upper() == "OVERWRITE"
    dynamic = bool(details.get("partition_overwrite"))
    if operation in ("MERGE", "UPDATE", "DELETE"):
        if not target:
            raise StepFailed(f"{operation} needs a target")
        table = lake.table(target)
        if operation == "DELETE":
            return delete_where(table, text or None)
        if operation == "UPDATE":
            return update_where(table, details["set"], text or None)
        return merge(
            table,
            lake_sql(lake, text),
            details["keys"],
            details.get("update", "all"),
            details.get("insert", "all"),
            details.get("delete_when"),
            details.get("update_when"),
        )
    if operation:
        raise StepFailed(f"unknown op {operation}")
    insert = _INSERT_HEAD.match(text)
    if insert:
        name = _plain(insert["name"])
        _same_target(name, target)
        table = lake.table(name)
        rows = lake_sql(lake, insert["query"])
        columns = [c.strip().strip("`") for c in insert["columns"].split(",")] if insert["columns"] else None
        if insert["mode"].lower() == "overwrite" or overwriting:
            if not insert["by_name"]:
                rows = rows.toDF(*(columns or schema_of(table.state()).names))
            return overwrite(rows, table, dynamic=dynamic)
        return append_by_name(rows, table) if insert["by_name"] else append_select(rows, table, columns)
    if _WRITE_HEAD.match(text):
        write = ParsedWrite(lake.spark, with_views(lake, text))
        _same_target(write.target, target)
        return write.run(lake)
    if not _QUERY_HEAD.match(text):
        raise StepFailed("a SQL step must be a query, an INSERT, a MERGE, an UPDATE or a DELETE, or name its op in the details")
    rows = lake_sql(lake, text)
    if not target:
        rows.write.format("noop").mode("overwrite").save()
        return None
    return write_result(rows, lake.table(target), out_mode, dynamic)


def _same_target(name: str, target: str | None) -> None:
    if target and name != _plain(target):
        raise StepFailed(f"the statement writes {name} but the step's target is {target}")


def write_result(
    rows: DataFrame, table: SnapshotTable, out_mode: str | None, dynamic: bool = False
) -> CommitResult:
    """APPEND (also blank) or OVERWRITE, columns matched by name."""
    mode = (out_mode or "").upper()
    if mode not in ("", "APPEND", "OVERWRITE"):
        raise StepFailed(f"unknown out mode {out_mode!r}")
    return overwrite(rows, table, dynamic=dynamic) if mode == "OVERWRITE" else append(rows, table)


# -- running steps -------------------------------------------------------------------------------------------------


def _details_dict(step: Row) -> dict:
    return json.loads(str(step.emc_func_dtls))


def run_sql_step(ctx: RunContext, step: Row) -> list[CommitResult]:
    done = run_statement(ctx.lake, step.statement, step.emc_target, step.emc_out_mode, _details_dict(step))
    return [done] if done else []


def run_job_step(ctx: RunContext, step: Row) -> list[CommitResult]:
    """Run the registered job; a DataFrame it returns is written to the target."""
    path = _details_dict(step)["notebook_path"]
    outcome = find_job(path)(ctx, json.loads(step.parms or "{}"))
    if outcome is None:
        return []
    if isinstance(outcome, CommitResult):
        return [outcome]
    if isinstance(outcome, DataFrame):
        if not step.emc_target:
            raise StepFailed(f"job {path} returned rows but the step has no target")
        return [write_result(outcome, ctx.lake.table(step.emc_target), step.emc_out_mode)]
    return list(outcome)


def run_load_step(ctx: RunContext, step: Row) -> list[CommitResult]:
    """The library was read when the steps were bound; here it only has to exist."""
    path = _details_dict(step)["sql_path"]
    if not paths.exists(ctx.spark, path):
        raise StepFailed(f"statement library {path} does not exist")
    return []


_RUNNERS = {"SQL": run_sql_step, "NOTEBOOK": run_job_step, "SQLLOAD": run_load_step}


def ready_steps(ctx: RunContext, task: str, layer: str) -> list[Row]:
    """The steps of a task as one plan (scan, checks, library join, rendering); only these few rows are collected."""
    steps = with_library_path(read_steps(ctx.config, task, layer, ctx.numeric_order), ctx.numeric_order)
    library = load_libraries(ctx.spark, steps)
    common = {**ctx.common(), "Interface": task}
    plan = render_steps(bind_statements(steps, library), common, ctx.parms_ovrd)
    return order_steps(plan, ctx.numeric_order).collect()


def _result_row(ctx: RunContext, target: str, start: dt.datetime, commits: Sequence[CommitResult], status: str) -> dict:
    counts = [c.row_counts for c in commits] if status == "SUCCESS" else []
    version = commits[-1].version if commits else None
    return {
        "target": target.lower(),
        "prev_version": commits[0].prev_version if commits else version,
        "new_version": version,
        **{f"rows_{n}": sum(c[i] for c in counts) for i, n in enumerate(("inserted", "updated", "deleted"))},
        "status": status,
        "start_ts": start,
        "end_ts": dt.datetime.now(dt.timezone.utc),
    }


RESULT_SCHEMA = (
    "target STRING, prev_version BIGINT, new_version BIGINT, rows_inserted BIGINT, rows_updated BIGINT, "
    "rows_deleted BIGINT, status STRING, start_ts TIMESTAMP, end_ts TIMESTAMP"
)


def results_frame(ctx: RunContext, results: Sequence[dict]) -> DataFrame:
    """Step results (a few per task) as a DataFrame with the run columns."""
    names = [column.split()[0] for column in RESULT_SCHEMA.split(", ")]
    rows = ctx.spark.createDataFrame([tuple(r[n] for n in names) for r in results], RESULT_SCHEMA)
    run = {**ctx.common(), "notebook": ctx.notebook}
    run.pop("Interface")
    return rows.select("*", *[F.lit(value).alias(name) for name, value in run.items()])


def run_task(ctx: RunContext, task: str, layer: str) -> DataFrame:
    """Run the active steps of a task and layer in order and stop at the first that fails.

    Returns the results of the steps with a target. They are appended to the load log in one write, also when a step
    fails; the failure is raised after that.
    """
    ctx.interface = task
    results: list[dict] = []
    failure: Exception | None = None
    for step in ready_steps(ctx, task, layer):
        start = dt.datetime.now(dt.timezone.utc)
        target = (step.emc_target or "").strip()
        try:
            if step.problem:
                raise StepFailed(step.problem)
            commits = _RUNNERS[step.emc_func_type.upper()](ctx, step)
            if target:
                if not commits:
                    version = ctx.lake.table(target).latest_version()
                    commits = [CommitResult("WRITE", version, version, {"numOutputRows": 0})]
                results.append(_result_row(ctx, target, start, commits, "SUCCESS"))
        except Exception as error:
            if target:
                results.append(_result_row(ctx, target, start, [], "FAILED"))
            failure = StepFailed(f"task {task} step {step.emc_seq}: {error}")
            failure.__cause__ = error
            break
    frame = results_frame(ctx, results)
    if ctx.log_loads and ctx.log_table and results:
        log_load(ctx.lake, ctx.log_table, frame)
    if failure:
        raise failure
    return frame


Stage = tuple[str, str] | Sequence[tuple[str, str]]


def run_pipeline(ctx: RunContext, tasks: Sequence[Stage]) -> DataFrame:
    """Run (task, layer) pairs one after the other, bronze to gold; a list of pairs in place of one runs side by side.

    Tasks side by side must not write the same table or read what another of them writes. Each has a thread of its own and a
    scheduler pool of its own, so with ``spark.scheduler.mode=FAIR`` none waits for all of another's jobs. When one fails the others of its list go on to
    their end; then the first failure, in the order given, is raised and later tasks are not run.
    """
    frames: list[DataFrame] = []
    for stage in tasks:
        if isinstance(stage[0], str):
            frames.append(run_task(ctx, *stage))
        else:
            frames += _run_beside(ctx, list(stage))
    return reduce(DataFrame.unionByName, frames)


def _run_beside(ctx: RunContext, tasks: Sequence[tuple[str, str]]) -> list[DataFrame]:
    local = ctx.spark.sparkContext

    def run(task: str, layer: str) -> DataFrame:
        local.setLocalProperty("spark.scheduler.pool", f"{task}-{layer}".lower())
        return run_task(replace(ctx), task, layer)

    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        running = [pool.submit(inheritable_thread_target(ctx.spark)(run), *task) for task in tasks]
        failures = [f.exception() for f in running]
    for failure in failures:
        if failure is not None:
            raise failure
    return [f.result() for f in running]


@job("ingest_files")
def ingest_job(ctx: RunContext, params: Mapping[str, str]) -> Sequence[CommitResult]:
    """Incremental file ingest as a step."""
    fmt = params["format"].lower()
    header = str(params.get("header", "true")).lower() == "true"
    infer_types = str(params.get("inferColumnTypes", "false")).lower() == "true"
    if params.get("outputMode", "append") != "append":
        raise StepFailed("file ingest appends; use stream_aggregate for a complete result")
    return ingest_files(
        ctx.spark,
        params["source_path"],
        ctx.lake.table(params["emc_target"]),
        params["checkpoint"],
        fmt,
        params.get("schemaLocation"),
        header,
        infer_types,
        str(params.get("mergeSchema", "true")).lower() == "true",
    )
