"""Incremental file ingest: every file of a folder is loaded once, new columns are taken up by name.

The streaming query only follows the *list* of files (the checkpoint remembers which were seen). Each micro-batch
then reads its new files with the batch reader of their format. That way columns are matched by name per file, which
a CSV stream with one fixed schema cannot do: it maps columns by position.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops import paths
from lakeops.operators.schemas import can_widen, merge_schemas
from lakeops.operators.writes import append
from lakeops.sources.snapshot import CommitResult, SnapshotTable

FORMATS = ("csv", "json", "parquet")
STREAMING_WRITE = "STREAMING UPDATE"
# The binaryFile source; only the path is selected, so no content is read.
LISTING_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


# -- schema kept between runs --------------------------------------------------------------------------------------


def _generations(spark: SparkSession, schema_loc: str) -> list[int]:
    return sorted(int(n[:-5]) for n in paths.child_names(spark, schema_loc) if n.endswith(".json"))


def stored_schema(spark: SparkSession, schema_loc: str) -> T.StructType | None:
    """The newest schema kept at a location."""
    for generation in reversed(_generations(spark, schema_loc)):
        text = paths.read_text(spark, f"{schema_loc}/{generation:06d}.json")
        if text.endswith("\n"):
            return T.StructType.fromJson(json.loads(text))
    return None


def store_schema(spark: SparkSession, schema_loc: str, schema: T.StructType) -> None:
    number = max(_generations(spark, schema_loc), default=-1) + 1
    if not paths.write_new(spark, f"{schema_loc}/{number:06d}.json", schema.json() + "\n"):
        raise RuntimeError(f"two runs keep their schema at {schema_loc}")


# -- reading new files ---------------------------------------------------------------------------------------------


def csv_headers(spark: SparkSession, files: Sequence[str], options: Mapping[str, str] | None = None) -> list[str]:
    """Header line of each CSV file.

    The driver opens the files side by side and reads their first block. A Spark scan would read every file to its
    end for it, and a micro-batch has a bounded number of files.
    """
    opts = dict(options or {})
    encoding, comment = opts.get("encoding", "UTF-8"), opts.get("comment")
    with ThreadPoolExecutor(max_workers=32) as pool:
        return list(pool.map(lambda f: paths.first_line(spark, f, encoding, comment), files))


def _group_by_header(
    spark: SparkSession, files: Sequence[str], options: Mapping[str, str]
) -> list[tuple[str, list[str]]]:
    """Files with the same header, as (header, files)."""
    groups: dict[str, list[str]] = {}
    for file, header in zip(files, csv_headers(spark, files, options)):
        groups.setdefault(header, []).append(file)
    return sorted(groups.items())


def _retype(names: Sequence[str], known: T.StructType | None, inferred: T.StructType | None) -> T.StructType:
    """Types for a file's columns: the kept type, else the inferred one, else STRING."""
    kept = {f.name.lower(): f.dataType for f in (known.fields if known else [])}
    found = {f.name.lower(): f.dataType for f in (inferred.fields if inferred else [])}
    return T.StructType(
        [
            T.StructField(n, kept.get(n.lower(), found.get(n.lower(), T.StringType())), True)
            for n in names
        ]
    )


def _refuse_growth(known: T.StructType | None, merged: T.StructType, evolve: bool) -> None:
    if known is not None and not evolve and len(merged.names) > len(known.names):
        raise ValueError(f"new columns in the files: {', '.join(merged.names[len(known.names):])}")


def read_new_files(
    spark: SparkSession,
    files: Sequence[str],
    fmt: str,
    known: T.StructType | None,
    header: bool = True,
    infer_types: bool = False,
    evolve: bool = True,
    options: Mapping[str, str] | None = None,
) -> tuple[DataFrame, T.StructType]:
    """Rows of the files and the schema after them (the known one, widened).

    A value that does not fit its column's type fails the read instead of turning into NULL. Types are inferred only
    for columns not known yet. With ``evolve=False`` new CSV or Parquet columns raise; JSON files are then read with
    the known schema as it is, without a pass that looks for new fields.
    """
    opts = {"mode": "FAILFAST", **dict(options or {})}
    named = [paths.literal(file) for file in files]
    if fmt == "parquet":
        found = spark.read.option("mergeSchema", "true").parquet(*named).schema
        merged = found if known is None else merge_schemas(known, found)
        _refuse_growth(known, merged, evolve)
        return spark.read.schema(merged).parquet(*named), merged
    if fmt == "json":
        if known is not None and not evolve:
            return spark.read.schema(known).options(**opts).json(named), known
        as_text = "false" if infer_types else "true"
        found = spark.read.options(**opts).option("primitivesAsString", as_text).json(named).schema
        if known is not None:
            # A kept type wins over what this batch alone looks like; only new columns are added.
            fresh = [f for f in found.fields if f.name.lower() not in {n.lower() for n in known.names}]
            same = [f for f in found.fields if f not in fresh and isinstance(f.dataType, (T.StructType, T.ArrayType))]
            found = merge_schemas(known, T.StructType(same + fresh))
        return spark.read.schema(found).options(**opts).json(named), found
    if fmt != "csv":
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, not {fmt!r}")

    csv_opts = {**opts, "header": str(bool(header)).lower()}
    groups = _group_by_header(spark, files, opts) if header else [("", list(files))]
    merged, frames = known, []
    for _, members in groups:
        members = [paths.literal(file) for file in members]
        names = spark.read.options(**csv_opts).csv(members[0]).columns
        have = {n.lower() for n in (merged.names if merged else [])}
        inferred = None
        if infer_types and any(n.lower() not in have for n in names):
            inferred = spark.read.options(**csv_opts).option("inferSchema", "true").csv(members).schema
        group_schema = _retype(names, merged, inferred)
        frame = spark.read.schema(group_schema).options(**csv_opts).csv(members)
        merged = group_schema if merged is None else merge_schemas(merged, group_schema)
        frames.append(frame)
    _refuse_growth(known, merged, evolve)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    present = {n.lower() for n in rows.columns}
    rows = rows.select(
        *[
            F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in merged.fields
        ]
    )
    return rows, merged


# Types a text column can be given, narrowest first; a column climbs to the first one that takes all its values.
_LADDERS = (("int", "bigint", "double"), ("date",), ("timestamp",), ("boolean",))


def _climbs(known: T.DataType | None) -> list[str]:
    """Types to try for a column: all ladders for a new one, else what its type can widen to in files already written."""
    if known is None:
        return [kind for ladder in _LADDERS for kind in ladder]
    return [known.simpleString(), *(kind for kind in ("bigint", "double") if can_widen(known, T._parse_datatype_string(kind)))]


def read_drifting(
    spark: SparkSession,
    files: Sequence[str],
    fmt: str,
    known: T.StructType | None,
    rescue: str,
    header: bool = True,
    infer_types: bool = False,
    options: Mapping[str, str] | None = None,
) -> tuple[DataFrame, T.StructType]:
    """Rows of CSV or JSON files whose values may not fit the kept types, and the schema after them.

    All columns are read as text. One pass counts, for each column and each type it could have, the values that do not fit. A known column keeps its type
    or widens to one that takes all of them and that old files can be read as; a new one gets the narrowest type of a ladder (text without
    ``infer_types``). A value that still does not fit becomes NULL and is kept, under its column's name and as it stood, in the
    JSON text of the column ``rescue``. Nested JSON values are read with the known type and fail when they do not fit it.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"values are rescued from csv or json files, not from {fmt}")
    kept = {f.name.lower(): f for f in (known.fields if known else []) if f.name.lower() != rescue.lower()}
    nested = [f for f in kept.values() if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    raw, text = read_new_files(spark, files, fmt, T.StructType(nested) if nested else None, header, False, options=options)
    plain = [f.name for f in text.fields if isinstance(f.dataType, T.StringType) and f.name.lower() != rescue.lower()]
    wanted = {}
    for name in plain:
        old = kept[name.lower()].dataType if name.lower() in kept else None
        if isinstance(old, T.StringType) or (old is None and not infer_types):
            continue
        wanted[name] = _climbs(old)
    unfit = lambda name, kind: F.col(f"`{name}`").isNotNull() & F.col(f"`{name}`").try_cast(kind).isNull()
    chosen: dict[str, str] = {}
    if wanted:
        tests = [F.count_if(unfit(n, k)).alias(f"m{i}_{j}") for i, (n, kinds) in enumerate(wanted.items()) for j, k in enumerate(kinds)]
        seen = [F.count(F.col(f"`{n}`")).alias(f"n{i}") for i, n in enumerate(wanted)]
        found = raw.agg(*tests, *seen).first()
        for i, (name, kinds) in enumerate(wanted.items()):
            fits = [k for j, k in enumerate(kinds) if not found[f"m{i}_{j}"]]
            if name.lower() in kept:
                chosen[name] = fits[0] if fits else kinds[0]
            elif fits and found[f"n{i}"]:
                chosen[name] = fits[0]
    typed = T.StructType([T.StructField(f.name, T._parse_datatype_string(chosen[f.name]) if f.name in chosen else f.dataType, True) for f in text.fields])
    merged = typed if known is None else merge_schemas(T.StructType([f for f in known.fields if f.name.lower() != rescue.lower()]), typed)
    merged = merged.add(rescue, T.StringType())
    have = {n.lower(): n for n in raw.columns}
    misfits = [F.when(unfit(n, k), F.col(f"`{n}`")) for n, k in chosen.items() if n.lower() in kept]
    named = F.map_from_arrays(F.array(*[F.lit(n) for n in chosen if n.lower() in kept]), F.array(*misfits)) if misfits else None
    left = F.map_filter(named, lambda _, v: v.isNotNull()) if misfits else None
    columns = []
    for f in merged.fields[:-1]:
        source = have.get(f.name.lower())
        if source is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            kind = chosen.get(source)
            value = F.col(f"`{source}`").try_cast(kind).cast(f.dataType) if kind else F.col(f"`{source}`")
            columns.append(value.alias(f.name))
    rescued = F.when(F.size(left) > 0, F.to_json(left)) if misfits else F.lit(None).cast("string")
    return raw.select(*columns, rescued.alias(rescue)), merged


def infer_stream_schema(
    spark: SparkSession,
    src: str,
    fmt: str,
    infer_types: bool = False,
    schema_loc: str | None = None,
    header: bool = True,
    options: Mapping[str, str] | None = None,
    batch_files: int = 10_000,
) -> T.StructType:
    """Schema of the files of a folder merged into the kept one, which is updated.

    Files are taken ``batch_files`` at a time; the driver holds no more paths than that.
    """
    known = stored_schema(spark, schema_loc) if schema_loc else None
    merged = known
    listed = paths.list_files(spark, src).select("path").toLocalIterator()
    while files := [row.path for row in islice(listed, batch_files)]:
        _, merged = read_new_files(spark, files, fmt, merged, header, infer_types, options=options)
    if merged is None:
        raise ValueError(f"no files at {src} and no kept schema")
    if schema_loc and merged != known:
        store_schema(spark, schema_loc, merged)
    return merged


# -- the stream ----------------------------------------------------------------------------------------------------


def _last_batch(target: SnapshotTable, app: str) -> int:
    """The newest micro-batch of a stream the table holds; every version carries this on."""
    return target.state().batches.get(app, -1) if target.exists() else -1


def _stream_path(spark: SparkSession, src: str) -> str:
    """A single file is named by a one-match pattern, because a streaming source wants folders or patterns."""
    return f"{src[:-1]}[{src[-1]}]" if paths.is_file(spark, src) else src


def ingest_files(
    spark: SparkSession,
    src: str,
    target: SnapshotTable,
    checkpoint: str,
    fmt: str = "csv",
    schema_loc: str | None = None,
    header: bool = True,
    infer_types: bool = False,
    merge_schema: bool = True,
    max_files: int = 10_000,
    options: Mapping[str, str] | None = None,
    rescue: str | None = None,
) -> list[CommitResult]:
    """Load the files that were not loaded before, then stop. One commit per micro-batch.

    The first batch creates the target where it does not exist.

    A batch that is replayed after a crash is recognised by its id in the table's log and skipped. ``max_files`` sets
    the size of one micro-batch, not of the run: all new files are loaded. With ``rescue`` types widen as the files
    drift, and values that fit no such type are kept in the column of that name (see ``read_drifting``).
    """
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, not {fmt!r}")
    kept_at = schema_loc or f"{checkpoint.rstrip('/')}-schema"
    app = checkpoint.rstrip("/")
    results: list[CommitResult] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id <= _last_batch(target, app):
            return
        # The listing names a file twice when another one's name reads as a pattern.
        files = sorted({row.path for row in batch.collect()})
        if not files:
            return
        known = stored_schema(session, kept_at)
        if rescue:
            rows, merged = read_drifting(session, files, fmt, known, rescue, header, infer_types, options)
            _refuse_growth(known, merged, merge_schema)
        else:
            rows, merged = read_new_files(session, files, fmt, known, header, infer_types, merge_schema, options)
        if merged != known:
            store_schema(session, kept_at, merged)
        table = SnapshotTable(session, target.base, target.name)
        if not table.exists():
            table.create(merged)
        results.append(append(rows, table, merge_schema, STREAMING_WRITE, (app, batch_id)))

    listing = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .load(_stream_path(spark, src))
        .select("path")
    )
    query = (
        listing.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
