"""Physical care of a versioned table: compaction, Z-order layout, vacuum and statistics."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops import paths
from lakeops.operators.changes import without_files
from lakeops.operators.landing import landed
from lakeops.sources.snapshot import CommitConflict, CommitResult, SnapshotTable, entry_of, schema_of

DEFAULT_TARGET_BYTES = 512 << 20
# Bytes of a file whose rows a task sorts before it writes them; in memory they take several times as much.
SORTED_BYTES = 128 << 20
# Fixed value: the shortest retention a vacuum accepts, in hours.
MIN_RETENTION_HOURS = 168


class RetentionTooShort(ValueError):
    """Vacuum was asked to keep less history than the minimum."""


# -- compaction ----------------------------------------------------------------------------------------------------


def compact(
    target: SnapshotTable, target_bytes: int = DEFAULT_TARGET_BYTES, round_files: int = 100_000, attempts: int = 50
) -> CommitResult:
    """Merge files smaller than three quarters of the target where several fit into one of the target size.

    The small files of a partition (of the whole table without partition columns) are packed into bins, largest first. A bin
    of several files becomes one file, one of a single file is left alone, so every rewrite leaves fewer files, and a
    table at rest gets no version. Rows stay as they are. A plain table is rewritten without a shuffle: Spark packs
    the files into scan tasks in the same way and each task writes one file. With partition columns each bin is sent to one task; with
    clustering columns the rows are cut into ranges of these.

    ``round_files`` bounds the file names the driver holds at a time: files are dealt to rounds by a hash of their
    partition (of their name without partition columns; a partition with more files is dealt by name too), and each round is its own commit. Rounds follow until none
    finds files to merge. Appends that others commit meanwhile are kept and followed, up to ``attempts`` times a round; any other commit raises CommitConflict.
    """
    state = target.state()
    files = target.file_sizes(state).count()
    done, after, saving = CommitResult("OPTIMIZE", state.version, state.version, {}), files, True
    while saving:
        saving = False
        small = _small_files(target, target.state(), target_bytes)
        rounds = max(1, math.ceil(small.count() / round_files))
        for number in range(rounds):
            dealt = F.when(F.col("members") > round_files, F.xxhash64("entry")).otherwise(F.xxhash64("folder"))
            mine = small.where(F.pmod(dealt, F.lit(rounds)) == number).select("entry", "length", "folder").collect()
            bins = _bins(mine, target_bytes)
            if bins:
                saved = sum(len(b) - 1 for b in bins)
                after -= saved
                done, saving = _merge_bins(target, bins, target_bytes, after + saved, after, attempts), True
    after = target.file_sizes().count() if done.metrics else files
    return CommitResult(done.operation, done.prev_version, done.version, {"numFilesBefore": files, "numFilesAfter": after})


def _small_files(target: SnapshotTable, state: Row, target_bytes: int) -> DataFrame:
    """(entry, length, folder, members): small files with their partition's folder and how many it has; all of the table's without partition columns have their own name's."""
    small = target.file_sizes(state).where(F.col("length") < target_bytes * 3 // 4)
    if not state.partition_by:
        return small.select("*", F.lit("").alias("folder"), F.lit((1 << 62)).alias("members"))
    small = small.withColumn("folder", F.regexp_replace("entry", "^[^/]*/|[^/]*$", ""))
    return small.join(small.groupBy("folder").agg(F.count(F.lit(1)).alias("members")), "folder")


def _bins(files: Sequence[Row], target_bytes: int) -> list[list[str]]:
    """Files of one folder that together fit in a file of the target size, as Spark packs scan tasks; bins of one file are left out."""
    out: list[list[str]] = []
    folder, room = None, 0
    for f in sorted(files, key=lambda f: (f.folder, -f.length, f.entry)):
        if f.folder != folder or f.length > room:
            out.append([])
            folder, room = f.folder, target_bytes
        out[-1].append(f.entry)
        room -= f.length
    return [b for b in out if len(b) > 1]


def _merge_bins(target: SnapshotTable, bins: list[list[str]], target_bytes: int, before: int, after: int, attempts: int) -> CommitResult:
    """Write each bin's rows as one file and commit them in place of its files."""
    state = target.state()
    schema = schema_of(state)
    small = sorted(entry for b in bins for entry in b)
    packed = target.spark.newSession()
    packed.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    packed.conf.set("spark.sql.files.openCostInBytes", "0")
    packed.conf.set("spark.sql.files.minPartitionNum", "1")
    scan = target.scan(small, schema, packed)
    columns = [F.col(f"`{n}`") for n in schema.names]
    if state.partition_by:
        # at most round_files names
        home = packed.createDataFrame([(e, k) for k, b in enumerate(bins) for e in b], "lk_entry STRING, lk_bin INT")
        rows = scan.select(*columns, entry_of(F.col("_metadata.file_path")).alias("lk_entry")).join(F.broadcast(home), "lk_entry")
        rows = rows.repartitionById(len(bins), F.col("lk_bin")).select(*columns)
    elif state.cluster_by:
        rows = by_range(scan, state.cluster_by, len(bins), row_address()).select(*columns)
    else:
        rows = scan.select(*columns)
    entry, _ = target.write_folder(rows, state, arranged=True)
    live, dropped = without_files(target, state, small)
    return _publish(target, state, {"numFilesBefore": before, "numFilesAfter": after}, [*live, entry], dropped, attempts)


def _publish(
    target: SnapshotTable, state: Row, metrics: dict, live: Sequence[str], dropped: Sequence[str], attempts: int
) -> CommitResult:
    """Commit a new layout of the rows of ``state``. Appends committed meanwhile are kept and followed; other commits raise."""
    newest = state
    for _ in range(attempts):
        added = [entry for entry in newest.live if entry not in set(state.live)]
        try:
            return target.commit(newest.version, Row(**{**newest.asDict(), "properties": state.properties}), "OPTIMIZE", metrics, [*live, *added], dropped=dropped)
        except CommitConflict:
            newest = target.state()
            same = newest.schema_json == state.schema_json and newest.partition_by == state.partition_by
            if not same or not set(state.live) <= set(newest.live) or sorted(newest.dropped) != sorted(state.dropped):
                raise
    raise CommitConflict(f"{target.name}: other writers committed first {attempts} times")


# -- clustering by ranges ------------------------------------------------------------------------------------------


def row_address() -> Column:
    """A number that tells the rows of a file scan apart and stays the same when a task runs again."""
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def by_range(df: DataFrame, keys: Sequence[str], parts: int, tie: Column) -> DataFrame:
    """Rows in ``parts`` ranges of their keys, sorted in each. Equal keys stay in one range, unless there are more of them
    than an average range holds; these are spread by ``tie``.

    Fewer than ``parts`` keys can have that many rows, so the list of them that is sent to every task has a bound.
    """
    rows = df.withColumn("lk_tie", tie)
    total = df.count()
    names = [f"lk_key_{i}" for i in range(len(keys))]
    held = df.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("lk_rows"))
    heavy = held.where(F.col("lk_rows") > max(1, total // max(1, parts))).select(*names, F.lit(True).alias("lk_heavy"))
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    rows = rows.join(F.broadcast(heavy), same, "left").withColumn("lk_tie", F.when(F.col("lk_heavy"), F.col("lk_tie")))
    order = [*[F.col(f"`{k}`") for k in keys], F.col("lk_tie")]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("lk_tie", "lk_heavy", *names)


def key_ranges(target: SnapshotTable, state: Row, keys: Sequence[str]) -> DataFrame:
    """(entry, low, high) of every live file: its lowest and highest key as structs, NULLs first. Reads the key columns only.

    Rows are not sorted for it: with a collected set among the sums Spark keeps the files of a task in a hash map, also for keys of
    a struct, which it would group by a sort of all the task's rows otherwise.
    """
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    files = target.scan_state(state).groupBy(entry_of(F.col("_metadata.file_path")).alias("entry"))
    files = files.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.collect_set(F.lit(1)).alias("lk_some"))
    return files.where(F.size("lk_some") > 0).drop("lk_some")


def overlapping(ranges: DataFrame) -> DataFrame:
    """(entry, stretch, depth): the stretch of keys that a file lies in, and the largest number of files over one point of it.

    A sweep over the ends of all ranges in key order keeps the number of open ranges; a stretch ends where none is open. Ranges that only touch do
    not overlap, and a file of one key lies in no stretch: a key with many rows fills several files rightly. It
    works on two rows per file.
    """
    wide = ranges.where("low < high")
    ends = wide.select("entry", F.col("low").alias("key"), F.lit(1).alias("step")).union(wide.select("entry", F.col("high").alias("key"), F.lit(-1).alias("step")))
    order = Window.orderBy("key", "step", "entry")  # of equal keys the ends come before the beginnings
    swept = ends.withColumn("open", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    begins = (F.col("step") == 1) & (F.col("open") == 1)
    swept = swept.withColumn("stretch", F.count_if(begins).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    depth = F.max("open").over(Window.partitionBy("stretch"))
    return swept.withColumn("depth", depth).where("step = 1").select("entry", "stretch", F.col("depth").cast("bigint").alias("depth"))


def overlap_depth(target: SnapshotTable) -> int:
    """The largest number of files whose key ranges share a stretch of keys; 1 for a table in order, 0 for an empty one."""
    state = target.state()
    if not state.live or not state.cluster_by:
        return 0
    found = overlapping(key_ranges(target, state, state.cluster_by)).agg(F.max("depth")).first()[0]
    return int(found or 1)


def recluster(
    target: SnapshotTable, limit: int = 1, target_bytes: int = DEFAULT_TARGET_BYTES, attempts: int = 50
) -> CommitResult:
    """Rewrite by range the files of those stretches of keys in which more than ``limit`` files overlap; leave all others alone.

    The files made for a stretch cover no key outside of it, where no other file has any, and do not overlap each other: a second run finds
    nothing to do and makes no version. A task sorts the rows of a file it makes, so files are made no larger than SORTED_BYTES, whatever
    the target. File names of the stretches that are rewritten reach the driver.
    """
    state = target.state()
    if not state.cluster_by or state.partition_by:
        raise ValueError(f"{target.name} has no clustering columns, or has partition columns")
    files = target.file_sizes(state).count()
    idle = CommitResult("OPTIMIZE", state.version, state.version, {"numFilesBefore": files, "numFilesAfter": files})
    if not state.live:
        return idle
    deep = overlapping(key_ranges(target, state, state.cluster_by)).where(F.col("depth") > limit).select("entry")
    chosen = target.file_sizes(state).join(deep, "entry", "left_semi").collect()
    if not chosen:
        return idle
    schema = schema_of(state)
    parts = max(1, math.ceil(sum(r.length for r in chosen) / min(target_bytes, SORTED_BYTES)))
    picked = sorted(r.entry for r in chosen)
    rows = by_range(target.scan(picked, schema), state.cluster_by, parts, row_address())
    entry, _ = target.write_folder(rows.select(*[F.col(f"`{n}`") for n in schema.names]), state, arranged=True)
    live, dropped = without_files(target, state, picked)
    metrics = {"numFilesBefore": files, "numFilesAfter": files - len(picked) + len(target.files_below([entry], schema))}
    return _publish(target, state, metrics, [*live, entry], dropped, attempts)


# -- Z-order -------------------------------------------------------------------------------------------------------

# Sizes that do not depend on the table: sampled values for each bucket of a column, bits of a Z-value that name a cell of the
# histogram, and bits in one word of a Z-value. Samples only place the bounds of buckets; every row is counted.
_SAMPLES, _CELL_BITS, _WORD_BITS = 32, 18, 60


def _with_buckets(df: DataFrame, cols: Sequence[str], bounds: dict[str, Column | None], names: Sequence[str], bits: int) -> DataFrame:
    """Add per column how many of its fewer than 2**bits ascending bounds lie at or below the value, 0 for NULL.

    A binary search of all columns side by side: each step is a projection that looks up one bound of each.
    """
    df = df.select("*", *[F.lit(0).alias(n) for n in names])
    kept = [F.col(f"`{n}`") for n in df.columns[: -len(names)]]
    for step in reversed(range(bits)):
        half, found = 1 << step, []
        for c, n in zip(cols, names):
            # a bound beyond the last one is NULL
            above = F.get(bounds[c], F.col(n) + (half - 1)) <= F.col(f"`{c}`") if bounds[c] is not None else F.lit(False)
            found.append(F.when(above, F.col(n) + half).otherwise(F.col(n)).alias(n))
        df = df.select(*kept, *found)
    return df


def _bounds(scan: DataFrame, cols: Sequence[str], rows: int, steps: int) -> dict[str, list]:
    """Per column up to ``steps`` - 1 ascending values, whole and of the column's own type, that cut it into even parts."""
    every = max(1, rows // (_SAMPLES * steps))
    some = scan.where(F.pmod(row_address(), F.lit(every)) == 0)
    picks = []
    for c in cols:
        values = F.array_sort(F.collect_list(F.col(f"`{c}`")))
        at = lambda v: F.transform(
            F.sequence(F.lit(1), F.lit(steps - 1)), lambda i: F.element_at(v, F.greatest(F.lit(1), F.ceil(i * F.size(v) / F.lit(steps)).cast("int")))
        )
        picks.append(F.when(F.size(values) > 0, F.array_distinct(at(values))))
    found = some.agg(*[p.alias(f"c{i}") for i, p in enumerate(picks)]).first()
    return {c: list(found[f"c{i}"] or []) for i, c in enumerate(cols)}


def z_words(buckets: Sequence[Column], bits: int) -> tuple[list[Column], int]:
    """Bits of the bucket numbers interleaved, highest bits first, as words of _WORD_BITS bits; and the bits of the first word."""
    places = [(index, bit) for bit in reversed(range(bits)) for index in range(len(buckets))]
    words = []
    for at in range(0, len(places), _WORD_BITS):
        run = places[at : at + _WORD_BITS]
        word = F.lit(0).cast("bigint")
        for shift, (index, bit) in enumerate(reversed(run)):
            one = F.shiftright(buckets[index].cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            word = word.bitwiseOR(F.shiftleft(one, shift))
        words.append(word)
    return words, min(len(places), _WORD_BITS)


def zorder(
    target: SnapshotTable,
    cols: Sequence[str],
    n_files: int | None = None,
    target_bytes: int = DEFAULT_TARGET_BYTES,
    bits: int = 8,
    attempts: int = 50,
) -> CommitResult:
    """Rewrite the table so that rows close in all ``cols`` lie in the same files.

    Each column, of any type that can be ordered and with whole values, is cut into 2**bits buckets at bounds from an even sample;
    the bucket numbers are interleaved. The first bits of the result name a cell. A histogram counts the rows of every cell, of
    which there are at most 2**18 whatever the table's size, and running sums in cell order give each cell its share of the files. Rows join
    their cell and go to a place in its share by their file and position, so a cell that holds a large part of the
    table lies in several files, and a task that runs again sends its rows to the same places. The way is the same for any number of files.

    A table that has not changed since it was ordered by the same columns is left alone.
    """
    state = target.state()
    schema = schema_of(state)
    unknown = [c for c in cols if c not in schema.names]
    if not cols or unknown:
        raise ValueError(f"Z-order columns not in the table: {', '.join(unknown) or 'none given'}")
    if not state.live:
        return CommitResult("OPTIMIZE", state.version, state.version, {"numFilesBefore": 0, "numFilesAfter": 0})
    totals = target.file_sizes(state).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    ).first()
    if n_files is None:
        n_files = max(1, math.ceil(totals.bytes / target_bytes))
    made = json.loads(dict(state.properties or {}).get("zorder", "{}"))
    wanted = {"cols": list(cols), "files": n_files, "bits": bits}
    if state.live == made.pop("live", None) and not state.dropped and made == wanted:
        return CommitResult("OPTIMIZE", state.version, state.version, {"numFilesBefore": totals.files, "numFilesAfter": totals.files})
    scan = target.scan_state(state)
    rows = target.read_state(state).count()
    bounds = _bounds(scan, cols, rows, 1 << bits)
    columns = [F.col(f"`{n}`") for n in schema.names]
    named = [f"lk_bucket_{i}" for i in range(len(cols))]
    known = {c: F.lit(bounds[c]).cast(T.ArrayType(schema[c].dataType)) if bounds[c] else None for c in cols}
    placed = _with_buckets(scan.select(*columns, row_address().alias("lk_address")), cols, known, named, bits)
    # a column of few values still fills all its bits, so that it counts as much as the others
    wide = [F.floor(F.shiftleft(F.col(n).cast("bigint"), bits) / F.lit(len(bounds[c]) + 1)).alias(n) for c, n in zip(cols, named)]
    placed = placed.select(*columns, "lk_address", *wide)
    words, width = z_words([F.col(n) for n in named], bits)
    leading = list(state.partition_by or [])
    partitions = target.file_sizes(state).select(F.regexp_replace("entry", "^[^/]*/|[^/]*$", "")).distinct().count() if leading else 1
    cell_bits = max(1, min(width, _CELL_BITS - math.ceil(math.log2(partitions))))
    z = [f"lk_z{i}" for i in range(len(words))]
    placed = placed.select(*columns, "lk_address", *[w.alias(n) for w, n in zip(words, z)])
    placed = placed.withColumn("lk_cell", F.shiftright("lk_z0", width - cell_bits))

    keys = [*leading, "lk_cell"]
    counts = placed.groupBy(*[F.col(f"`{k}`").alias(f"lk_of_{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("lk_rows"))
    order = [f"lk_of_{i}" for i in range(len(keys))]
    before = F.sum("lk_rows").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("lk_rows")
    cells = counts.withColumn("lk_before", before)
    if partitions << cell_bits <= 1 << _CELL_BITS:
        cells = F.broadcast(cells)  # at most 2**_CELL_BITS rows
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(o)) for k, o in zip(keys, order)])
    share = F.pmod("lk_address", F.lit(1 << 30)) / F.lit(float(1 << 30))
    part = F.floor((F.col("lk_before") + share * F.col("lk_rows")) * F.lit(n_files) / F.lit(max(rows, 1)))
    spread = placed.join(cells, same).withColumn("lk_part", F.least(part, F.lit(n_files - 1)).cast("int"))
    spread = spread.repartitionById(n_files, F.col("lk_part")).sortWithinPartitions(*[F.col(f"`{k}`") for k in leading], *z)
    entry, _ = target.write_folder(spread, state, arranged=True)
    after = len(target.files_below([entry], schema))
    metrics = {"numFilesBefore": totals.files, "numFilesAfter": after}
    noted = {**(state.properties or {}), "zorder": json.dumps({**wanted, "live": [entry]})}
    return _publish(target, Row(**{**state.asDict(), "properties": noted}), metrics, [entry], [], attempts)


def files_by_probe(target: SnapshotTable, probes: Sequence[tuple[str, str, object, object]]) -> DataFrame:
    """(probe, row_count, files_hit, files): for each (name, column, low, high) the rows in the range and the files whose own range of that column meets it."""
    state = target.state()
    ranges = target.scan_state(state).groupBy(F.col("_metadata.file_path").alias("lk_file"))
    held = [F.count_if(F.col(f"`{c}`").between(F.lit(low), F.lit(high))).alias(f"n{i}") for i, (_, c, low, high) in enumerate(probes)]
    met = [
        ((F.min(f"`{c}`") <= F.lit(high)) & (F.max(f"`{c}`") >= F.lit(low))).alias(f"m{i}") for i, (_, c, low, high) in enumerate(probes)
    ]
    total = ranges.agg(*held, *met).agg(
        F.count(F.lit(1)).alias("files"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(probes))], *[F.count_if(f"m{i}").alias(f"m{i}") for i in range(len(probes))]
    )
    rows = [F.struct(F.lit(name).alias("probe"), F.col(f"n{i}").alias("row_count"), F.col(f"m{i}").alias("files_hit"), "files") for i, (name, *_) in enumerate(probes)]
    return total.select(F.inline(F.array(*rows)))


# -- vacuum --------------------------------------------------------------------------------------------------------


def retained_versions(log: DataFrame, cutoff: Column) -> DataFrame:
    """``live`` and ``dropped`` of every version a reader may still ask for: committed since the cut-off, or current
    at it. The newest version is always one of these."""
    lists = F.struct("live", "dropped").alias("lists")
    since = log.where(F.col("committed_at") > cutoff).select(lists)
    at_cutoff = log.where(F.col("committed_at") <= cutoff).agg(F.max_by(lists, "version").alias("lists"))
    return since.unionByName(at_cutoff).select("lists.*")


def vacuum_candidates(files: DataFrame, log: DataFrame, cutoff: Column) -> DataFrame:
    """Files (entry, length, modified) that no retained version uses and that are older than the cut-off.

    A retained version uses a file that it lists, or whose folder it lists unless it dropped the file. So a file is
    free when it is listed nowhere and dropped as often as its folder is listed.
    """
    retained = retained_versions(log, cutoff)
    listed = retained.select(F.explode("live").alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("uses"))
    drops = retained.select(F.explode("dropped").alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("drops"))
    old = files.where(F.col("modified") < cutoff).withColumn("folder", F.substring_index("entry", "/", 1))
    free = (
        old.join(listed, "entry", "left_anti")
        .join(listed.withColumnRenamed("entry", "folder"), "folder", "left")
        .join(drops, "entry", "left")
    )
    unused = F.coalesce("uses", F.lit(0)) <= F.coalesce("drops", F.lit(0))
    return free.where(unused).select(files.columns)


def stored_files(target: SnapshotTable) -> DataFrame:
    """(entry, length, modified) of all data files on storage, live or not."""
    files = paths.list_files(target.spark, target.data_dir)
    return files.select(
        entry_of(F.col("uri")).alias("entry"), "length", F.col("modificationTime").alias("modified")
    )


def vacuum(
    target: SnapshotTable, hours: int | None = None, dry_run: bool = False, now: Column | None = None
) -> tuple[DataFrame, int]:
    """Delete files that retained versions do not use; returns (candidates, files deleted).

    A retention below the minimum is refused, also for a dry run; None means the minimum.
    """
    retention = MIN_RETENTION_HOURS if hours is None else hours
    if retention < MIN_RETENTION_HOURS:
        raise RetentionTooShort(f"retention of {retention} hours is below the minimum of {MIN_RETENTION_HOURS}")
    clock = F.current_timestamp() if now is None else now
    cutoff = clock - F.make_interval(hours=F.lit(retention))
    spark = target.spark
    moment = spark.range(1).select(cutoff.cast("timestamp").alias("c")).first()["c"]
    candidates = vacuum_candidates(stored_files(target), target.log(), F.lit(moment))
    if dry_run:
        return candidates, 0
    # The list is fixed first: it must not change while files disappear.
    listed, listed_at = landed(candidates.withColumn("folder", F.substring_index("entry", "/", 1)), "vacuum")
    stored = stored_files(target).groupBy(F.substring_index("entry", "/", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("stored")
    )
    dead = listed.groupBy("folder").agg(F.count(F.lit(1)).alias("dead")).join(stored, "folder")
    # A folder without any file in use goes as a whole, one call instead of one per file.
    whole = dead.where("dead = stored").select("folder")
    single = listed.join(dead.where("dead < stored").select("folder"), "folder", "left_semi").select("entry")
    removed = listed.count()
    with ThreadPoolExecutor(max_workers=16) as pool:
        doomed = whole.unionByName(single.withColumnRenamed("entry", "folder")).toLocalIterator()
        while batch := list(islice(doomed, 1000)):
            list(pool.map(lambda row: paths.delete(spark, f"{target.data_dir}/{unquote(row.folder)}"), batch))
    paths.delete(spark, listed_at)
    return candidates, removed


# -- statistics ----------------------------------------------------------------------------------------------------


def column_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: row_count, null_count, distinct_approx, min_value and max_value as text. One scan."""
    wanted = list(cols) if cols else [
        f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
    ]
    aggregates = []
    for i, name in enumerate(wanted):
        col = F.col(f"`{name}`")
        aggregates += [
            F.count_if(col.isNull()).alias(f"nulls_{i}"),
            F.approx_count_distinct(col).alias(f"distinct_{i}"),
            F.min(col).cast("string").alias(f"min_{i}"),
            F.max(col).cast("string").alias(f"max_{i}"),
        ]
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"nulls_{i}").alias("null_count"),
                F.col(f"distinct_{i}").alias("distinct_approx"),
                F.col(f"min_{i}").alias("min_value"),
                F.col(f"max_{i}").alias("max_value"),
            )
            for i, name in enumerate(wanted)
        ]
    )
    return totals.select(F.inline(rows))


def analyze(target: SnapshotTable, columns: Sequence[str] | None = None) -> DataFrame:
    """Collect table statistics (row and file counts, bytes; column statistics on request) and keep them.

    The row count comes from Parquet footers, the sizes from a listing. The result is stored beside the table, one
    folder per version, and returned.
    """
    state = target.state()
    rows = target.read_state(state)
    row_count = rows.count()
    table_stats = target.file_sizes(state).agg(
        F.lit(state.version).cast("bigint").alias("version"),
        F.lit(row_count).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"),
    )
    table_stats.coalesce(1).write.mode("overwrite").parquet(f"{target.base}/stats/v={state.version}/table")
    if columns:
        path = f"{target.base}/stats/v={state.version}/columns"
        column_stats(rows, columns).coalesce(1).write.mode("overwrite").parquet(path)
    return target.spark.read.parquet(f"{target.base}/stats/v={state.version}/table")


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType,))


def file_sketches(scan: DataFrame, schema: T.StructType, cols: Sequence[str]) -> DataFrame:
    """One row per file: its row count and, per column, NULLs, lowest and highest value, an HLL sketch and for numbers a KLL sketch of doubles."""
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    for i, name in enumerate(cols):
        col = F.col(f"`{name}`")
        aggregates += [F.count_if(col.isNull()).alias(f"nulls_{i}"), F.min(col).alias(f"low_{i}"), F.max(col).alias(f"high_{i}")]
        aggregates.append(F.hll_sketch_agg(col.cast("string"), F.lit(_HLL_BITS)).alias(f"hll_{i}"))
        if _is_number(schema[name].dataType):
            aggregates.append(F.kll_sketch_agg_double(col.cast("double"), F.lit(_KLL_K)).alias(f"kll_{i}"))
    return scan.groupBy(entry_of(F.col("_metadata.file_path")).alias("entry")).agg(*aggregates)


# Sizes of the sketches kept per file and column.
_HLL_BITS, _KLL_K = 11, 200


def analyze_files(target: SnapshotTable, cols: Sequence[str]) -> tuple[DataFrame, int]:
    """Statistics of columns from sketches kept per file, and how many files had to be read.

    Files never change, so each is read once: its sketches are stored beside the table, and a later run reads only the files that came
    since and merges the sketches of all live ones. Returns column_name, row_count, null_count, distinct_approx, min_value,
    max_value (as text) and median_approx (numbers only).
    """
    state = target.state()
    schema = schema_of(state)
    unknown = [c for c in cols if c not in schema.names]
    if unknown or not cols:
        raise ValueError(f"columns not in the table: {', '.join(unknown) or 'none given'}")
    fields = [schema[c] for c in cols]
    layout = T.StructType(fields).json() + f"{_HLL_BITS} {_KLL_K}"
    kept_at = f"{target.base}/stats/files/{hashlib.sha256(layout.encode()).hexdigest()[:16]}"
    kinds = [T.StructField("entry", T.StringType()), T.StructField("row_count", T.LongType())]
    for i, f in enumerate(fields):
        kinds += [T.StructField(f"nulls_{i}", T.LongType()), T.StructField(f"low_{i}", f.dataType), T.StructField(f"high_{i}", f.dataType), T.StructField(f"hll_{i}", T.BinaryType())]
        kinds += [T.StructField(f"kll_{i}", T.BinaryType())] if _is_number(f.dataType) else []
    stored = T.StructType(kinds)
    spark = target.spark
    known = spark.read.schema(stored).parquet(kept_at) if paths.exists(spark, kept_at) else spark.createDataFrame([], stored)
    live = target.file_sizes(state).select("entry")
    fresh = sorted(r.entry for r in live.join(known, "entry", "left_anti").collect())
    if fresh:
        file_sketches(target.scan(fresh, schema), schema, cols).select(*stored.names).write.mode("append").parquet(kept_at)
        known = spark.read.schema(stored).parquet(kept_at)
    # two runs at a time may both have stored a file
    mine = known.join(live, "entry", "left_semi").dropDuplicates(["entry"])
    merged = [F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")]
    for i, f in enumerate(fields):
        merged += [F.coalesce(F.sum(f"nulls_{i}"), F.lit(0)).alias(f"n{i}"), F.min(f"low_{i}").cast("string").alias(f"l{i}"), F.max(f"high_{i}").cast("string").alias(f"h{i}")]
        merged.append(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"hll_{i}")), F.lit(0)).alias(f"d{i}"))
        if _is_number(f.dataType):
            merged.append(F.kll_merge_agg_double(f"kll_{i}").alias(f"q{i}"))
    total = mine.agg(*merged)
    rows = []
    for i, f in enumerate(fields):
        empty = F.col("rows") == F.col(f"n{i}")
        middle = F.when(~empty, F.kll_sketch_get_quantile_double(F.col(f"q{i}"), F.lit(0.5))) if _is_number(f.dataType) else F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"n{i}").alias("null_count"),
                F.col(f"d{i}").alias("distinct_approx"),
                F.col(f"l{i}").alias("min_value"),
                F.col(f"h{i}").alias("max_value"),
                middle.alias("median_approx"),
            )
        )
    return total.select(F.inline(F.array(*rows))), len(fresh)


def analyze_catalog_table(spark, name: str) -> None:
    """Table statistics of a session-catalog table, kept by the catalog."""
    quoted = ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
    spark.sql(f"ANALYZE TABLE {quoted} COMPUTE STATISTICS")


def live_file_count(target: SnapshotTable) -> int:
    return target.file_sizes().count()
