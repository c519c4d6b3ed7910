"""Delete, update, merge and version diff. Only files that hold affected rows are rewritten."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops import paths
from lakeops.operators.landing import landed
from lakeops.sources.snapshot import CommitResult, SnapshotTable, entry_of, folder_of, schema_of


class DuplicateMergeKeys(ValueError):
    """The merge source holds a key more than once."""


def _as_column(condition: str | Column) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def _distinct_files(uris: DataFrame) -> list[str]:
    """Entries of the files a column of file URIs names (file names only reach the driver)."""
    return sorted(row.entry for row in uris.select(entry_of(F.col(uris.columns[0])).alias("entry")).distinct().collect())


def touched_files(target: SnapshotTable, state: Row, condition: Column, alias: str | None = None) -> list[str]:
    """Entries of the live files that hold a row where the condition is true."""
    if not state.live:
        return []
    names = [F.col(f"`{n}`") for n in schema_of(state).names]
    located = target.scan_state(state).select(*names, F.col("_metadata.file_path").alias("lk_file"))
    return _distinct_files(_named(located, alias).where(condition).select("lk_file"))


def _named(df: DataFrame, alias: str | None) -> DataFrame:
    return df.alias(alias) if alias else df


def without_files(target: SnapshotTable, state: Row, touched: Sequence[str]) -> tuple[list[str], list[str]]:
    """(live entries, newly dropped files) of a version without some of its files.

    Folders that lose no file stay as they are. One that loses files stays a folder with dropped files, or, when more
    than half of it is gone, is replaced by the files left. So the log lists the smaller side.
    """
    gone: dict[str, set[str]] = {}
    for entry in (*state.dropped, *touched):
        gone.setdefault(folder_of(entry), set()).add(entry)
    hit = {folder_of(entry) for entry in touched}
    live = [e for e in state.live if ("/" in e and e not in gone.get(folder_of(e), ())) or ("/" not in e and e not in hit)]
    dropped: list[str] = []
    opened = [e for e in state.live if "/" not in e and e in hit]
    files: dict[str, list[str]] = {folder: [] for folder in opened}
    for entry in target.files_below(opened, schema_of(state)):
        files[folder_of(entry)].append(entry)
    for folder, members in files.items():
        left = [e for e in members if e not in gone[folder]]
        if 2 * len(left) >= len(members) and left:
            live.append(folder)
            dropped += [e for e in touched if folder_of(e) == folder]
        else:
            live += left
    return live, dropped


def delete_where(target: SnapshotTable, condition: str | Column | None = None, alias: str | None = None) -> CommitResult:
    """Remove rows where the condition is true; rows where it is false or NULL stay.

    The condition can hold subqueries, and qualify the table's columns with ``alias``.
    """
    state = target.state()
    if condition is None:
        count = target.read_state(state).count()
        return target.commit(state.version, state, "DELETE", {"numDeletedRows": count}, [])
    hit = _as_column(condition)
    touched = touched_files(target, state, hit, alias)
    if not touched:
        return target.commit(state.version, state, "DELETE", {"numDeletedRows": 0}, state.live)
    rows = _named(target.read_entries(touched, schema_of(state)), alias).withColumn("lk_hit", F.coalesce(hit, F.lit(False)))
    doomed = F.col("lk_hit")
    # The scan reads the rows partition by partition already: rewriting them needs no shuffle.
    entry, counts = target.write_folder(rows, state, {"deleted": F.count_if(doomed)}, cut=~doomed, arranged=True)
    live, dropped = without_files(target, state, touched)
    live += [entry] if counts["rows_written"] else []
    metrics = {"numDeletedRows": counts["deleted"]}
    return target.commit(state.version, state, "DELETE", metrics, live, dropped=dropped)


def update_where(
    target: SnapshotTable,
    assignments: Mapping[str, str | Column],
    condition: str | Column | None = None,
    alias: str | None = None,
) -> CommitResult:
    """Set columns on rows where the condition is true (all rows without one).

    Condition and values can hold subqueries, and qualify the table's columns with ``alias``.
    """
    state = target.state()
    schema = schema_of(state)
    hit = F.coalesce(_as_column(condition), F.lit(False)) if condition is not None else F.lit(True)
    touched = touched_files(target, state, hit, alias) if condition is not None else target.live_files(state)
    if not touched:
        return target.commit(state.version, state, "UPDATE", {"numUpdatedRows": 0}, state.live)
    new_values = {name.lower(): _as_column(value) for name, value in assignments.items()}
    unknown = set(new_values) - {name.lower() for name in schema.names}
    if unknown:
        raise ValueError(f"columns not in the table: {', '.join(sorted(unknown))}")
    tag = "lk_hit"
    flagged = _named(target.read_entries(touched, schema), alias).withColumn(tag, hit)
    rows = flagged.select(
        tag,
        *[
            F.when(F.col(tag), new_values[f.name.lower()].cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
            if f.name.lower() in new_values
            else F.col(f"`{f.name}`")
            for f in schema.fields
        ],
    )
    moves = any(name.lower() in new_values for name in state.partition_by or [])
    entry, counts = target.write_folder(rows, state, {"updated": F.count_if(F.col(tag))}, arranged=not moves)
    live, dropped = without_files(target, state, touched)
    metrics = {"numUpdatedRows": counts["updated"]}
    return target.commit(state.version, state, "UPDATE", metrics, [*live, entry], dropped=dropped)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _key_range(source: DataFrame, schema: T.StructType, keys: Sequence[str]) -> Column:
    """The range of the source's keys as a filter on the target.

    It reaches the Parquet scan, so on a table laid out by its keys most files and row groups are skipped before the
    join. Only keys of the same type on both sides whose values pass through Python unchanged take part.
    """
    plain = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.StringType, T.DateType)
    types = {f.name.lower(): f.dataType for f in schema.fields}
    used = [
        f.name
        for f in source.schema.fields
        if f.name.lower() in {k.lower() for k in keys}
        and isinstance(f.dataType, plain)
        and types.get(f.name.lower()) == f.dataType
    ]
    if not used:
        return F.lit(True)
    ends = source.agg(*[f(k).alias(f"{n}_{k}") for k in used for n, f in (("low", F.min), ("high", F.max))]).first()
    condition = F.lit(True)
    for k in used:
        condition = condition & F.col(k).between(F.lit(ends[f"low_{k}"]), F.lit(ends[f"high_{k}"]))
    return condition


def _clause(clause: str | Mapping[str, str] | None, schema: T.StructType, source: DataFrame) -> dict:
    """Column expressions of an UPDATE or INSERT clause; "all" copies the columns the source has."""
    if clause is None:
        return {}
    if clause == "all":
        have = {name.lower(): name for name in source.columns}
        return {
            f.name: F.col(f"s.`{have[f.name.lower()]}`").cast(f.dataType)
            for f in schema.fields
            if f.name.lower() in have
        }
    given = {name.lower(): F.expr(text) for name, text in clause.items()}
    unknown = set(given) - {name.lower() for name in schema.names}
    if unknown:
        raise ValueError(f"columns not in the table: {', '.join(sorted(unknown))}")
    return {f.name: given[f.name.lower()].cast(f.dataType) for f in schema.fields if f.name.lower() in given}


def merge(
    target: SnapshotTable,
    source: DataFrame,
    keys: Sequence[str],
    update: str | Mapping[str, str] | None = "all",
    insert: str | Mapping[str, str] | None = "all",
    delete_when: str | None = None,
    update_when: str | None = None,
) -> CommitResult:
    """Upsert by key. Clauses see the target row as ``t`` and the source row as ``s``.

    A matched row is deleted when ``delete_when`` holds, else updated when ``update_when`` holds (always without
    one); source rows without a match are inserted. A key that is NULL never matches. A repeated source key raises.

    The source is unique by key, so only the target side can be skewed. It is therefore the left side of a left
    join, which adaptive execution can cut at a hot key, and its keys are made distinct (with map-side combine)
    before they meet the source in the anti join. A full outer join could not be cut.
    """
    source, landed_at = landed(source, "merge-source")
    try:
        return _merge_landed(target, source, keys, update, insert, delete_when, update_when)
    finally:
        paths.delete(target.spark, landed_at)


def _merge_landed(target, source, keys, update, insert, delete_when, update_when) -> CommitResult:
    state = target.state()
    schema = schema_of(state)
    repeated = source.where(~_any_null(keys)).groupBy(*keys).count().where("count > 1")
    if repeated.take(1):
        raise DuplicateMergeKeys(f"{target.name}: merge source repeats a key of ({', '.join(keys)})")

    touched: list[str] = []
    if state.live:
        near = target.scan_state(state).where(_key_range(source, schema, keys))
        located = near.select(*keys, F.col("_metadata.file_path").alias("lk_file"))
        touched = _distinct_files(located.join(source.select(*keys), list(keys), "left_semi").select("lk_file"))

    rewrites = update is not None or delete_when is not None
    old = target.read_entries(touched, schema)
    branches = []
    if rewrites and touched:
        hits = source.withColumn("lk_hit", F.lit(True)).alias("s")
        on = reduce(lambda a, b: a & b, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys])
        joined = old.alias("t").join(hits, on, "left")
        hit = F.coalesce(F.col("lk_hit"), F.lit(False))
        action = F.lit("kept")
        if update is not None:
            wanted = F.coalesce(F.expr(update_when), F.lit(False)) if update_when else F.lit(True)
            action = F.when(hit & wanted, "updated").otherwise(action)
        if delete_when is not None:
            action = F.when(hit & F.coalesce(F.expr(delete_when), F.lit(False)), "deleted").otherwise(action)
        new_values = _clause(update, schema, source)
        tagged = joined.withColumn("lk_action", action)
        branches.append(
            tagged.select(
                "lk_action",
                *[
                    F.when(F.col("lk_action") == "updated", new_values[f.name])
                    .otherwise(F.col(f"t.`{f.name}`"))
                    .alias(f.name)
                    if f.name in new_values
                    else F.col(f"t.`{f.name}`").alias(f.name)
                    for f in schema.fields
                ],
            )
        )
    if insert is not None:
        values = _clause(insert, schema, source)
        present = old.select(*keys).distinct()
        unmatched = source.where(~_any_null(keys)).join(present, list(keys), "left_anti")
        unmatched = unmatched.unionByName(source.where(_any_null(keys))).alias("s")
        branches.append(
            unmatched.select(
                F.lit("inserted").alias("lk_action"),
                *[
                    (values[f.name] if f.name in values else F.lit(None).cast(f.dataType)).alias(f.name)
                    for f in schema.fields
                ],
            )
        )
    if not branches:
        return target.commit(state.version, state, "MERGE", {}, state.live)
    result = reduce(DataFrame.unionByName, branches)
    tallies = {name: F.count_if(F.col("lk_action") == name) for name in ("inserted", "updated", "deleted")}
    entry, counts = target.write_folder(result, state, tallies, cut=F.col("lk_action") != "deleted")
    live, dropped = without_files(target, state, touched) if rewrites else (list(state.live), [])
    live += [entry] if counts["rows_written"] else []
    metrics = {
        "numTargetRowsInserted": counts["inserted"],
        "numTargetRowsUpdated": counts["updated"],
        "numTargetRowsDeleted": counts["deleted"],
    }
    return target.commit(state.version, state, "MERGE", metrics, live, dropped=dropped)


@dataclass(frozen=True)
class MergeClause:
    """One WHEN clause: its outcome (updated, deleted or inserted), its condition and the values by column; without values
    the columns of the source are taken by name."""

    outcome: str
    condition: Column | None = None
    values: Mapping[str, Column] | None = None


def merge_into(
    target: SnapshotTable,
    source: DataFrame,
    on: Column,
    matched: Sequence[MergeClause] = (),
    unmatched: Sequence[MergeClause] = (),
    missing: Sequence[MergeClause] = (),
    target_alias: str = "t",
    source_alias: str = "s",
) -> CommitResult:
    """MERGE with any condition and any number of clauses; of several that hold, the first counts.

    ``matched`` clauses see both rows, ``unmatched`` ones a source row without partner, ``missing`` ones a target row without partner.
    A target row with several partners raises, unless all there is to do with it is to delete it.

    The pairs that meet are found once, as (file, row, source row), and kept as a table. What follows joins on these unique
    addresses, or the target with those source rows that met it, of which a target row has one: only the target side can be
    skewed, and as the left side of a left join adaptive execution can cut it.
    """
    numbered, landed_at = landed(source.withColumn("lk_source", F.monotonically_increasing_id()), "merge-source")
    used = [landed_at]
    try:
        return _merge_numbered(target, numbered, on, list(matched), list(unmatched), list(missing), target_alias, source_alias, used)
    finally:
        for path in used:
            paths.delete(target.spark, path)


def _first_clause(clauses: Sequence[MergeClause]) -> Column:
    """Number of the first clause that holds, NULL without one."""
    out = F.lit(None).cast("int")
    for number, clause in reversed(list(enumerate(clauses))):
        holds = F.lit(True) if clause.condition is None else F.coalesce(clause.condition, F.lit(False))
        out = F.when(holds, number).otherwise(out)
    return out


def _outcome(clauses: Sequence[MergeClause], otherwise: Column) -> Column:
    out = otherwise
    for number, clause in enumerate(clauses):
        out = F.when(F.col("lk_clause") == number, clause.outcome).otherwise(out)
    return out


def _values(clauses: Sequence[MergeClause], schema: T.StructType, source: DataFrame, source_alias: str, old) -> list[Column]:
    """The table's columns after the clause of each row; ``old`` gives the column as it was."""
    have = {name.lower(): name for name in source.columns}
    known = {f.name.lower() for f in schema.fields}
    out = []
    for clause in clauses:
        strange = sorted(set(clause.values or {}) - known)
        if strange:
            raise ValueError(f"columns not in the table: {', '.join(strange)}")
    for f in schema.fields:
        value = old(f)
        for number, clause in enumerate(clauses):
            if clause.outcome == "deleted":
                continue
            key = f.name.lower()
            if clause.values is not None:
                new = clause.values.get(key)
            else:
                new = F.col(f"`{source_alias}`.`{have[key]}`") if key in have else None
            if new is None and clause.outcome == "inserted":
                new = F.lit(None)
            if new is not None:
                value = F.when(F.col("lk_clause") == number, new.cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    return out


def _merge_numbered(target, source, on, matched, unmatched, missing, target_alias, source_alias, used) -> CommitResult:
    state = target.state()
    schema = schema_of(state)
    plain = [name for name in source.columns if name != "lk_source"]
    empty = target.spark.range(0).selectExpr("'' AS lk_file", "id AS lk_row", "id AS lk_source")
    if state.live:
        address = target.scan_state(state).select(
            *[F.col(f"`{n}`") for n in schema.names],
            F.col("_metadata.file_path").alias("lk_file"),
            F.col("_metadata.row_index").alias("lk_row"),
        )
        pairs = address.alias(target_alias).join(source.alias(source_alias), on).select("lk_file", "lk_row", "lk_source")
        pairs, pairs_at = landed(pairs, "merge-pairs")
        used.append(pairs_at)
    else:
        pairs = empty
    only_deleted = len(matched) == 1 and matched[0].outcome == "deleted" and matched[0].condition is None
    if matched and not only_deleted and pairs.groupBy("lk_file", "lk_row").count().where("count > 1").take(1):
        raise DuplicateMergeKeys(f"{target.name}: several rows of the merge source match one row")

    touched: list[str] = []
    if missing:
        touched = target.live_files(state)
    elif matched:
        touched = _distinct_files(pairs.select("lk_file"))
    met = pairs.select("lk_source").distinct()
    branches = []
    if touched:
        as_was = lambda f: F.col(f"`{target_alias}`.`{f.name}`")
        old = target.scan(touched, schema)
        hits = source.join(met, "lk_source", "left_semi")
        if only_deleted and not missing:
            rows = old.select(*[F.col(f"`{n}`") for n in schema.names], F.col("_metadata.file_path").alias("lk_file"), F.col("_metadata.row_index").alias("lk_row"))
            rows = rows.join(pairs.select("lk_file", "lk_row").distinct().withColumn("lk_hit", F.lit(True)), ["lk_file", "lk_row"], "left")
            outcome = F.when(F.col("lk_hit"), "deleted").otherwise("kept")
            branches.append(rows.select(outcome.alias("lk_action"), *[F.col(f"`{n}`") for n in schema.names]))
        else:
            old = old.select(*[F.col(f"`{n}`") for n in schema.names]).alias(target_alias)
            partners = hits.withColumn("lk_hit", F.lit(True)).alias(source_alias)
            if missing:
                # these clauses know no source columns
                lonely = old.join(partners, on, "left_anti").withColumn("lk_clause", _first_clause(missing))
                branches.append(lonely.select(_outcome(missing, F.lit("kept")).alias("lk_action"), *_values(missing, schema, source.select(*plain), source_alias, as_was)))
                if only_deleted:
                    both = old.join(partners, on, "left_semi").withColumn("lk_clause", F.lit(0))
                    branches.append(both.select(F.lit("deleted").alias("lk_action"), *[as_was(f).alias(f.name) for f in schema.fields]))
            if not (missing and only_deleted):
                both = old.join(partners, on, "inner" if missing else "left")
                both = both.withColumn("lk_clause", F.when(F.col("lk_hit"), _first_clause(matched)))
                branches.append(both.select(_outcome(matched, F.lit("kept")).alias("lk_action"), *_values(matched, schema, source.select(*plain), source_alias, as_was)))
    if unmatched:
        new = source.join(met, "lk_source", "left_anti").alias(source_alias).withColumn("lk_clause", _first_clause(unmatched)).where("lk_clause IS NOT NULL")
        nothing = lambda f: F.lit(None).cast(f.dataType)
        branches.append(new.select(F.lit("inserted").alias("lk_action"), *_values(unmatched, schema, source.select(*plain), source_alias, nothing)))
    counts = {"inserted": 0, "updated": 0, "deleted": 0, "rows_written": 0}
    live, dropped = list(state.live), []
    if branches:
        tallies = {name: F.count_if(F.col("lk_action") == name) for name in ("inserted", "updated", "deleted")}
        entry, counts = target.write_folder(reduce(DataFrame.unionByName, branches), state, tallies, cut=F.col("lk_action") != "deleted")
        live, dropped = without_files(target, state, touched)
        live += [entry] if counts["rows_written"] else []
    metrics = {f"numTargetRows{name.capitalize()}": counts[name] for name in ("inserted", "updated", "deleted")}
    return target.commit(state.version, state, "MERGE", metrics, live, dropped=dropped)


def _row_fingerprint(schema: T.StructType) -> Column:
    """64-bit hash of a row. NULL flags are hashed too, because the hash itself skips NULLs."""
    values = [
        F.to_json(F.col(f"`{f.name}`"))
        if isinstance(f.dataType, (T.MapType, T.VariantType))
        else F.col(f"`{f.name}`")
        for f in schema.fields
    ]
    return F.xxhash64(*values, *[v.isNull() for v in values])


def diff_frames(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that differ between two frames, with ``change`` inserted, updated or deleted.

    Both sides are hashed to (key, fingerprint) and summed per key in one aggregation: no join, partial sums on the
    map side, so a key that many rows share does not end up in one large group.
    """
    names = before.columns

    def side(df: DataFrame, is_after: int) -> DataFrame:
        df = df.select(*names)
        mark = _row_fingerprint(df.schema)
        return df.select(
            *keys,
            F.lit(1 - is_after).cast("bigint").alias("lk_old"),
            F.lit(is_after).cast("bigint").alias("lk_new"),
            (mark.bitwiseAND(F.lit(0xFFFFFFFF)) * (1 - 2 * is_after)).alias("lk_low"),
            (F.shiftrightunsigned(mark, 32) * (1 - 2 * is_after)).alias("lk_high"),
        )

    sums = (
        side(before, 0)
        .unionByName(side(after, 1))
        .groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in ("lk_old", "lk_new", "lk_low", "lk_high")])
    )
    change = (
        F.when(F.col("lk_old") == 0, "inserted")
        .when(F.col("lk_new") == 0, "deleted")
        .when((F.col("lk_old") != F.col("lk_new")) | (F.col("lk_low") != 0) | (F.col("lk_high") != 0), "updated")
    )
    return sums.select(*keys, change.alias("change")).where("change IS NOT NULL")


def _apart(target: SnapshotTable, state: Row, other: Row) -> list[str]:
    """Files of a version below the entries that another does not have, or has with other files dropped."""
    changed = {folder_of(e) for e in set(state.dropped) ^ set(other.dropped)}
    shared = {e for e in set(state.live) & set(other.live) if "/" in e or e not in changed}
    return target.live_files(Row(**{**state.asDict(), "live": [e for e in state.live if e not in shared]}))


def diff_versions(target: SnapshotTable, before: int, after: int, keys: Sequence[str]) -> DataFrame:
    """Row-level changes between two versions; ``keys`` must identify a row.

    Files both versions share hold the same rows and are not read; of folders that both hold alike not even the names are.
    """
    old_state, new_state = target.state(before), target.state(after)
    schema = schema_of(new_state)
    old_files, new_files = set(_apart(target, old_state, new_state)), set(_apart(target, new_state, old_state))
    return diff_frames(
        target.read_entries(sorted(old_files - new_files), schema),
        target.read_entries(sorted(new_files - old_files), schema),
        keys,
    )


def change_counts(changes: DataFrame) -> DataFrame:
    """One row: rows_inserted, rows_updated, rows_deleted."""
    return changes.agg(
        *[F.count_if(F.col("change") == name).alias(f"rows_{name}") for name in ("inserted", "updated", "deleted")]
    )
