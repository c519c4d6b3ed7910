"""Run a check in Spark and its SQL in DuckDB and compare the rows.

``python -m tests.oracle [sf] [name ...]`` prints one line per check.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return int(value) if value.is_integer() else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, sf_dir: str, query, sql: str | None) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    got_columns, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"{len(got)} rows (no SQL)"
    con = duck(sf_dir)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want_columns, want = _sorted_rows(columns, cursor.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    apart = {c: (t, types[c]) for c, t in df.dtypes if DUCK_TYPES.get(t, t) != types[c]}
    if apart:
        return False, f"types differ: {apart}"
    if len(got) != len(want):
        return False, f"{len(got)} rows != {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        return False, f"{len(different)} rows differ, first: {different[0]}"
    return True, f"{len(got)} rows"


def main() -> None:
    from lakeops.session import build_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    oracles, failed = entry.oracle_sql(), []
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, f"/root/testdata/sf{sf}", entry.queries()[name], oracles.get(name))
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {note}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")


if __name__ == "__main__":
    main()
