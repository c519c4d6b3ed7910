"""Checks of incremental file ingest and the streaming aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.checks.registry import check, new_lake, table
from lakeops.operators.writes import TableSpec, ensure_tables
from lakeops.session import scratch_path
from lakeops.streaming.aggregate import stream_aggregate
from lakeops.streaming.ingest import infer_stream_schema, ingest_files


def _as_text(df):
    """All columns as text, the shape untyped files have."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _drops(spark, df, halves, fmt, **write_options):
    """A source folder and the two writes that put the two halves of a frame into it."""
    src = scratch_path(spark, f"drop-{fmt}")

    def put(condition):
        df.where(condition).write.format(fmt).options(**write_options).mode("append").save(src)

    return src, [lambda c=c: put(c) for c in (halves, f"NOT ({halves})")]


def _target(lake, name, schema):
    ensure_tables(lake, [TableSpec(name, schema)])
    return lake.table(name)


def _load_twice(spark, label, df, halves, fmt, infer_types=False, **write_options):
    """Two drops, each followed by a run, and a third run that must find nothing."""
    src, puts = _drops(spark, df, halves, fmt, **write_options)
    lake = new_lake(spark, label)
    puts[0]()
    schema = infer_stream_schema(spark, src, fmt, infer_types)
    target = _target(lake, f"dev.bronze.{label}", schema)
    checkpoint = scratch_path(spark, f"checkpoint-{label}")
    ingest_files(spark, src, target, checkpoint, fmt, infer_types=infer_types)
    puts[1]()
    ingest_files(spark, src, target, checkpoint, fmt, infer_types=infer_types)
    idle = ingest_files(spark, src, target, checkpoint, fmt, infer_types=infer_types)
    if idle:
        raise AssertionError(f"a run without new files committed {idle}")
    return target.read()


@check("ingest_csv", "SELECT * FROM customer")
def ingest_csv(spark, sf):
    customers = table(spark, sf, "customer")
    loaded = _load_twice(spark, "customer", customers, "c_acctbal < 5000", "csv", header=True)
    return loaded.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in customers.schema.fields])


@check("ingest_json", "SELECT * FROM events")
def ingest_json(spark, sf):
    events = table(spark, sf, "events")
    loaded = _load_twice(spark, "events", _as_text(events), "event_type IN ('click', 'view')", "json")
    return loaded.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in events.schema.fields])


@check("ingest_parquet", "SELECT * FROM orders")
def ingest_parquet(spark, sf):
    return _load_twice(spark, "orders", table(spark, sf, "orders"), "o_orderstatus = 'O'", "parquet")


@check(
    "ingest_schema_infer",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def ingest_schema_infer(spark, sf):
    loaded = _load_twice(
        spark, "typed", table(spark, sf, "customer"), "c_acctbal < 5000", "csv", infer_types=True, header=True
    )
    types = {f.name: f.dataType for f in loaded.schema.fields}
    if not (isinstance(types["c_acctbal"], T.DoubleType) and isinstance(types["c_nationkey"], T.IntegerType)):
        raise AssertionError(f"types were not inferred: {types}")
    return loaded.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@check(
    "ingest_evolve",
    """SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN p_brand END AS p_brand,
              CASE WHEN p_size > 25 THEN p_size END AS p_size FROM part""",
)
def ingest_evolve(spark, sf):
    # The second drop has two more columns, and its columns stand in another order.
    parts = _as_text(table(spark, sf, "part"))
    src = scratch_path(spark, "drop-evolve")
    target = _target(
        new_lake(spark, "evolve"),
        "dev.bronze.part",
        T.StructType([T.StructField("p_partkey", T.StringType()), T.StructField("p_name", T.StringType())]),
    )
    checkpoint = scratch_path(spark, "checkpoint-evolve")
    first = parts.where("p_size <= 25").select("p_partkey", "p_name")
    first.write.csv(src, header=True)
    ingest_files(spark, src, target, checkpoint)
    second = parts.where("p_size > 25").select("p_brand", "p_name", "p_size", "p_partkey")
    second.write.mode("append").csv(src, header=True)
    ingest_files(spark, src, target, checkpoint)
    return target.read().select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", "p_brand", F.col("p_size").cast("int")
    )


@check(
    "metrics_stream",
    """SELECT batch, operation, inserted FROM (
         SELECT 1 AS batch, 'STREAMING UPDATE' AS operation, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS inserted FROM orders
         UNION ALL SELECT 2, 'STREAMING UPDATE', CAST(count_if(o_orderstatus <> 'O') AS BIGINT) FROM orders)""",
)
def metrics_stream(spark, sf):
    orders = table(spark, sf, "orders")
    src, puts = _drops(spark, orders, "o_orderstatus = 'O'", "parquet")
    target = _target(new_lake(spark, "metrics"), "dev.bronze.orders", orders.schema)
    checkpoint = scratch_path(spark, "checkpoint-metrics")
    rows = []
    for batch, put in enumerate(puts, 1):
        put()
        done = ingest_files(spark, src, target, checkpoint, "parquet")
        rows.append((batch, done[0].operation, sum(d.row_counts[0] for d in done)))
    return spark.createDataFrame(rows, "batch INT, operation STRING, inserted BIGINT")


@check(
    "stream_complete_counts",
    """SELECT event_type, count(*) AS event_count, max(event_id) AS last_event FROM events GROUP BY event_type""",
)
def stream_complete_counts(spark, sf):
    events = table(spark, sf, "events")
    src, puts = _drops(spark, events, "value < 50", "parquet")
    layout = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.max("event_id").alias("last_event")
    )
    target = _target(new_lake(spark, "complete"), "dev.gold.event_counts", layout.schema)
    checkpoint = scratch_path(spark, "checkpoint-complete")
    aggregates = [F.count(F.lit(1)).alias("event_count"), F.max("event_id").alias("last_event")]
    for put in puts:
        put()
        stream_aggregate(spark, src, "parquet", events.schema, ["event_type"], aggregates, target, checkpoint)
    return target.read()


_RESCUED = """CASE WHEN event_id % 3 = 2 AND event_id % 7 = 0 THEN '{"value":"n/a ' || event_id || '"}' END"""


@check(
    "ingest_type_drift",
    f"""SELECT CASE WHEN event_id % 3 = 1 THEN event_id + 3000000000 ELSE event_id END AS event_id,
      CASE event_id % 3 WHEN 0 THEN floor(value) WHEN 1 THEN value ELSE CASE WHEN event_id % 7 <> 0 THEN value END END AS value,
      CASE WHEN event_id % 3 = 2 THEN user_id END AS user_id, {_RESCUED} AS rescued, format
    FROM events, (VALUES ('csv'), ('json')) f(format)""",
)
def ingest_type_drift(spark, sf):
    """Three drops of events: whole numbers, then larger ids and fractions (both columns widen), then texts among the numbers
    (kept in the rescue column) and a new column."""
    events = table(spark, sf, "events")
    part = F.col("event_id") % 3
    drops = [
        events.where(part == 0).select("event_id", F.floor("value").alias("value")),
        events.where(part == 1).select((F.col("event_id") + 3000000000).alias("event_id"), "value"),
        events.where(part == 2).select(
            "event_id",
            F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("n/a "), "event_id")).otherwise(F.col("value").cast("string")).alias("value"),
            "user_id",
        ),
    ]
    out = None
    for fmt in ("csv", "json"):
        src, lake = scratch_path(spark, f"drift-{fmt}"), new_lake(spark, f"drift-{fmt}")
        target, checkpoint = lake.table("dev.bronze.events"), scratch_path(spark, f"checkpoint-drift-{fmt}")
        for rows in drops:
            rows.write.format(fmt).options(**({"header": True} if fmt == "csv" else {})).mode("append").save(src)
            ingest_files(spark, src, target, checkpoint, fmt, infer_types=True, rescue="rescued")
        found = target.read().select("event_id", "value", F.col("user_id").cast("bigint").alias("user_id"), "rescued", F.lit(fmt).alias("format"))
        out = found if out is None else out.unionByName(found)
    return out
