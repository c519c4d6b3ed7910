"""Checks of table scans, sinks and change-tracked writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.checks.registry import check, new_lake, table
from lakeops.operators.changes import change_counts, delete_where, diff_versions, merge, update_where
from lakeops.operators.upkeep import analyze_catalog_table
from lakeops.operators.writes import (
    TableSpec,
    append,
    append_by_name,
    append_select,
    describe_tables,
    ensure_catalog_tables,
    ensure_tables,
    overwrite,
    rows_df,
    write_clustered,
)
from lakeops.session import scratch_path
from lakeops.sources.inventory import lake_inventory, table_inventory
from lakeops.sources.snapshot import read_table, table_history


def made(lake, name, df, **spec):
    """A lake table with the columns of a frame, still empty."""
    ensure_tables(lake, [TableSpec(name, df.schema, **spec)])
    return lake.table(name)


@check(
    "table_scan",
    """SELECT l_returnflag, l_linestatus, count(*) AS line_count,
              CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
       FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2""",
)
def table_scan(spark, sf):
    lake = new_lake(spark, "scan")
    lines = table(spark, sf, "lineitem")
    append(lines, made(lake, "dev.bronze.lineitem", lines, partition_by=["l_returnflag"]))
    read = read_table(spark, lake, "dev.bronze.lineitem").where("l_returnflag <> 'N'")
    return read.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


_STATUSES = ("O", "F", "P")


@check(
    "history_latest",
    """SELECT CAST(3 AS BIGINT) AS version, 'WRITE' AS operation,
              (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS rows_written,
              CAST(4 AS BIGINT) AS versions FROM (SELECT 1)""",
)
def history_latest(spark, sf):
    lake = new_lake(spark, "history")
    orders = table(spark, sf, "orders")
    target = made(lake, "dev.bronze.orders", orders)
    for status in _STATUSES:
        append(orders.where(F.col("o_orderstatus") == status), target)
    history = table_history(lake, "dev.bronze.orders")
    versions = history.count()
    return history.limit(1).select(
        "version",
        "operation",
        F.col("metrics")["numOutputRows"].alias("rows_written"),
        F.lit(versions).cast("bigint").alias("versions"),
    )


@check(
    "version_pairs",
    """SELECT prev_version, version, rows_written FROM (
         SELECT CAST(0 AS BIGINT) AS prev_version, CAST(1 AS BIGINT) AS version, count(*) AS rows_written
           FROM orders WHERE o_orderstatus = 'O'
         UNION ALL SELECT 1, 2, count(*) FROM orders WHERE o_orderstatus = 'F'
         UNION ALL SELECT 2, 3, count(*) FROM orders WHERE o_orderstatus = 'P')""",
)
def version_pairs(spark, sf):
    orders = table(spark, sf, "orders")
    target = made(new_lake(spark, "pairs"), "dev.bronze.orders", orders)
    done = [append(orders.where(F.col("o_orderstatus") == status), target) for status in _STATUSES]
    rows = [(d.prev_version, d.version, d.metrics["numOutputRows"]) for d in done]
    return spark.createDataFrame(rows, "prev_version BIGINT, version BIGINT, rows_written BIGINT")


@check(
    "metrics_write",
    """SELECT operation, inserted, updated, deleted, stored FROM (
         SELECT 'append' AS operation, count(*) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted,
                count(*) AS stored FROM lineitem
         UNION ALL SELECT 'overwrite', count(*), 0, 0, count(*) FROM lineitem WHERE l_quantity > 25)""",
)
def metrics_write(spark, sf):
    lines = table(spark, sf, "lineitem")
    target = made(new_lake(spark, "metrics"), "dev.bronze.lineitem", lines)
    rows = []
    for label, write, df in (("append", append, lines), ("overwrite", overwrite, lines.where("l_quantity > 25"))):
        done = write(df, target)
        rows.append((label, *done.row_counts, target.read().count()))
    return spark.createDataFrame(rows, "operation STRING, inserted BIGINT, updated BIGINT, deleted BIGINT, stored BIGINT")


@check(
    "insert_select_all",
    """SELECT o_orderkey AS dst_id, o_orderpriority AS dst_priority, CAST(NULL AS DOUBLE) AS dst_total,
              CAST(o_orderdate AS DATE) AS dst_load_date FROM orders""",
)
def insert_select_all(spark, sf):
    columns = "dst_id BIGINT, dst_priority STRING, dst_total DOUBLE, dst_load_date DATE"
    layout = spark.range(0).selectExpr(
        *[f"cast(null as {c.split()[1]}) AS {c.split()[0]}" for c in columns.split(", ")]
    )
    target = made(new_lake(spark, "insert-all"), "dev.silver.orders", layout)
    rows = table(spark, sf, "orders").select(F.to_date("o_orderdate"), "o_orderkey", "o_orderpriority")
    append_select(rows, target, ["dst_load_date", "dst_id", "dst_priority"])
    return target.read()


@check(
    "insert_by_name",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
       UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier""",
)
def insert_by_name(spark, sf):
    suppliers = table(spark, sf, "supplier")
    target = made(new_lake(spark, "by-name"), "dev.bronze.supplier", suppliers)
    append_by_name(suppliers.select("s_acctbal", "s_name", "s_nationkey", "s_suppkey"), target)
    append_by_name(suppliers.select("s_name", "s_suppkey"), target)
    return target.read()


@check(
    "insert_values",
    """SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT * FROM (VALUES (-1, 'unknown'), (-2, 'none'))""",
)
def insert_values(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    target = made(new_lake(spark, "values"), "dev.bronze.supplier", suppliers)
    append(rows_df(spark, [(-1, "unknown"), (-2, "none")], "s_suppkey BIGINT, s_name STRING"), target)
    append(suppliers, target)
    return target.read()


@check("append_frames", "SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_size > 25")
def append_frames(spark, sf):
    parts = table(spark, sf, "part")
    target = made(new_lake(spark, "append"), "dev.bronze.part", parts)
    append(parts, target)
    append(parts.where("p_size > 25"), target)
    return target.read()


@check(
    "overwrite_partition",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 WHEN o_orderpriority = '5-LOW'
         THEN 1.0 ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders""",
)
def overwrite_partition(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    target = made(new_lake(spark, "partition"), "dev.gold.orders", orders, partition_by=["o_orderpriority"])
    append(orders, target)
    urgent = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.lit(0.0))
    overwrite(urgent, target, partition={"o_orderpriority": "1-URGENT"})
    low = orders.where("o_orderpriority = '5-LOW'").withColumn("o_totalprice", F.lit(1.0))
    overwrite(low, target, dynamic=True)
    return target.read()


@check(
    "ddl_roundtrip",
    """SELECT 'dev.bronze.customer' AS table_name, x.column_name, x.type_name, n.rows_kept FROM
         (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'),
                 ('c_mktsegment', 'string')) x(column_name, type_name),
         (SELECT count(*) AS rows_kept FROM customer) n""",
)
def ddl_roundtrip(spark, sf):
    lake = new_lake(spark, "ddl")
    customers = table(spark, sf, "customer")
    spec = TableSpec("dev.bronze.customer", customers.schema, comment="customers", cluster_by=["c_custkey"])
    ensure_tables(lake, [spec])
    append(customers, lake.table(spec.name))
    ensure_tables(lake, [spec], replace=True)
    append(customers, lake.table(spec.name))
    ensure_tables(lake, [spec])
    kept = lake.read(spec.name).count()
    columns = describe_tables(lake, [spec.name]).select("table_name", "column_name", "type_name")
    return columns.withColumn("rows_kept", F.lit(kept).cast("bigint"))


@check("clustered_write", "SELECT * FROM lineitem")
def clustered_write(spark, sf):
    path = scratch_path(spark, "clustered")
    write_clustered(table(spark, sf, "lineitem"), path, ["l_returnflag", "l_linestatus"])
    return spark.read.parquet(path)


@check(
    "inventory",
    """SELECT 'dev' AS catalog_name, 'bronze' AS schema_name, lower(c_mktsegment) AS table_name,
              count(*) AS row_count FROM customer GROUP BY c_mktsegment""",
)
def inventory(spark, sf):
    lake = new_lake(spark, "inventory")
    customers = table(spark, sf, "customer")
    counts = None
    for (segment,) in customers.select("c_mktsegment").distinct().collect():
        name = f"dev.bronze.{segment}"
        append(customers.where(F.col("c_mktsegment") == segment), made(lake, name, customers))
        one = lake.read(name).agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(segment.lower()))
        counts = one if counts is None else counts.unionByName(one)
    return lake_inventory(lake).join(counts, "table_name")


@check(
    "delete_where",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
       WHERE o_orderpriority IS NULL OR NOT (o_orderpriority = '5-LOW' AND o_totalprice > 100000)""",
)
def delete_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    target = made(new_lake(spark, "delete"), "dev.silver.orders", orders)
    append(orders, target)
    delete_where(target, "o_orderpriority = '5-LOW' AND o_totalprice > 100000")
    return target.read()


@check(
    "update_where",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN upper(p_name) ELSE p_name END AS p_name,
              CASE WHEN p_size > 40 THEN 0 ELSE p_size END AS p_size FROM part""",
)
def update_rows(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    target = made(new_lake(spark, "update"), "dev.silver.part", parts)
    append(parts, target)
    update_where(target, {"p_name": "upper(p_name)", "p_size": "0"}, "p_size > 40")
    return target.read()


@check(
    "metrics_changes",
    """SELECT * FROM (
      SELECT 'DELETE' AS operation, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated,
        (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS deleted
      UNION ALL SELECT 'UPDATE', 0, (SELECT count(*) FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'), 0
      UNION ALL SELECT 'MERGE', (SELECT count(*) FROM customer WHERE c_acctbal < 0),
        (SELECT count(*) FROM customer WHERE c_acctbal >= 0 AND c_nationkey <> 3),
        (SELECT count(*) FROM customer WHERE c_acctbal >= 0 AND c_nationkey = 3))""",
)
def metrics_changes(spark, sf):
    customers = table(spark, sf, "customer")
    target = made(new_lake(spark, "changes"), "dev.silver.customer", customers)
    append(customers, target)
    done = [
        delete_where(target, "c_acctbal < 0"),
        update_where(target, {"c_acctbal": "0"}, "c_mktsegment = 'BUILDING'"),
        merge(target, customers, ["c_custkey"], delete_when="t.c_nationkey = 3"),
    ]
    rows = [(d.operation, *d.row_counts) for d in done]
    return spark.createDataFrame(rows, "operation STRING, inserted BIGINT, updated BIGINT, deleted BIGINT")


@check(
    "merge_upsert",
    """WITH target AS (SELECT * FROM customer WHERE c_mktsegment <> 'FURNITURE')
    SELECT t.c_custkey, t.c_name, CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal + 1 END AS c_acctbal,
           t.c_mktsegment
      FROM target t LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 12) s ON t.c_custkey = s.c_custkey
      WHERE s.c_custkey IS NULL OR NOT (t.c_acctbal < 0)
    UNION ALL SELECT c_custkey, c_name, c_acctbal + 1, c_mktsegment FROM customer
      WHERE c_mktsegment = 'FURNITURE' AND c_nationkey < 12""",
)
def merge_upsert(spark, sf):
    customers = table(spark, sf, "customer")
    kept = customers.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    target = made(new_lake(spark, "merge"), "dev.silver.customer", kept)
    append(kept.where("c_mktsegment <> 'FURNITURE'"), target)
    source = customers.where("c_nationkey < 12").select(
        "c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment"
    )
    merge(target, source, ["c_custkey"], update={"c_acctbal": "s.c_acctbal"}, delete_when="t.c_acctbal < 0")
    return target.read()


@check(
    "diff_versions",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'deleted' WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'updated'
         ELSE 'inserted' END AS change FROM customer
       WHERE c_mktsegment = 'BUILDING' OR (c_mktsegment <> 'HOUSEHOLD' AND c_nationkey = 5) OR c_mktsegment = 'HOUSEHOLD'
      """,
)
def version_diff(spark, sf):
    customers = table(spark, sf, "customer")
    target = made(new_lake(spark, "diff"), "dev.silver.customer", customers)
    before = append(customers.where("c_mktsegment <> 'HOUSEHOLD'"), target).version
    delete_where(target, "c_mktsegment = 'BUILDING'")
    update_where(target, {"c_acctbal": "c_acctbal + 1"}, "c_nationkey = 5")
    after = append(customers.where("c_mktsegment = 'HOUSEHOLD'"), target).version
    return diff_versions(target, before, after, ["c_custkey"])


@check(
    "diff_counts",
    """SELECT CAST(count_if(c_mktsegment = 'HOUSEHOLD') AS BIGINT) AS rows_inserted,
              CAST(count_if(c_mktsegment <> 'HOUSEHOLD' AND c_nationkey = 5) AS BIGINT) AS rows_updated,
              CAST(count_if(c_nationkey = 6 AND c_mktsegment <> 'HOUSEHOLD') AS BIGINT) AS rows_deleted FROM customer""",
)
def diff_counts(spark, sf):
    customers = table(spark, sf, "customer")
    target = made(new_lake(spark, "diff-counts"), "dev.silver.customer", customers)
    before = append(customers.where("c_mktsegment <> 'HOUSEHOLD'"), target).version
    merge(
        target,
        customers.where("c_nationkey IN (5, 6) OR c_mktsegment = 'HOUSEHOLD'").withColumn("c_acctbal", F.lit(-1.5)),
        ["c_custkey"],
        delete_when="t.c_nationkey = 6",
    )
    return change_counts(diff_versions(target, before, target.latest_version(), ["c_custkey"]))


@check("catalog_tables", "SELECT p_size, count(*) AS part_count FROM part GROUP BY p_size")
def catalog_tables(spark, sf):
    parts = table(spark, sf, "part")
    path = scratch_path(spark, "catalog")
    name = f"{path.rsplit('/', 1)[-1].replace('-', '_')}.part"
    spec = TableSpec(f"dev.{name}", parts.schema, comment="parts of the catalog check")
    ensure_catalog_tables(spark, [spec], location=path)
    ensure_catalog_tables(spark, [spec], replace=True)
    parts.write.insertInto(name)
    analyze_catalog_table(spark, name)
    return spark.table(name).groupBy("p_size").agg(F.count(F.lit(1)).alias("part_count"))


@check(
    "catalog_inventory",
    """SELECT 'spark_catalog' AS catalog_name, 'inv_' || lower(replace(r_name, ' ', '_')) AS schema_name, lower(replace(n_name, ' ', '_')) AS table_name
       FROM nation JOIN region ON n_regionkey = r_regionkey
       UNION ALL SELECT 'dev', 'bronze', lower(replace(r_name, ' ', '_')) FROM region""",
)
def catalog_inventory(spark, sf):
    """Tables of the session catalog, a schema per region and a table per nation, together with those of a lake; views are none."""
    regions, nations = table(spark, sf, "region"), table(spark, sf, "nation")
    plain = lambda c: F.lower(F.replace(F.col(c), F.lit(" "), F.lit("_")))
    names = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(plain("r_name").alias("r"), plain("n_name").alias("n"))
    lake, where = new_lake(spark, "inventory-run"), scratch_path(spark, "inventory-catalog")
    for r, n in names.collect():
        ensure_catalog_tables(spark, [TableSpec(f"inv_{r}.{n}", nations.schema)], replace=True, location=f"{where}/{r}")
        if not lake.exists(f"dev.bronze.{r}"):
            made(lake, f"dev.bronze.{r}", nations)
    nations.createOrReplaceTempView("inventory_view")
    return table_inventory(spark, lake=lake).where("schema_name LIKE 'inv%' OR catalog_name = 'dev'")
