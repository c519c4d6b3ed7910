"""Checks of column expressions, filters and count reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.checks.registry import check, table
from lakeops.functions.columns import (
    blank_to,
    bracket,
    day_of_month,
    normalise,
    on_date,
    project,
    weekday_name,
    with_run_columns,
    zero_to_null,
)
from lakeops.functions.names import classify_name, table_key, with_name_parts
from lakeops.functions.params import as_variant, detail, has_detail, merge_params, params_map, render
from lakeops.operators.counts import count_by, count_by_bracket


@check(
    "project_rename",
    """SELECT c_name AS dst_name, c_custkey AS dst_id, c_mktsegment AS dst_segment, c_acctbal AS dst_balance
       FROM customer""",
)
def project_rename(spark, sf):
    names = {
        "dst_name": "c_name",
        "dst_id": "c_custkey",
        "dst_segment": "c_mktsegment",
        "dst_balance": "c_acctbal",
    }
    return project(table(spark, sf, "customer"), names)


@check(
    "blank_default",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 'DF' ELSE event_type END AS event_type
       FROM events""",
)
def blank_default(spark, sf):
    # 'error' becomes blank and 'view' becomes NULL; both must come out as the default.
    raw = F.when(F.col("event_type") == "error", "").when(F.col("event_type") != "view", F.col("event_type"))
    return table(spark, sf, "events").select("event_id", blank_to(raw, "DF").alias("event_type"))


@check(
    "nullif_zero",
    """SELECT doc_id, CASE WHEN quality = 0 THEN NULL ELSE quality END AS quality,
              CASE WHEN toxic = 0 THEN NULL ELSE toxic END AS toxic FROM labels""",
)
def nullif_zero(spark, sf):
    return table(spark, sf, "labels").select(
        "doc_id", zero_to_null(F.col("quality")).alias("quality"), zero_to_null(F.col("toxic")).alias("toxic")
    )


_BRACKET_SQL = """CASE WHEN {c} BETWEEN 0 AND 20 THEN '0-20' WHEN {c} BETWEEN 21 AND 40 THEN '21-40'
    WHEN {c} BETWEEN 41 AND 60 THEN '41-60' WHEN {c} > 60 THEN '61+' ELSE 'Unknown' END"""


@check(
    "age_bracket",
    f"""SELECT event_id, {_BRACKET_SQL.format(c="value")} AS value_bracket,
               {_BRACKET_SQL.format(c="(value - 30)")} AS shifted_bracket,
               {_BRACKET_SQL.format(c="(CASE WHEN event_type = 'error' THEN NULL ELSE value END)")} AS gap_bracket
        FROM events""",
)
def age_bracket(spark, sf):
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        bracket(value).alias("value_bracket"),
        bracket(value - 30).alias("shifted_bracket"),
        bracket(F.when(F.col("event_type") != "error", value)).alias("gap_bracket"),
    )


@check(
    "date_filter",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
       WHERE CAST(l_shipdate AS DATE) = DATE '1998-03-05' AND l_linestatus = 'F'""",
)
def date_filter(spark, sf):
    rows = table(spark, sf, "lineitem").where(on_date(F.col("l_shipdate"), "1998-03-05") & (F.col("l_linestatus") == "F"))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")


@check(
    "normalise_text",
    """SELECT doc_id, upper(trim('  ' || lang || ' ')) AS lang, lower(trim(upper(source))) AS source,
              lower(trim(text)) AS text FROM documents""",
)
def normalise_text(spark, sf):
    padded = F.concat(F.lit("  "), F.col("lang"), F.lit(" "))
    return table(spark, sf, "documents").select(
        "doc_id",
        normalise(padded).alias("lang"),
        normalise(F.upper("source"), "lower").alias("source"),
        normalise(F.col("text"), "lower").alias("text"),
    )


_NAME_SQL = """SELECT c_custkey,
    CASE c_mktsegment WHEN 'BUILDING' THEN ' ' || r_name || ' '
         WHEN 'AUTOMOBILE' THEN r_name || '.' || n_name
         WHEN 'MACHINERY' THEN r_name || '..' || n_name || '.' || replace(c_name, '#', '_')
         WHEN 'FURNITURE' THEN r_name || '.' || n_name || '.' || c_mktsegment || '.x'
         WHEN 'HOUSEHOLD' THEN CASE WHEN c_acctbal < 0 THEN NULL ELSE n_name || '. .' END END AS full_name,
    r_name, n_name, c_name, c_mktsegment, c_acctbal
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _dotted_names(spark, sf):
    places = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", F.concat(F.lit(" "), "r_name", F.lit(" ")))
        .when(segment == "AUTOMOBILE", F.concat_ws(".", "r_name", "n_name"))
        .when(segment == "MACHINERY", F.concat_ws(".", "r_name", F.lit(""), "n_name", F.translate("c_name", "#", "_")))
        .when(segment == "FURNITURE", F.concat_ws(".", "r_name", "n_name", "c_mktsegment", F.lit("x")))
        .when(F.col("c_acctbal") >= 0, F.concat("n_name", F.lit(". .")))
    )
    return places.select("c_custkey", name.alias("full_name"))


@check(
    "classify_names",
    f"""WITH names AS ({_NAME_SQL})
    SELECT c_custkey, full_name,
      CASE WHEN full_name IS NULL THEN 'INVALID' ELSE CASE c_mktsegment WHEN 'BUILDING' THEN 'CATALOG'
        WHEN 'AUTOMOBILE' THEN 'SCHEMA' WHEN 'MACHINERY' THEN 'TABLE' WHEN 'FURNITURE' THEN 'INVALID'
        ELSE 'CATALOG' END END AS object_type,
      CASE WHEN full_name IS NULL THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN n_name ELSE r_name END AS catalog_name,
      CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY', 'FURNITURE') THEN n_name END AS schema_name,
      CASE c_mktsegment WHEN 'MACHINERY' THEN replace(c_name, '#', '_') WHEN 'FURNITURE' THEN c_mktsegment END
        AS table_name
    FROM names""",
)
def classify_names(spark, sf):
    return with_name_parts(_dotted_names(spark, sf), "full_name")


@check(
    "table_keys",
    f"""WITH names AS ({_NAME_SQL})
    SELECT c_custkey, lower(r_name || '.' || n_name || '.' || c_name) AS table_key,
           CASE WHEN full_name IS NULL THEN 'INVALID' ELSE CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'SCHEMA'
             WHEN 'MACHINERY' THEN 'TABLE' WHEN 'FURNITURE' THEN 'INVALID' ELSE 'CATALOG' END END AS object_type
    FROM names""",
)
def table_keys(spark, sf):
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    keyed = table(spark, sf, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    key = table_key(F.col("r_name"), F.col("n_name"), F.col("c_name"))
    kinds = _dotted_names(spark, sf).select("c_custkey", classify_name(F.col("full_name")).alias("object_type"))
    return keyed.select("c_custkey", key.alias("table_key")).join(kinds, "c_custkey")


@check(
    "json_extract",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              json_exists(props, '$.k') AS has_k, json_exists(props, '$.missing') AS has_missing,
              CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def json_extract(spark, sf):
    parsed = as_variant(F.col("props"))
    return table(spark, sf, "events").select(
        "event_id",
        detail(parsed, "k", "bigint").alias("k"),
        has_detail(parsed, "k").alias("has_k"),
        has_detail(parsed, "missing").alias("has_missing"),
        detail(parsed, "missing").alias("missing"),
    )


@check(
    "param_override",
    """SELECT event_id,
         CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR) ELSE json_extract_string(props, '$.k') END AS k,
         CASE WHEN event_type IN ('purchase', 'click') THEN event_type END AS kind,
         CASE WHEN event_type = 'signup' THEN 0 WHEN event_type IN ('purchase', 'click') THEN 2 ELSE 1 END AS n_keys
       FROM events""",
)
def param_override(spark, sf):
    kind = F.col("event_type")
    defaults = F.when(kind == "signup", "").otherwise(F.col("props"))
    both = F.to_json(F.struct(F.col("user_id").cast("string").alias("k"), kind.alias("kind")))
    one = F.to_json(F.struct(kind.alias("kind")))
    override = F.when(kind == "purchase", both).when(kind == "click", one).otherwise("")
    merged = F.parse_json(merge_params(defaults, override))
    shown = table(spark, sf, "events").select("event_id", "props", "event_type", merged.alias("m"))
    return shown.select(
        "event_id",
        F.when(kind == "signup", F.get_json_object("props", "$.k")).otherwise(detail(F.col("m"), "k")).alias("k"),
        detail(F.col("m"), "kind").alias("kind"),
        F.size(F.map_keys(F.col("m").cast("map<string,variant>"))).alias("n_keys"),
    )


@check(
    "render_statement",
    """SELECT event_id, 'SELECT ' || CAST(user_id AS VARCHAR) || ' FROM t WHERE d = ''' ||
         CAST(CAST(ts AS DATE) AS VARCHAR) || ''' AND k = ' || json_extract_string(props, '$.k') ||
         ' AND run = ''{jobrunid}''' AS statement FROM events""",
)
def render_statement(spark, sf):
    params = F.to_json(
        F.struct(
            F.to_date("ts").alias("etl_date"), F.col("user_id").alias("user"), F.get_json_object("props", "$.k").alias("k")
        )
    )
    text = F.lit("SELECT {user} FROM t WHERE d = '{etl_date}' AND k = {k} AND run = '{jobrunid}'")
    return table(spark, sf, "events").select("event_id", render(text, params_map(params)).alias("statement"))


@check(
    "calendar_parts",
    """SELECT o_orderkey, upper(dayname(o_orderdate)) AS weekday, CAST(day(o_orderdate) AS INTEGER) AS dom
       FROM orders""",
)
def calendar_parts(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", weekday_name(F.col("o_orderdate")).alias("weekday"), day_of_month(F.col("o_orderdate")).alias("dom")
    )


@check(
    "casts",
    """SELECT event_id, CAST(ts AS DATE) AS load_date, CAST(user_id AS VARCHAR) AS user_text, ts AS event_ts
       FROM events""",
)
def casts(spark, sf):
    text = table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
        "user_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso_text"),
    )
    return text.select(
        "event_id",
        F.col("day_text").cast("date").alias("load_date"),
        F.col("user_id").cast("string").alias("user_text"),
        F.col("iso_text").cast("timestamp_ntz").alias("event_ts"),
    )


@check(
    "run_stamp",
    """SELECT o_orderstatus, count(*) AS row_count, count(*) AS ids, CAST(1 AS BIGINT) AS stamps, 'nightly' AS job_name
       FROM orders GROUP BY o_orderstatus""",
)
def run_stamp(spark, sf):
    stamped = with_run_columns(table(spark, sf, "orders"), "log_id", "logged_at", job_name="nightly")
    return stamped.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("log_id").alias("ids"),
        F.count_distinct("logged_at").alias("stamps"),
        F.max("job_name").alias("job_name"),
    )


@check(
    "gold_counts",
    """SELECT event_type, count(*) AS event_count FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'
       GROUP BY event_type""",
)
def gold_counts(spark, sf):
    return count_by(table(spark, sf, "events"), ["event_type"], on_date(F.col("ts"), "2024-01-10"), "event_count")


@check(
    "gold_age_brackets",
    f"""SELECT {_BRACKET_SQL.format(c="p_size")} AS size_bracket, count(*) AS part_count FROM part GROUP BY 1""",
)
def gold_age_brackets(spark, sf):
    return count_by_bracket(table(spark, sf, "part"), F.col("p_size"), label="size_bracket", name="part_count")
