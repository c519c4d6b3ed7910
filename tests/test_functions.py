"""Column functions and the statement library on small inputs with known results."""

import json

from pyspark.sql import functions as F

from lakeops.functions.columns import blank_to, bracket, zero_to_null
from lakeops.functions.names import classify_name, with_name_parts
from lakeops.functions.params import merge_params, params_map, render
from lakeops.sources.statements import read_statement_library


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def merged(spark, defaults, override):
    return json.loads(one(spark, merge_params(F.lit(defaults), F.lit(override)))[0])


def test_override_wins(spark):
    got = merged(spark, '{"key1":"valuex","key2":"valuey"}', '{"key1":"value1"}')
    assert got == {"key1": "value1", "key2": "valuey"}


def test_both_blank_gives_an_empty_object(spark):
    assert merged(spark, "", "") == {}
    assert merged(spark, "{}", " ") == {}


def test_without_override_defaults_stay(spark):
    assert merged(spark, '{"parm1":"a","parm2":"b"}', "") == {"parm1": "a", "parm2": "b"}


def test_blank_defaults_take_the_override(spark):
    assert merged(spark, "", '{"a":1}') == {"a": 1}


def test_values_keep_their_json_types(spark):
    got = merged(spark, '{"n":1,"o":{"x":[1,2]},"b":true}', '{"n":null}')
    assert got == {"n": None, "o": {"x": [1, 2]}, "b": True}


def test_placeholders(spark):
    text = "select '{etl_date}', '{jobrunid}', '{taskrunid}', {extra}, {unknown} from t"
    params = '{"etl_date":"2022-01-01","jobrunid":"12","taskrunid":"34","extra":7}'
    got = one(spark, render(F.lit(text), params_map(F.lit(params))))[0]
    assert got == "select '2022-01-01', '12', '34', 7, {unknown} from t"


def test_placeholders_are_filled_in_key_order(spark):
    got = one(spark, render(F.lit("{z}"), params_map(F.lit('{"z":"{a}","a":"done"}'))))[0]
    assert got == "done"
    assert one(spark, render(F.lit("x {k}"), params_map(F.lit('{"k":null}'))))[0] == "x null"
    assert one(spark, render(F.lit("x {k}"), params_map(F.lit(""))))[0] == "x {k}"


def write(spark, path, text):
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.text(path)


def test_statement_library_of_two(spark, scratch):
    path = scratch("lib")
    write(
        spark,
        path,
        'first = """\nselect a,\n  b from t where x = \'1\';\n"""\n\n# a note; with = signs\nsecond = """select 1;"""\n',
    )
    rows = read_statement_library(spark, path).orderBy("pos").collect()
    assert [(r.sql_var, r.sql_text) for r in rows] == [
        ("first", "select a,\n  b from t where x = '1'"),
        ("second", "select 1"),
    ]


def test_statement_library_last_of_a_name_wins(spark, scratch):
    path = scratch("lib")
    write(spark, path, "".join(f'sql{i} = """select {i};"""\n' for i in (1, 2, 3, 4)) + 'sql2 = """select 22;"""')
    rows = {r.sql_var: r.sql_text for r in read_statement_library(spark, path).collect()}
    assert rows == {"sql1": "select 1", "sql2": "select 22", "sql3": "select 3", "sql4": "select 4"}


def test_name_levels(spark):
    cases = {"a": "CATALOG", "a.b": "SCHEMA", " a . b.c ": "TABLE", "a..b": "SCHEMA", "a.b.c.d": "INVALID", "..": "INVALID"}
    df = spark.createDataFrame([(n,) for n in cases] + [(None,)], "name STRING")
    got = {r.name: r.kind for r in df.select("name", classify_name(F.col("name")).alias("kind")).collect()}
    assert got == {**cases, None: "INVALID"}
    parts = with_name_parts(df.where("name = ' a . b.c '"), "name").first()
    assert (parts.catalog_name, parts.schema_name, parts.table_name) == ("a", "b", "c")


def test_bracket_ends(spark):
    cases = {0: "0-20", 20: "0-20", 21: "21-40", 40: "21-40", 41: "41-60", 60: "41-60", 61: "61+", -1: "Unknown"}
    df = spark.createDataFrame([(n,) for n in cases] + [(None,)], "n INT")
    got = {r.n: r.b for r in df.select("n", bracket(F.col("n")).alias("b")).collect()}
    assert got == {**cases, None: "Unknown"}


def test_blank_and_zero(spark):
    df = spark.createDataFrame([("", 0), (None, None), ("x", 5)], "s STRING, n INT")
    got = df.select(blank_to(F.col("s"), "DF"), zero_to_null(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("DF", None), ("DF", None), ("x", 5)]
