"""Input gates on the fixture frames."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.operators.input_rules import InputError, Rule, gate_rules, rule_column_names, validate_input
from lacuna.params import InputLimits


def failing(report, severity="error"):
    return {(r["rule"], r["column"]): r["measured"] for r in report.where(f"severity = '{severity}' and not passed").collect()}


def test_good_frame_passes(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (3.0, None), (None, "z")], "A double, B string")
    assert failing(validate_input(df, strict=True)) == {}


def test_empty_table(spark):
    df = spark.createDataFrame([], "A double")
    assert ("empty", None) in failing(validate_input(df))
    with pytest.raises(InputError, match="empty"):
        validate_input(df, strict=True)
    with pytest.raises(InputError):
        validate_input(None)


def test_no_columns(spark):
    assert ("empty", None) in failing(validate_input(spark.createDataFrame([], T.StructType([]))))


def test_row_limit(spark):
    df = spark.range(200000).withColumnRenamed("id", "A")
    assert failing(gate_rules(df, InputLimits(max_rows=1000))) == {("max_rows", None): 200000.0}
    assert failing(gate_rules(df, InputLimits(max_rows=None))) == {}


def test_column_limit(spark):
    df = spark.range(2).select(*[(F.col("id") + 1).alias(f"c{i}") for i in range(60)])
    assert failing(gate_rules(df, InputLimits(max_columns=50))) == {("max_columns", None): 60.0}


def test_empty_column(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, None, "z")], "A int, B double, C string")
    assert ("empty_column", "B") in failing(gate_rules(df))
    with pytest.raises(InputError, match="empty_column in B"):
        validate_input(df, strict=True)


def test_missing_percentage(spark):
    df = spark.createDataFrame([(None, None), (None, None), (None, None), (1.0, "x")], "A double, B string")
    assert failing(gate_rules(df, InputLimits(max_missing_percentage=50.0)))["missing_percentage", None] == 75.0


def test_min_values(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "y"), (None, "z"), (None, None)], "A double, B string")
    assert failing(gate_rules(df)) == {("min_values", "A"): 1.0}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (float("nan"),), (1.0,)], "A double")
    assert failing(gate_rules(df)) == {("min_values", "A"): 1.0}


def test_names_only_warn(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a int, b int, c int, d int, e int").toDF("A", "A", " ", "p/q", "r:s")
    found = {(r["rule"], r["column"]) for r in rule_column_names(df).collect()}
    assert found == {("duplicate_name", "A"), ("blank_name", " "), ("awkward_name", "p/q")}
    two = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int").toDF("A", "A")
    assert failing(validate_input(two, strict=True)) == {}


def test_long_name(spark):
    df = spark.range(2).toDF("x" * 101)
    assert [r["rule"] for r in rule_column_names(df).collect()] == ["long_name"]


def test_quality_warnings(spark):
    df = spark.createDataFrame([(1.0, "x", "1"), (2.0, "x", "2"), (None, "x", "3"), (4.0, "x", "4")], "A double, B string, C string")
    assert set(failing(validate_input(df), "warning")) == {("constant", "B"), ("numeric_text", "C")}


def test_high_cardinality(spark):
    df = spark.range(20).select(F.concat(F.lit("v"), F.col("id")).alias("u"), F.lit("c").alias("k"))
    assert ("high_cardinality", "u") in failing(validate_input(df), "warning")


def test_user_rule(spark):
    df = spark.range(10).toDF("a")
    assert failing(gate_rules(df, rules=[Rule("small", F.col("a") < 8, limit=1)])) == {("small", None): 2.0}
