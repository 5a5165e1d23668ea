"""Input gates and quality warnings as rows: ``position, rule, column, severity, passed, measured, threshold``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.columns import (
    data_type, inline_rows, literal, quoted, scalar_columns, value_sql,
)
from lacuna.functions.durable import local_table, small_table
from lacuna.operators.profile import missing_summary, text_key_sql
from lacuna.params import BAD_NAME_CHARACTERS, NUMERIC_TEXT, InputLimits

RULE_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType()), T.StructField("rule", T.StringType()),
    T.StructField("column", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("passed", T.BooleanType()), T.StructField("measured", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
])


class InputError(ValueError):
    """A blocking input gate failed."""


@dataclass(frozen=True)
class Rule:
    """A user's row condition; passes when at most ``limit`` rows violate it."""

    name: str
    condition: Column
    limit: int = 0
    severity: str = "error"


def _text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(data_type(df, c), (T.StringType, T.CharType, T.VarcharType))]


def _measures(df: DataFrame, columns: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Every count the gates need, in one pass."""
    texts = set(_text_columns(df, columns))
    aggregates = [F.count(F.lit(1)).alias("n")]
    for j, c in enumerate(columns):
        value = value_sql(df, c)
        aggregates.append(F.expr(f"count({value}) AS p{j}"))
        aggregates.append(F.expr(f"min({value}) = max({value}) AS one{j}"))
        if c in texts:
            aggregates.append(F.expr(f"count_if(regexp_like({quoted(c)}, {literal(NUMERIC_TEXT)})) AS num{j}"))
    aggregates += [F.count_if(~F.coalesce(r.condition, F.lit(False))).alias(f"rule{i}") for i, r in enumerate(rules)]
    return df.agg(*aggregates)


def _row(order: int, rule: str, column: str | None, severity: str, passed: str, measured: str,
         threshold: float | None) -> dict[str, str]:
    return {
        "position": str(order), "rule": literal(rule),
        "column": "CAST(NULL AS STRING)" if column is None else literal(column), "severity": literal(severity),
        "passed": f"coalesce({passed}, true)", "measured": f"CAST({measured} AS DOUBLE)",
        "threshold": "CAST(NULL AS DOUBLE)" if threshold is None else f"{float(threshold)!r}D",
    }


def gate_rules(df: DataFrame, limits: InputLimits = InputLimits(), rules: Sequence[Rule] = (),
               columns: Sequence[str] | None = None) -> DataFrame:
    """Blocking gates in their order, then constant columns and numeric-looking texts; one aggregate pass."""
    columns = list(columns) if columns is not None else scalar_columns(df)
    texts = set(_text_columns(df, columns))
    width = len(columns)
    rows = [_row(0, "empty", None, "error", f"n > 0 AND {width} > 0", "n", 0.0)]
    if limits.max_rows is not None:
        rows.append(_row(1, "max_rows", None, "error", f"n <= {limits.max_rows}", "n", limits.max_rows))
    rows.append(_row(2, "max_columns", None, "error", f"{width} <= {limits.max_columns}", str(width), limits.max_columns))
    for j, c in enumerate(columns):
        rows.append(_row(3, "empty_column", c, "error", f"n = 0 OR p{j} > 0", f"p{j}", 0.0))
    rows.append(_row(4, "missing_percentage", None, "error", f"gaps <= {float(limits.max_missing_percentage)!r}D", "gaps",
                     limits.max_missing_percentage))
    for j, c in enumerate(columns):
        rows.append(_row(5, "min_values", c, "error", f"NOT (p{j} > 0 AND p{j} < {limits.min_non_null_values})", f"p{j}",
                         limits.min_non_null_values))
    for i, r in enumerate(rules):
        rows.append(_row(6, r.name, None, r.severity, f"rule{i} <= {r.limit}", f"rule{i}", r.limit))
    for j, c in enumerate(columns):
        rows.append(_row(8, "constant", c, "warning", f"NOT (p{j} > 1 AND one{j})", f"p{j}", 1.0))
        if c in texts:
            share = f"try_divide(CAST(num{j} AS DOUBLE), CAST(p{j} AS DOUBLE))"
            rows.append(_row(9, "numeric_text", c, "warning", f"NOT ({share} > {float(limits.numeric_text_share)!r}D)", share,
                             limits.numeric_text_share))
    present = " + ".join(["0", *[f"p{j}" for j in range(width)]])
    gaps = F.expr(f"try_divide((n * {width} - ({present})) * 100.0D, CAST(n * {width} AS DOUBLE)) AS gaps")
    return _measures(df, columns, rules).select("*", gaps).select(inline_rows(rows))


def rule_high_cardinality(df: DataFrame, limits: InputLimits = InputLimits(),
                          columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns with more than ten values of which nearly all differ; long texts compared by digest."""
    texts = _text_columns(df, columns if columns is not None else scalar_columns(df))
    if not texts:
        return local_table(df.sparkSession, [], RULE_SCHEMA)
    cells = inline_rows([{"column": literal(c), "v": text_key_sql(df, c)} for c in texts])
    values = df.select(cells).where("v is not null").groupBy("column", "v").agg(F.count(F.lit(1)).alias("c"))
    ratio = F.col("u") / F.col("p")
    per_column = values.groupBy("column").agg(F.count(F.lit(1)).alias("u"), F.sum("c").alias("p"))
    return per_column.select(
        F.lit(10).alias("position"), F.lit("high_cardinality").alias("rule"), "column", F.lit("warning").alias("severity"),
        F.coalesce(~((F.col("p") > 10) & (ratio > limits.high_cardinality_ratio)), F.lit(True)).alias("passed"),
        ratio.alias("measured"),
        F.lit(limits.high_cardinality_ratio).alias("threshold"),
    )


def rule_column_names(df: DataFrame) -> DataFrame:
    """Duplicate, blank, over-long and awkward column names; metadata only."""
    spark = df.sparkSession
    names = local_table(spark, list(enumerate(df.columns)), "i int, name string")
    times = F.count(F.lit(1)).over(Window.partitionBy("name"))

    def test(rule: str, bad: Column, measured: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), bad.alias("bad"), measured.cast("double").alias("m"))

    checked = names.withColumn("times", times).select("i", "name", F.inline(F.array(
        test("duplicate_name", F.col("times") > 1, F.col("times")),
        test("blank_name", F.trim("name") == "", F.length("name")),
        test("long_name", F.length("name") > 100, F.length("name")),
        test("awkward_name", F.regexp_like("name", F.lit(BAD_NAME_CHARACTERS)), F.length("name")),
    )))
    bad = checked.where("bad").groupBy("rule", "name").agg(F.min("i").alias("i"), F.max("m").alias("m"))
    # Only the first column with awkward characters is reported.
    first = Window.partitionBy("rule").orderBy("i")
    kept = bad.withColumn("r", F.row_number().over(first)).where((F.col("rule") != "awkward_name") | (F.col("r") == 1))
    return kept.select(
        F.lit(7).alias("position"), "rule", F.col("name").alias("column"), F.lit("warning").alias("severity"),
        F.lit(False).alias("passed"), F.col("m").alias("measured"), F.lit(None).cast("double").alias("threshold"),
    )


def column_types(df: DataFrame) -> DataFrame:
    """Type of every column, and its missing count and percentage (two decimals)."""
    types = local_table(df.sparkSession,
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)], "position int, column string, data_type string")
    gaps = missing_summary(df, digits=2).select("column", "missing_count", "missing_percentage")
    return types.join(F.broadcast(gaps), "column", "left").select(
        "position", "column", "data_type", F.coalesce("missing_count", F.lit(0)).alias("missing_count"),
        F.coalesce("missing_percentage", F.lit(0.0)).alias("missing_percentage"))


def _distinct_names(df: DataFrame) -> DataFrame:
    """A table whose repeated column names carry their occurrence, so that each can be measured."""
    if len(set(df.columns)) == len(df.columns):
        return df
    seen: dict[str, int] = {}
    names = []
    for name in df.columns:
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}#{seen[name]}")
    return df.toDF(*names)


def _only(rule: str):
    def single(df: DataFrame, limits: InputLimits = InputLimits(), columns: Sequence[str] | None = None) -> DataFrame:
        return gate_rules(df, limits, columns=columns).where(F.col("rule") == rule)

    single.__name__ = f"rule_{rule}"
    single.__doc__ = f"The ``{rule}`` rows of :func:`gate_rules`."
    return single


rule_empty = _only("empty")
rule_max_rows = _only("max_rows")
rule_max_columns = _only("max_columns")
rule_empty_columns = _only("empty_column")
rule_missing_pct = _only("missing_percentage")
rule_min_values = _only("min_values")
rule_constant = _only("constant")
rule_numeric_text = _only("numeric_text")


def validate_input(df: DataFrame, limits: InputLimits = InputLimits(), rules: Sequence[Rule] = (),
                   strict: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """All input rules. ``strict`` raises the first failing gate instead of returning it."""
    if df is None:
        raise InputError("input table is missing")
    named = _distinct_names(df)
    report = gate_rules(named, limits, rules, columns)
    report = report.unionByName(rule_column_names(df)).unionByName(rule_high_cardinality(named, limits, columns))
    if strict:
        report = small_table(report)
        failed = report.where("severity = 'error' and not passed").orderBy("position", "column").limit(1).collect()
        if failed:
            f = failed[0]
            raise InputError(f"{f['rule']}{' in ' + f['column'] if f['column'] else ''}: measured {f['measured']}, limit {f['threshold']}")
    return report
