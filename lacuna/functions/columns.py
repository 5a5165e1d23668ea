"""Column expressions shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
_FLOATING = (T.DoubleType, T.FloatType)


def quoted(name: str) -> str:
    """Column name as SQL text; survives dots and quotes in the name."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """String as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ref(name: str) -> Column:
    return F.col(quoted(name))


def data_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


# Wide tables build thousands of per-column expressions, and every Column call is a round trip to the
# JVM. These helpers therefore come as SQL text, and the text is handed over once per expression.


def missing_sql(df: DataFrame, name: str) -> str:
    """NULL, and NaN for floating-point columns."""
    c = quoted(name)
    return f"({c} IS NULL OR isnan({c}))" if isinstance(data_type(df, name), _FLOATING) else f"({c} IS NULL)"


def present_sql(df: DataFrame, name: str) -> str:
    c = quoted(name)
    return f"({c} IS NOT NULL AND NOT isnan({c}))" if isinstance(data_type(df, name), _FLOATING) else f"({c} IS NOT NULL)"


def value_sql(df: DataFrame, name: str) -> str:
    """The value with NaN turned into NULL."""
    c = quoted(name)
    return f"CASE WHEN NOT isnan({c}) THEN {c} END" if isinstance(data_type(df, name), _FLOATING) else c


def number_text_sql(value: str) -> str:
    """Plain decimal text of a double, without an exponent: ``52.0``, ``12345678.5``, ``0.0001``."""
    short = f"CAST({value} AS STRING)"
    wide = f"regexp_replace(CAST(CAST({value} AS DECIMAL(38,12)) AS STRING), '([.][0-9]+?)0+$', '$1')"
    return (f"CASE WHEN abs({value}) >= 1e-3D AND abs({value}) < 1e7D OR {value} = 0D THEN {short} "
            f"WHEN abs({value}) >= 1e-11D AND abs({value}) < 1e25D THEN {wide} ELSE {short} END")


def text_sql(df: DataFrame, name: str) -> str:
    """Text form of a present value; NULL when the value is missing."""
    c = quoted(name)
    if isinstance(data_type(df, name), T.DoubleType):
        return f"CASE WHEN NOT isnan({c}) THEN {number_text_sql(c)} END"
    if isinstance(data_type(df, name), T.FloatType):
        return f"CASE WHEN NOT isnan({c}) THEN {number_text_sql(f'CAST({c} AS DOUBLE)')} END"
    return f"CAST({c} AS STRING)"


def is_missing(df: DataFrame, name: str) -> Column:
    return F.expr(missing_sql(df, name))


def is_present(df: DataFrame, name: str) -> Column:
    return F.expr(present_sql(df, name))


def present_value(df: DataFrame, name: str) -> Column:
    return F.expr(value_sql(df, name))


def as_text(df: DataFrame, name: str) -> Column:
    return F.expr(text_sql(df, name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise NaN to NULL in every floating-point column."""
    return df.selectExpr(*[f"{value_sql(df, c)} AS {quoted(c)}" for c in df.columns])


def number_as_text(value: Column) -> Column:
    size = F.abs(value)
    wide = F.regexp_replace(value.cast("decimal(38,12)").cast("string"), r"([.][0-9]+?)0+$", "$1")
    return F.when((size >= 1e-3) & (size < 1e7) | (size == 0), value.cast("string")).when(
        (size >= 1e-11) & (size < 1e25), wide
    ).otherwise(value.cast("string"))


def inline_rows(rows: Sequence[Mapping[str, str]]) -> Column:
    """``inline(array(...))`` of rows given as name -> SQL text."""
    return F.expr("inline(array(" + ", ".join(
        "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in row.items()) + ")" for row in rows) + "))")


def scalar_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns of a plain type; nested and binary ones cannot hold a fillable cell."""
    skip = set(exclude)
    return [f.name for f in df.schema if f.name not in skip and not isinstance(f.dataType, _NESTED)]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if f.name not in skip and isinstance(f.dataType, T.NumericType)]


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(data_type(df, name), T.NumericType)


def round_half_even(value: Column, digits: int) -> Column:
    """Round on the scaled value, ties to even."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole``; NULL when there is nothing to divide by."""
    return round_half_even(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, digits)
