"""Row and cell selection, row contexts, and patching filled cells back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.columns import (
    as_text, data_type, is_numeric, is_present, literal, missing_sql, present_sql, ref, scalar_columns, text_sql,
)
from lacuna.functions.durable import local_table
from lacuna.params import NO_CONTEXT


def missing_cells(df: DataFrame, id_col: str, column: str | None = None) -> DataFrame:
    """``row_id, column`` of every missing cell, or of one column's."""
    columns = [column] if column else scalar_columns(df, exclude=[id_col])
    cases = [f"CASE WHEN {missing_sql(df, c)} THEN {literal(c)} END" for c in columns]
    gaps = F.expr(f"array_compact(array({', '.join(cases)}))")
    return df.select(ref(id_col).alias("row_id"), F.explode(gaps).alias("column"))


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no missing value."""
    return df.where(" AND ".join(["true", *[present_sql(df, c) for c in columns or scalar_columns(df)]]))


def non_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_present(df, column)).select(ref(column))


def head_values(df: DataFrame, id_col: str, n: int, columns: Iterable[str] | None = None,
                present: dict[str, int] | None = None) -> DataFrame:
    """First ``n`` present values per column by ``id_col``: ``position, column, rank, row_id, value``.

    The smallest ids are found first (narrow, no sort of the table) and only those rows are read.
    A column with fewer than ``n`` values among them gets its own top-n over the whole table, unless
    ``present`` (its count of present values) shows that nothing is left to find.
    """
    columns = list(columns) if columns is not None else scalar_columns(df, exclude=[id_col])
    positions = {c: i for i, c in enumerate(df.columns)}
    schema = T.StructType([
        T.StructField("position", T.IntegerType(), False), T.StructField("column", T.StringType(), False),
        T.StructField("rank", T.IntegerType()), T.StructField("row_id", data_type(df, id_col)),
        T.StructField("value", T.StringType()),
    ])
    spark = df.sparkSession
    window_rows = max(8 * n, 64)
    ids = df.select(ref(id_col).alias("i")).orderBy("i").limit(window_rows)
    cut = ids.agg(F.max("i")).first()[0]
    if cut is None or not columns:
        return local_table(spark, [], schema)

    head = df.where(ref(id_col) <= F.lit(cut)).orderBy(ref(id_col)).limit(window_rows)
    rows = head.select(ref(id_col).alias("i"), *[as_text(df, c).alias(f"v{j}") for j, c in enumerate(columns)]).collect()
    found: dict[str, list] = {c: [] for c in columns}
    for row in rows:
        for j, c in enumerate(columns):
            if row[j + 1] is not None and len(found[c]) < n:
                found[c].append((row[0], row[j + 1]))
    done = [(positions[c], c, r + 1, i, v) for c in columns for r, (i, v) in enumerate(found[c])]
    sparse = [
        c for c in columns
        if len(found[c]) < n and len(rows) == window_rows and (present is None or present[c] > len(found[c]))
    ]
    result = local_table(spark, [r for r in done if r[1] not in sparse], schema)
    for c in sparse:
        few = df.where(is_present(df, c)).select(ref(id_col).alias("row_id"), as_text(df, c).alias("value"))
        few = few.orderBy("row_id").limit(n)
        packed = few.agg(F.array_sort(F.collect_list(F.struct("row_id", "value"))).alias("vs"))
        part = packed.select(F.posexplode("vs").alias("p", "v")).select(
            F.lit(positions[c]).alias("position"), F.lit(c).alias("column"),
            (F.col("p") + 1).alias("rank"), "v.row_id", "v.value",
        )
        result = result.unionByName(part)
    return result


def row_context(df: DataFrame, exclude: str, columns: Sequence[str] | None = None) -> Column:
    """``"c1: v1, c2: v2"`` over the other columns in table order, missing cells left out."""
    names = [c for c in (columns or scalar_columns(df)) if c != exclude]
    if not names:
        return F.lit(NO_CONTEXT)
    parts = [f"concat({literal(c + ': ')}, {text_sql(df, c)})" for c in names]
    joined = F.expr(f"concat_ws(', ', {', '.join(parts)})")
    return F.when(joined == "", F.lit(NO_CONTEXT)).otherwise(joined)


def apply_ledger(df: DataFrame, id_col: str, ledger: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Write the ledger's values into their cells; every other cell stays as it is.

    Filled integer columns come out as DOUBLE, because fills carry decimals. A ledger holds at most
    one row per cell, so the patch has one row per table row and the join cannot fan out.
    """
    columns = list(columns) if columns is not None else scalar_columns(df, exclude=[id_col])
    wide = ledger.groupBy(F.col("row_id").alias("__row")).agg(*[
        F.first(
            F.when(F.col("column") == c, F.col("suggested_num") if is_numeric(df, c) else F.col("suggested_value")),
            ignorenulls=True,
        ).alias(f"__p{j}")
        for j, c in enumerate(columns)
    ])
    joined = df.join(wide, ref(id_col) == F.col("__row"), "left")
    patched = {c: patch(df, c, F.col(f"__p{j}")) for j, c in enumerate(columns)}
    return joined.select(*[patched[c].alias(c) if c in patched else ref(c) for c in df.columns])


def patch(df: DataFrame, name: str, fill: Column) -> Column:
    """The column's own value where present, else ``fill`` in the type a filled column has."""
    kind = data_type(df, name)
    own = F.when(is_present(df, name), ref(name))
    if isinstance(kind, T.DecimalType):
        return F.coalesce(own, F.round(fill.cast("double"), kind.scale).cast(kind))
    if is_numeric(df, name):
        return F.coalesce(own.cast("double"), fill.cast("double"))
    return F.coalesce(own, fill.try_cast(kind))


def confident(ledger: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Fills whose confidence reaches the threshold; all of them for a threshold of 0."""
    if threshold <= 0:
        return ledger
    return ledger.where(F.col("confidence") >= threshold)


def last_hours(metrics: DataFrame, hours: int, now: Column, ts: str = "timestamp") -> DataFrame:
    """Rows of the trailing window that ends at ``now``."""
    return metrics.where(F.col(ts) >= now - F.make_interval(hours=F.lit(hours)))
