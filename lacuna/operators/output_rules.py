"""Checks of a filled table and its ledger against the original table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import inline_rows, is_numeric, literal, quoted, ref, scalar_columns, text_sql, value_sql
from lacuna.functions.durable import local_table, small_table
from lacuna.operators.impute import LEDGER_FIELDS
from lacuna.params import QUALITY_STATES

REPORT_SCHEMA = "rule string, severity string, column string, violations bigint"
QUALITY_FIELDS = ("overall_quality_score", "high_confidence_percentage", "low_confidence_count", "error_count", "status")


class OutputError(ValueError):
    """A blocking output check failed."""


def _same_sql(before: DataFrame, after: DataFrame, name: str, a: str, b: str) -> str:
    """Numbers agree within ``1e-8 + 1e-10 * |filled|``; everything else agrees as text."""
    if is_numeric(before, name) and is_numeric(after, name):
        x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
        return f"({x} = {y} OR abs({x} - {y}) <= 1e-8D + 1e-10D * abs({y}))"
    return f"(CAST({a} AS STRING) = CAST({b} AS STRING))"


def _shared(before: DataFrame, after: DataFrame, id_col: str) -> list[str]:
    return [c for c in scalar_columns(before, [id_col]) if c in after.columns]


def compare_tables(before: DataFrame, after: DataFrame, id_col: str) -> DataFrame:
    """Per column: gaps before and after, modified and newly filled cells; one join, one aggregate.

    ``only_before`` and ``only_after`` count ids without partner and repeat on every row.
    """
    columns = _shared(before, after, id_col)
    old = before.selectExpr(f"{quoted(id_col)} AS ib", "1 AS hb", *[
        f"{value_sql(before, c)} AS b{j}" for j, c in enumerate(columns)])
    new = after.selectExpr(f"{quoted(id_col)} AS ia", "1 AS ha", *[
        f"{value_sql(after, c)} AS a{j}" for j, c in enumerate(columns)])
    joined = old.join(new, F.col("ib") == F.col("ia"), "full_outer")
    measures = ["count_if(hb IS NOT NULL AND ha IS NULL) AS only_before", "count_if(ha IS NOT NULL AND hb IS NULL) AS only_after"]
    rows = []
    for j, c in enumerate(columns):
        same = f"coalesce({_same_sql(before, after, c, f'b{j}', f'a{j}')}, false)"
        measures += [
            f"count_if(hb IS NOT NULL AND b{j} IS NULL) AS mb{j}", f"count_if(ha IS NOT NULL AND a{j} IS NULL) AS ma{j}",
            f"count_if(ha IS NOT NULL AND b{j} IS NOT NULL AND NOT {same}) AS mod{j}",
            f"count_if(hb IS NOT NULL AND b{j} IS NULL AND a{j} IS NOT NULL) AS fill{j}",
        ]
        rows.append({
            "position": str(before.columns.index(c)), "column": literal(c), "missing_before": f"mb{j}",
            "missing_after": f"ma{j}", "modified": f"mod{j}", "filled": f"fill{j}",
        })
    return joined.agg(*[F.expr(m) for m in measures]).select(inline_rows(rows), "only_before", "only_after")


def check_shape(before: DataFrame, after: DataFrame) -> DataFrame:
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(f"rows_{name}")).withColumn("__one", F.lit(1))

    both = counted(before, "before").join(F.broadcast(counted(after, "after")), "__one").drop("__one")  # one row each
    widths = len(before.columns), len(after.columns)
    return both.select("rows_before", "rows_after", F.lit(widths[0]).alias("columns_before"), F.lit(widths[1]).alias("columns_after"),
                       ((F.col("rows_before") == F.col("rows_after")) & F.lit(widths[0] == widths[1])).alias("passed"))


def check_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Names position by position; metadata only."""
    width = max(len(before.columns), len(after.columns))
    pad = lambda names: [*names, *[None] * (width - len(names))]
    rows = [(i, b, a, b == a) for i, (b, a) in enumerate(zip(pad(before.columns), pad(after.columns)))]
    return local_table(before.sparkSession, rows, "position int, before string, after string, passed boolean")


def check_no_new_missing(before: DataFrame, after: DataFrame, id_col: str) -> DataFrame:
    return compare_tables(before, after, id_col).select(
        "position", "column", "missing_before", "missing_after",
        (F.col("missing_after") <= F.col("missing_before")).alias("passed"))


def check_unmodified(before: DataFrame, after: DataFrame, id_col: str) -> DataFrame:
    return compare_tables(before, after, id_col).select(
        "position", "column", "modified", "only_before", "only_after",
        ((F.col("modified") == 0) & (F.col("only_before") == 0) & (F.col("only_after") == 0)).alias("passed"))


def check_ledger_schema(ledger: DataFrame) -> DataFrame:
    """Required fields and whether the ledger has them; metadata only."""
    rows = [(f, f in ledger.columns) for f in LEDGER_FIELDS if f != "suggested_num"]
    return local_table(ledger.sparkSession, rows, "field string, passed boolean")


def check_ledger_rows(ledger: DataFrame, before: DataFrame, id_col: str) -> DataFrame:
    """Ledger cells whose row does not exist."""
    return ledger.join(before.select(ref(id_col).alias("row_id")), "row_id", "left_anti").select("row_id", "column")


def check_ledger_columns(ledger: DataFrame, before: DataFrame) -> DataFrame:
    return ledger.where(~F.coalesce(F.col("column").isin(before.columns), F.lit(False))).select("row_id", "column")


def check_confidence(ledger: DataFrame) -> DataFrame:
    """Ledger cells whose confidence is not a number in [0, 1]; NULL and NaN count."""
    good = F.col("confidence").between(0.0, 1.0) & ~F.isnan("confidence")
    return ledger.where(~F.coalesce(good, F.lit(False))).select("row_id", "column", "confidence")


def _cell(table: DataFrame, id_col: str, chooser: str = "__column") -> Column:
    """Text of the cell that ``chooser`` names, without unpivoting the table."""
    cases = [f"WHEN {chooser} = {literal(c)} THEN {text_sql(table, c)}" for c in scalar_columns(table, [id_col])]
    return F.expr(f"CASE {' '.join(cases)} END")


def check_was_missing(ledger: DataFrame, before: DataFrame, id_col: str) -> DataFrame:
    """Ledger cells that had a value before."""
    keyed = ledger.select(F.col("row_id").alias("__row"), F.col("column").alias("__column"))
    joined = keyed.join(before, F.col("__row") == ref(id_col))
    return joined.where(_cell(before, id_col).isNotNull()).select(
        F.col("__row").alias("row_id"), F.col("__column").alias("column"))


def check_duplicates(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("row_id", "column").agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def check_quality(assessment: DataFrame) -> DataFrame:
    """Rows ``field, passed`` for a one-row quality assessment."""
    missing = [f for f in QUALITY_FIELDS if f not in assessment.columns]
    if missing:
        return local_table(assessment.sparkSession, [(f, False) for f in missing], "field string, passed boolean")
    tests = {
        "overall_quality_score": F.col("overall_quality_score").between(0, 100),
        "high_confidence_percentage": F.col("high_confidence_percentage").between(0, 100),
        "low_confidence_count": F.col("low_confidence_count") >= 0, "error_count": F.col("error_count") >= 0,
        "status": F.col("status").isin(*QUALITY_STATES),
    }
    return assessment.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("field"), F.coalesce(t, F.lit(False)).alias("passed")) for f, t in tests.items()])))


def cell_consistency(after: DataFrame, ledger: DataFrame, id_col: str) -> DataFrame:
    """Per ledger cell: expected and actual text and ``outcome``.

    Outcomes: ``filled``, ``both_missing`` (consistent, not counted), ``missing_mismatch``, ``value_mismatch``.
    """
    keyed = ledger.select(
        F.col("row_id").alias("__row"), F.col("column").alias("__column"), F.col("suggested_value").alias("__expected"))
    joined = keyed.join(after, F.col("__row") == ref(id_col))
    actual = _cell(after, id_col)
    outcome = (
        F.when(F.col("expected").isNull() & F.col("actual").isNull(), "both_missing")
        .when(F.col("expected").isNull() | F.col("actual").isNull(), "missing_mismatch")
        .when(F.col("expected") == F.col("actual"), "filled").otherwise("value_mismatch")
    )
    return joined.select(
        F.col("__row").alias("row_id"), F.col("__column").alias("column"), F.col("__expected").alias("expected"),
        actual.alias("actual")).withColumn("outcome", outcome)


def check_consistency(after: DataFrame, ledger: DataFrame, id_col: str) -> DataFrame:
    """Cells where ledger and table disagree."""
    return cell_consistency(after, ledger, id_col).where("outcome in ('missing_mismatch', 'value_mismatch')")


def consistency_summary(after: DataFrame, ledger: DataFrame, id_col: str) -> DataFrame:
    """One row: cells compared, cells filled as stated, disagreements."""
    return cell_consistency(after, ledger, id_col).agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(F.col("outcome") == "filled").alias("filled_count"),
        F.count_if(F.col("outcome").isin("missing_mismatch", "value_mismatch")).alias("issues"))


def fills_per_column(before: DataFrame, after: DataFrame, ledger: DataFrame, id_col: str) -> DataFrame:
    """Cells that became present against ledger rows, per column."""
    return _fills(compare_tables(before, after, id_col), ledger)


def _fills(compared: DataFrame, ledger: DataFrame) -> DataFrame:
    expected = ledger.groupBy("column").agg(F.count(F.lit(1)).alias("expected"))
    joined = compared.select("column", "filled").join(expected, "column", "full_outer")
    actual, wanted = F.coalesce("filled", F.lit(0)), F.coalesce("expected", F.lit(0))
    return joined.select("column", actual.alias("filled"), wanted.alias("expected"), (actual == wanted).alias("passed"))


def validate_output(before: DataFrame, after: DataFrame, ledger: DataFrame, id_col: str,
                    assessment: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """All output checks as ``rule, severity, column, violations``; consistency issues only warn."""
    spark = before.sparkSession
    same_names = before.columns == after.columns
    # One row per column, read by several rules: the tables are joined once.
    compared = small_table(compare_tables(before, after, id_col))

    def row(rule: str, severity: str, column: str | None, count: str) -> dict[str, str]:
        return {"rule": literal(rule), "severity": literal(severity), "column": column or "CAST(NULL AS STRING)",
                "violations": f"CAST({count} AS BIGINT)"}

    width = abs(len(before.columns) - len(after.columns))
    per_column = compared.select("column", inline_rows([
        row("new_missing", "error", "`column`", "greatest(missing_after - missing_before, 0)"),
        row("modified", "error", "`column`", "modified")]).alias("rule", "severity", "name", "violations")).drop("column")
    per_column = per_column.withColumnRenamed("name", "column")
    whole = compared.agg(F.max("only_before").alias("b"), F.max("only_after").alias("a")).select(inline_rows([
        row("shape", "error", None, f"coalesce(a + b, 0) + {width}"), row("columns", "error", None, str(int(not same_names)))]))
    absent = [f for f in LEDGER_FIELDS if f != "suggested_num" and f not in ledger.columns]
    parts = [per_column, whole]
    if absent:
        parts.append(local_table(spark, [("ledger_schema", "error", f, 1) for f in absent], REPORT_SCHEMA))
    else:
        keyed = ledger.select(
            F.col("row_id").alias("__row"), F.col("column").alias("__column"), F.col("confidence").alias("__confidence"))
        found = keyed.join(before.withColumn("__found", F.lit(True)), F.col("__row") == ref(id_col), "left")
        counts = found.agg(
            F.expr("count_if(__found IS NULL) AS orphans"),
            F.count_if(~F.coalesce(F.col("__column").isin(before.columns), F.lit(False))).alias("unknown"),
            F.expr("count_if(NOT coalesce(__confidence BETWEEN 0 AND 1 AND NOT isnan(__confidence), false)) AS unsure"),
            F.count_if(_cell(before, id_col).isNotNull()).alias("present"),
        )
        parts.append(counts.select(inline_rows([
            row("ledger_row", "error", None, "orphans"), row("ledger_column", "error", None, "unknown"),
            row("confidence", "error", None, "unsure"), row("was_missing", "error", None, "present")])))
        parts.append(check_duplicates(ledger).agg(F.count(F.lit(1)).alias("d")).select(
            inline_rows([row("duplicate", "error", None, "d")])))
        if same_names:
            parts.append(consistency_summary(after, ledger, id_col).select(
                inline_rows([row("consistency", "warning", None, "issues")])))
        parts.append(_fills(compared, ledger).select(
            F.lit("fill_count").alias("rule"), F.lit("warning").alias("severity"), "column",
            F.abs(F.col("filled") - F.col("expected")).alias("violations")))
    if assessment is not None:
        parts.append(check_quality(assessment).select(
            inline_rows([row("quality", "error", "field", "CASE WHEN passed THEN 0 ELSE 1 END")])))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    if strict:
        bad = report.where("severity = 'error' and violations > 0").orderBy("rule", "column").limit(1).collect()
        if bad:
            raise OutputError(f"{bad[0]['rule']}{' in ' + bad[0]['column'] if bad[0]['column'] else ''}: {bad[0]['violations']} violations")
    return report
