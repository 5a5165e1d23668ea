"""Output checks on the fixture frames, each with one seeded fault."""

import pytest
from pyspark.sql import functions as F

from lacuna.operators.output_rules import OutputError, check_quality, consistency_summary, validate_output


@pytest.fixture
def before(spark):
    rows = [(0, 1, "x", 10.5), (1, 2, None, 20.0), (2, None, "z", 30.5), (3, 4, "w", None)]
    return spark.createDataFrame(rows, "row_id bigint, A bigint, B string, C double")


@pytest.fixture
def after(spark):
    rows = [(0, 1, "x", 10.5), (1, 2, "y", 20.0), (2, 3, "z", 30.5), (3, 4, "w", 25.0)]
    return spark.createDataFrame(rows, "row_id bigint, A bigint, B string, C double")


@pytest.fixture
def ledger(spark, run_ts):
    rows = [
        (2, "A", None, "3", 3.0, 0.8, "knn_imputation", "r", run_ts), (1, "B", None, "y", None, 0.7, "llm_categorical", "r", run_ts),
        (3, "C", None, "25.0", 25.0, 0.9, "statistical", "r", run_ts),
    ]
    return spark.createDataFrame(
        rows, "row_id bigint, column string, original_value string, suggested_value string, suggested_num double, "
              "confidence double, method string, reasoning string, timestamp timestamp")


def broken(before, after, ledger, **kw):
    report = validate_output(before, after, ledger, "row_id", **kw)
    return {(r["rule"], r["column"]): r["violations"] for r in report.where("violations > 0").collect()}


def where(df, id_, column, value):
    return df.withColumn(column, F.when(F.col("row_id") == id_, F.lit(value)).otherwise(F.col(column)))


def test_valid(before, after, ledger):
    assert broken(before, after, ledger, strict=True) == {}
    assert consistency_summary(after, ledger, "row_id").first().asDict() == {"compared": 3, "filled_count": 3, "issues": 0}


def test_lost_rows(before, after, ledger):
    assert broken(before, after.where("row_id < 2"), ledger)["shape", None] == 2


def test_renamed_column(before, after, ledger):
    assert broken(before, after.withColumnRenamed("A", "X"), ledger)["columns", None] == 1


def test_new_gap(before, after, ledger):
    found = broken(before, where(after, 0, "C", None), ledger)
    assert found["modified", "C"] == 1
    more = broken(before, where(where(after, 0, "C", None), 3, "C", None), ledger)
    assert more["new_missing", "C"] == 1


def test_modified_value(before, after, ledger):
    assert broken(before, where(after, 0, "A", 999), ledger) == {("modified", "A"): 1}
    assert broken(before, after.withColumn("C", F.col("C") + 1e-9), ledger).get(("modified", "C")) is None
    with pytest.raises(OutputError, match="modified in A"):
        validate_output(before, where(after, 0, "A", 999), ledger, "row_id", strict=True)


def test_empty_ledger_is_valid(before, ledger):
    assert broken(before, before, ledger.where("false")) == {}


def test_missing_field(before, after, ledger):
    assert broken(before, after, ledger.drop("confidence"))["ledger_schema", "confidence"] == 1


@pytest.mark.parametrize("column, value, rule", [
    ("row_id", 999, "ledger_row"), ("column", "NonExistent", "ledger_column"), ("confidence", 1.5, "confidence"),
    ("confidence", None, "confidence"), ("confidence", float("nan"), "confidence"), ("row_id", 0, "was_missing"),
])
def test_ledger_faults(before, after, ledger, column, value, rule):
    bad = ledger.withColumn(column, F.when(F.col("method") == "knn_imputation", F.lit(value)).otherwise(F.col(column)))
    assert broken(before, after, bad)[rule, None] == 1


def test_duplicate(before, after, ledger):
    assert broken(before, after, ledger.unionByName(ledger.where("row_id = 2")))["duplicate", None] == 1


def test_inconsistent_value_only_warns(before, after, ledger):
    found = broken(before, where(after, 2, "A", 999), ledger, strict=True)
    assert found == {("consistency", None): 1}


def test_quality(spark):
    good = spark.createDataFrame([(85.0, 75.0, 2, 0, "good")],
                                 "overall_quality_score double, high_confidence_percentage double, low_confidence_count bigint, error_count bigint, status string")
    failed = lambda df: {r["field"] for r in check_quality(df).where("not passed").collect()}
    assert failed(good) == set()
    assert failed(good.withColumn("overall_quality_score", F.lit(150.0))) == {"overall_quality_score"}
    assert failed(good.withColumn("status", F.lit("invalid_status"))) == {"status"}
    assert failed(good.drop("error_count")) == {"error_count"}
