"""Hand-derived results for the two sample tables."""

import json

from pyspark.sql import functions as F

from lacuna.operators.cells import row_context
from lacuna.operators.respond import function_responder, table_responder
from lacuna.plans.analyze import analyze
from lacuna.plans.fill import fill_missing
from lacuna.plans.process import process


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def constant_responder(value):
    text = json.dumps({"value": value, "confidence": 0.9, "reasoning": "r"})
    return lambda prompts: prompts.select("cache_key", F.lit(text).alias("response_text"))


def test_food_analysis(food, run_ts):
    result = analyze(food, "row_id", run_ts)
    profile, missing, plan = by_column(result.columns), by_column(result.missing), by_column(result.plan)
    assert food.columns[1:] == ["food_name", "category", "fodmap_level", "glycemic_index", "calories_per_100g"]
    assert {c: m["missing_count"] for c, m in missing.items()} == {"category": 6, "fodmap_level": 5, "glycemic_index": 4}
    assert {c: m["missing_percentage"] for c, m in missing.items()} == {"category": 66.7, "fodmap_level": 55.6, "glycemic_index": 44.4}
    assert {m["priority"] for m in missing.values()} == {"MEDIUM"}
    assert plan["category"]["method"] == "llm_contextual"
    assert plan["fodmap_level"]["method"] == "llm_categorical" and plan["fodmap_level"]["categories"] == ["Low"]
    assert plan["glycemic_index"]["method"] == "statistical"
    assert profile["food_name"]["domain_hints"] == ["domain:person", "domain:food", "pattern:ratings_levels"]
    assert profile["category"]["domain_hints"] == ["domain:industry", "domain:category", "pattern:limited_categories"]
    assert profile["fodmap_level"]["domain_hints"] == ["domain:status", "pattern:ratings_levels"]
    assert profile["calories_per_100g"]["domain_hints"] == []
    assert result.complexity.first()["complexity_score"] == 0.6
    time = result.time.first()
    assert abs(time["total_minutes"] - 1.55) < 1e-9 and time["estimated_total_time"] == "< 2 minutes"
    assert result.dataset.first()["total_rows"] == 9


def test_food_context(food):
    columns = food.columns[1:]
    text = food.where("row_id = 0").select(row_context(food, "category", columns).alias("t")).first()["t"]
    assert text == "food_name: Apple Honeycrisp raw, fodmap_level: Low, calories_per_100g: 52"


def test_food_median_without_text_fills(food, run_ts):
    plan = analyze(food, "row_id", run_ts).plan
    result = fill_missing(food, "row_id", plan, run_ts)
    rows = result.ledger.collect()
    assert {(r["suggested_num"], r["confidence"], r["method"]) for r in rows} == {(53.0, 0.6, "median_imputation")}
    assert len(rows) == 4


def test_food_knn_after_text_fills(food, run_ts):
    plan = analyze(food, "row_id", run_ts).plan
    responders = {"category": constant_responder("Fruit"), "fodmap_level": constant_responder("low")}
    result = fill_missing(food, "row_id", plan, run_ts, responders)
    rows = result.ledger.where("column = 'glycemic_index'").join(food.select("row_id", "food_name"), "row_id").collect()
    fills = {r["food_name"].split()[0].lower(): (r["suggested_num"], r["confidence"]) for r in rows}
    assert sorted(fills.values()) == [(43.33, 0.8), (43.33, 0.8), (47.0, 0.8), (47.0, 0.8)]
    assert fills["apple"] == (43.33, 0.8) and fills["salmon"] == (47.0, 0.8)
    snapped = result.ledger.where("column = 'fodmap_level'").collect()
    assert {(r["suggested_value"], round(r["confidence"], 6)) for r in snapped} == {("Low", 0.72)}
    assert result.table.where("glycemic_index is null or category is null or fodmap_level is null").count() == 0


def test_demo_fill_and_report(demo, run_ts):
    report = process(demo, "row_id", run_ts, {"*": constant_responder("Acme")})
    plan = by_column(report.analysis.plan)
    assert plan["company_name"]["method"] == plan["industry"]["method"] == "llm_contextual"
    fills = {(r["row_id"], r["column"]): r for r in report.filled.ledger.collect()}
    assert {fills[i, "revenue_millions"]["suggested_num"] for i in (1, 3)} == {12.5}
    assert {fills[i, "employee_count"]["suggested_num"] for i in (2, 4)} == {50.0}
    assert fills[3, "founded_year"]["suggested_num"] == 2008.33
    assert fills[3, "founded_year"]["method"] == "knn_imputation"
    assert report.output_rules.where("violations > 0").count() == 0
    assert {r["improvement_percentage"] for r in report.completion.collect()} == {100.0}
    summary = report.summary.first()
    assert summary["total_rows_processed"] == 5 and summary["total_fields_filled"] == len(fills)


def test_complete_table_gets_a_report(spark, run_ts):
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "row_id bigint, a double")
    report = process(df, "row_id", run_ts)
    assert report.quality.first()["status"] == "no_imputation_needed"
    assert report.quality.first()["overall_quality_score"] is None
    assert report.filled.ledger.count() == 0
    assert [r["recommendation"] for r in report.recommendations.collect()] == [
        "No missing data found - dataset is already complete!"]
