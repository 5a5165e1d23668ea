"""Answers, snapping, cache and responders."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lacuna.operators import cache as C
from lacuna.operators.prompts import cap_calls, parse_responses, snap_category, with_fallback
from lacuna.operators.profile import missing_summary, plan_fills, profile_columns
from lacuna.operators.respond import function_responder, respond, table_responder
from lacuna.params import CacheParams, FillParams, ModelParams
from lacuna.plans.fill import Strategy, fill_missing
from lacuna.operators.impute import ledger_rows

LONG = "no json here " * 10


@pytest.mark.parametrize("text, value, confidence, reasoning", [
    ('{"value": "a", "confidence": 0.9, "reasoning": "r"}', "a", 0.9, "r"),
    ('Sure! {"value": "a", "confidence": 0.9} done', "a", 0.9, "LLM prediction"),
    ('{"value": "a", "confidence": 0.9,}', "a", 0.9, "Partial extraction"),
    ("{'value': 'a'}", "a", 0.5, "LLM prediction"),
    ('{"value": "a", "confidence": "high"}', "Error", 0.1, None),
    ('{"value": "a", "confidence": null}', "Error", 0.1, None),
    ('{"value": "a", "confidence": "0.7"}', "a", 0.7, "LLM prediction"),
    ('{"confidence": 0.4}', "Unknown", 0.4, "LLM prediction"),
    ("{}", "{}", 0.3, "Non-JSON response, extracted text"),
    ("  just 'text' ", "just text", 0.3, "Non-JSON response, extracted text"),
    (LONG, "Parse_Error", 0.1, "Could not parse: " + LONG[:50] + "..."),
    ('{"value": 3, "confidence": 0.9}', "3", 0.9, "LLM prediction"),
    ('{"value": "a",\n "confidence": 0.9}', "a", 0.9, "LLM prediction"),
])
def test_answer_ladder(spark, text, value, confidence, reasoning):
    row = parse_responses(spark.createDataFrame([(text,)], "response_text string")).first()
    assert (row["value"], row["confidence"]) == (value, confidence)
    if reasoning is not None:
        assert row["reasoning"] == reasoning
    assert row["is_text"] == (value != "3") and not row["clamped"]


def test_confidence_is_clamped_and_marked(spark):
    row = parse_responses(spark.createDataFrame([('{"value": "a", "confidence": 1.5}',)], "response_text string")).first()
    assert (row["confidence"], row["clamped"]) == (1.0, True)


@pytest.mark.parametrize("value, snapped, factor", [
    ("dairy", "Dairy", 0.8), ("whole grain", "Grain", 0.8), ("xyz", "Fruit", 0.8), ("", "Fruit", 0.8), ("Fruit", "Fruit", 1.0),
])
def test_snap(spark, value, snapped, factor):
    df = spark.createDataFrame([(value, 0.5, "r")], "value string, confidence double, reasoning string")
    row = snap_category(df, ["Fruit", "Dairy", "Grain"]).first()
    assert row["value"] == snapped and abs(row["confidence"] - 0.5 * factor) < 1e-12
    assert row["reasoning"] == ("r" if factor == 1.0 else "r (adjusted to closest valid category)")
    unchanged = snap_category(df, []).first()
    assert unchanged["value"] == value and abs(unchanged["confidence"] - 0.4) < 1e-12


def test_fallback_rows(spark):
    df = spark.createDataFrame([("3", 0.9, "r", False), (None, 0.9, "r", True)], "value string, confidence double, reasoning string, is_text boolean")
    assert [(r["value"], r["confidence"], r["method"]) for r in with_fallback(df, "llm_categorical", ["A", "B"]).collect()] == [
        ("A", 0.3, "fallback")] * 2
    assert [(r["value"], r["confidence"], r["method"]) for r in with_fallback(df, "llm_contextual").collect()] == [
        ("3", 0.9, "llm_contextual"), ("Unknown", 0.2, "error_fallback")]


def entry(key, second, access=None, value="v"):
    at = datetime(2024, 1, 1) + timedelta(seconds=second)
    return (key, value, 0.5, "r", at, datetime(2024, 1, 1) + timedelta(seconds=access if access is not None else second), {})


@pytest.fixture
def cache(spark):
    return spark.createDataFrame([entry(f"k{i}", i, 100 - i) for i in range(10)], C.CACHE_SCHEMA)


def at(second):
    return F.lit(datetime(2024, 1, 1) + timedelta(seconds=second))


def keys(df):
    return sorted(r["cache_key"] for r in df.collect())


def test_entry_expires_strictly_after_ttl(spark, cache):
    prompts = spark.createDataFrame([("k4",), ("k5",), ("zz",)], "cache_key string")
    hits = {r["cache_key"]: r["hit"] for r in C.cache_lookup(prompts, cache, 10, at(15)).collect()}
    assert hits == {"k4": False, "k5": True, "zz": False}
    assert keys(C.cache_misses(prompts, cache, 10, at(15))) == ["k4", "zz"]
    assert keys(C.cache_purge(cache, 10, at(15))) == [f"k{i}" for i in range(5, 10)]


def test_upsert_keeps_the_later_entry(spark, cache):
    new = spark.createDataFrame([entry("k3", 50, value="new"), entry("k9", 1, value="old"), entry("n", 0)], C.CACHE_SCHEMA)
    merged = {r["cache_key"]: r["value"] for r in C.cache_upsert(cache, new).collect()}
    assert len(merged) == 11 and merged["k3"] == "new" and merged["k9"] == "v"


def test_evictions(spark, cache):
    assert keys(C.cache_evict_lru(cache, 3)) == ["k0", "k1", "k2"]
    assert keys(C.cache_evict_oldest(cache, 10, buffer=4)) == [f"k{i}" for i in range(4, 10)]
    assert len(keys(C.cache_evict_oldest(cache, 11, buffer=4))) == 10
    assert keys(C.cache_evict_lru(C.cache_touch(cache, spark.createDataFrame([("k9",)], "cache_key string"), at(500)), 1)) == ["k9"]
    assert keys(C.cache_delete(cache, cache.where("cache_key > 'k1'"))) == ["k0", "k1"]
    assert keys(C.cache_clear(cache)) == []


def test_responder_retries_and_reports_failures(spark):
    def ask(prompt):
        if prompt == "bad":
            raise RuntimeError("no")
        return prompt.upper()

    prompts = spark.createDataFrame([("1", "a"), ("2", "bad")], "cache_key string, prompt string")
    rows = {r["cache_key"]: r for r in respond(prompts, ask, 2, ModelParams(max_retries=2, retry_delay=0.0)).collect()}
    assert (rows["1"]["response_text"], rows["1"]["status"], rows["1"]["attempts"]) == ("A", "ok", 1)
    assert (rows["2"]["response_text"], rows["2"]["status"], rows["2"]["attempts"]) == (None, "failed", 3)


@pytest.fixture
def pets(spark):
    rows = [(i, ["cat", "dog"][i % 2] if i % 5 else None, "small") for i in range(40)]
    return spark.createDataFrame(rows, "id bigint, kind string, size string")


def plan_of(df):
    return plan_fills(profile_columns(df, "id"), missing_summary(df))


def test_equal_prompts_are_asked_once_and_cached(spark, pets, run_ts, tmp_path):
    log = str(tmp_path)

    def ask(prompt):
        import uuid

        open(f"{log}/{uuid.uuid4()}", "w").close()
        return '{"value": "Dog", "confidence": 1.0}'

    plan = plan_of(pets)
    result = fill_missing(pets, "id", plan, run_ts, {"kind": function_responder(ask)})
    rows = result.ledger.collect()
    assert len(rows) == 8 and {(r["suggested_value"], r["confidence"]) for r in rows} == {("dog", 0.8)}
    assert len(list(tmp_path.iterdir())) == 1  # eight cells, one distinct prompt, one call
    assert result.table.where("kind is null").count() == 0

    again = fill_missing(pets, "id", plan, run_ts, {"kind": function_responder(ask)}, cache=result.new_cache)
    assert again.ledger.count() == 8 and again.new_cache.count() == 0
    assert len(list(tmp_path.iterdir())) == 1
    late = fill_missing(pets, "id", plan, run_ts + timedelta(hours=2), {"kind": function_responder(ask)},
                        cache=result.new_cache, caching=CacheParams(ttl_seconds=3600))
    assert late.ledger.count() == 8 and len(list(tmp_path.iterdir())) == 2


def test_unanswered_cells_are_doubtful_and_capped_cells_stay_open(spark, pets, run_ts):
    nothing = table_responder(spark.createDataFrame([], "cache_key string, response_text string"))
    rows = fill_missing(pets, "id", plan_of(pets), run_ts, {"kind": nothing}).ledger.collect()
    assert {(r["suggested_value"], r["method"], round(r["confidence"], 6)) for r in rows} == {("dog", "llm_categorical", 0.08)}
    varied = pets.withColumn("size", F.col("id").cast("string"))
    plan = plan_of(varied).where("column = 'kind'")
    capped = fill_missing(varied, "id", plan, run_ts, {"kind": nothing}, FillParams(max_calls_per_column=3))
    assert sorted(r["row_id"] for r in capped.ledger.collect()) == [0, 5, 10]
    assert capped.table.where("kind is null").count() == 5


def test_user_strategy_and_range_guard(spark, run_ts):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0), (3, None)], "id bigint, a double")

    def impute(table, id_col, column, plan, ts):
        wild = F.when(F.col("id") == 1, 1000.0).otherwise(2.5)
        return ledger_rows(table.where("a is null"), F.col("id"), column, num=wild, confidence=F.lit(0.9),
                           method=F.lit("mine"), reasoning=F.lit("mine"), run_ts=ts)

    mine = Strategy("mine", lambda row: row["column"] == "a", impute)
    rows = {r["row_id"]: (r["suggested_num"], r["method"]) for r in fill_missing(df, "id", plan_of(df), run_ts, strategies=[mine]).ledger.collect()}
    assert rows == {1: (2.0, "median_fallback"), 3: (2.5, "mine")}


def test_cap_is_per_column(spark):
    df = spark.range(50).selectExpr("id AS row_id", "concat('c', id % 2) AS column")
    assert sorted(r["row_id"] for r in cap_calls(df, 2).collect()) == [0, 1, 2, 3]
