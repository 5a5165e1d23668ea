"""Exactness on skewed data, invariance under layout, and the shape of the plans."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lacuna.functions import joins, ranking
from lacuna.functions.joins import attach_unique
from lacuna.functions.quantile import exact_median
from lacuna.functions.ranking import newest
from lacuna.operators.cells import head_values
from lacuna.operators.profile import column_counts, profile_columns
from lacuna.operators.respond import respond
from lacuna.plans.analyze import analyze
from workload.tables import read

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_median_with_a_hot_value(spark, accuracy):
    rng = random.Random(5)
    values = [7.0] * 3000 + [rng.lognormvariate(0, 5) for _ in range(5000)] + [-rng.random() for _ in range(1001)]
    rng.shuffle(values)
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, v double").repartition(8)
    assert exact_median(df, "v", accuracy=accuracy).first()["median"] == statistics.median(values)
    found = {r["k"]: (r["median"], r["n"]) for r in exact_median(df, "v", ["k"], accuracy=accuracy).collect()}
    assert found == {k: (statistics.median(values[k::3]), len(values[k::3])) for k in range(3)}


def test_median_of_nothing_and_of_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 4.0), (1, None)], "k int, v double")
    assert [(r["k"], r["median"]) for r in exact_median(df, "v", ["k"]).collect()] == [(None, 2.5)]
    empty = exact_median(df.where("false"), "v").collect()
    assert not empty or empty[0]["median"] is None


def test_hot_keys_are_split_and_nothing_is_lost(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_GROUPS", 3)
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    rows = [(i, None if i % 10 == 0 else (0 if i % 3 == 0 else i % 50)) for i in range(1000)]
    left = spark.createDataFrame(rows, "id bigint, k int")
    right = left.where("k is null or k < 40").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    joined = attach_unique(left, right, ["k"], weight="n")
    firsts = {r["k"]: r["first"] for r in right.collect()}
    assert {(r["id"], r["k"], r["first"]) for r in joined.collect()} == {(i, k, firsts.get(k)) for i, k in rows}
    assert "BroadcastHashJoin" in plan(joined)


@pytest.mark.parametrize("n", [1, 40, 999, 5000])
@pytest.mark.parametrize("newest_first", [True, False])
def test_newest_equals_sort(spark, monkeypatch, n, newest_first):
    monkeypatch.setattr(ranking, "group_limit", lambda df: 10)
    rng = random.Random(1)
    # A third of all rows share one time.
    rows = [(i, 1_700_000_000 + (0 if i % 3 == 0 else rng.randint(-20000, 20000))) for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    expected = sorted(rows, key=lambda r: (-r[1] if newest_first else r[1], r[0]))[:n]
    assert {r["id"] for r in newest(df, "ts", "id", n, newest_first).collect()} == {r[0] for r in expected}


def test_head_values_of_sparse_columns(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id >= 900 THEN id END AS late", "CASE WHEN id = 950 THEN 'x' END AS one",
                                      "CAST(NULL AS STRING) AS never", "id AS full").repartition(7)
    found = {}
    for r in head_values(df, "id", 3).collect():
        found.setdefault(r["column"], []).append((r["rank"], r["value"]))
    assert {c: sorted(v) for c, v in found.items()} == {
        "late": [(1, "900"), (2, "901"), (3, "902")], "one": [(1, "x")], "full": [(1, "0"), (2, "1"), (3, "2")]}


def test_profile_does_not_depend_on_layout(spark):
    df = read(spark, SF, "documents_m")
    rows = lambda p: sorted(map(str, p.collect()))
    assert rows(profile_columns(df, "doc_id")) == rows(profile_columns(df.orderBy(F.rand(3)).repartition(5), "doc_id"))


def test_long_categories_come_back_whole(spark):
    long = "x" * 300
    df = spark.range(20).selectExpr("id", f"CASE WHEN id % 2 = 0 THEN '{long}' ELSE 'short' END AS t")
    row = profile_columns(df, "id").first()
    assert row["is_categorical"] and row["categories"] == [long, "short"] and row["unique_values"] == 2


def test_approximate_profile_keeps_small_columns_exact(spark):
    df = spark.range(5000).selectExpr("id", "concat('v', id) AS many", "concat('c', id % 7) AS few")
    found = {r["column"]: r for r in profile_columns(df, "id", approx=True).collect()}
    assert found["few"]["unique_values"] == 7 and found["few"]["is_categorical"]
    assert abs(found["many"]["unique_values"] - 5000) < 500 and not found["many"]["is_categorical"]


def test_counts_read_once_and_prune_columns(spark):
    df = read(spark, SF, "lineitem_m")
    text = plan(column_counts(df, ["l_quantity"]))
    assert text.count("FileScan") == 1 and "l_comment" not in text and "l_shipdate" not in text.split("FileScan")[1].split("]")[0]


def test_distinct_values_are_shuffled_once(spark):
    from lacuna.operators.profile import column_values

    values = column_values(read(spark, SF, "customer_m"), "c_custkey", ["c_name", "c_mktsegment"])
    per = values.groupBy("position").agg(F.expr("sum(element_at(seen, 1).n) AS present"), F.count("*").alias("u"))
    lists = values.join(F.broadcast(per.where("u < 50 and present > 0").select("position")), "position").groupBy("position").agg(
        F.collect_list(F.struct(F.expr("element_at(seen, 1).first_id"), "value_key")).alias("c"))
    joined = per.join(lists, "position", "left")
    joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 2 and final.count("FileScan") == 1


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    from lacuna.operators.cells import last_hours, missing_cells

    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(last_hours(df, 24, F.lit("2024-01-31").cast("timestamp_ntz"), "ts"))
    assert "Python" not in plan(missing_cells(df, "event_id")) and "Exchange" not in plan(missing_cells(df, "event_id"))


def test_analysis_jobs_do_not_grow_with_width(spark, run_ts):
    def jobs(width):
        df = spark.range(50).selectExpr("id", *[f"CASE WHEN id % 7 <> 0 THEN id + {i} END AS c{i}" for i in range(width)])
        spark.sparkContext.setJobGroup(f"width{width}", "x")
        analyze(df, "id", run_ts)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"width{width}"))

    assert jobs(30) <= jobs(3) + 1
