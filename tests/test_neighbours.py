"""Neighbour search against brute force, on data built to be awkward."""

import math
import random

import pytest

from pyspark.sql import functions as F

from lacuna.operators.neighbours import _coded, _survey, knn_predictions, nearest_donors


def brute(rows, k):
    """rows: (id, y, x...) with None for gaps."""
    donors = [r for r in rows if r[1] is not None]
    mean = sum(r[1] for r in donors) / len(donors)
    total = len(rows[0]) - 1
    found = {}
    for r in rows:
        if r[1] is not None:
            continue
        near = []
        for d in donors:
            shared = [(a - b) ** 2 for a, b in zip(r[2:], d[2:]) if a is not None and b is not None]
            if shared:
                acc = 0.0
                for s in shared:
                    acc += s
                near.append((acc * (total / len(shared)), d[0], d[1]))
        near = sorted(near)[:k]
        found[r[0]] = sum(n[2] for n in near) / len(near) if near else mean
    return found


def clusters(n, seed, gaps=0.2):
    """A third of all rows on one point, a tight cluster, a long tail, and gaps everywhere."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = i % 3
        if kind == 0:
            x = [5.0, 5.0]
        elif kind == 1:
            x = [100 + rng.gauss(0, 1e-3), -3 + rng.gauss(0, 1e-3)]
        else:
            x = [math.exp(rng.uniform(-5, 14)), rng.uniform(-1000, 1000)]
        x = [None if rng.random() < gaps else round(v, 6) for v in x]
        rows.append((i, None if rng.random() < 0.25 else round(rng.uniform(0, 100), 2), *x))
    return rows


@pytest.mark.parametrize("seed, k, leaf", [(1, 3, 8), (2, 1, 32), (3, 7, 4)])
def test_equals_brute_force(spark, seed, k, leaf):
    rows = clusters(500, seed)
    df = spark.createDataFrame(rows, "id bigint, y double, a double, b double")
    found = {r["row_id"]: r["prediction"] for r in knn_predictions(df, "id", "y", ["a", "b"], k, leaf=leaf).collect()}
    expected = brute(rows, k)
    assert found.keys() == expected.keys()
    assert all(abs(found[i] - expected[i]) < 1e-9 for i in expected)


def test_three_features_one_constant(spark):
    rng = random.Random(9)
    rows = [(i, None if i % 4 == 0 else float(i), float(rng.randint(0, 20)), 1.0, rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, y double, a double, b double, c double")
    found = {r["row_id"]: r["prediction"] for r in knn_predictions(df, "id", "y", ["a", "b", "c"], 3, leaf=4).collect()}
    expected = brute(rows, 3)
    assert all(abs(found[i] - expected[i]) < 1e-9 for i in expected)


def test_no_shared_feature_takes_the_mean(spark):
    rows = [(0, None, None, 1.0), (1, 10.0, 1.0, None), (2, 20.0, 2.0, None), (3, None, None, None)]
    df = spark.createDataFrame(rows, "id bigint, y double, a double, b double")
    found = {(r["row_id"], r["prediction"], r["neighbours"]) for r in knn_predictions(df, "id", "y", ["a", "b"], 3).collect()}
    assert found == {(0, 15.0, 0), (3, 15.0, 0)}


def test_fewer_donors_than_neighbours(spark):
    df = spark.createDataFrame([(0, None, 1.0), (1, 10.0, 1.0), (2, 30.0, 9.0)], "id bigint, y double, a double")
    assert [r["prediction"] for r in knn_predictions(df, "id", "y", ["a"], 5).collect()] == [20.0]


def test_no_pair_of_all_rows_in_the_plan(spark):
    df = spark.createDataFrame(clusters(300, 4), "id bigint, y double, a double, b double")
    plan = knn_predictions(df, "id", "y", ["a", "b"], 3, leaf=8)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def strip(spark, n=4000):
    """A long and narrow cloud: a running number, and a code of 25 values."""
    rows = [(i, "", float(i), float(i * 7 % 25), None if i % 9 == 5 else float(i * 31 % 1000)) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, block string, x0 double, x1 double, y double")


def test_a_narrow_coordinate_is_split_after_a_wide_one(spark):
    base = strip(spark)
    donors = _coded(base.where("y is not null"), _survey(base, ["x0", "x1"]), ["x0", "x1"])
    boxes = donors.groupBy(F.substring("code", 1, 6)).agg((F.max("x0") - F.min("x0")).alias("long"), F.count_distinct("x1").alias("codes")).collect()
    assert len(boxes) > 40 and all(b["long"] < 200 and b["codes"] == 25 for b in boxes)


def test_a_missing_coordinate_takes_no_bits(spark):
    base = strip(spark)
    donors = _coded(base.where("y is not null").withColumn("x0", F.lit(None).cast("double")), _survey(base, ["x0", "x1"]), ["x0", "x1"])
    assert donors.select(F.substring("code", 1, 5)).distinct().count() > 20


def nodes(plan):
    yield plan
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    below = plan.children()
    for i in range(below.size()):
        yield from nodes(below.apply(i))


def test_receivers_do_not_meet_donors_as_rows(spark):
    base = strip(spark)
    near = nearest_donors(base, _survey(base, ["x0", "x1"]), 2, 3, leaf=128)
    found = near.count(), near.collect()
    receivers = base.where("y is null").count()
    assert found[0] == len(found[1]) == 3 * receivers
    most = 0
    for node in nodes(near._jdf.queryExecution().executedPlan()):
        rows = node.metrics().get("numOutputRows")
        most = max(most, rows.get().value()) if rows.isDefined() else most
    assert 3 * receivers <= most <= 40 * receivers


def test_crowded_cells_of_the_last_level(spark):
    """Half of the donors are closer together than the grid can tell."""
    rng = random.Random(5)
    rows = [(i, None if i % 5 == 0 else float(i), 1.0 + rng.random() * 1e-9 if i % 2 else rng.uniform(-1e6, 1e6)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, y double, a double")
    found = {r["row_id"]: r["prediction"] for r in knn_predictions(df, "id", "y", ["a"], 3, leaf=4).collect()}
    expected = brute(rows, 3)
    assert found.keys() == expected.keys() and all(abs(found[i] - expected[i]) < 1e-9 for i in expected)
