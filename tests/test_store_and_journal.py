import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lacuna.operators import cache as C
from lacuna.operators.categories import contained, snap_to_table
from lacuna.operators.profile import overlap_pairs
from lacuna.operators.prompts import snap_category
from lacuna.operators.respond import respond
from lacuna.params import FillParams, ModelParams
from lacuna.plans.analyze import analyze
from lacuna.plans.fill import fill_missing
from lacuna.sources.cache_store import CacheConflict, CacheStore

START = datetime(2024, 1, 1)


def entries(spark, keys, minute=0, value="v"):
    at = START + timedelta(minutes=minute)
    return spark.createDataFrame([(k, f"{value}{k}", 0.5, None, at, at, {"column": "c"}) for k in keys], C.CACHE_SCHEMA)


def content(store, version=None):
    return {r.cache_key: r.value for r in store.read(version).collect()}


def test_store_keeps_snapshots(spark, tmp_path):
    store = CacheStore(spark, str(tmp_path / "cache"), buckets=8)
    assert content(store) == {} and store.versions() == []
    first = store.upsert(entries(spark, range(40)))
    second = store.upsert(entries(spark, [3, 100], 5, "new"))
    assert content(store)["3"] == "new3" and len(content(store)) == 41 and content(store, first)["3"] == "v3"
    touched = [n for n in os.listdir(tmp_path / "cache" / "data" / f"version={second}") if n.startswith("bucket=")]
    assert 1 <= len(touched) <= 2  # only the buckets of the two keys
    store.delete(entries(spark, range(10)))
    assert set(content(store)) == {str(k) for k in [*range(10, 40), 100]}
    store.touch(entries(spark, [11]), F.lit(START + timedelta(hours=1)))
    store.evict_lru(2)
    assert set(content(store)) == {"11", "100"}
    store.purge(60, F.lit(START + timedelta(minutes=5, seconds=30)))
    assert set(content(store)) == {"100"}
    store.clear()
    assert content(store) == {}
    store.upsert(entries(spark, [7]))
    store.expire(keep=1)
    again = CacheStore(spark, str(tmp_path / "cache"), buckets=99)
    assert again.buckets == 8 and content(again) == {"7": "v7"} and len(again.versions()) == 1


def test_store_lookup_reads_touched_buckets(spark, tmp_path):
    store = CacheStore(spark, str(tmp_path / "cache"), buckets=32)
    store.upsert(entries(spark, range(200)))
    prompts = spark.createDataFrame([("5",), ("nothing",)], "cache_key string")
    found = store.lookup(prompts, 3600, F.lit(START))
    assert {r.cache_key: r.hit for r in found.collect()} == {"5": True, "nothing": False}
    assert len(found.inputFiles()) <= 4 < len(store.read().inputFiles())


def test_failed_write_leaves_the_old_snapshot(spark, tmp_path):
    store = CacheStore(spark, str(tmp_path / "cache"), buckets=4)
    store.upsert(entries(spark, range(20)))
    before = content(store)
    broken = F.udf(lambda k: 1 // (0 if k == "30" else 1), "int")
    bad = lambda rows: rows.unionByName(entries(spark, range(20, 40))).withColumn("confidence", broken("cache_key").cast("double"))
    with pytest.raises(Exception):
        store._change(entries(spark, range(20, 40)), bad)
    assert content(CacheStore(spark, str(tmp_path / "cache"))) == before
    store.upsert(entries(spark, [50]))  # the failed version's leftovers are not taken up
    assert content(store) == before | {"50": "v50"}


def test_second_writer_of_a_version_fails(spark, tmp_path):
    store = CacheStore(spark, str(tmp_path / "cache"), buckets=4)
    store.upsert(entries(spark, [1]))
    with pytest.raises(CacheConflict):
        store._commit(1, {})
    assert content(store) == {"1": "v1"}


def asked(folder):
    return sorted(name.split("-")[0] for name in os.listdir(folder))


@pytest.mark.parametrize("flush", [1, 4])
def test_lost_task_does_not_repeat_its_calls(spark, tmp_path, flush):
    calls, journal, flag = tmp_path / "calls", str(tmp_path / "journal"), str(tmp_path / "died")
    calls.mkdir()

    def ask(prompt):
        if prompt == "p25" and not os.path.exists(flag):
            open(flag, "w").close()
            os._exit(1)  # the worker dies in the middle of its task
        open(f"{calls}/{prompt}-{os.urandom(6).hex()}", "w").close()
        return f"answer to {prompt}"

    prompts = spark.createDataFrame([(f"k{k}", f"p{k}") for k in range(40)], "cache_key string, prompt string")
    with pytest.raises(Exception):
        respond(prompts, ask, concurrency=1, journal=journal, flush=flush)
    got = {r.cache_key: r.response_text for r in respond(prompts, ask, concurrency=1, journal=journal, flush=flush).collect()}
    assert got == {f"k{k}": f"answer to p{k}" for k in range(40)}
    repeated = len(asked(calls)) - 40
    assert 0 <= repeated < flush


def test_failed_prompts_are_asked_again(spark, tmp_path):
    prompts = spark.createDataFrame([(f"k{k}", f"p{k}") for k in range(6)], "cache_key string, prompt string")

    def bad(prompt):
        raise TimeoutError

    model = ModelParams(max_retries=0)
    assert {r.status for r in respond(prompts, bad, 2, model, str(tmp_path / "j")).collect()} == {"failed"}
    assert {r.status for r in respond(prompts, str.upper, 2, model, str(tmp_path / "j")).collect()} == {"ok"}
    assert {r.response_text for r in respond(prompts, bad, 2, model, str(tmp_path / "j")).collect()} == {f"P{k}" for k in range(6)}


def test_calls_keep_their_pace(spark):
    import time

    prompts = spark.createDataFrame([(f"k{k}", f"p{k}") for k in range(5)], "cache_key string, prompt string").coalesce(1)
    stamps = [float(r.response_text) for r in respond(prompts, lambda p: str(time.time()), 1, ModelParams(requests_per_minute=300)).collect()]
    stamps.sort()
    assert all(b - a >= 0.19 for a, b in zip(stamps, stamps[1:]))


def test_snap_to_table_equals_the_short_list(spark):
    names = ["Fruit", "Dairy", "fruit juice", "", "Grain", "a", "FRUIT", "Fruit", "ß-Carotin"]
    values = ["dairy", "whole grain", "xyz", "", "Fruit", "fruit", "ju", "ju!", "a", None, "AIR", "FRUIT JUICES", "ß", "in", "i", "GRAIN"]
    for listed in (names, [n for n in names if n], names[:1], []):
        answers = spark.createDataFrame([(k, v, 0.5, "r") for k, v in enumerate(values)], "id int, value string, confidence double, reasoning string")
        table = spark.createDataFrame([(k, c) for k, c in enumerate(listed)], "position int, category string")
        short = snap_category(answers, listed) if listed else answers
        expected = [tuple(r) for r in short.orderBy("id").collect()]
        got = [tuple(r) for r in snap_to_table(answers, table).orderBy("id").collect()]
        for (i, v, c, r), (_, v2, c2, r2) in zip(expected, got):
            if values[i] is not None:
                assert (v, c, r) == (v2, c2, r2), values[i]
        assert got[9][1] == (listed[0] if listed else None)


def test_many_categories_stay_out_of_the_plan(spark):
    table = spark.range(100_000).select(F.col("id").alias("position"), F.concat(F.lit("part no "), F.col("id").cast("string")).alias("category"))
    answers = spark.createDataFrame([("the part no 77777 x", 0.5, "r"), ("o 99998", 0.5, "r"), ("PART NO 5", 1.0, "r")],
                                    "value string, confidence double, reasoning string")
    snapped = snap_to_table(answers, table)
    # A text that holds several names takes the first of them.
    assert [r.value for r in snapped.collect()] == ["part no 7", "part no 99998", "part no 5"]
    assert "part no 5000" not in snapped._jdf.queryExecution().toString()


def test_contained_finds_all_pairs(spark):
    words = ["ab", "abc", "b", "xabcx", "zz", "", "bc", "abcabc", "é", "aéb"]
    texts = lambda name: spark.createDataFrame([(w,) for w in words], f"{name} string")
    got = {(r.needle, r.hay) for r in contained(texts("needle"), texts("hay")).collect()}
    assert got == {(n, h) for n in words for h in words if n and n in h}


def test_overlap_of_200_columns(spark):
    df = spark.range(500).select(*[F.when(F.xxhash64("id", F.lit(j)) % 3 != 0, F.col("id")).alias(f"c{j}") for j in range(200)])
    got = {(r.first, r.second): (r.joint_rows, r.usable) for r in overlap_pairs(df).collect()}
    rows = df.toPandas().notna().to_numpy().astype(int)
    joint = rows.T @ rows
    assert got == {(f"c{i}", f"c{j}"): (joint[i, j], joint[i, j] >= 2) for i in range(200) for j in range(i + 1, 200)}
    assert overlap_pairs(df.where("id < 0")).where("joint_rows <> 0").count() == 0 and overlap_pairs(df, ["c1"]).count() == 0


def test_threshold_leaves_cells_open(spark, run_ts):
    df = spark.createDataFrame([(k, None if k == 3 else float(k)) for k in range(6)], "id int, v double")
    plan = analyze(df, "id", run_ts).plan
    kept = fill_missing(df, "id", plan, run_ts, params=FillParams(confidence_threshold=0.6))
    none = fill_missing(df, "id", plan, run_ts, params=FillParams(confidence_threshold=0.7))
    assert kept.ledger.count() == 1 and kept.table.where("v IS NULL").count() == 0
    assert none.ledger.count() == 0 and none.table.where("v IS NULL").count() == 1
