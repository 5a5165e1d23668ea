"""Delimited text, sinks, file batches, and late rows in streams."""

import json

import pytest
from pyspark.sql import functions as F

from lacuna.operators.metrics import export_rows
from lacuna.params import NA_TOKENS, InputLimits
from lacuna.plans.process import fill_files, fill_same_schema
from lacuna.sources.scan import check_source, load, scan_csv
from lacuna.sources.sink import export_metrics, write_csv
from lacuna.streaming.live import stream_distinct_prompts, stream_gate, stream_summary


def test_tokens_become_missing_before_typing(spark, tmp_path):
    path = tmp_path / "t.csv"
    lines = [f"{i},{token},t{i},{token if i % 2 else 'True'}" for i, token in enumerate(NA_TOKENS)]
    path.write_text("a,b,c,d\n" + "\n".join(lines) + "\n7,1.5,x,False\n")
    df = scan_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "string", "boolean"]
    assert df.where("b is not null").count() == 1 and df.count() == len(NA_TOKENS) + 1


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 12345678.5, "a,\"b\""), (2, None, None)], "i bigint, d double, s string")
    write_csv(df, str(tmp_path / "out.csv"))
    assert sorted(map(tuple, scan_csv(spark, str(tmp_path / "out.csv")).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_source_gate(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "b.CSV").write_text("a\n1\n")
    ok = lambda p: check_source(spark, str(tmp_path / p)).first()["ok"]
    assert not ok("a.txt") and not ok("absent.csv") and ok("b.CSV")
    with pytest.raises(TypeError):
        load(spark, 5)


def test_one_bad_file_does_not_stop_the_batch(spark, tmp_path, run_ts):
    (tmp_path / "good.csv").write_text("a,b\n1,10\n2,\n3,30\n4,40\n")
    (tmp_path / "bad.csv").write_text("a,b\n1,\n2,\n")
    reports, summary = fill_files(spark, [str(tmp_path / n) for n in ("good.csv", "bad.csv", "none.csv")], str(tmp_path / "out"), run_ts)
    rows = reports.orderBy("batch_index").collect()
    assert [r["success"] for r in rows] == [True, False, False] and "empty_column" in rows[1]["error"]
    assert rows[0]["fills"] == 1
    total = summary.first()
    assert (total["total_files"], total["successful_files"], total["failed_files"]) == (3, 1, 2)
    filled = scan_csv(spark, str(tmp_path / "out" / "filled_good.csv"))
    assert {r["a"]: r["b"] for r in filled.collect()} == {1: 10.0, 2: 26.67, 3: 30.0, 4: 40.0}


def test_each_file_has_its_own_median(spark, tmp_path, run_ts):
    for name, low in (("x", 0), ("y", 100)):
        spark.range(5).selectExpr(f"id + {low} AS id", f"CASE WHEN id < 3 THEN double(id + {low}) END AS v").coalesce(1).write.parquet(str(tmp_path / name))
    ledger = fill_same_schema(spark, [str(tmp_path / "x"), str(tmp_path / "y")], "id", "v", run_ts).ledger
    assert {r["row_id"]: r["suggested_num"] for r in ledger.collect()} == {3: 1.0, 4: 1.0, 103: 101.0, 104: 101.0}


def test_metric_export(spark, tmp_path):
    one = spark.range(2).selectExpr("id AS a")
    export_metrics(export_rows(one, one, one), str(tmp_path / "m"))
    lines = spark.read.text(str(tmp_path / "m" / "kind=performance_metrics")).collect()
    assert sorted(json.loads(r["value"])["a"] for r in lines) == [0, 1]


def batches(spark, tmp_path, name, schema, *frames):
    """A file stream that reads one frame per micro-batch."""
    folder = tmp_path / name
    for i, rows in enumerate(frames):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"{i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))


def drain(stream, path):
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(
        availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "operation string, duration_seconds double, s bigint"
    hour = 3600
    stream = batches(spark, tmp_path, "perf", schema, [("a", 1.0, 0)], [("a", 2.0, 5 * hour)], [("a", 3.0, 5 * hour)], [("a", 9.0, 10)], [("a", 4.0, 9 * hour)])
    summary = stream_summary(stream.withColumn("timestamp", F.timestamp_seconds("s")))
    rows = {r["s"]: (r["count"], r["total_duration"]) for r in drain(summary, tmp_path).withColumn("s", F.unix_seconds("window_start")).collect()}
    assert rows == {0: (1, 1.0), 5 * hour: (2, 5.0)}


def test_prompts_repeat_only_after_their_time(spark, tmp_path):
    schema = "cache_key string, s bigint"
    stream = batches(spark, tmp_path, "prompts", schema, [("k", 0), ("k", 1)], [("k", 100)], [("other", 50_000)], [("other", 50_001)], [("k", 60_000)])
    keyed = stream.withColumn("timestamp", F.timestamp_seconds("s"))
    rows = sorted(r["s"] for r in drain(stream_distinct_prompts(keyed), tmp_path).where("cache_key = 'k'").collect())
    assert len(rows) == 2 and rows[0] in (0, 1) and rows[1] == 60_000


def test_gate_routes_batches(spark, tmp_path):
    stream = batches(spark, tmp_path, "rows", "a double", [(1.0,), (2.0,)], [(None,), (None,)])
    p = str(tmp_path)
    stream_gate(stream, f"{p}/good", f"{p}/bad", f"{p}/verdicts", f"{p}/st", InputLimits(max_rows=None)).start().awaitTermination()
    assert spark.read.parquet(f"{p}/good").count() == 2 and spark.read.parquet(f"{p}/bad").count() == 2
    assert spark.read.parquet(f"{p}/verdicts").where("rule = 'empty_column' and not passed").count() == 1
