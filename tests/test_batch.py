import random

import pytest
from pyspark.sql import functions as F

from lacuna.functions.durable import durable
from lacuna.operators.profile import load_state, merge_states, profile_columns, profile_columns_by, profile_from_state, profile_state
from lacuna.params import FillParams
from lacuna.plans.analyze import analyze
from lacuna.plans.batch import fill_batch
from lacuna.plans.fill import fill_missing
from lacuna.plans.process import fill_files, read_batch, with_row_ids
from lacuna.sources.scan import list_files, row_ids, scan_csv
from lacuna.sources.sink import write_csv

SCHEMA = "a double, b bigint, c double, colour string, note string, empty string"


def rows_of_file(seed):
    rng = random.Random(seed)
    size = [0, 2, 5, 30, 60, 1][seed % 6]
    maybe = lambda v: None if rng.random() < 0.3 else v
    colours = ["red", "blue", "a colour with a name of more than sixty-four characters, for the digest path"]
    return [(maybe(rng.choice([1.0, 2.5, 7.25, 100.0])), maybe(rng.randint(0, 9)), maybe(rng.random()) if seed % 2 else None,
             maybe(rng.choice(colours)), maybe(f"note {rng.randint(0, 99)}, \"quoted\""), None) for _ in range(size)]


@pytest.fixture
def files(spark, tmp_path):
    paths = []
    for seed in (0, 2, 3, 4):
        path = str(tmp_path / f"file {seed}.parquet")
        spark.createDataFrame(rows_of_file(seed), SCHEMA).coalesce(1).write.parquet(path)
        paths.append(path)
    return paths


def answers(prompts):
    return prompts.select("cache_key", F.concat(F.lit('{"value": "'), F.when(F.contains("prompt", F.lit("of column colour")), "RED").otherwise(
        F.substring("cache_key", 1, 4)), F.lit('", "confidence": 0.9}')).alias("response_text"))


FIELDS = ("row_id", "column", "suggested_value", "suggested_num", "confidence", "method", "reasoning")


@pytest.mark.parametrize("method", ["knn"])
def test_batch_equals_each_file_alone(spark, files, run_ts, method):
    params = FillParams(statistical_method=method)
    result = fill_batch(durable(read_batch(spark, files)), "__row_id", "__file", run_ts, {"*": answers}, params)
    got = sorted((tuple(r[c] for c in ("__file", *FIELDS)) for r in result.ledger.collect()), key=repr)
    expected, reports = [], []
    for k, path in enumerate(files):
        table = with_row_ids(spark, path, "__row_id")
        if not table.count():
            continue
        one = fill_missing(table, "__row_id", analyze(table, "__row_id", run_ts).plan, run_ts, {"*": answers}, params)
        expected += [(k, r.row_id + (k << 36), *(r[c] for c in FIELDS[1:])) for r in one.ledger.collect()]
        reports.append((k, table.count(), one.ledger.count()))
    assert got == sorted(expected, key=repr)
    assert sorted((r["__file"], r.rows, r.fills) for r in result.reports.collect()) == reports


def test_profiles_by_group_equal_profiles_alone(spark, files):
    table = durable(read_batch(spark, files))
    by = {(r["__file"], r.column): r for r in profile_columns_by(table, "__row_id", ["__file"]).collect()}
    for k in {f for f, _ in by}:
        for r in profile_columns(table.where(F.col("__file") == k).drop("__file"), "__row_id").collect():
            mine = by[k, r.column]
            assert [mine[c] for c in r.asDict() if c != "position"] == [r[c] for c in r.asDict() if c != "position"]


def test_merged_states_equal_the_whole(spark, files, tmp_path):
    table = durable(read_batch(spark, files))
    for by in ([], ["__file"]):
        whole = sorted(map(repr, profile_columns_by(table, "__row_id", by).collect()))
        parts = [profile_state(table.where(F.col("__row_id") % 3 == k), "__row_id", by) for k in range(3)]
        parts[0].save(str(tmp_path / f"state{len(by)}"))
        merged = merge_states(merge_states(parts[2], load_state(spark, str(tmp_path / f"state{len(by)}"))), parts[1])
        assert sorted(map(repr, profile_from_state(merged).collect())) == whole
    with pytest.raises(ValueError):
        merge_states(parts[0], profile_state(table, "__row_id", columns=["a"]))


def jobs(spark, run):
    before = spark.sparkContext.getConf().get("spark.app.id")
    spark.sparkContext.setJobGroup(f"count-{random.random()}", before)
    name = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    run()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_number_of_jobs_does_not_follow_the_files(spark, tmp_path, run_ts):
    counts = []
    for size in (3, 12):
        paths = [str(tmp_path / f"{size}-{k}.parquet") for k in range(size)]
        for p in paths:
            spark.createDataFrame([(float(i), None if i % 3 else i) for i in range(9)], "a double, b int").coalesce(1).write.parquet(p)
        counts.append(jobs(spark, lambda: fill_files(spark, paths, str(tmp_path / f"out{size}"), run_ts, same_schema=True)))
    # Adaptive stages may start a job more or less; 9 more files do not.
    assert abs(counts[1] - counts[0]) <= 3 and counts[0] > 10


def test_fill_files_of_one_schema(spark, files, tmp_path, run_ts):
    paths = [files[2], str(tmp_path / "absent.parquet"), files[0], files[3]]
    reports, summary = fill_files(spark, paths, str(tmp_path / "out"), run_ts, same_schema=True)
    got = sorted(reports.collect(), key=lambda r: r.batch_index)
    assert [r.success for r in got] == [True, False, False, True] and got[1].error and got[0].output_path.endswith("filled=file 3.parquet")
    assert summary.first().failed_files == 2
    back = scan_csv(spark, str(tmp_path / "out"))
    assert back.where("filled = 'file 4.parquet'").count() == 60 and back.where("a IS NULL").count() == 0


@pytest.mark.parametrize("split", ["1k", "128m"])
def test_row_ids_do_not_depend_on_splits(spark, tmp_path, split):
    paths = [str(tmp_path / f"{n}.csv") for n in "ab"]
    for p in paths:
        with open(p, "w") as f:
            f.write("k,text\n" + "".join(f"{k},{'x' * (k % 40)}\n" for k in range(900)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = row_ids(scan_csv(spark, paths, origin=True), "id", "file", list_files(spark, paths)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.file, r.id - (r.file << 36), r.k) for r in rows) == [(f, k, k) for f in (0, 1) for k in range(900)]


def test_quoted_line_breaks(spark, tmp_path):
    path = str(tmp_path / "with space.csv")
    with open(path, "w") as f:
        f.write('id,v,t\n1,2.5,"one, ""two""\nthree"\n2,,plain\n3,4,"a\n\nb"\n')
    assert [tuple(r) for r in scan_csv(spark, path).orderBy("id").collect()] == [
        (1, 2.5, 'one, "two"\nthree'), (2, None, "plain"), (3, 4.0, "a\n\nb")]
    typed = scan_csv(spark, path, spark.createDataFrame([], "id int, v double, t string").schema)
    assert typed.count() == 3 and typed.schema["id"].dataType.simpleString() == "int"
    mixed = str(tmp_path / "mixed.csv")
    write_csv(spark.createDataFrame([(k, "x\ny" if k % 7 == 0 else "z") for k in range(50)], "k int, t string").repartition(9, "k"), mixed)
    assert scan_csv(spark, mixed).groupBy("t").count().orderBy("t").collect() == [("x\ny", 8), ("z", 42)]
