"""End to end: validate, analyze, fill, report, check, write - for one table or many files."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.columns import as_text, scalar_columns
from lacuna.functions.durable import durable, local_table
from lacuna.functions.joins import attach_unique
from lacuna.operators.impute import Filled, mean_impute, median_impute
from lacuna.operators.input_rules import validate_input
from lacuna.operators.output_rules import validate_output
from lacuna.operators.reports import (
    assess_quality, batch_summary, completion, confidence_distribution, method_breakdown, recommendations, run_summary,
)
from lacuna.operators.respond import Responder
from lacuna.params import FillParams, InputLimits
from lacuna.plans.analyze import Analysis, analyze
from lacuna.plans.batch import fill_batch
from lacuna.plans.fill import FillResult, Strategy, fill_missing
from lacuna.sources.scan import check_source, list_files, load, row_ids, scan_csv
from lacuna.sources.sink import write_csv


class Report(NamedTuple):
    input_rules: DataFrame
    analysis: Analysis
    filled: FillResult
    completion: DataFrame
    confidence: DataFrame
    methods: DataFrame
    quality: DataFrame
    recommendations: DataFrame
    output_rules: DataFrame
    summary: DataFrame


def process(df: DataFrame, id_col: str, run_ts: datetime, responders: Mapping[str, Responder] | None = None,
            limits: InputLimits = InputLimits(max_rows=None), params: FillParams = FillParams(),
            strategies: Sequence[Strategy] = (), strict: bool = True, features: Sequence[str] | None = None) -> Report:
    """The whole run over one table. The filled table and its ledger are written out once and reused."""
    rules = validate_input(df, limits, strict=strict)
    analysis = analyze(df, id_col, run_ts, params.categorical_threshold)
    result = fill_missing(df, id_col, analysis.plan, run_ts, responders, params, strategies=strategies, features=features)
    result = FillResult(durable(result.table), durable(result.ledger), result.new_cache)
    done = completion(df, result.table)
    confidence = confidence_distribution(result.ledger)
    quality = assess_quality(result.ledger)
    totals = run_summary(df, result.ledger).withColumn("__one", F.lit(1))
    score = quality.select("overall_quality_score", "status").withColumn("__one", F.lit(1))
    summary = totals.join(F.broadcast(score), "__one").drop("__one").withColumn("total_columns", F.lit(len(df.columns)))
    return Report(
        rules, analysis, result, done, confidence, method_breakdown(result.ledger), quality,
        recommendations(done, confidence), validate_output(df, result.table, result.ledger, id_col), summary)


def with_row_ids(spark: SparkSession, path: str, id_col: str) -> DataFrame:
    """The file behind ``path`` with a row id that does not depend on how it is split; written out once."""
    files = list_files(spark, [path])
    table = scan_csv(spark, path, origin=True) if path.lower().endswith(".csv") else load(spark, path)
    return durable(row_ids(table, id_col, "__file", files).drop("__file"))


def fill_files(spark: SparkSession, paths: Sequence[str], out_dir: str | None, run_ts: datetime,
               responders: Mapping[str, Responder] | None = None, params: FillParams = FillParams(),
               parallel: int = 4, same_schema: bool = False) -> tuple[DataFrame, DataFrame]:
    """Each file filled on its own; a file that fails does not stop the others.

    Returns per-file reports ``batch_index, input_file, output_path, success, error, rows, fills,
    quality_score, processing_seconds`` and the batch summary. With ``same_schema`` (the first file's) all files go through one
    chain of jobs (:mod:`lacuna.plans.batch`), output is ``out_dir/filled=<name>`` and seconds are the batch's, shared out evenly. Else
    each file is its own Spark jobs, ``parallel`` files at a time, and output goes to ``out_dir/filled_<name>``.
    """
    if same_schema:
        reports = _fill_batch_files(spark, paths, out_dir, run_ts, responders, params)
        return reports, batch_summary(reports)

    def one(index: int, path: str) -> tuple:
        began = time.monotonic()
        try:
            verdict = check_source(spark, path).first()
            if not verdict["ok"]:
                raise ValueError(f"{path}: {verdict['reason']}")
            table = with_row_ids(spark, path, "__row_id")
            report = process(table, "__row_id", run_ts, responders, params=params)
            target = f"{out_dir}/filled_{_name(path)}" if out_dir else None
            if target:
                write_csv(report.filled.table.drop("__row_id"), target)
            s = report.summary.first()
            return (index, path, target, True, None, s["total_rows_processed"], s["total_fields_filled"],
                    s["overall_quality_score"], time.monotonic() - began)
        except Exception as error:
            return (index, path, None, False, f"{type(error).__name__}: {str(error).splitlines()[0]}", None, None, None, time.monotonic() - began)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(one, range(len(paths)), paths))
    reports = local_table(spark, rows, FILE_REPORT)
    return reports, batch_summary(reports)


FILE_REPORT = ("batch_index int, input_file string, output_path string, success boolean, error string, rows bigint, fills bigint, "
               "quality_score double, processing_seconds double")


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def read_batch(spark: SparkSession, paths: Sequence[str], id_col: str = "__row_id", file_col: str = "__file") -> DataFrame | None:
    """Rows of all files of one schema (the first file's) with stable ids and the file's position in ``paths``; None if no file exists.

    Files that do not exist are left out, and so are files whose content cannot be read.
    """
    files = list_files(spark, paths)
    if not files:
        return None
    names = [name for _, name in files]
    if paths[files[0][0]].lower().rstrip("/").endswith(".csv"):
        table = scan_csv(spark, names, origin=True)
    else:
        first = spark.read.parquet(names[0]).schema
        table = spark.read.option("ignoreCorruptFiles", True).schema(first).parquet(*names)
    return row_ids(table, id_col, file_col, files)


def _fill_batch_files(spark: SparkSession, paths: Sequence[str], out_dir: str | None, run_ts: datetime,
                      responders: Mapping[str, Responder] | None, params: FillParams) -> DataFrame:
    began = time.monotonic()
    table = read_batch(spark, paths)
    asked = local_table(spark, [(k, p, f"{out_dir}/filled={_name(p)}" if out_dir else None, _name(p)) for k, p in enumerate(paths)],
                        "batch_index int, input_file string, output_path string, name string")
    if table is None:
        found = local_table(spark, [], "batch_index int, rows bigint, fills bigint, quality_score double")
    else:
        result = fill_batch(durable(table), "__row_id", "__file", run_ts, responders, params)
        found = result.reports.withColumnRenamed("__file", "batch_index")
        if out_dir:
            named = attach_unique(result.table, asked.select(F.col("batch_index").alias("__file"), F.col("name").alias("filled")), ["__file"])
            texts = [as_text(result.table, c).alias(c) for c in scalar_columns(result.table, ["__row_id", "__file"])]
            named.select(*texts, "filled").write.mode("overwrite").partitionBy("filled").option("header", True).option("escape", '"').csv(out_dir)
    found = durable(found)
    seconds = (time.monotonic() - began) / max(len(paths), 1)
    return asked.join(found, "batch_index", "left").select(
        "batch_index", "input_file", F.when(F.col("rows").isNotNull(), F.col("output_path")).alias("output_path"),
        F.col("rows").isNotNull().alias("success"),
        F.when(F.col("rows").isNull(), "no rows: the file does not exist, is empty or cannot be read").alias("error"),
        "rows", "fills", "quality_score", F.lit(seconds).alias("processing_seconds"))


def fill_same_schema(spark: SparkSession, paths: Sequence[str], id_col: str, target: str, run_ts: datetime,
                     method: str = "median") -> Filled:
    """Parquet files of one schema in one job: the statistic of each file fills that file's gaps."""
    table = spark.read.parquet(*paths).withColumn("source_file", F.col("_metadata.file_path"))
    impute = {"median": median_impute, "mean": mean_impute}[method]
    return impute(table, id_col, target, run_ts, by=["source_file"])
