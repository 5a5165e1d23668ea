"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.columns import as_text, round_half_even
from lacuna.functions.durable import durable, scratch_path
from lacuna.operators import cache as C
from lacuna.operators import cells as P
from lacuna.operators.categories import snap_to_table
from lacuna.operators import impute as I
from lacuna.operators import input_rules as V
from lacuna.operators import metrics as M
from lacuna.operators import neighbours as N
from lacuna.operators import output_rules as O
from lacuna.operators import profile as A
from lacuna.operators import prompts as L
from lacuna.operators import reports as R
from lacuna.operators import respond as S
from lacuna.params import DOMAIN_KEYWORDS, FillParams, InputLimits, ModelParams
from lacuna.plans.analyze import analyze
from lacuna.plans.fill import Strategy, fill_missing
from lacuna.plans.batch import fill_batch
from lacuna.plans.process import fill_files, fill_same_schema, process, read_batch
from lacuna.sources.cache_store import CacheStore
from lacuna.sources.scan import check_source, list_files, row_ids, scan_csv, scan_parquet
from lacuna.sources.sink import write_csv
from lacuna.streaming.live import (
    read_latest, stream_counters, stream_distinct_prompts, stream_fill, stream_fill_by, stream_gate, stream_newest, stream_spans, stream_summary,
)
from workload.tables import DERIVED, read, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
RUN_TS = datetime(2024, 1, 31)
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
HOURS = 24 * 10


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register a query together with its check SQL over the named derived tables."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = (with_tables(*tables) + "\n" if tables else "") + sql
        return fn

    return register


def ledger(spark, sf, name="ledger") -> DataFrame:
    return read(spark, sf, name).withColumnRenamed("col_name", "column").withColumn("original_value", F.lit(None).cast("string"))


def pct(part: str, whole: str, digits: int) -> str:
    scale = f"{10 ** digits}.0"
    return f"round_even(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100.0 * {scale}, 0) / {scale}"


def gap_rows(table: str, columns: list[str], first: int = 0) -> str:
    """One row per column with its number of rows and gaps."""
    return " UNION ALL ".join(
        f"SELECT {i + first} AS position, '{c}' AS \"column\", COUNT(*) AS n, COUNT(*) - COUNT({c}) AS missing_count FROM {table}"
        for i, c in enumerate(columns))


PART = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
CUSTOMER = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus"]

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]

# ---------------------------------------------------------------- scans, sinks


@query("scan_parquet", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_parquet_query(spark, sf):
    return scan_parquet(spark, f"{sf}/nation.parquet")


@query("export_metrics", """
    SELECT 'performance_metrics' AS kind, COUNT(*) AS records FROM events UNION ALL
    SELECT 'api_call_metrics', COUNT(*) FROM events UNION ALL SELECT 'imputation_metrics', COUNT(*) FROM events""")
def export_query(spark, sf):
    rows = M.export_rows(read(spark, sf, "performance"), read(spark, sf, "api_calls"), read(spark, sf, "imputations"))
    return rows.where(F.try_parse_json("record").isNotNull()).groupBy("kind").agg(F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------- cells


@query("missing_cells", " UNION ALL ".join(
    f"SELECT p_partkey AS row_id, '{c}' AS \"column\" FROM part_m WHERE {c} IS NULL" for c in PART), ("part_m",))
def missing_cells_query(spark, sf):
    return P.missing_cells(read(spark, sf, "part_m"), "p_partkey")


@query("missing_cells_of_column", """SELECT o_orderkey AS row_id, 'o_totalprice' AS "column" FROM orders_m WHERE o_totalprice IS NULL""",
       ("orders_m",))
def missing_column_query(spark, sf):
    return P.missing_cells(read(spark, sf, "orders_m"), "o_orderkey", "o_totalprice")


@query("complete_rows", "SELECT * FROM part_m WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in PART), ("part_m",))
def complete_rows_query(spark, sf):
    return P.complete_rows(read(spark, sf, "part_m"))


@query("non_missing", "SELECT l_quantity FROM lineitem_m WHERE l_quantity IS NOT NULL", ("lineitem_m",))
def non_missing_query(spark, sf):
    return P.non_missing(read(spark, sf, "lineitem_m"), "l_quantity")


@query("head_values", " UNION ALL ".join(f"""
    SELECT * FROM (SELECT '{c}' AS "column", ROW_NUMBER() OVER (ORDER BY p_partkey) AS rank, p_partkey AS row_id,
    CAST({c} AS VARCHAR) AS value FROM part_m WHERE {c} IS NOT NULL) WHERE rank <= 5""" for c in PART), ("part_m",))
def head_values_query(spark, sf):
    heads = P.head_values(read(spark, sf, "part_m"), "p_partkey", 5)
    return heads.select("column", F.col("rank").cast("bigint").alias("rank"), "row_id", "value")


CONTEXT = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN '{c}: ' || CAST({c} AS VARCHAR) END" for c in PART if c != "p_type") + ")"


@query("row_context", f"SELECT p_partkey, {CONTEXT} AS context FROM part_m WHERE p_type IS NULL", ("part_m",))
def row_context_query(spark, sf):
    df = read(spark, sf, "part_m")
    return df.where("p_type IS NULL").select("p_partkey", P.row_context(df, "p_type", PART).alias("context"))


@query("apply_ledger", """
    SELECT p_partkey, p_name, COALESCE(p_brand, 'Brand#1') AS p_brand, p_type, COALESCE(CAST(p_size AS DOUBLE), 25.0) AS p_size,
           COALESCE(p_retailprice, 1000.5) AS p_retailprice FROM part_m""", ("part_m",))
def apply_ledger_query(spark, sf):
    return P.apply_ledger(read(spark, sf, "part_m"), "p_partkey", ledger(spark, sf), ["p_brand", "p_size", "p_retailprice"])


@query("confident", 'SELECT row_id, col_name AS "column", confidence FROM ledger WHERE confidence >= 0.5', ("ledger",))
def confident_query(spark, sf):
    return P.confident(ledger(spark, sf), 0.5).select("row_id", "column", "confidence")


@query("last_hours", f"SELECT event_id, operation FROM performance WHERE timestamp >= {NOW} - INTERVAL {HOURS} HOURS", ("performance",))
def last_hours_query(spark, sf):
    return P.last_hours(read(spark, sf, "performance"), HOURS, now()).select("event_id", "operation")


# ---------------------------------------------------------------- profiles and plans


@query("dataset_profile", f"SELECT COUNT(*) AS total_rows, 5 AS total_columns FROM customer")
def dataset_profile_query(spark, sf):
    return A.dataset_profile(read(spark, sf, "customer_m"), RUN_TS).select("total_rows", "total_columns")


def summary_sql(table: str, columns: list[str], digits: int = 1, first: int = 0) -> str:
    return f"""
    SELECT position, "column", missing_count, {pct('missing_count', 'n', digits)} AS missing_percentage,
           CASE WHEN missing_count * 100.0 / n > 70 THEN 'HIGH' WHEN missing_count * 100.0 / n > 30 THEN 'MEDIUM' ELSE 'LOW' END AS priority
    FROM ({gap_rows(table, columns, first)}) WHERE missing_count > 0"""


@query("missing_summary", summary_sql("part_m", PART, first=1), ("part_m",))
def missing_summary_query(spark, sf):
    return A.missing_summary(read(spark, sf, "part_m"))


@query("missing_summary_customer", summary_sql("customer_m", CUSTOMER, first=1), ("customer_m",))
def missing_summary_customer_query(spark, sf):
    return A.missing_summary(read(spark, sf, "customer_m"))


@query("missing_summary_lineitem", summary_sql("lineitem_m", LINEITEM), ("lineitem_m",))
def missing_summary_lineitem_query(spark, sf):
    return A.missing_summary(read(spark, sf, "lineitem_m"))


@query("distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS present, COUNT(DISTINCT {c}) AS unique_values FROM lineitem_m" for c in LINEITEM), ("lineitem_m",))
def distinct_counts_query(spark, sf):
    return A.distinct_counts(read(spark, sf, "lineitem_m"), "l_orderkey", LINEITEM).select("column", "present", "unique_values")


def profile_sql(table: str, key: str, columns: list[tuple[str, str]], extra: str = "") -> str:
    """Profile rows of text (``t``) and numeric (``n``) columns, one SELECT per column."""
    rows = []
    for position, (c, kind) in columns:
        name_hints = [f"domain:{d}" for d, words in DOMAIN_KEYWORDS.items() if any(w in c.lower() for w in words)]
        prefix = "".join(h + "|" for h in name_hints)
        any_of = lambda words: " OR ".join(f"contains(head, '{w}')" for w in words)
        is_cat = f"({str(kind == 't').upper()} AND present > 0 AND u <= least(50.0, present * 0.5))"
        hint = f"""CASE WHEN {str(kind == 'n').upper()} OR present = 0 THEN '' ELSE rtrim('{prefix}' || CASE
            WHEN {any_of(('inc', 'corp', 'llc', 'ltd'))} THEN 'pattern:company_names'
            WHEN {any_of(('high', 'low', 'medium', 'good', 'bad'))} THEN 'pattern:ratings_levels'
            WHEN u <= 10 THEN 'pattern:limited_categories' ELSE '' END, '|') END"""
        rows.append(f"""
        SELECT {position} AS position, '{c}' AS "column", present, u AS unique_values, {str(kind == 'n').lower()} AS is_numeric,
               {is_cat} AS is_categorical, {hint} AS domain_hints, samples AS sample_values,
               CASE WHEN {is_cat} THEN cats ELSE '' END AS categories
        FROM (SELECT COUNT({c}) AS present, COUNT(DISTINCT {c}) AS u FROM {table}),
             (SELECT COALESCE(lower(string_agg(v, ' ' ORDER BY r)), '') AS head,
                     COALESCE(string_agg(CASE WHEN r <= 3 THEN v END, '|' ORDER BY r), '') AS samples FROM (
                SELECT CAST({c} AS VARCHAR) AS v, ROW_NUMBER() OVER (ORDER BY {key}) AS r FROM {table} WHERE {c} IS NOT NULL) WHERE r <= 10),
             (SELECT COALESCE(string_agg(v, '|' ORDER BY f), '') AS cats FROM (
                SELECT CAST({c} AS VARCHAR) AS v, MIN({key}) AS f FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY f LIMIT 51))""")
    return " UNION ALL ".join(rows)


def flat_profile(profile: DataFrame) -> DataFrame:
    return profile.select(
        "position", "column", "present", "unique_values", "is_numeric", "is_categorical",
        F.array_join("domain_hints", "|").alias("domain_hints"), F.array_join("sample_values", "|").alias("sample_values"),
        F.coalesce(F.array_join("categories", "|"), F.lit("")).alias("categories"))


PART_KINDS = list(enumerate([("p_name", "t"), ("p_brand", "t"), ("p_type", "t"), ("p_size", "n"), ("p_retailprice", "n")], 1))


@query("profile_columns", profile_sql("part_m", "p_partkey", PART_KINDS), ("part_m",))
def profile_columns_query(spark, sf):
    return flat_profile(A.profile_columns(read(spark, sf, "part_m"), "p_partkey"))


@query("profile_merged", profile_sql("part_m", "p_partkey", PART_KINDS), ("part_m",))
def profile_merged_query(spark, sf):
    """The profile of two halves: each one's state is stored and read back, and the two are merged."""
    df, path = read(spark, sf, "part_m"), scratch_path(spark, "states")
    for k in (0, 1):
        A.profile_state(df.where(F.col("p_partkey") % 2 == k), "p_partkey").save(f"{path}/{k}")
    return flat_profile(A.profile_from_state(A.merge_states(*(A.load_state(spark, f"{path}/{k}") for k in (0, 1)))))


@query("profile_columns_documents", profile_sql("documents_m", "doc_id", list(enumerate(
    [("text", "t"), ("lang", "t"), ("source", "t"), ("n_chars", "n")], 1))), ("documents_m",))
def profile_documents_query(spark, sf):
    return flat_profile(A.profile_columns(read(spark, sf, "documents_m"), "doc_id"))


@query("domain_hints", profile_sql("customer_m", "c_custkey", list(enumerate(
    [("c_name", "t"), ("c_nationkey", "n"), ("c_acctbal", "n"), ("c_mktsegment", "t")], 1))), ("customer_m",))
def domain_hints_query(spark, sf):
    return flat_profile(A.profile_columns(read(spark, sf, "customer_m"), "c_custkey"))


def plan_sql(table: str, kinds: list) -> str:
    rows = []
    for position, (c, kind) in kinds:
        cat = f"({str(kind == 't').upper()} AND u <= least(50.0, (n - m) * 0.5))"
        method = f"CASE WHEN {str(kind == 'n').upper()} THEN 'statistical' WHEN {cat} AND u <= 20 THEN 'llm_categorical' ELSE 'llm_contextual' END"
        time = f"CASE WHEN {str(kind == 'n').upper()} THEN 0.1::DOUBLE WHEN {cat} THEN m * 0.05::DOUBLE ELSE m * 0.2::DOUBLE END"
        rows.append(f"""SELECT {position} AS position, '{c}' AS "column", m AS missing_count, {method} AS method,
            round({time}, 6) AS estimated_time_minutes FROM (SELECT COUNT(*) AS n, COUNT(*) - COUNT({c}) AS m, COUNT(DISTINCT {c}) AS u FROM {table})
            WHERE m > 0""")
    return " UNION ALL ".join(rows)


@query("plan_fills", f"""
    SELECT position, "column", missing_count, method, estimated_time_minutes,
           CASE method WHEN 'statistical' THEN 'knn_imputation' WHEN 'llm_categorical' THEN 'classification_with_examples'
                ELSE 'contextual_inference' END AS approach,
           CASE method WHEN 'statistical' THEN 0.8::DOUBLE WHEN 'llm_categorical' THEN 0.7::DOUBLE ELSE 0.6::DOUBLE END AS confidence_base
    FROM ({plan_sql('part_m', PART_KINDS)})""", ("part_m",))
def plan_fills_query(spark, sf):
    df = read(spark, sf, "part_m")
    plan = A.plan_fills(A.profile_columns(df, "p_partkey"), A.missing_summary(df))
    return plan.select("position", "column", "missing_count", "method",
                       F.round("estimated_time_minutes", 6).alias("estimated_time_minutes"), "approach", "confidence_base")


@query("analyze_effort", f"""
    SELECT round_even(c * 10.0, 0) / 10.0 AS complexity_score, round(t, 6) AS total_minutes,
           CASE WHEN t < 2 THEN '< 2 minutes' WHEN t < 10 THEN '~' || CAST(floor(t) AS BIGINT) || ' minutes'
                ELSE '~' || CAST(floor(t) AS BIGINT) || ' minutes (consider batch processing)' END AS estimated_total_time
    FROM (SELECT SUM(estimated_time_minutes) AS t, SUM(missing_count * CASE method WHEN 'llm_contextual' THEN 0.1::DOUBLE
                 WHEN 'statistical' THEN 0.01::DOUBLE ELSE 0.0::DOUBLE END) AS c FROM ({plan_sql('part_m', PART_KINDS)}))""", ("part_m",))
def analyze_query(spark, sf):
    found = analyze(read(spark, sf, "part_m"), "p_partkey", RUN_TS)
    one = found.complexity.withColumn("k", F.lit(1)).join(found.time.withColumn("k", F.lit(1)), "k").drop("k")
    return one.withColumn("total_minutes", F.round("total_minutes", 6))


@query("feature_overlap", " UNION ALL ".join(f"""
    SELECT '{f}' AS feature, COUNT(*) FILTER (WHERE l_quantity IS NOT NULL AND {f} IS NOT NULL) AS joint_rows,
    COUNT(*) FILTER (WHERE l_quantity IS NOT NULL AND {f} IS NOT NULL) >= 2 AS usable FROM lineitem_m"""
    for f in ("l_extendedprice", "l_discount", "l_tax")), ("lineitem_m",))
def feature_overlap_query(spark, sf):
    return A.feature_overlap(read(spark, sf, "lineitem_m"), "l_quantity", ["l_extendedprice", "l_discount", "l_tax"])


# ---------------------------------------------------------------- numeric fills


def knn_sql(table: str, key: str, target: str, features: list[str], k: int = 3) -> str:
    both = " + ".join(f"CAST(r.{f} IS NOT NULL AND d.{f} IS NOT NULL AS INT)" for f in features)
    total = " + ".join(f"COALESCE(CAST(r.{f} - d.{f} AS DOUBLE) * CAST(r.{f} - d.{f} AS DOUBLE), 0.0::DOUBLE)" for f in features)
    return f"""
    SELECT r.{key} AS row_id, COALESCE(n.prediction, (SELECT round_even(AVG({target}) * 100.0, 0) / 100.0 FROM {table})) AS suggested_num
    FROM {table} r LEFT JOIN (
        SELECT id, round_even(AVG(y) * 100.0, 0) / 100.0 AS prediction FROM (
            SELECT r.{key} AS id, d.{target} AS y, ROW_NUMBER() OVER (PARTITION BY r.{key} ORDER BY
                ({total}) * ({len(features) + 1}.0::DOUBLE / ({both})), d.{key}) AS rn
            FROM {table} r, {table} d WHERE r.{target} IS NULL AND d.{target} IS NOT NULL AND ({both}) > 0)
        WHERE rn <= {k} GROUP BY id) n ON n.id = r.{key}
    WHERE r.{target} IS NULL"""


@query("knn_impute", knn_sql("part_knn", "p_partkey", "p_retailprice", ["p_size", "p_code"]), ("part_knn",))
def knn_query(spark, sf):
    return N.knn_impute(read(spark, sf, "part_knn"), "p_partkey", "p_retailprice", RUN_TS).ledger.select("row_id", "suggested_num")


@query("knn_impute_single_feature", knn_sql("part_m", "p_partkey", "p_retailprice", ["p_size"]), ("part_m",))
def knn_single_query(spark, sf):
    return N.knn_impute(read(spark, sf, "part_m"), "p_partkey", "p_retailprice", RUN_TS).ledger.select("row_id", "suggested_num")


@query("knn_impute_repeated_values", knn_sql("customer_m", "c_custkey", "c_acctbal", ["c_nationkey"], 5), ("customer_m",))
def knn_repeated_query(spark, sf):
    return N.knn_impute(read(spark, sf, "customer_m"), "c_custkey", "c_acctbal", RUN_TS, n=5).ledger.select("row_id", "suggested_num")


@query("knn_impute_blocked", f"""
    SELECT row_id, suggested_num FROM (SELECT r.p_partkey AS row_id, round_even(AVG(y) * 100.0, 0) / 100.0 AS suggested_num FROM (
        SELECT r.p_partkey, d.p_retailprice AS y, ROW_NUMBER() OVER (PARTITION BY r.p_partkey ORDER BY
            CAST(r.p_size - d.p_size AS DOUBLE) * CAST(r.p_size - d.p_size AS DOUBLE), d.p_partkey) AS rn
        FROM part r JOIN part d ON r.p_brand = d.p_brand WHERE r.p_partkey % 7 = 3 AND d.p_partkey % 7 <> 3) r
    WHERE rn <= 3 GROUP BY 1)""")
def knn_blocked_query(spark, sf):
    df = read(spark, sf, "part").selectExpr(
        "p_partkey", "p_brand", "p_size", "CASE WHEN p_partkey % 7 <> 3 THEN p_retailprice END AS p_retailprice")
    return N.knn_impute(df, "p_partkey", "p_retailprice", RUN_TS, ["p_size"], block_by=["p_brand"]).ledger.select("row_id", "suggested_num")


MEDIAN = "round_even(median({0}) * 100.0, 0) / 100.0"


@query("median_impute", f"SELECT o_orderkey AS row_id, (SELECT {MEDIAN.format('o_totalprice')} FROM orders_m) AS suggested_num, "
       "0.6::DOUBLE AS confidence, 'median_imputation' AS method FROM orders_m WHERE o_totalprice IS NULL", ("orders_m",))
def median_query(spark, sf):
    return I.median_impute(read(spark, sf, "orders_m"), "o_orderkey", "o_totalprice", RUN_TS).ledger.select(
        "row_id", "suggested_num", "confidence", "method")


@query("median_impute_table", f"""SELECT o_orderkey, o_custkey, o_orderstatus,
       COALESCE(o_totalprice, (SELECT {MEDIAN.format('o_totalprice')} FROM orders_m)) AS o_totalprice, o_orderpriority FROM orders_m""", ("orders_m",))
def median_table_query(spark, sf):
    return I.median_impute(read(spark, sf, "orders_m"), "o_orderkey", "o_totalprice", RUN_TS).table.drop("o_orderdate")


@query("median_impute_by", f"""SELECT e.event_id AS row_id, m.v AS suggested_num FROM events_m e LEFT JOIN
       (SELECT user_id, {MEDIAN.format('value')} AS v FROM events_m WHERE value IS NOT NULL GROUP BY user_id) m ON m.user_id = e.user_id
       WHERE e.value IS NULL""", ("events_m",))
def median_by_query(spark, sf):
    return I.median_impute(read(spark, sf, "events_m"), "event_id", "value", RUN_TS, by=["user_id"]).ledger.select("row_id", "suggested_num")


@query("mean_impute_by", """SELECT e.event_id AS row_id, m.v AS suggested_num FROM events_m e LEFT JOIN
       (SELECT event_type, round_even(AVG(value) * 100.0, 0) / 100.0 AS v FROM events_m WHERE value IS NOT NULL GROUP BY event_type) m
       ON m.event_type IS NOT DISTINCT FROM e.event_type WHERE e.value IS NULL""", ("events_m",))
def mean_by_query(spark, sf):
    return I.mean_impute(read(spark, sf, "events_m"), "event_id", "value", RUN_TS, by=["event_type"]).ledger.select("row_id", "suggested_num")


@query("mean_impute", """SELECT o_orderkey AS row_id, (SELECT round_even(AVG(o_totalprice) * 100.0, 0) / 100.0 FROM orders_m) AS suggested_num
       FROM orders_m WHERE o_totalprice IS NULL""", ("orders_m",))
def mean_query(spark, sf):
    return I.mean_impute(read(spark, sf, "orders_m"), "o_orderkey", "o_totalprice", RUN_TS).ledger.select("row_id", "suggested_num")


@query("fill_same_schema", f"""SELECT o_orderkey AS row_id, (SELECT {MEDIAN.format('o_totalprice')} FROM orders) AS suggested_num FROM orders WHERE o_totalprice IS NULL
       UNION ALL SELECT 0, (SELECT {MEDIAN.format('o_totalprice')} FROM orders)""")
def same_schema_query(spark, sf):
    # The given file has no gaps: its per-file statistic is shown instead of fills.
    table = fill_same_schema(spark, [f"{sf}/orders.parquet"], "o_orderkey", "o_totalprice", RUN_TS)
    source = spark.read.parquet(f"{sf}/orders.parquet").withColumn("source_file", F.col("_metadata.file_path"))
    stat = I.median_statistic(source, "o_totalprice", ["source_file"])
    return table.ledger.select("row_id", "suggested_num").unionByName(
        stat.select(F.lit(0).cast("bigint").alias("row_id"), round_half_even(F.col("median"), 2).alias("suggested_num")))


@query("choose_numeric", """SELECT CASE WHEN (SELECT COUNT(*) FROM part_m WHERE p_brand IS NOT NULL AND p_type IS NOT NULL AND p_size IS NOT NULL
       AND p_retailprice IS NOT NULL AND p_name IS NOT NULL) >= 3 AND (SELECT COUNT(*) FROM part_m WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL) >= 2
       THEN 'knn' ELSE 'median' END AS method, 'p_size' AS features""", ("part_m",))
def choose_numeric_query(spark, sf):
    choice = I.choose_numeric(read(spark, sf, "part_m"), "p_partkey", "p_retailprice")
    return spark.range(1).select(F.lit(choice.method).alias("method"), F.lit(",".join(choice.features)).alias("features"))


@query("range_guard", f"""
    SELECT row_id, CASE WHEN p < lo - (hi - lo) OR p > hi + (hi - lo) THEN med ELSE p END AS suggested_num,
           CASE WHEN p < lo - (hi - lo) OR p > hi + (hi - lo) THEN 'median_fallback' ELSE 'custom' END AS method,
           CASE WHEN p < lo - (hi - lo) OR p > hi + (hi - lo) THEN 0.6::DOUBLE ELSE 0.8::DOUBLE END AS confidence
    FROM (SELECT o_orderkey AS row_id, CAST(o_custkey * 10000 - 300000 AS DOUBLE) AS p FROM orders_m WHERE o_totalprice IS NULL),
         (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi, {MEDIAN.format('o_totalprice')} AS med FROM orders_m)""", ("orders_m",))
def range_guard_query(spark, sf):
    df = read(spark, sf, "orders_m")
    guesses = I.ledger_rows(
        df.where("o_totalprice IS NULL"), F.col("o_orderkey"), "o_totalprice", num=F.col("o_custkey") * 10000 - 300000,
        confidence=F.lit(0.8), method=F.lit("custom"), reasoning=F.lit("guess"), run_ts=RUN_TS)
    return I.range_guard(guesses, df, "o_totalprice").select("row_id", "suggested_num", "method", "confidence")


GUARDED = f"""
    SELECT row_id, CASE WHEN p < lo - (hi - lo) OR p > hi + (hi - lo) THEN med ELSE p END AS suggested_num,
           CASE WHEN p < lo - (hi - lo) OR p > hi + (hi - lo) THEN 'median_fallback' ELSE 'by_customer' END AS method
    FROM (SELECT o_orderkey AS row_id, CAST(o_custkey * 10000 - 300000 AS DOUBLE) AS p FROM orders_m WHERE o_totalprice IS NULL),
         (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi, {MEDIAN.format('o_totalprice')} AS med FROM orders_m)"""


@query("custom_strategy", GUARDED, ("orders_m",))
def custom_strategy_query(spark, sf):
    """A user's strategy takes the price column; what it predicts outside the plausible range becomes the median."""
    def impute(now, id_col, column, row, run_ts):
        return I.ledger_rows(now.where(F.col(column).isNull()), F.col(id_col), column, num=F.col("o_custkey") * 10000 - 300000,
                             confidence=F.lit(0.8), method=F.lit("by_customer"), reasoning=F.lit("price of the customer"), run_ts=run_ts)

    df = read(spark, sf, "orders_m").select("o_orderkey", "o_custkey", "o_totalprice")
    plan = A.plan_fills(A.profile_columns(df, "o_orderkey"), A.missing_summary(df))
    own = Strategy("by_customer", lambda row: row["column"] == "o_totalprice", impute)
    done = fill_missing(df, "o_orderkey", plan, RUN_TS, strategies=[own])
    filled = done.table.select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("suggested_num"))
    return done.ledger.select("row_id", "method").join(filled, "row_id")


@query("fill_same_schema_gaps", f"""SELECT o_orderkey AS row_id, m.v AS suggested_num FROM orders_m o JOIN
       (SELECT o_orderstatus, {MEDIAN.format('o_totalprice')} AS v FROM orders_m GROUP BY 1) m ON m.o_orderstatus = o.o_orderstatus WHERE o_totalprice IS NULL""", ("orders_m",))
def same_schema_gaps_query(spark, sf):
    """A file per order status, each filled with its own median."""
    path = scratch_path(spark, "statuses")
    orders = read(spark, sf, "orders_m")
    orders.select("o_orderkey", "o_totalprice", "o_orderstatus").repartition(1, "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    return fill_same_schema(spark, [path], "o_orderkey", "o_totalprice", RUN_TS).ledger.select("row_id", "suggested_num")


@query("overlap_pairs", " UNION ALL ".join(f"""
    SELECT '{a}' AS first, '{b}' AS second, COUNT(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS joint_rows,
    COUNT(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) >= 2 AS usable FROM events_m""" for i, a in enumerate(EVENT_COLUMNS)
    for b in EVENT_COLUMNS[i + 1:]), ("events_m",))
def overlap_pairs_query(spark, sf):
    return A.overlap_pairs(read(spark, sf, "events_m"), EVENT_COLUMNS)


@query("fill_sequential", f"""
    , first_fill AS ({knn_sql('part_m', 'p_partkey', 'p_size', ['p_retailprice'])}),
    sized AS (SELECT p_partkey, COALESCE(CAST(p_size AS DOUBLE), f.suggested_num) AS p_size, p_retailprice FROM part_m
              LEFT JOIN first_fill f ON f.row_id = p_partkey)
    SELECT row_id, 'p_size' AS "column", suggested_num, 'knn_imputation' AS method FROM first_fill
    UNION ALL SELECT row_id, 'p_retailprice', suggested_num, 'knn_imputation' FROM ({knn_sql('sized', 'p_partkey', 'p_retailprice', ['p_size'])})""",
       ("part_m",))
def fill_sequential_query(spark, sf):
    df = read(spark, sf, "part_m").select("p_partkey", "p_size", "p_retailprice")
    plan = A.plan_fills(A.profile_columns(df, "p_partkey"), A.missing_summary(df))
    return fill_missing(df, "p_partkey", plan, RUN_TS).ledger.select("row_id", "column", "suggested_num", "method")


@query("fill_independent_median", f"""
    SELECT p_partkey, COALESCE(CAST(p_size AS DOUBLE), (SELECT {MEDIAN.format('p_size')} FROM part_m)) AS p_size,
           COALESCE(p_retailprice, (SELECT {MEDIAN.format('p_retailprice')} FROM part_m)) AS p_retailprice FROM part_m""", ("part_m",))
def fill_independent_query(spark, sf):
    df = read(spark, sf, "part_m").select("p_partkey", "p_size", "p_retailprice")
    plan = A.plan_fills(A.profile_columns(df, "p_partkey"), A.missing_summary(df))
    return fill_missing(df, "p_partkey", plan, RUN_TS, params=FillParams(statistical_method="median"), mode="independent").table


# ---------------------------------------------------------------- text fills

TYPES = ["ECONOMY", "STANDARD", "SMALL", "PROMO", "LARGE", "MEDIUM"]
FORMAT = L.ANSWER_FORMAT.replace("'", "''")
PROMPT = f"""'Missing value of column p_type.' || chr(10) || 'Row: ' || {CONTEXT} || chr(10) || 'Choose one of: {", ".join(TYPES)}' || chr(10) || '{FORMAT}'"""


@query("categorical_prompts", f"""SELECT row_id, 'p_type' AS "column", prompt,
       sha256(prompt || chr(31) || 'offline' || chr(31) || 'mode' || chr(31) || '0.3') AS cache_key
       FROM (SELECT p_partkey AS row_id, {PROMPT} AS prompt FROM part_m WHERE p_type IS NULL)""", ("part_m",))
def categorical_prompts_query(spark, sf):
    return L.categorical_prompts(read(spark, sf, "part_m"), "p_partkey", "p_type", TYPES, PART)


@query("contextual_prompts", """
    SELECT doc_id AS row_id, 'lang' AS "column", sha256('Missing value of column lang.' || chr(10) || 'Row: ' ||
           concat_ws(', ', 'text: ' || text, 'source: ' || source, 'n_chars: ' || CAST(n_chars AS VARCHAR)) || chr(10) ||
           'Hints: domain:x' || chr(10) || 'Examples: ' || (SELECT string_agg(lang, ', ' ORDER BY doc_id) FROM (
               SELECT lang, doc_id FROM documents_m WHERE lang IS NOT NULL ORDER BY doc_id LIMIT 5)) || chr(10) || '""" + FORMAT + """') AS digest
    FROM documents_m WHERE lang IS NULL""", ("documents_m",))
def contextual_prompts_query(spark, sf):
    df = read(spark, sf, "documents_m")
    examples = [r["value"] for r in P.head_values(df, "doc_id", 5, ["lang"]).orderBy("rank").collect()]
    prompts = L.contextual_prompts(df, "doc_id", "lang", ["domain:x"], examples, ["text", "lang", "source", "n_chars"])
    return prompts.select("row_id", "column", F.sha2("prompt", 256).alias("digest"))


@query("distinct_prompts", """SELECT MIN(event_id) AS row_id, COUNT(*) AS cells FROM events_m WHERE event_type IS NULL GROUP BY user_id""", ("events_m",))
def distinct_prompts_query(spark, sf):
    prompts = L.categorical_prompts(read(spark, sf, "events_m"), "event_id", "event_type", ["click", "view"], ["event_type", "user_id"])
    return L.distinct_prompts(prompts).select("row_id", "cells")


FRESH = f"epoch_us({NOW}) - epoch_us(timestamp) <= {{ttl}} * 1000000::BIGINT"
TTL = 29 * 24 * 3600 + 12 * 3600


@query("cache_lookup", f"""SELECT l.row_id, l.cache_key, c.value, c.confidence, c.cache_key IS NOT NULL AS hit FROM lookups l
       LEFT JOIN (SELECT * FROM cache WHERE {FRESH.format(ttl=TTL)}) c ON c.cache_key = l.cache_key""", ("lookups", "cache"))
def cache_lookup_query(spark, sf):
    found = C.cache_lookup(read(spark, sf, "lookups"), read(spark, sf, "cache"), TTL, now())
    return found.select("row_id", "cache_key", "value", "confidence", "hit")


@query("cache_misses", f"""SELECT row_id, cache_key FROM lookups WHERE cache_key NOT IN (SELECT cache_key FROM cache WHERE {FRESH.format(ttl=TTL)})""",
       ("lookups", "cache"))
def cache_misses_query(spark, sf):
    return C.cache_misses(read(spark, sf, "lookups"), read(spark, sf, "cache"), TTL, now()).select("row_id", "cache_key")


@query("cache_upsert", """SELECT cache_key, value, confidence, reasoning FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cache_key
       ORDER BY timestamp DESC, last_access DESC, value DESC, confidence DESC, reasoning DESC) AS rn
       FROM (SELECT * FROM cache UNION ALL SELECT * FROM cache_new)) WHERE rn = 1""", ("cache", "cache_new"))
def cache_upsert_query(spark, sf):
    return C.cache_upsert(read(spark, sf, "cache"), read(spark, sf, "cache_new")).select("cache_key", "value", "confidence", "reasoning")


@query("cache_touch", f"""SELECT cache_key, CASE WHEN cache_key IN (SELECT cache_key FROM lookups) THEN epoch_us({NOW}) ELSE epoch_us(last_access) END AS access_us
       FROM cache""", ("lookups", "cache"))
def cache_touch_query(spark, sf):
    touched = C.cache_touch(read(spark, sf, "cache"), read(spark, sf, "lookups"), now().cast("timestamp_ntz"))
    return touched.select("cache_key", F.unix_micros(F.col("last_access").cast("timestamp")).alias("access_us"))


@query("cache_evict_lru", "SELECT cache_key FROM cache ORDER BY last_access DESC, cache_key LIMIT 100", ("cache",))
def cache_lru_query(spark, sf):
    return C.cache_evict_lru(read(spark, sf, "cache"), 100).select("cache_key")


@query("cache_evict_oldest", """SELECT cache_key FROM (SELECT cache_key, ROW_NUMBER() OVER (ORDER BY timestamp DESC, cache_key) AS r,
       COUNT(*) OVER () AS n FROM cache) WHERE n < 300 OR r <= 200""", ("cache",))
def cache_oldest_query(spark, sf):
    return C.cache_evict_oldest(read(spark, sf, "cache"), 300, 100).select("cache_key")


@query("cache_purge", f"SELECT cache_key FROM cache WHERE {FRESH.format(ttl=TTL)}", ("cache",))
def cache_purge_query(spark, sf):
    return C.cache_purge(read(spark, sf, "cache"), TTL, now()).select("cache_key")


@query("cache_delete", "SELECT cache_key FROM cache WHERE cache_key NOT IN (SELECT cache_key FROM cache_new)", ("cache", "cache_new"))
def cache_delete_query(spark, sf):
    return C.cache_delete(read(spark, sf, "cache"), read(spark, sf, "cache_new")).select("cache_key")


@query("cache_store", """SELECT cache_key, value, confidence, epoch_us(last_access) AS access_us FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cache_key
       ORDER BY timestamp DESC, last_access DESC, value DESC, confidence DESC, reasoning DESC) AS rn
       FROM (SELECT * FROM cache UNION ALL SELECT * FROM cache_new)) WHERE rn = 1 AND cache_key NOT IN (SELECT cache_key FROM cache_new WHERE confidence < 0.8)
       ORDER BY last_access DESC, cache_key LIMIT 200""", ("cache", "cache_new"))
def cache_store_query(spark, sf):
    """A stored cache, written, added to, deleted from, evicted, and read by a second reader."""
    path = scratch_path(spark, "cache-store")
    store = CacheStore(spark, path, buckets=16)
    for name in ("cache", "cache_new"):
        store.upsert(read(spark, sf, name).withColumn("metadata", F.lit(None)))
    store.delete(read(spark, sf, "cache_new").where("confidence < 0.8"))
    store.evict_lru(200)
    store.expire(keep=1)
    return CacheStore(spark, path).read().select("cache_key", "value", "confidence", F.unix_micros("last_access").alias("access_us"))


@query("cache_store_lookup", f"""SELECT l.row_id, l.cache_key, c.value, c.cache_key IS NOT NULL AS hit FROM lookups l
       LEFT JOIN (SELECT * FROM cache WHERE {FRESH.format(ttl=TTL)}) c ON c.cache_key = l.cache_key""", ("lookups", "cache"))
def cache_store_lookup_query(spark, sf):
    store = CacheStore(spark, scratch_path(spark, "cache-store"), buckets=16)
    store.upsert(read(spark, sf, "cache").withColumn("metadata", F.lit(None)))
    return store.lookup(read(spark, sf, "lookups"), TTL, now()).select("row_id", "cache_key", "value", "hit")


@query("cache_stats", f"""SELECT (SELECT COUNT(*) FROM cache) AS size, 1000 AS max_size, 3600 AS ttl_seconds, COUNT(*) AS lookups,
       COUNT(*) FILTER (WHERE cache_key IN (SELECT cache_key FROM cache)) AS hits,
       round(AVG(CASE WHEN cache_key IN (SELECT cache_key FROM cache) THEN 1.0 ELSE 0.0 END), 6) AS hit_rate FROM lookups""", ("lookups", "cache"))
def cache_stats_query(spark, sf):
    cached = read(spark, sf, "cache")
    looked = C.cache_lookup(read(spark, sf, "lookups"), cached, 10**9, now())
    stats = C.cache_stats(cached, 1000, 3600, looked)
    return stats.select("size", "max_size", "ttl_seconds", "lookups", "hits", F.round("hit_rate", 6).alias("hit_rate"))


@query("parse_responses", r"""
    , stripped AS (SELECT cache_key, regexp_replace(response_text, '^\s+|\s+$', '', 'g') AS t FROM responses),
    blocks AS (SELECT cache_key, t, regexp_extract(t, '(?s)\{.*\}') AS strict, regexp_matches(t, '"value":\s*"[^"]*"') AS part,
                      regexp_extract(replace(replace(t, ',}', '}'), '''', '"'), '(?s)\{.*\}') AS fixed,
                      regexp_replace(regexp_replace(t, '["'']', '', 'g'), '^\s+|\s+$', '', 'g') AS clean FROM stripped),
    rungs AS (SELECT *, CASE WHEN json_valid(strict) AND NOT regexp_matches(strict, ',\s*[}\]]') THEN 1 WHEN part THEN 2 WHEN json_valid(fixed) THEN 3 ELSE 4 END AS rung FROM blocks),
    objects AS (SELECT *, CASE rung WHEN 1 THEN strict WHEN 3 THEN fixed ELSE '{}' END AS j FROM rungs),
    fields AS (SELECT *, (rung IN (1, 3) AND json_keys(j) <> []) AS parsed, json_extract_string(j, '$.value') AS jv, json_extract_string(j, '$.confidence') AS jc,
                      json_extract_string(j, '$.reasoning') AS jr, regexp_extract(t, '"confidence":\s*([0-9.]+)', 1) AS rc FROM objects),
    scored AS (SELECT *, CASE WHEN parsed AND jc IS NULL THEN 0.5::DOUBLE WHEN parsed THEN TRY_CAST(jc AS DOUBLE) WHEN rung = 2 AND rc = '' THEN 0.5::DOUBLE
                      WHEN rung = 2 THEN TRY_CAST(rc AS DOUBLE) WHEN length(clean) < 100 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END AS c FROM fields)
    SELECT cache_key, COALESCE(c, 0.1::DOUBLE) AS confidence,
           CASE WHEN c IS NULL THEN 'Error' WHEN parsed THEN COALESCE(jv, 'Unknown') WHEN rung = 2 THEN regexp_extract(t, '"value":\s*"([^"]*)"', 1)
                WHEN length(clean) < 100 THEN clean ELSE 'Parse_Error' END AS value,
           CASE WHEN c IS NULL THEN 'LLM error: confidence is not a number' WHEN parsed THEN COALESCE(jr, 'LLM prediction')
                WHEN rung = 2 AND regexp_matches(t, '"reasoning":\s*"[^"]*"') THEN regexp_extract(t, '"reasoning":\s*"([^"]*)"', 1)
                WHEN rung = 2 THEN 'Partial extraction' WHEN length(clean) < 100 THEN 'Non-JSON response, extracted text'
                ELSE 'Could not parse: ' || left(t, 50) || '...' END AS reasoning
    FROM scored""", ("responses",))
def parse_responses_query(spark, sf):
    return L.parse_responses(read(spark, sf, "responses")).select("cache_key", "confidence", "value", "reasoning")


CHOICE = "CASE " + " ".join(f"WHEN lower(value) = '{t.lower()}' THEN '{t}'" for t in TYPES) + " " + " ".join(
    f"WHEN contains('{t.lower()}', lower(value)) OR contains(lower(value), '{t.lower()}') THEN '{t}'" for t in TYPES) + f" ELSE '{TYPES[0]}' END"


@query("snap_category", f"""SELECT row_id, CASE WHEN known THEN value ELSE {CHOICE} END AS value,
       CASE WHEN known THEN confidence ELSE confidence * 0.8::DOUBLE END AS confidence,
       CASE WHEN known THEN reasoning ELSE reasoning || ' (adjusted to closest valid category)' END AS reasoning
       FROM (SELECT *, value IN ({", ".join(f"'{t}'" for t in TYPES)}) AS known FROM answers)""", ("answers",))
def snap_query(spark, sf):
    return L.snap_category(read(spark, sf, "answers"), TYPES)


NAMES = """, named AS (SELECT p_name AS category, MIN(p_partkey) AS position FROM part GROUP BY p_name),
    said AS (SELECT p_partkey AS row_id, CASE p_partkey % 7 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN concat('a ', p_name, '!')
        WHEN 3 THEN substring(p_name, 3, 6) WHEN 4 THEN substring(p_name, 2, 2) WHEN 5 THEN concat(p_name, p_partkey) ELSE concat('?', p_partkey) END AS value,
        CAST(0.5 AS DOUBLE) AS confidence, 'r' AS reasoning FROM part)"""


@query("snap_to_table", "WITH none AS (SELECT 1)" + NAMES + """,
    best AS (SELECT value, COALESCE(MIN(CASE WHEN lower(value) = lower(category) THEN position END),
                 MIN(CASE WHEN contains(lower(value), lower(category)) OR contains(lower(category), lower(value)) THEN position END),
                 (SELECT MIN(position) FROM named)) AS position, bool_or(value = category) AS known
             FROM (SELECT DISTINCT value FROM said), named GROUP BY value)
    SELECT row_id, CASE WHEN known THEN s.value ELSE category END AS value, CASE WHEN known THEN confidence ELSE confidence * 0.8::DOUBLE END AS confidence,
           CASE WHEN known THEN reasoning ELSE reasoning || ' (adjusted to closest valid category)' END AS reasoning
    FROM said s JOIN best b ON b.value = s.value JOIN named n ON n.position = b.position""")
def snap_to_table_query(spark, sf):
    """All part names as categories; answers that are a name, differ in case, contain one, are part of one, or neither."""
    part = read(spark, sf, "part")
    name, key = F.col("p_name"), F.col("p_partkey")
    said = F.when(key % 7 == 0, name).when(key % 7 == 1, F.upper(name)).when(key % 7 == 2, F.concat(F.lit("a "), name, F.lit("!"))).when(
        key % 7 == 3, F.substring(name, 3, 6)).when(key % 7 == 4, F.substring(name, 2, 2)).when(
        key % 7 == 5, F.concat(name, key.cast("string"))).otherwise(F.concat(F.lit("?"), key.cast("string")))
    answers = part.select(key.alias("row_id"), said.alias("value"), F.lit(0.5).alias("confidence"), F.lit("r").alias("reasoning"))
    return snap_to_table(answers, part.select(key.alias("position"), name.alias("category")))


@query("with_fallback", """SELECT row_id, CASE WHEN value = '' THEN 'ECONOMY' ELSE value END AS value,
       CASE WHEN value = '' THEN 0.3::DOUBLE ELSE confidence END AS confidence, CASE WHEN value = '' THEN 'fallback' ELSE 'llm_categorical' END AS method
       FROM answers""", ("answers",))
def with_fallback_query(spark, sf):
    answers = read(spark, sf, "answers").withColumn("is_text", F.col("value") != "")
    return L.with_fallback(answers, "llm_categorical", TYPES).select("row_id", "value", "confidence", "method")


@query("cap_calls", """SELECT row_id, "column" FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY row_id) AS r FROM (
       SELECT p_partkey AS row_id, 'p_type' AS "column" FROM part_m WHERE p_type IS NULL UNION ALL
       SELECT p_partkey, 'p_brand' FROM part_m WHERE p_brand IS NULL)) WHERE r <= 100""", ("part_m",))
def cap_calls_query(spark, sf):
    df = read(spark, sf, "part_m")
    return L.cap_calls(P.missing_cells(df, "p_partkey", "p_type").unionByName(P.missing_cells(df, "p_partkey", "p_brand")), 100)


MODES = """, votes AS (SELECT p_brand, p_type, COUNT(*) AS c FROM part_m WHERE p_type IS NOT NULL GROUP BY 1, 2),
    grouped AS (SELECT p_brand, p_type, c, total FROM (SELECT *, SUM(c) OVER (PARTITION BY p_brand) AS total,
        ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY c DESC, p_type) AS r FROM votes) WHERE r = 1),
    overall AS (SELECT p_type, c, total FROM (SELECT p_type, SUM(c) AS c, SUM(SUM(c)) OVER () AS total,
        ROW_NUMBER() OVER (ORDER BY SUM(c) DESC, p_type) AS r FROM votes GROUP BY p_type) WHERE r = 1),
    replies AS (SELECT p.p_partkey AS row_id, COALESCE(g.p_type, o.p_type) AS value,
        round_even(CAST(COALESCE(g.c, o.c) AS DOUBLE) / CAST(COALESCE(g.total, o.total) AS DOUBLE) * 100.0, 0) / 100.0 AS confidence
        FROM part_m p LEFT JOIN grouped g ON g.p_brand IS NOT DISTINCT FROM p.p_brand, overall o WHERE p.p_type IS NULL)"""


@query("mode_responder", MODES + " SELECT row_id, value, confidence FROM replies", ("part_m",))
def mode_responder_query(spark, sf):
    df = read(spark, sf, "part_m")
    return S.mode_answers(df, "p_partkey", "p_type", "p_brand", P.missing_cells(df, "p_partkey", "p_type").select("row_id"))


@query("fill_text_offline", MODES + """ SELECT p_partkey, p_brand, COALESCE(p_type, r.value) AS p_type FROM part_m LEFT JOIN replies r ON r.row_id = p_partkey""",
       ("part_m",))
def fill_text_query(spark, sf):
    df = read(spark, sf, "part_m").select("p_partkey", "p_brand", "p_type", "p_name")
    plan = A.plan_fills(A.profile_columns(df, "p_partkey"), A.missing_summary(df)).where("column = 'p_type'")
    # Prompts differ by row: the id takes part in the context here, so that no two cells share an answer.
    keyed = df.withColumn("key_text", F.col("p_partkey").cast("string"))
    responders = {"p_type": S.mode_responder(keyed, "p_partkey", "p_type", "p_brand")}
    return fill_missing(keyed, "p_partkey", plan, RUN_TS, responders).table.select("p_partkey", "p_brand", "p_type")


@query("fill_above_threshold", MODES + """ SELECT row_id, value AS suggested_value, confidence FROM replies WHERE confidence >= 0.25""", ("part_m",))
def fill_above_threshold_query(spark, sf):
    """Only fills that reach the threshold are made."""
    df = read(spark, sf, "part_m").select("p_partkey", "p_brand", "p_type")
    keyed = df.withColumn("key_text", F.col("p_partkey").cast("string"))
    plan = A.plan_fills(A.profile_columns(keyed, "p_partkey"), A.missing_summary(keyed)).where("column = 'p_type'")
    responders = {"p_type": S.mode_responder(keyed, "p_partkey", "p_type", "p_brand")}
    done = fill_missing(keyed, "p_partkey", plan, RUN_TS, responders, FillParams(confidence_threshold=0.25))
    made = done.table.where("p_type IS NOT NULL").select("p_partkey")
    return done.ledger.join(made, F.col("row_id") == F.col("p_partkey")).select("row_id", "suggested_value", "confidence")


# ---------------------------------------------------------------- reports


def completion_sql(before: str, after: str, columns: list[str]) -> str:
    return f"""SELECT b.position, b."column", b.missing_count AS originally_missing, a.missing_count AS still_missing,
        b.missing_count - a.missing_count AS filled_count, {pct('(b.missing_count - a.missing_count)', 'b.missing_count', 1)} AS improvement_percentage
        FROM ({gap_rows(before, columns, 1)}) b JOIN ({gap_rows(after, columns, 1)}) a ON a."column" = b."column" WHERE b.missing_count > 0"""


@query("completion", completion_sql("part_m", "part_f", PART), ("part_m", "part_f"))
def completion_query(spark, sf):
    return R.completion(read(spark, sf, "part_m"), read(spark, sf, "part_f"))


BUCKETS = """COUNT(*) FILTER (WHERE confidence >= 0.8) AS high, COUNT(*) FILTER (WHERE confidence >= 0.6 AND confidence < 0.8) AS medium,
             COUNT(*) FILTER (WHERE confidence < 0.6) AS low"""


@query("confidence_distribution", f"SELECT {BUCKETS} FROM ledger", ("ledger",))
def confidence_query(spark, sf):
    return R.confidence_distribution(ledger(spark, sf))


@query("method_breakdown", "SELECT method, COUNT(*) AS fills FROM ledger GROUP BY method", ("ledger",))
def method_query(spark, sf):
    return R.method_breakdown(ledger(spark, sf))


@query("method_confidence", "SELECT method, COUNT(*) AS fills, round(AVG(confidence), 9) AS average_confidence FROM ledger GROUP BY method", ("ledger",))
def method_confidence_query(spark, sf):
    return R.method_confidence(ledger(spark, sf)).withColumn("average_confidence", F.round("average_confidence", 9))


@query("assess_quality", f"""SELECT round_even(s * 10.0, 0) / 10.0 AS overall_quality_score, {pct('high', 'n', 1)} AS high_confidence_percentage,
       low AS low_confidence_count, errors AS error_count, CASE WHEN s >= 85 THEN 'excellent' WHEN s >= 70 THEN 'good' ELSE 'needs_review' END AS status
       FROM (SELECT *, (high + (n - high - low) * 0.7::DOUBLE) / n * 100 AS s FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE confidence >= 0.8) AS high,
       COUNT(*) FILTER (WHERE confidence < 0.5) AS low, COUNT(*) FILTER (WHERE contains(lower(method), 'error')) AS errors FROM ledger))""", ("ledger",))
def quality_query(spark, sf):
    return R.assess_quality(ledger(spark, sf))


@query("recommendations", f"""
    , done AS ({completion_sql('part_m', 'part_f', PART)}), dist AS (SELECT {BUCKETS} FROM ledger),
    share AS (SELECT low * 100.0::DOUBLE / (high + medium + low) AS s FROM dist),
    said AS (
        SELECT 1 AS o, format('{{:.1f}}', s) || '% of predictions have low confidence - consider manual review' AS recommendation FROM share WHERE s > 25
        UNION ALL SELECT 2, 'High overall confidence - safe for production use with spot checking' FROM share WHERE s < 10
        UNION ALL SELECT 3, 'Consider additional strategies for: ' || string_agg("column", ', ' ORDER BY position) FROM done WHERE improvement_percentage < 100 HAVING COUNT(*) > 0
        UNION ALL SELECT 4, 'Validate a sample of high-confidence predictions against domain expertise')
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY o) - 1 AS INT) AS position, recommendation FROM said""", ("part_m", "part_f", "ledger"))
def recommendations_query(spark, sf):
    done = R.completion(read(spark, sf, "part_m"), read(spark, sf, "part_f"))
    return R.recommendations(done, R.confidence_distribution(ledger(spark, sf)))


@query("run_summary", """SELECT (SELECT COUNT(*) FROM part_m) AS total_rows_processed, COUNT(*) AS total_fields_filled,
       (SELECT string_agg(m, ',' ORDER BY m) FROM (SELECT DISTINCT method AS m FROM ledger)) AS methods FROM ledger""", ("part_m", "ledger"))
def run_summary_query(spark, sf):
    summary = R.run_summary(read(spark, sf, "part_m"), ledger(spark, sf))
    return summary.select("total_rows_processed", "total_fields_filled", F.array_join("processing_methods_used", ",").alias("methods"))


@query("batch_summary", """SELECT COUNT(*) AS total_files, COUNT(*) FILTER (WHERE success) AS successful_files, COUNT(*) FILTER (WHERE NOT success) AS failed_files,
       round(SUM(duration_seconds), 2) AS total_processing_time, round(AVG(duration_seconds), 9) AS average_time_per_file FROM performance""", ("performance",))
def batch_summary_query(spark, sf):
    reports = read(spark, sf, "performance").select("success", F.col("duration_seconds").alias("processing_seconds"))
    return R.batch_summary(reports).withColumn("total_processing_time", F.round("total_processing_time", 2)).withColumn(
        "average_time_per_file", F.round("average_time_per_file", 9))


# ---------------------------------------------------------------- input rules

LIMITS = InputLimits(max_rows=1000, max_columns=4, max_missing_percentage=10.0, min_non_null_values=2)


def gates_sql(table: str, columns: list[tuple[str, str]], limits: InputLimits) -> str:
    n, width = f"(SELECT COUNT(*) FROM {table})", len(columns)
    present = " + ".join(f"COUNT({c})" for c, _ in columns)
    gaps = f"(SELECT (COUNT(*) * {width} - ({present})) * 100.0::DOUBLE / (COUNT(*) * {width}) FROM {table})"
    rows = [
        f"SELECT 'empty' AS rule, NULL AS \"column\", 'error' AS severity, {n} > 0 AS passed, CAST({n} AS DOUBLE) AS measured",
        f"SELECT 'max_rows', NULL, 'error', {n} <= {limits.max_rows}, CAST({n} AS DOUBLE)",
        f"SELECT 'max_columns', NULL, 'error', {width} <= {limits.max_columns}, {width}",
        f"SELECT 'missing_percentage', NULL, 'error', {gaps} <= {limits.max_missing_percentage}, round({gaps}, 6)",
    ]
    for c, kind in columns:
        rows.append(f"SELECT 'empty_column', '{c}', 'error', COUNT({c}) > 0, COUNT({c}) FROM {table}")
        rows.append(f"SELECT 'min_values', '{c}', 'error', NOT (COUNT({c}) > 0 AND COUNT({c}) < 2), COUNT({c}) FROM {table}")
        rows.append(f"SELECT 'constant', '{c}', 'warning', NOT (COUNT({c}) > 1 AND COUNT(DISTINCT {c}) = 1), COUNT({c}) FROM {table}")
        if kind == "t":
            share = f"COUNT(*) FILTER (WHERE regexp_full_match({c}, '-?[0-9]+\\.?[0-9]*'))::DOUBLE / NULLIF(COUNT({c}), 0)"
            rows.append(f"SELECT 'numeric_text', '{c}', 'warning', COALESCE(NOT ({share} > 0.8), TRUE), round({share}, 6) FROM {table}")
    return " UNION ALL ".join(rows)


def gates(df: DataFrame, limits: InputLimits = LIMITS) -> DataFrame:
    return V.gate_rules(df, limits).select("rule", "column", "severity", "passed", F.round("measured", 6).alias("measured"))


@query("gate_rules", gates_sql("customer_m", [("c_custkey", "n"), ("c_name", "t"), ("c_nationkey", "n"), ("c_acctbal", "n"), ("c_mktsegment", "t")], LIMITS),
       ("customer_m",))
def gate_rules_query(spark, sf):
    return gates(read(spark, sf, "customer_m"))


FIXED = """, coded AS (SELECT o_orderkey, 'same' AS fixed, CAST(o_custkey AS VARCHAR) AS digits, CAST(NULL AS VARCHAR) AS nothing,
    CASE WHEN o_orderkey = (SELECT MIN(o_orderkey) FROM orders_m) THEN 'x' END AS lonely FROM orders_m) """


@query("gate_rules_faults", FIXED + gates_sql("coded", [("o_orderkey", "n"), ("fixed", "t"), ("digits", "t"), ("nothing", "t"), ("lonely", "t")], LIMITS), ("orders_m",))
def gate_faults_query(spark, sf):
    df = read(spark, sf, "orders_m")
    least = df.agg(F.min("o_orderkey")).first()[0]
    coded = df.select("o_orderkey", F.lit("same").alias("fixed"), F.col("o_custkey").cast("string").alias("digits"),
                      F.lit(None).cast("string").alias("nothing"), F.when(F.col("o_orderkey") == least, "x").alias("lonely"))
    return gates(coded)


@query("high_cardinality", " UNION ALL ".join(f"""SELECT '{c}' AS "column", NOT (COUNT({c}) > 10 AND COUNT(DISTINCT {c}) * 1.0 / COUNT({c}) > 0.95) AS passed,
       round(COUNT(DISTINCT {c}) * 1.0::DOUBLE / COUNT({c}), 6) AS measured FROM documents_m""" for c in ("text", "lang", "source")), ("documents_m",))
def high_cardinality_query(spark, sf):
    return V.rule_high_cardinality(read(spark, sf, "documents_m")).select("column", "passed", F.round("measured", 6).alias("measured"))


@query("column_names", """SELECT 'awkward_name' AS rule, 'user/id' AS "column", 7.0::DOUBLE AS measured UNION ALL SELECT 'blank_name', '  ', 2 UNION ALL
       SELECT 'duplicate_name', 'event_id', 2 UNION ALL SELECT 'constant', 'event_id#2', COUNT(*) FROM events""")
def column_names_query(spark, sf):
    df = read(spark, sf, "events").select("event_id", "ts", "user_id", F.lit(1).alias("x"), "value", "props")
    named = df.toDF("event_id", "  ", "user/id", "event_id", "va:lue", "props")
    report = V.validate_input(named, InputLimits(max_rows=None))
    return report.where("not passed and rule <> 'high_cardinality'").select("rule", "column", "measured")


@query("column_types", f"""SELECT position, "column", missing_count, {pct('missing_count', 'n', 2)} AS missing_percentage FROM ({gap_rows('customer_m', ['c_custkey', *CUSTOMER])})""",
       ("customer_m",))
def column_types_query(spark, sf):
    return V.column_types(read(spark, sf, "customer_m")).select("position", "column", "missing_count", "missing_percentage")


@query("custom_rule", "SELECT 'positive_price' AS rule, CAST(COUNT(*) FILTER (WHERE NOT COALESCE(o_totalprice > 1000, FALSE)) AS DOUBLE) AS measured, "
       "COUNT(*) FILTER (WHERE NOT COALESCE(o_totalprice > 1000, FALSE)) <= 5 AS passed FROM orders_m", ("orders_m",))
def custom_rule_query(spark, sf):
    rule = V.Rule("positive_price", F.col("o_totalprice") > 1000, limit=5)
    return V.gate_rules(read(spark, sf, "orders_m"), rules=[rule]).where("rule = 'positive_price'").select("rule", "measured", "passed")


@query("validate_input", """SELECT rule, COUNT(*) AS checks, COUNT(*) FILTER (WHERE NOT passed) AS failures FROM (""" + gates_sql(
    "customer_m", [("c_custkey", "n"), ("c_name", "t"), ("c_nationkey", "n"), ("c_acctbal", "n"), ("c_mktsegment", "t")], LIMITS) + """
    UNION ALL SELECT 'high_cardinality', 'c_name', 'warning', NOT (COUNT(c_name) > 10 AND COUNT(DISTINCT c_name) * 1.0 / COUNT(c_name) > 0.95), 0 FROM customer_m
    UNION ALL SELECT 'high_cardinality', 'c_mktsegment', 'warning', NOT (COUNT(c_mktsegment) > 10 AND COUNT(DISTINCT c_mktsegment) * 1.0 / COUNT(c_mktsegment) > 0.95), 0 FROM customer_m)
    GROUP BY rule""", ("customer_m",))
def validate_input_query(spark, sf):
    report = V.validate_input(read(spark, sf, "customer_m"), LIMITS)
    return report.groupBy("rule").agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failures"))


# ---------------------------------------------------------------- output rules

ORPHAN = "row_id NOT IN (SELECT p_partkey FROM part_m)"
COLUMNS = ", ".join(f"'{c}'" for c in ["p_partkey", *PART])


def close(c: str) -> str:
    if c in ("p_size", "p_retailprice"):
        return f"abs(b.{c} - a.{c}) <= 1e-8 + 1e-10 * abs(a.{c})"
    return f"b.{c} = a.{c}"


@query("check_shape", """SELECT b AS rows_before, a AS rows_after, b = a AS passed FROM (SELECT COUNT(*) AS b FROM part_m), (SELECT COUNT(*) AS a FROM part_f)""",
       ("part_m", "part_f"))
def shape_query(spark, sf):
    return O.check_shape(read(spark, sf, "part_m"), read(spark, sf, "part_f")).select("rows_before", "rows_after", "passed")


@query("check_no_new_missing", f"""SELECT b."column", b.missing_count AS missing_before, a.missing_count AS missing_after, a.missing_count <= b.missing_count AS passed
       FROM ({gap_rows('part_m', PART)}) b JOIN ({gap_rows('part_f', PART)}) a ON a."column" = b."column" """, ("part_m", "part_f"))
def new_missing_query(spark, sf):
    return O.check_no_new_missing(read(spark, sf, "part_m"), read(spark, sf, "part_f"), "p_partkey").drop("position")


@query("check_unmodified", " UNION ALL ".join(f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE a.p_partkey IS NOT NULL AND b.{c} IS NOT NULL AND NOT COALESCE({close(c)}, FALSE)) AS modified,
       COUNT(*) FILTER (WHERE a.p_partkey IS NULL) AS only_before FROM part_m b LEFT JOIN part_f a ON a.p_partkey = b.p_partkey""" for c in PART), ("part_m", "part_f"))
def unmodified_query(spark, sf):
    return O.check_unmodified(read(spark, sf, "part_m"), read(spark, sf, "part_f"), "p_partkey").select("column", "modified", "only_before")


@query("check_columns_and_ledger_schema", """SELECT 'columns' AS rule, NULL AS "column", 1 AS violations
       UNION ALL SELECT 'ledger_schema', 'reasoning', 1 UNION ALL SELECT 'ledger_schema', 'timestamp', 1
       UNION ALL SELECT 'shape', NULL, (SELECT COUNT(*) FROM part_m) - (SELECT COUNT(*) FROM part_f)""", ("part_m", "part_f"))
def columns_query(spark, sf):
    after = read(spark, sf, "part_f").withColumnRenamed("p_name", "name")
    report = O.validate_output(read(spark, sf, "part_m"), after, ledger(spark, sf, "ledger_f"), "p_partkey")
    return report.where("rule in ('columns', 'ledger_schema', 'shape')").select("rule", "column", "violations")


@query("check_ledger_rows", f'SELECT row_id, col_name AS "column" FROM ledger_f WHERE {ORPHAN}', ("ledger_f",))
def ledger_rows_query(spark, sf):
    return O.check_ledger_rows(ledger(spark, sf, "ledger_f"), read(spark, sf, "part_m"), "p_partkey")


@query("check_ledger_columns", f'SELECT row_id, col_name AS "column" FROM ledger_f WHERE col_name NOT IN ({COLUMNS})', ("ledger_f",))
def ledger_columns_query(spark, sf):
    return O.check_ledger_columns(ledger(spark, sf, "ledger_f"), read(spark, sf, "part_m"))


@query("check_confidence", 'SELECT row_id, col_name AS "column" FROM ledger_f WHERE NOT COALESCE(confidence BETWEEN 0 AND 1, FALSE)', ("ledger_f",))
def check_confidence_query(spark, sf):
    return O.check_confidence(ledger(spark, sf, "ledger_f")).select("row_id", "column")


WAS_PRESENT = "CASE l.col_name " + " ".join(f"WHEN '{c}' THEN b.{c} IS NOT NULL" for c in PART) + " ELSE FALSE END"


@query("check_was_missing", f"""SELECT l.row_id, l.col_name AS "column" FROM ledger_f l JOIN part_m b ON b.p_partkey = l.row_id WHERE {WAS_PRESENT}""", ("ledger_f", "part_m"))
def was_missing_query(spark, sf):
    return O.check_was_missing(ledger(spark, sf, "ledger_f"), read(spark, sf, "part_m"), "p_partkey")


@query("check_duplicates", 'SELECT row_id, col_name AS "column", COUNT(*) AS times FROM ledger_f GROUP BY 1, 2 HAVING COUNT(*) > 1', ("ledger_f",))
def duplicates_query(spark, sf):
    return O.check_duplicates(ledger(spark, sf, "ledger_f"))


@query("check_quality", " UNION ALL ".join(f"SELECT '{f}' AS field, TRUE AS passed" for f in O.QUALITY_FIELDS))
def check_quality_query(spark, sf):
    return O.check_quality(R.assess_quality(ledger(spark, sf)))


@query("check_quality_faults", """SELECT 'overall_quality_score' AS field, n * 1.0 / 10 BETWEEN 0 AND 100 AS passed FROM (SELECT COUNT(*) AS n FROM ledger)
       UNION ALL SELECT 'high_confidence_percentage', -1.0 >= 0 UNION ALL SELECT 'low_confidence_count', COUNT(*) FILTER (WHERE confidence < 0.5) >= 0 FROM ledger
       UNION ALL SELECT 'error_count', FALSE UNION ALL SELECT 'status', FALSE""", ("ledger",))
def check_quality_faults_query(spark, sf):
    """An assessment with a score that follows the rows, a negative share, no error count and an unknown status."""
    assessed = R.assess_quality(ledger(spark, sf))
    n = ledger(spark, sf).count()
    return O.check_quality(assessed.withColumns({
        "overall_quality_score": F.lit(n / 10), "high_confidence_percentage": F.lit(-1.0), "error_count": F.lit(None).cast("bigint"),
        "status": F.lit("splendid")}))


CELL = "CASE l.col_name " + " ".join(f"WHEN '{c}' THEN CAST(a.{c} AS VARCHAR)" for c in PART) + " END"
OUTCOMES = f"""(SELECT row_id, col_name, expected, actual, CASE WHEN expected IS NULL AND actual IS NULL THEN 'both_missing'
    WHEN expected IS NULL OR actual IS NULL THEN 'missing_mismatch' WHEN expected = actual THEN 'filled' ELSE 'value_mismatch' END AS outcome
    FROM (SELECT l.row_id, l.col_name, l.suggested_value AS expected, {CELL} AS actual FROM ledger_f l JOIN part_f a ON a.p_partkey = l.row_id))"""


@query("check_consistency", f"""SELECT row_id, col_name AS "column", expected, actual, outcome FROM {OUTCOMES} WHERE outcome LIKE '%mismatch'""", ("ledger_f", "part_f"))
def consistency_query(spark, sf):
    return O.check_consistency(read(spark, sf, "part_f"), ledger(spark, sf, "ledger_f"), "p_partkey")


@query("consistency_summary", f"""SELECT COUNT(*) AS compared, COUNT(*) FILTER (WHERE outcome = 'filled') AS filled_count,
       COUNT(*) FILTER (WHERE outcome LIKE '%mismatch') AS issues FROM {OUTCOMES}""", ("ledger_f", "part_f"))
def consistency_summary_query(spark, sf):
    return O.consistency_summary(read(spark, sf, "part_f"), ledger(spark, sf, "ledger_f"), "p_partkey")


FILLS = """SELECT COALESCE(f."column", e.col_name) AS "column", COALESCE(f.filled, 0) AS filled, COALESCE(e.expected, 0) AS expected,
    COALESCE(f.filled, 0) = COALESCE(e.expected, 0) AS passed FROM (""" + " UNION ALL ".join(f"""SELECT '{c}' AS "column",
    COUNT(*) FILTER (WHERE b.{c} IS NULL AND a.{c} IS NOT NULL) AS filled FROM part_m b LEFT JOIN part_f a ON a.p_partkey = b.p_partkey""" for c in PART) + """) f
    FULL OUTER JOIN (SELECT col_name, COUNT(*) AS expected FROM ledger_f GROUP BY 1) e ON e.col_name = f."column" """


@query("fills_per_column", FILLS, ("ledger_f", "part_m", "part_f"))
def fills_query(spark, sf):
    return O.fills_per_column(read(spark, sf, "part_m"), read(spark, sf, "part_f"), ledger(spark, sf, "ledger_f"), "p_partkey")


@query("validate_output", f"""
    SELECT 'duplicate' AS rule, NULL AS "column", (SELECT COUNT(*) FROM (SELECT 1 FROM ledger_x GROUP BY row_id, col_name HAVING COUNT(*) > 1)) AS violations
    UNION ALL SELECT 'ledger_row', NULL, COUNT(*) FILTER (WHERE {ORPHAN}) FROM ledger_x
    UNION ALL SELECT 'ledger_column', NULL, COUNT(*) FILTER (WHERE col_name NOT IN ({COLUMNS})) FROM ledger_x
    UNION ALL SELECT 'confidence', NULL, COUNT(*) FILTER (WHERE NOT COALESCE(confidence BETWEEN 0 AND 1, FALSE)) FROM ledger_x
    UNION ALL SELECT 'was_missing', NULL, COUNT(*) FILTER (WHERE {WAS_PRESENT}) FROM ledger_x l JOIN part_m b ON b.p_partkey = l.row_id
    UNION ALL SELECT 'consistency', NULL, COUNT(*) FILTER (WHERE outcome LIKE '%mismatch') FROM {OUTCOMES}
    UNION ALL SELECT 'shape', NULL, (SELECT COUNT(*) FROM part_m) - (SELECT COUNT(*) FROM part_f)
    UNION ALL SELECT 'columns', NULL, 0
    UNION ALL SELECT 'fill_count', "column", abs(filled - expected) FROM ({FILLS})
    UNION ALL SELECT 'new_missing', b."column", greatest(a.missing_count - b.missing_count, 0) FROM ({gap_rows('part_m', PART)}) b JOIN ({gap_rows('part_f', PART)}) a ON a."column" = b."column"
    UNION ALL """.replace("ledger_x", "ledger_f") + " UNION ALL ".join(f"""SELECT 'modified', '{c}', COUNT(*) FILTER (WHERE a.p_partkey IS NOT NULL AND b.{c} IS NOT NULL AND NOT COALESCE({close(c)}, FALSE))
    FROM part_m b LEFT JOIN part_f a ON a.p_partkey = b.p_partkey""" for c in PART), ("ledger_f", "part_m", "part_f"))
def validate_output_query(spark, sf):
    full = ledger(spark, sf, "ledger_f").withColumn("reasoning", F.lit("r")).withColumn("timestamp", F.lit(RUN_TS))
    return O.validate_output(read(spark, sf, "part_m"), read(spark, sf, "part_f"), full, "p_partkey").select("rule", "column", "violations")


# ---------------------------------------------------------------- metrics

RECENT = f"timestamp >= {NOW} - INTERVAL {HOURS} HOURS"


# Sums of doubles differ in their last bits between engines: sums of cents are compared at two decimals, sums
# of thousandths at four, and averages at nine, where no value of the tables lies halfway between two results.
DIGITS = {"total_duration": 2, "cost": 4}


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.round(c, DIGITS.get(c, 9)).alias(c) if c in names else F.col(c) for c in df.columns])


OPERATIONS = f"""SELECT operation, COUNT(*) AS count, round(AVG(duration_seconds), 9) AS avg_duration, MIN(duration_seconds) AS min_duration,
    MAX(duration_seconds) AS max_duration, round(SUM(duration_seconds), 2) AS total_duration FROM performance WHERE {RECENT} GROUP BY operation"""
API = f"""SELECT provider, COUNT(*) AS calls, CAST(COALESCE(SUM(tokens_used) FILTER (WHERE success), 0) AS BIGINT) AS tokens,
    round(COALESCE(SUM(cost) FILTER (WHERE success), 0), 4) AS cost, COUNT(*) FILTER (WHERE NOT success) AS errors,
    (SELECT round(AVG(CASE WHEN success THEN 100.0 ELSE 0.0 END), 9) FROM api_calls WHERE {RECENT}) AS success_rate FROM api_calls WHERE {RECENT} GROUP BY provider"""
IMPUTATIONS = f"""SELECT method, COUNT(*) AS operations, CAST(SUM(count) AS BIGINT) AS values_filled, round(AVG(average_confidence), 9) AS avg_confidence
    FROM imputations WHERE {RECENT} GROUP BY method"""


@query("operation_summary", OPERATIONS, ("performance",))
def operation_summary_query(spark, sf):
    return rounded(M.operation_summary(read(spark, sf, "performance"), HOURS, now()), "avg_duration", "total_duration")


@query("api_summary", API, ("api_calls",))
def api_summary_query(spark, sf):
    return rounded(M.api_summary(read(spark, sf, "api_calls"), HOURS, now()), "cost", "success_rate")


@query("imputation_summary", IMPUTATIONS, ("imputations",))
def imputation_summary_query(spark, sf):
    return rounded(M.imputation_summary(read(spark, sf, "imputations"), HOURS, now()), "avg_confidence")


@query("counters", """SELECT name, round(SUM(v), 4) AS value FROM (
    SELECT 'operations.' || operation || '.total' AS name, 1.0::DOUBLE AS v FROM performance
    UNION ALL SELECT 'operations.' || operation || '.' || CASE WHEN success THEN 'success' ELSE 'error' END, 1.0 FROM performance
    UNION ALL SELECT 'api.' || provider || '.calls.total', 1.0 FROM api_calls UNION ALL SELECT 'api.' || provider || '.calls.' || model, 1.0 FROM api_calls
    UNION ALL SELECT 'api.' || provider || '.calls.' || CASE WHEN success THEN 'success' ELSE 'error' END, 1.0 FROM api_calls
    UNION ALL SELECT 'api.' || provider || '.tokens.total', tokens_used FROM api_calls WHERE success AND tokens_used <> 0
    UNION ALL SELECT 'api.' || provider || '.cost.total', cost FROM api_calls WHERE success AND cost <> 0
    UNION ALL SELECT 'imputation.' || method || '.total', 1.0 FROM imputations UNION ALL SELECT 'imputation.values_filled.total', count FROM imputations)
    GROUP BY name""", ("performance", "api_calls", "imputations"))
def counters_query(spark, sf):
    return M.counters(read(spark, sf, "performance"), read(spark, sf, "api_calls"),
                              read(spark, sf, "imputations").withColumnRenamed("col_name", "column")).withColumn("value", F.round("value", 4))


@query("newest_metrics", "SELECT event_id FROM performance ORDER BY timestamp DESC, event_id LIMIT 5000", ("performance",))
def newest_query(spark, sf):
    return M.newest_metrics(read(spark, sf, "performance"), "event_id", 5000).select("event_id")


@query("newest_metrics_few", "SELECT event_id FROM performance ORDER BY timestamp DESC, event_id LIMIT 500", ("performance",))
def newest_few_query(spark, sf):
    return M.newest_metrics(read(spark, sf, "performance"), "event_id", 500).select("event_id")


def long_sql(section: str, key: str, inner: str, measures: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, {key} AS key, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({inner})" for m in measures)


@query("metrics_summary", " UNION ALL ".join([
    long_sql("performance", "operation", OPERATIONS, ["count", "avg_duration", "min_duration", "max_duration", "total_duration"]),
    long_sql("api_usage", "provider", API, ["calls", "tokens", "cost", "errors", "success_rate"]),
    long_sql("imputation", "method", IMPUTATIONS, ["operations", "values_filled", "avg_confidence"]),
    long_sql("cache", "'table'", "SELECT COUNT(*) AS size, 1000 AS max_size, 3600 AS ttl_seconds FROM cache", ["size", "max_size", "ttl_seconds"])]),
    ("performance", "api_calls", "imputations", "cache"))
def metrics_summary_query(spark, sf):
    summary = M.metrics_summary(read(spark, sf, "performance"), read(spark, sf, "api_calls"), read(spark, sf, "imputations"),
                                HOURS, now(), C.cache_stats(read(spark, sf, "cache"), 1000, 3600))
    exact = F.when(F.col("measure") == "total_duration", F.round("value", 2)).when(
        F.col("measure") == "cost", F.round("value", 4)).otherwise(F.round("value", 9))
    return summary.withColumn("value", exact)


@query("pair_spans", """SELECT s.operation_id, s.operation, round((epoch_us(e.end_ts) - epoch_us(s.start_ts)) / 1000000.0, 6) AS duration_seconds, e.success, e.error
       FROM span_starts s JOIN span_ends e ON e.operation_id = s.operation_id""", ("span_starts", "span_ends"))
def spans_query(spark, sf):
    return M.pair_spans(read(spark, sf, "span_starts"), read(spark, sf, "span_ends")).select(
        "operation_id", "operation", "duration_seconds", "success", "error")


@query("orphan_ends", "SELECT operation_id, success FROM span_ends WHERE operation_id NOT IN (SELECT operation_id FROM span_starts)", ("span_starts", "span_ends"))
def orphan_query(spark, sf):
    return M.orphan_ends(read(spark, sf, "span_starts"), read(spark, sf, "span_ends")).select("operation_id", "success")


# ---------------------------------------------------------------- files


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer_m", ("customer_m",))
def scan_csv_query(spark, sf):
    """The masked table written as delimited text, its gaps as varying NA tokens, and read back."""
    path = scratch_path(spark, "customer") + ".csv"
    df = read(spark, sf, "customer_m")
    token = F.element_at(F.array(*[F.lit(t) for t in ("NA", "null", "<NA>", "nan", "#N/A")]), (F.col("c_custkey") % 5 + 1).cast("int"))
    gaps = df.select("c_custkey", "c_name", "c_nationkey", *[
        F.coalesce(as_text(df, c), token).alias(c) for c in ("c_acctbal", "c_mktsegment")])
    write_csv(gaps, path)
    return scan_csv(spark, path).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query("check_source", "SELECT TRUE AS ok, COUNT(*) AS rows FROM customer UNION ALL SELECT FALSE, 0")
def check_source_query(spark, sf):
    verdicts = check_source(spark, f"{sf}/customer.parquet").unionByName(check_source(spark, f"{sf}/customer.xyz"))
    rows = scan_parquet(spark, f"{sf}/customer.parquet").agg(F.count(F.lit(1)).alias("n"))
    return verdicts.join(F.broadcast(rows.withColumn("ok", F.lit(True))), "ok", "left").select(
        "ok", F.coalesce("n", F.lit(0)).alias("rows"))


@query("fill_files", """SELECT 0 AS batch_index, TRUE AS success, COUNT(*) AS rows, COUNT(*) FILTER (WHERE c_acctbal IS NULL) AS fills FROM customer_m
       UNION ALL SELECT 1, FALSE, NULL, NULL UNION ALL SELECT 2, TRUE, COUNT(*), 0 FROM supplier""", ("customer_m",))
def fill_files_query(spark, sf):
    """Three files: one with gaps in a numeric and a text column, one that does not exist, one complete."""
    first = scratch_path(spark, "customer") + ".parquet"
    read(spark, sf, "customer_m").select("c_custkey", "c_nationkey", "c_acctbal").write.parquet(first)
    reports, _ = fill_files(spark, [first, f"{sf}/absent.parquet", f"{sf}/supplier.parquet"], scratch_path(spark, "out"), RUN_TS)
    return reports.select("batch_index", "success", "rows", "fills")


NATION_GATE = """gate AS (SELECT c_nationkey, COUNT(*) FILTER (WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL) >= 3 AND COUNT(c_acctbal) >= 2 AS near,
           AVG(c_acctbal) AS mean, median(c_acctbal) AS middle FROM customer_m GROUP BY c_nationkey)"""


@query("fill_files_in_one_chain", f"""
    , {NATION_GATE},
    nearest AS (SELECT c_custkey, AVG(y) AS v FROM (
        SELECT r.c_custkey, d.c_acctbal AS y, ROW_NUMBER() OVER (PARTITION BY r.c_custkey ORDER BY abs(r.c_custkey - d.c_custkey), d.c_custkey) AS rn
        FROM customer_m r JOIN customer_m d ON r.c_nationkey = d.c_nationkey WHERE r.c_acctbal IS NULL AND d.c_acctbal IS NOT NULL)
        WHERE rn <= 3 GROUP BY c_custkey)
    SELECT c.c_nationkey AS batch_index, c.c_custkey, round_even(COALESCE(CASE WHEN near THEN COALESCE(v, mean) ELSE middle END, 0.0) * 100.0, 0) / 100.0 AS suggested_num,
           CASE WHEN near THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END AS confidence,
           CASE WHEN near THEN 'knn_imputation' ELSE 'median_imputation' END AS method
    FROM customer_m c JOIN gate g ON g.c_nationkey = c.c_nationkey LEFT JOIN nearest n ON n.c_custkey = c.c_custkey WHERE c.c_acctbal IS NULL""", ("customer_m",))
def fill_one_chain_query(spark, sf):
    """A file per nation, all filled together, each from its own rows only; the row's place in its file is its id."""
    path = scratch_path(spark, "nations")
    read(spark, sf, "customer_m").repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").write.partitionBy(
        "c_nationkey").parquet(path)
    table = read_batch(spark, [f"{path}/c_nationkey={k}" for k in range(25)])
    result = fill_batch(durable(table), "__row_id", "__file", RUN_TS)
    keys = result.table.select(F.col("__row_id").alias("row_id"), "c_custkey")
    return result.ledger.where(F.col("column") == "c_acctbal").join(keys, "row_id").select(
        F.col("__file").alias("batch_index"), "c_custkey", "suggested_num", "confidence", "method")


@query("profile_by_group", """SELECT c_nationkey, 'c_mktsegment' AS "column", COUNT(*) AS n, COUNT(c_mktsegment) AS present, COUNT(DISTINCT c_mktsegment) AS unique_values,
       COUNT(DISTINCT c_mktsegment) <= LEAST(50.0, COUNT(c_mktsegment) * 0.5) AND COUNT(c_mktsegment) > 0 AS is_categorical,
       array_to_string((list(c_mktsegment ORDER BY c_custkey) FILTER (WHERE c_mktsegment IS NOT NULL))[1:3], '|') AS sample_values FROM customer_m GROUP BY c_nationkey
       UNION ALL SELECT c_nationkey, 'c_acctbal', COUNT(*), COUNT(c_acctbal), COUNT(DISTINCT c_acctbal), FALSE, '' FROM customer_m GROUP BY c_nationkey""", ("customer_m",))
def profile_by_query(spark, sf):
    profile = A.profile_columns_by(read(spark, sf, "customer_m"), "c_custkey", ["c_nationkey"], ["c_mktsegment", "c_acctbal"])
    return profile.select("c_nationkey", "column", "n", "present", "unique_values", "is_categorical",
                          F.when(F.col("is_numeric"), "").otherwise(F.array_join("sample_values", "|")).alias("sample_values"))


@query("scan_csv_quoted", """SELECT c_custkey, c_name || chr(10) || '"' || c_mktsegment || '", ' || c_custkey AS note, c_acctbal FROM customer""")
def scan_csv_quoted_query(spark, sf):
    """Texts with commas, quotes and line breaks, written and read back."""
    path = scratch_path(spark, "quoted") + ".csv"
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", '), F.col("c_custkey").cast("string"))
    write_csv(read(spark, sf, "customer").select("c_custkey", note.alias("note"), "c_acctbal"), path)
    return scan_csv(spark, path)


@query("row_ids", "SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) - 1 AS row_id FROM customer")
def row_ids_query(spark, sf):
    """Rows of a delimited file, read in small blocks, are numbered in the file's order."""
    path = scratch_path(spark, "numbered") + ".csv"
    write_csv(read(spark, sf, "customer").select("c_custkey", "c_name").orderBy("c_custkey").coalesce(1), path)
    blocks = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = row_ids(scan_csv(spark, path, origin=True), "row_id", "file", list_files(spark, [path]))
        return durable(rows.select("c_custkey", "row_id"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", blocks)


@query("process", """SELECT COUNT(*) AS total_rows_processed, COUNT(*) FILTER (WHERE o_totalprice IS NULL) AS total_fields_filled,
       'knn_imputation' AS methods, 100.0::DOUBLE AS overall_quality_score, 'excellent' AS status, 0 AS violations FROM orders_m""", ("orders_m",))
def process_query(spark, sf):
    df = read(spark, sf, "orders_m").select("o_orderkey", "o_custkey", "o_totalprice")
    report = process(df, "o_orderkey", RUN_TS)
    broken = report.output_rules.agg(F.sum("violations").alias("violations")).withColumn("k", F.lit(1))
    return report.summary.withColumn("k", F.lit(1)).join(broken, "k").select(
        "total_rows_processed", "total_fields_filled", F.array_join("processing_methods_used", ",").alias("methods"),
        "overall_quality_score", "status", "violations")


@query("respond", "SELECT sha256('prompt of ' || user_id) AS cache_key, 'asked: prompt of ' || user_id AS response_text, 'ok' AS status FROM events GROUP BY user_id")
def respond_query(spark, sf):
    prompts = read(spark, sf, "events").select(F.concat(F.lit("prompt of "), F.col("user_id")).alias("prompt")).distinct()
    asked = S.respond(prompts.withColumn("cache_key", F.sha2("prompt", 256)), lambda prompt: f" asked: {prompt} ")
    return asked.select("cache_key", "response_text", "status")


@query("respond_resumed", """SELECT sha256('prompt of ' || user_id) AS cache_key, CASE WHEN user_id % 2 = 0 THEN 'first: ' ELSE 'second: ' END || 'prompt of ' || user_id AS response_text,
       'ok' AS status FROM events GROUP BY user_id""")
def respond_resumed_query(spark, sf):
    """A first run in which half of the calls fail; a second one with the same journal asks only those."""
    def first(prompt: str) -> str:
        if int(prompt.rsplit(" ", 1)[1]) % 2:
            raise TimeoutError
        return f"first: {prompt}"

    prompts = read(spark, sf, "events").select(F.concat(F.lit("prompt of "), F.col("user_id")).alias("prompt")).distinct()
    prompts = prompts.withColumn("cache_key", F.sha2("prompt", 256))
    journal, model = scratch_path(spark, "journal"), ModelParams(max_retries=0)
    S.respond(prompts, first, model=model, journal=journal, flush=50)
    again = S.respond(prompts, lambda prompt: f"second: {prompt}", model=model, journal=journal, flush=50)
    return again.select("cache_key", "response_text", "status")


# ---------------------------------------------------------------- streams


def stream_events(spark, sf, *columns: str) -> DataFrame:
    """The events file as a stream, with the same gaps as the masked table."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.selectExpr(*columns)


def drained(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run a stream over everything available into files and read them back."""
    path = scratch_path(spark, name)
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", path + "-state").trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_fill", f"SELECT event_id, COALESCE(value, (SELECT {MEDIAN.format('value')} FROM events_m)) AS value FROM events_m", ("events_m",))
def stream_fill_query(spark, sf):
    frozen = I.median_statistic(read(spark, sf, "events_m"), "value").select(round_half_even(F.col("median"), 2)).first()[0]
    stream = stream_events(spark, sf, "event_id", "CASE WHEN event_id % 10 <> 7 THEN value END AS value")
    return drained(stream_fill(stream, {"value": frozen}), spark, "stream-fill")


@query("stream_fill_by", """SELECT e.event_id, e.user_id, COALESCE(e.value, m.v) AS value FROM events_m e LEFT JOIN
       (SELECT user_id, median(value) AS v FROM events_m WHERE value IS NOT NULL GROUP BY user_id) m ON m.user_id = e.user_id""", ("events_m",))
def stream_fill_by_query(spark, sf):
    stats = I.median_statistic(read(spark, sf, "events_m"), "value", ["user_id"])
    stream = stream_events(spark, sf, "event_id", "user_id", "CASE WHEN event_id % 10 <> 7 THEN value END AS value")
    return drained(stream_fill_by(stream, "value", stats, "user_id", "median"), spark, "stream-fill-by")


WINDOWS = """SELECT epoch_us(w) AS window_us, operation, COUNT(*) AS count, round(AVG(duration_seconds), 9) AS avg_duration, MAX(duration_seconds) AS max_duration
    FROM ({rows}) WHERE w + INTERVAL 1 HOUR <= (SELECT MAX(timestamp) - INTERVAL 1 HOUR FROM performance) GROUP BY w, operation"""


@query("stream_summary", WINDOWS.format(rows="SELECT *, date_trunc('hour', timestamp) AS w FROM performance"), ("performance",))
def stream_summary_query(spark, sf):
    stream = stream_events(spark, sf, "event_type AS operation", "value AS duration_seconds", "ts AS timestamp")
    return windows(drained(stream_summary(stream), spark, "stream-summary"))


@query("stream_summary_sliding", WINDOWS.format(rows="""SELECT *, time_bucket(INTERVAL 15 MINUTES, timestamp) - INTERVAL 15 MINUTES * o AS w
       FROM performance, (SELECT UNNEST([0, 1, 2, 3]) AS o)"""), ("performance",))
def stream_sliding_query(spark, sf):
    stream = stream_events(spark, sf, "event_type AS operation", "value AS duration_seconds", "ts AS timestamp")
    return windows(drained(stream_summary(stream, slide="15 minutes"), spark, "stream-sliding"))


def windows(summary: DataFrame) -> DataFrame:
    return summary.select(F.unix_micros("window_start").alias("window_us"), "operation", "count",
                          F.round("avg_duration", 9).alias("avg_duration"), "max_duration")


@query("stream_distinct_prompts", "SELECT DISTINCT sha256(CONCAT('k', user_id, '_', event_type)) AS cache_key FROM events")
def stream_distinct_query(spark, sf):
    stream = stream_events(spark, sf, "sha2(CONCAT('k', user_id, '_', event_type), 256) AS cache_key", "ts AS timestamp")
    return drained(stream_distinct_prompts(stream), spark, "stream-distinct").select("cache_key")


def in_two_runs(spark, sf, name: str, start) -> None:
    """The events as four files: two are there for a first run of the stream, which ends; the others for a second one, a file a batch."""
    path = scratch_path(spark, name)
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("part", F.col("event_id") % 4)
    for parts in ((0, 1), (2, 3)):
        events.where(F.col("part").isin(*parts)).repartition(2, "part").drop("part").write.mode("append").parquet(path)
        stream = spark.readStream.schema(events.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(path)
        start(stream).start().awaitTermination()


@query("stream_counters", ORACLE["counters"])
def stream_counters_query(spark, sf):
    path = scratch_path(spark, "stream-counters")

    def start(stream):
        derived = {n: spark.sql(DERIVED[n], events=stream) for n in ("performance", "api_calls", "imputations")}
        return stream_counters(M.counter_entries(*derived.values()), f"{path}/counters", f"{path}/state")

    in_two_runs(spark, sf, "stream-counters-in", start)
    return read_latest(spark, f"{path}/counters").withColumn("value", F.round("value", 4))


@query("stream_newest", "SELECT event_id FROM performance ORDER BY timestamp DESC, event_id LIMIT 700", ("performance",))
def stream_newest_query(spark, sf):
    path = scratch_path(spark, "stream-newest")
    in_two_runs(spark, sf, "stream-newest-in", lambda stream: stream_newest(
        spark.sql(DERIVED["performance"], events=stream), f"{path}/newest", f"{path}/state", "event_id", 700))
    return read_latest(spark, f"{path}/newest").select("event_id")


@query("stream_spans", """SELECT COALESCE(s.operation_id, e.operation_id) AS operation_id, s.operation,
       round((epoch_us(e.end_ts) - epoch_us(s.start_ts)) / 1000000.0, 6) AS duration_seconds, e.success, e.error,
       CASE WHEN s.operation_id IS NULL THEN 'orphan' WHEN e.operation_id IS NULL THEN 'open' ELSE 'paired' END AS state
       FROM span_starts s FULL JOIN span_ends e ON e.operation_id = s.operation_id""", ("span_starts", "span_ends"))
def stream_spans_query(spark, sf):
    """Starts and ends as two streams; a last event far ahead lets the watermark pass all others."""
    folders = {}
    for name, ts in (("span_starts", "start_ts"), ("span_ends", "end_ts")):
        folders[name] = scratch_path(spark, name)
        rows = read(spark, sf, name)
        last = rows.agg(F.max(ts).alias(ts)).select((F.col(ts) + F.expr("INTERVAL 10 DAYS")).alias(ts), F.lit("past the end").alias("operation_id"))
        rows.unionByName(last, allowMissingColumns=True).write.parquet(folders[name])
    streams = [spark.readStream.schema(spark.read.parquet(f).schema).parquet(f) for f in folders.values()]
    found = drained(stream_spans(*streams, longest="5 minutes"), spark, "stream-spans")
    return found.where("operation_id <> 'past the end'").select("operation_id", "operation", "duration_seconds", "success", "error", "state")


@query("stream_gate", """SELECT 'good' AS sink, event_id FROM events_m""", ("events_m",))
def stream_gate_query(spark, sf):
    path = scratch_path(spark, "stream-gate")
    stream = stream_events(spark, sf, "event_id", "CASE WHEN event_id % 10 <> 7 THEN value END AS value")
    gate = stream_gate(stream, f"{path}/good", f"{path}/quarantine", f"{path}/verdicts", f"{path}/state", InputLimits(max_rows=None))
    gate.start().awaitTermination()
    return spark.read.parquet(f"{path}/good").select(F.lit("good").alias("sink"), "event_id")


@query("stream_gate_quarantine", """SELECT 'quarantine' AS sink, event_id, 'missing_percentage' AS failed FROM events_m""", ("events_m",))
def stream_quarantine_query(spark, sf):
    path = scratch_path(spark, "stream-quarantine")
    stream = stream_events(spark, sf, "event_id", "CASE WHEN event_id % 10 <> 7 THEN value END AS value")
    limits = InputLimits(max_rows=None, max_missing_percentage=2.0)
    stream_gate(stream, f"{path}/good", f"{path}/quarantine", f"{path}/verdicts", f"{path}/state", limits).start().awaitTermination()
    failed = spark.read.parquet(f"{path}/verdicts").where("severity = 'error' and not passed").select("batch_id", F.col("rule").alias("failed"))
    rows = spark.read.parquet(f"{path}/quarantine")
    return rows.join(F.broadcast(failed), "batch_id").select(F.lit("quarantine").alias("sink"), "event_id", "failed")
