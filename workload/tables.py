"""Inputs of the registered queries, as SQL that Spark and DuckDB both read.

The given tables have no gaps, so each masked table opens some by a rule on its key. Everything here is
derived from the given tables and covers all of their rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SOURCES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

DERIVED = {
    "part_m": """
        SELECT p_partkey, p_name, CASE WHEN p_partkey % 6 <> 2 THEN p_brand END AS p_brand,
               CASE WHEN p_partkey % 11 <> 4 THEN p_type END AS p_type,
               CASE WHEN p_partkey % 5 <> 1 THEN p_size END AS p_size,
               CASE WHEN p_partkey % 7 <> 3 THEN p_retailprice END AS p_retailprice
        FROM {part}""",
    "part_knn": """
        SELECT p_partkey, CASE WHEN p_partkey % 5 <> 1 THEN p_size END AS p_size,
               CAST(p_partkey * 7 % 1000 AS INT) AS p_code,
               CASE WHEN p_partkey % 7 <> 3 THEN p_retailprice END AS p_retailprice
        FROM {part}""",
    "customer_m": """
        SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 9 <> 5 THEN c_acctbal END AS c_acctbal,
               CASE WHEN c_custkey % 4 <> 1 THEN c_mktsegment END AS c_mktsegment
        FROM {customer}""",
    "orders_m": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 8 <> 3 THEN o_totalprice END AS o_totalprice, o_orderdate,
               CASE WHEN o_orderkey % 13 <> 6 THEN o_orderpriority END AS o_orderpriority
        FROM {orders}""",
    "events_m": """
        SELECT event_id, ts, user_id, CASE WHEN event_id % 17 <> 2 THEN event_type END AS event_type,
               CASE WHEN event_id % 10 <> 7 THEN value END AS value
        FROM {events}""",
    "documents_m": """
        SELECT doc_id, text, CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang, source,
               CASE WHEN doc_id % 3 <> 1 THEN n_chars END AS n_chars
        FROM {documents}""",
    "lineitem_m": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CASE WHEN (l_orderkey + l_partkey) % 11 <> 0 THEN l_quantity END AS l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
        FROM {lineitem}""",
    # A wide spread of confidences and methods over the missing cells of part.
    "ledger": """
        SELECT p_partkey AS row_id, 'p_retailprice' AS col_name, CAST(1000.5 AS DOUBLE) AS suggested_num,
               '1000.5' AS suggested_value, CAST(p_partkey % 21 AS DOUBLE) / 20.0 AS confidence,
               CASE WHEN p_partkey % 17 = 0 THEN 'median_fallback' ELSE 'knn_imputation' END AS method
        FROM {part_m} WHERE p_retailprice IS NULL
        UNION ALL
        SELECT p_partkey, 'p_size', CAST(25.0 AS DOUBLE), '25.0', CAST(p_partkey % 11 AS DOUBLE) / 10.0, 'median_imputation'
        FROM {part_m} WHERE p_size IS NULL
        UNION ALL
        SELECT p_partkey, 'p_brand', CAST(NULL AS DOUBLE), 'Brand#1', CAST(p_partkey % 5 AS DOUBLE) / 4.0,
               CASE WHEN p_partkey % 19 = 0 THEN 'error_fallback' ELSE 'llm_contextual' END
        FROM {part_m} WHERE p_brand IS NULL""",
    # A filled part table with seeded faults: lost rows, changed values, new gaps, wrong fills.
    "part_f": """
        SELECT p_partkey, p_name, COALESCE(p_brand, 'Brand#1') AS p_brand, p_type,
               CASE WHEN p_partkey % 101 = 5 THEN CAST(p_size AS DOUBLE) + 1.0
                    ELSE COALESCE(CAST(p_size AS DOUBLE), 25.0) END AS p_size,
               CASE WHEN p_partkey % 103 = 7 THEN NULL
                    WHEN p_partkey % 73 = 10 THEN 999.0
                    ELSE COALESCE(p_retailprice, 1000.5) END AS p_retailprice
        FROM {part_m} WHERE p_partkey % 211 <> 9""",
    # The ledger with seeded faults: orphan rows, unknown columns, bad confidences, doubled cells.
    "ledger_f": """
        SELECT CASE WHEN row_id % 89 = 3 THEN row_id + 1000000000000 ELSE row_id END AS row_id,
               CASE WHEN row_id % 83 = 4 THEN 'no_such_column' ELSE col_name END AS col_name,
               suggested_num, suggested_value,
               CASE WHEN row_id % 97 = 8 THEN confidence + 1.5 WHEN row_id % 113 = 8 THEN NULL ELSE confidence END AS confidence,
               method
        FROM {ledger}
        UNION ALL
        SELECT row_id, col_name, suggested_num, suggested_value, confidence, method FROM {ledger} WHERE row_id % 79 = 2
        UNION ALL
        SELECT p_partkey, 'p_name', CAST(NULL AS DOUBLE), p_name, CAST(0.5 AS DOUBLE), 'llm_contextual'
        FROM {part_m} WHERE p_partkey % 71 = 1""",
    "performance": """
        SELECT event_id, event_type AS operation, value AS duration_seconds, ts AS timestamp,
               event_id % 7 <> 0 AS success FROM {events}""",
    "api_calls": """
        SELECT event_id, CONCAT('provider', user_id % 3) AS provider, CONCAT('model', user_id % 5) AS model,
               ts AS timestamp, value AS duration_seconds, event_id % 500 AS tokens_used,
               CAST(event_id % 100 AS DOUBLE) / 1000.0 AS cost, event_id % 11 <> 0 AS success FROM {events}""",
    "imputations": """
        SELECT event_id, CONCAT('column', user_id % 4) AS col_name, event_type AS method, event_id % 50 AS count,
               CAST(event_id % 21 AS DOUBLE) / 20.0 AS average_confidence, ts AS timestamp,
               value AS duration_seconds FROM {events}""",
    "cache": """
        SELECT CONCAT('k', user_id, '_', event_type) AS cache_key, MAX(event_type) AS value,
               CAST(MAX(event_id % 21) AS DOUBLE) / 20.0 AS confidence, 'cached' AS reasoning,
               MIN(ts) AS timestamp, MAX(ts) AS last_access
        FROM {events} GROUP BY user_id, event_type""",
    "cache_new": """
        SELECT CONCAT('k', user_id, '_', event_type) AS cache_key, CONCAT('new_', MAX(event_type)) AS value,
               CAST(0.9 AS DOUBLE) AS confidence, 'fresh' AS reasoning, MAX(ts) AS timestamp, MAX(ts) AS last_access
        FROM {events} WHERE event_type <> 'view' GROUP BY user_id, event_type
        UNION ALL
        SELECT CONCAT('n', user_id) AS cache_key, 'first' AS value, CAST(0.7 AS DOUBLE), 'fresh', MAX(ts), MAX(ts)
        FROM {events} GROUP BY user_id""",
    "lookups": """
        SELECT event_id AS row_id, CONCAT('k', user_id, '_', CASE WHEN event_id % 3 = 0 THEN 'none' ELSE event_type END)
               AS cache_key FROM {events}""",
    "span_starts": """
        SELECT CONCAT('op', event_id) AS operation_id, event_type AS operation, ts AS start_ts
        FROM {events} WHERE event_id % 9 <> 4""",
    "span_ends": """
        SELECT CONCAT('op', event_id) AS operation_id, ts + INTERVAL 90 SECONDS AS end_ts, event_id % 7 <> 0 AS success,
               CASE WHEN event_id % 7 = 0 THEN 'failed' END AS error
        FROM {events} WHERE event_id % 10 <> 3""",
    "responses": """
        SELECT CONCAT('c', conv_id, '_', turn) AS cache_key,
               CASE (conv_id + turn) % 7
                    WHEN 0 THEN CONCAT('{{"value": "', role, '", "confidence": 0.9, "reasoning": "plain"}}')
                    WHEN 1 THEN CONCAT('Sure! {{"value": "', role, '", "confidence": 0.25}} done')
                    WHEN 2 THEN CONCAT('{{"value": "', role, '", "confidence": 0.75,}}')
                    WHEN 3 THEN CONCAT('{{''value'': ''', role, '''}}')
                    WHEN 4 THEN CONCAT('{{"value": "', role, '", "confidence": "high"}}')
                    WHEN 5 THEN '{{}}'
                    ELSE text END AS response_text
        FROM {conversations}""",
    "answers": """
        SELECT p_partkey AS row_id,
               CASE p_partkey % 5 WHEN 0 THEN LOWER(p_type) WHEN 1 THEN CONCAT('very ', p_type) WHEN 2 THEN ''
                    WHEN 3 THEN 'xyz' ELSE p_type END AS value,
               CAST(p_partkey % 5 AS DOUBLE) / 4.0 AS confidence, 'r' AS reasoning
        FROM {part}""",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one derived from them."""
    if name in SOURCES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = DERIVED[name]
    inputs = {n: read(spark, sf_dir, n) for n in dict.fromkeys(re.findall(r"(?<!\{)\{(\w+)\}", text))}
    return spark.sql(text, **inputs)


def with_tables(*names: str) -> str:
    """``WITH ...`` clause that defines the derived tables for the check SQL."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in SOURCES or name in done:
            return
        needs = re.findall(r"(?<!\{)\{(\w+)\}", DERIVED[name])
        for n in needs:
            add(n)
        done[name] = DERIVED[name].format(**{n: n for n in needs})

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in done.items())
