"""Column profiles, fill planning and the aggregates behind them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.columns import (
    as_text, inline_rows, is_numeric, literal, missing_sql, numeric_columns, percentage, present_sql, quoted, ref, round_half_even,
    scalar_columns, text_sql, value_sql,
)
from lacuna.functions.durable import durable, local_table
from lacuna.functions.ranking import top_n
from lacuna.operators.cells import head_values
from lacuna.params import (
    APPROACHES, BASE_CONFIDENCE, CATEGORICAL, COMPANY_WORDS, CONTEXTUAL, DOMAIN_KEYWORDS, EXPLANATIONS,
    RATING_WORDS, STATISTICAL,
)

LONG_TEXT = 64
MAX_CATEGORIES = 50


def _size_estimate(df: DataFrame) -> float | None:
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return round(int(stats.sizeInBytes().toString()) / 1024**2, 2)
    except Exception:  # no JVM handle (remote session)
        return None


def dataset_profile(df: DataFrame, run_ts: datetime) -> DataFrame:
    """One row: rows, columns, the optimizer's size estimate in MB, run time."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        F.lit(_size_estimate(df)).cast("double").alias("memory_usage_mb"),
        F.lit(run_ts).alias("analysis_timestamp"),
    )


def column_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``position, column, n, missing_count`` for every column from one pass over the table."""
    columns = list(columns) if columns is not None else scalar_columns(df)
    position = {c: i for i, c in enumerate(df.columns)}
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(f"count_if({missing_sql(df, c)}) AS m{j}") for j, c in enumerate(columns)])
    return wide.select("n", inline_rows([
        {"position": str(position[c]), "column": literal(c), "missing_count": f"m{j}"} for j, c in enumerate(columns)
    ])).select("position", "column", "n", "missing_count")


def priority(pct: Column) -> Column:
    return F.when(pct > 70, "HIGH").when(pct > 30, "MEDIUM").otherwise("LOW")


def missing_summary(df: DataFrame, digits: int = 1, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count, percentage and fill priority of every column that has a gap."""
    return _summary(column_counts(df, columns), digits)


def missing_from_counts(profile: DataFrame, rows: int | Column, digits: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """The same from a profile's counts, without reading the table again."""
    n = rows if isinstance(rows, Column) else F.lit(rows)
    return _summary(profile.withColumn("n", n).withColumn("missing_count", F.col("n") - F.col("present")), digits, by)


def _summary(counts: DataFrame, digits: int, by: Sequence[str] = ()) -> DataFrame:
    counts = counts.where(F.col("missing_count") > 0)
    raw = F.col("missing_count") / F.col("n") * 100.0
    return counts.select(
        *by, "position", "column", "missing_count",
        percentage(F.col("missing_count"), F.col("n"), digits).alias("missing_percentage"),
        priority(raw).alias("priority"),
    )


def text_key_sql(df: DataFrame, name: str) -> str:
    """Grouping key of a text: itself, or a digest so that long texts are not shuffled."""
    text = text_sql(df, name)
    return f"CASE WHEN length({text}) > {LONG_TEXT} THEN concat('#', sha2({text}, 256)) ELSE {text} END"


def _value_key(df: DataFrame, name: str) -> dict[str, str]:
    """Grouping key of any value as ``whole, real, value_key``; numbers are never turned into text."""
    kind = df.schema[name].dataType
    key = {"whole": "CAST(NULL AS BIGINT)", "real": "CAST(NULL AS DOUBLE)", "value_key": "CAST(NULL AS STRING)"}
    if isinstance(kind, T.IntegralType):
        key["whole"] = f"CAST({quoted(name)} AS BIGINT)"
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        key["real"] = f"CAST({value_sql(df, name)} AS DOUBLE)"
    elif is_numeric(df, name):
        key["value_key"] = f"CAST({quoted(name)} AS STRING)"
    else:
        key["value_key"] = text_key_sql(df, name)
    return key


def column_values(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """Distinct values of all ``columns``: ``position, whole, real, value_key, seen``; one shuffle.

    ``seen`` holds one struct: ``n`` counts the value, ``first_id`` is where a text occurs first
    (categories are listed by it). Inside an array the optimizer cannot prune either of them, so all
    readers share one scan and one shuffle instead of repeating them for fewer columns.
    """
    position = {c: i for i, c in enumerate(df.columns)}
    names = ("whole", "real", "value_key")
    cells = inline_rows([{"position": str(position[c]), **_value_key(df, c)} for c in columns])
    long = df.select(ref(id_col).alias("id"), cells).where("whole IS NOT NULL OR real IS NOT NULL OR value_key IS NOT NULL")
    return long.groupBy("position", *names).agg(F.expr(
        "array(named_struct('n', count(1), 'first_id', min(CASE WHEN value_key IS NOT NULL THEN id END))) AS seen"))


def distinct_counts(df: DataFrame, id_col: str, columns: Sequence[str] | None = None,
                    approx: bool = False) -> DataFrame:
    """``position, column, present, unique_values``; exact unless ``approx``."""
    columns = list(columns) if columns is not None else scalar_columns(df, exclude=[id_col])
    position = {c: i for i, c in enumerate(df.columns)}
    names = F.create_map(*[x for c in columns for x in (F.lit(position[c]), F.lit(c))])
    if approx:
        wide = df.agg(*[F.expr(f"count({value_sql(df, c)}) AS n{j}") for j, c in enumerate(columns)], *[
            F.expr(f"approx_count_distinct({value_sql(df, c)}, 0.02D) AS u{j}") for j, c in enumerate(columns)])
        return wide.select(inline_rows([
            {"position": str(position[c]), "column": literal(c), "present": f"n{j}", "unique_values": f"u{j}"}
            for j, c in enumerate(columns)
        ]))
    values = column_values(df, id_col, columns)
    return values.groupBy("position").agg(
        F.expr("sum(element_at(seen, 1).n)").alias("present"), F.count(F.lit(1)).alias("unique_values")
    ).select("position", F.element_at(names, F.col("position")).alias("column"), "present", "unique_values")


def profile_columns(df: DataFrame, id_col: str, columns: Sequence[str] | None = None,
                    approx: bool = False) -> DataFrame:
    """One row per column with type, cardinality, samples, categories and hints.

    Jobs are fixed in number whatever the width: counts and distinct values, head rows, and - only
    when a categorical column holds long texts - one read of the rows its categories come from.
    With ``approx`` columns of clearly high cardinality are counted by sketch and only the rest
    exactly. The result is control data (one row per column) and comes back as a local relation.
    """
    spark = df.sparkSession
    columns = list(columns) if columns is not None else scalar_columns(df, exclude=[id_col])
    exact = columns
    stats: dict[str, tuple[int, int]] = {c: (0, 0) for c in columns}
    if approx:
        for row in distinct_counts(df, id_col, columns, approx=True).collect():
            stats[row["column"]] = (row["present"], row["unique_values"])
        exact = [c for c in columns if stats[c][1] <= 4 * MAX_CATEGORIES]

    categories: dict[str, list[str]] = {}
    position = {c: i for i, c in enumerate(df.columns)}
    text_positions = [position[c] for c in columns if not is_numeric(df, c)]
    if exact:
        values = column_values(df, id_col, exact)
        per_column = values.groupBy("position").agg(F.expr("sum(element_at(seen, 1).n)").alias("present"), F.count(F.lit(1)).alias("u"))
        small = per_column.where(
            F.col("position").isin(text_positions)
            & (F.col("u") <= F.least(F.lit(float(MAX_CATEGORIES)), F.col("present") * 0.5))
        ).select("position")
        # At most one row per column, and at most MAX_CATEGORIES values for each of them.
        lists = values.join(F.broadcast(small), "position").groupBy("position").agg(
            F.array_sort(F.collect_list(F.struct(F.expr("element_at(seen, 1).first_id AS first_id"), "value_key"))).alias("categories")
        )
        for row in per_column.join(lists, "position", "left").collect():
            name = df.columns[row["position"]]
            stats[name] = (row["present"], row["u"])
            if row["categories"] is not None:
                categories[name] = [(c["first_id"], c["value_key"]) for c in row["categories"]]

    hashed = {c: [i for i, v in vs if v.startswith("#") and len(v) == LONG_TEXT + 1] for c, vs in categories.items()}
    wanted = sorted({i for ids in hashed.values() for i in ids})
    if wanted:
        names = [c for c, ids in hashed.items() if ids]
        rows = df.where(ref(id_col).isin(wanted)).select(
            ref(id_col).alias("i"), *[as_text(df, c).alias(f"v{j}") for j, c in enumerate(names)]
        ).collect()
        full = {(c, r["i"]): r[f"v{j}"] for r in rows for j, c in enumerate(names)}
        for c in names:
            categories[c] = [(i, full[c, i] if i in hashed[c] else v) for i, v in categories[c]]

    present = {c: stats[c][0] for c in columns}
    heads: dict[str, list[str]] = {c: [] for c in columns}
    for row in head_values(df, id_col, 10, columns, present).orderBy("position", "rank").collect():
        heads[row["column"]].append(row["value"])

    local = local_table(
        spark,
        [(position[c], c, df.schema[c].dataType.simpleString(), stats[c][0], stats[c][1], heads[c],
          is_numeric(df, c), [v for _, v in categories[c]] if c in categories else None) for c in columns],
        T.StructType([
            T.StructField("position", T.IntegerType()), T.StructField("column", T.StringType()),
            T.StructField("data_type", T.StringType()), T.StructField("present", T.LongType()),
            T.StructField("unique_values", T.LongType()), T.StructField("head", T.ArrayType(T.StringType())),
            T.StructField("is_numeric", T.BooleanType()), T.StructField("categories", T.ArrayType(T.StringType())),
        ]),
    )
    hints = F.when((F.col("present") > 0) & ~F.col("is_numeric"),
                   domain_hints(F.col("column"), F.col("head"), F.col("unique_values")))
    return local.select(
        "position", "column", "data_type", "present", "unique_values",
        F.slice("head", 1, 3).alias("sample_values"),
        "is_numeric",
        F.col("categories").isNotNull().alias("is_categorical"),
        "categories",
        F.coalesce(hints, F.array().cast("array<string>")).alias("domain_hints"),
    ).withColumn("has_patterns", F.size("domain_hints") > 0)


class ProfileState(NamedTuple):
    """What a profile is made of, in a form that can be added up: tables with a row per group, value and head value.

    ``counts``: ``by``, n. ``values``: ``by``, position, whole, real, value_key, times, first_id, text (of long texts in short lists).
    ``heads``: ``by``, position, id, value of the first ten values. ``fields``: position, column, data_type, is_numeric of each column.
    """

    counts: DataFrame
    values: DataFrame
    heads: DataFrame
    by: list[str]
    fields: list[tuple[int, str, str, bool]]

    def save(self, path: str) -> None:
        """Three tables and the columns below ``path``."""
        for name in ("counts", "values", "heads"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        spark = self.counts.sparkSession
        head = local_table(spark, [(*f, ",".join(map(quoted, self.by))) for f in self.fields],
                           "position int, column string, data_type string, is_numeric boolean, by string")
        head.coalesce(1).write.mode("overwrite").parquet(f"{path}/fields")


def load_state(spark: SparkSession, path: str) -> ProfileState:
    rows = sorted(spark.read.parquet(f"{path}/fields").collect())
    tables = [spark.read.parquet(f"{path}/{name}") for name in ("counts", "values", "heads")]
    return ProfileState(*tables, [c for c in tables[0].columns if c != "n"], [tuple(r)[:4] for r in rows])


def profile_state(df: DataFrame, id_col: str, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> ProfileState:
    """The state of ``df``, of each ``by`` group apart; ``id_col`` is unique over all groups, and over all tables whose states will be merged."""
    columns = list(columns) if columns is not None else scalar_columns(df, exclude=[id_col, *by])
    position = {c: i for i, c in enumerate(df.columns)}
    texts = [position[c] for c in columns if not is_numeric(df, c)]
    keys = [ref(b).alias(b) for b in by]
    group = [*by, "position"]
    some = "whole IS NOT NULL OR real IS NOT NULL OR value_key IS NOT NULL"
    cells = df.select(*keys, ref(id_col).alias("id"), inline_rows([{"position": str(position[c]), **_value_key(df, c)} for c in columns]))
    values = durable(cells.where(some).groupBy(*group, "whole", "real", "value_key").agg(
        F.count(F.lit(1)).alias("times"), F.min("id").alias("first_id")))
    heads = top_n(cells.where(some).select(*group, "id"), group, [F.col("id").asc()], 10, salt=F.col("id"))
    # Lists only get longer, so a column with a long one here needs no texts of it. Texts are read only where a list shows them.
    short = values.where(F.col("position").isin(texts)).groupBy(*group).agg(F.count(F.lit(1)).alias("u")).where(F.col("u") <= MAX_CATEGORIES)
    hashed = F.col("value_key").startswith("#") & (F.length("value_key") == LONG_TEXT + 1)
    listed = values.where(hashed).join(short.select(*group), group, "left_semi").select(*group, F.col("first_id").alias("id"))
    shown = durable(heads.select(*group, "id", F.lit(True).alias("head")).unionByName(listed.withColumn("head", F.lit(False))))
    rows = df.join(shown.select(F.col("id").alias("__id")).distinct(), ref(id_col) == F.col("__id"), "left_semi").select(
        ref(id_col).alias("id"), inline_rows([{"position": str(position[c]), "value": text_sql(df, c)} for c in columns]))
    shown = durable(shown.join(rows, ["id", "position"]))
    long = shown.where(~F.col("head")).select(*group, F.col("id").alias("first_id"), F.col("value").alias("text"))
    return ProfileState(
        durable(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))), values.join(long, [*group, "first_id"], "left"),
        shown.where("head").select(*group, "id", "value"), list(by),
        [(position[c], c, df.schema[c].dataType.simpleString(), is_numeric(df, c)) for c in columns])


def merge_states(one: ProfileState, other: ProfileState) -> ProfileState:
    """The state of both tables together; neither is read again, only their states are."""
    if (one.by, one.fields) != (other.by, other.fields):
        raise ValueError("states of different columns")
    group = [*one.by, "position"]
    counts = one.counts.unionByName(other.counts).groupBy(*one.by).agg(F.sum("n").alias("n"))
    values = one.values.unionByName(other.values).groupBy(*group, "whole", "real", "value_key").agg(
        F.sum("times").alias("times"), F.min("first_id").alias("first_id"), F.min_by("text", "first_id").alias("text"))
    heads = top_n(one.heads.unionByName(other.heads), group, [F.col("id").asc()], 10)
    return ProfileState(durable(counts), durable(values), durable(heads), one.by, one.fields)


def profile_from_state(state: ProfileState) -> DataFrame:
    """The profile as a table: ``by``, n (rows of the group), the columns of :func:`profile_columns`, and examples (first five values)."""
    by, group = state.by, [*state.by, "position"]
    counts = state.values.groupBy(*group).agg(F.sum("times").alias("present"), F.count(F.lit(1)).alias("unique_values"))
    every = state.counts.select(*by, "n", inline_rows([
        {"position": str(i), "column": literal(c), "data_type": literal(kind), "is_numeric": str(numeric).lower()}
        for i, c, kind, numeric in state.fields]))
    stats = durable(every.join(counts, group, "left").withColumns({
        "present": F.coalesce("present", F.lit(0)), "unique_values": F.coalesce("unique_values", F.lit(0))}))
    categorical = ~F.col("is_numeric") & (F.col("present") > 0) & (
        F.col("unique_values") <= F.least(F.lit(float(MAX_CATEGORIES)), F.col("present") * 0.5))
    listed = state.values.join(stats.where(categorical).select(*group), group, "left_semi").select(
        *group, F.col("first_id").alias("id"), F.coalesce("text", "value_key").alias("value"))

    def lists(rows: DataFrame, name: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("id", "value")))  # ten, or at most MAX_CATEGORIES
        return rows.groupBy(*group).agg(F.transform(ordered, lambda x: x["value"]).alias(name))

    profile = stats.join(lists(state.heads, "head"), group, "left").join(lists(listed, "categories"), group, "left").withColumns({
        "head": F.coalesce("head", F.array().cast("array<string>")), "is_categorical": categorical})
    hints = F.when((F.col("present") > 0) & ~F.col("is_numeric"), domain_hints(F.col("column"), F.col("head"), F.col("unique_values")))
    return profile.select(
        *by, "n", "position", "column", "data_type", "present", "unique_values", F.slice("head", 1, 3).alias("sample_values"), "is_numeric",
        "is_categorical", F.when(F.col("is_categorical"), F.col("categories")).alias("categories"),
        F.coalesce(hints, F.array().cast("array<string>")).alias("domain_hints"), F.slice("head", 1, 5).alias("examples"),
    ).withColumn("has_patterns", F.size("domain_hints") > 0)


def profile_columns_by(df: DataFrame, id_col: str, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """:func:`profile_columns` of every ``by`` group in the same few jobs, as a table: ``by``, n (rows of the group) and the profile's columns.

    Nothing of it goes through the driver, so the number of groups does not matter. ``id_col`` is unique over all groups.
    """
    return profile_from_state(profile_state(df, id_col, by, columns))


def domain_hints(name: Column, head: Column, unique_values: Column) -> Column:
    """Hints from the column name (any number) and from its first ten values (at most one)."""
    lowered = F.lower(name)

    def any_word(text: Column, words: Sequence[str]) -> Column:
        return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))

    from_name = [
        F.when(any_word(lowered, words), F.lit(f"domain:{domain}")) for domain, words in DOMAIN_KEYWORDS.items()
    ]
    text = F.lower(F.array_join(head, " "))
    from_values = (
        F.when(any_word(text, COMPANY_WORDS), "pattern:company_names")
        .when(any_word(text, RATING_WORDS), "pattern:ratings_levels")
        .when(unique_values <= 10, "pattern:limited_categories")
    )
    return F.array_compact(F.array(*from_name, from_values))


def plan_fills(profile: DataFrame, summary: DataFrame, threshold: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """One row per gappy column, of each ``by`` key: fill method, base confidence, time estimate."""
    gaps = summary.select(*by, "column", "missing_count", "missing_percentage", "priority")
    method = (
        F.when(F.col("is_numeric"), STATISTICAL)
        .when(F.col("is_categorical") & (F.size("categories") <= threshold), CATEGORICAL)
        .otherwise(CONTEXTUAL)
    )

    def by_method(values: dict) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("method"))

    joined = profile.join(gaps, [*by, "column"]).withColumn("method", method)
    return joined.select(
        *by, "position", "column", "method",
        by_method(APPROACHES).alias("approach"),
        by_method(BASE_CONFIDENCE).alias("confidence_base"),
        by_method(EXPLANATIONS).alias("explanation"),
        F.when(F.col("method") == CATEGORICAL, F.col("categories")).alias("categories"),
        F.when(F.col("method") == CONTEXTUAL, F.col("domain_hints")).alias("domain_hints"),
        "missing_count", "missing_percentage", "priority",
        minutes(F.col("is_numeric"), F.col("is_categorical"), F.col("missing_count")).alias("estimated_time_minutes"),
    )


def minutes(numeric: Column, categorical: Column, missing: Column) -> Column:
    return F.when(numeric, 0.1).when(categorical, missing * 0.05).otherwise(missing * 0.2)


def estimate_time(plan: DataFrame) -> DataFrame:
    """Total minutes over all planned columns and their wording."""
    total = F.coalesce(F.sum("estimated_time_minutes"), F.lit(0.0))
    whole = F.floor("total_minutes").cast("string")
    text = (
        F.when(F.col("total_minutes") < 2, "< 2 minutes")
        .when(F.col("total_minutes") < 10, F.concat(F.lit("~"), whole, F.lit(" minutes")))
        .otherwise(F.concat(F.lit("~"), whole, F.lit(" minutes (consider batch processing)")))
    )
    return plan.agg(total.alias("total_minutes")).withColumn("estimated_total_time", text)


def complexity(plan: DataFrame) -> DataFrame:
    weight = F.when(F.col("method") == CONTEXTUAL, 0.1).when(F.col("method") == STATISTICAL, 0.01).otherwise(0.0)
    total = F.coalesce(F.sum(F.col("missing_count") * weight), F.lit(0.0))
    return plan.agg(round_half_even(total, 1).alias("complexity_score"))


def feature_overlap(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """``feature, joint_rows, usable``: rows where target and feature are both present; usable from two."""
    wide = df.agg(*[
        F.expr(f"count_if({present_sql(df, target)} AND {present_sql(df, f)}) AS j{i}") for i, f in enumerate(features)])
    return wide.select(inline_rows([
        {"feature": literal(f), "joint_rows": f"j{i}", "usable": f"j{i} >= 2"} for i, f in enumerate(features)]))


def overlap_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``first, second, joint_rows, usable`` for every pair of ``columns`` (numeric ones unless named), in table order; usable from two rows.

    One scan: rows are counted by which columns they have, packed into whole numbers, and each such pattern adds to all
    its pairs at once. A task holds one number per pair and a batch of patterns.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    size, width = len(columns), 62
    packs = [columns[at:at + width] for at in range(0, size, width)]
    masks = [F.expr(" + ".join(f"IF({present_sql(df, c)}, {1 << j}L, 0L)" for j, c in enumerate(pack)) + f" AS m{i}")
             for i, pack in enumerate(packs)]
    patterns = df.select(*masks).groupBy(*[f"m{i}" for i in range(len(packs))]).agg(F.count(F.lit(1)).alias("n"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), np.int64)
        for batch in batches:
            has = np.concatenate([(batch.column(i).to_numpy()[:, None] >> np.arange(len(pack)) & 1).astype(np.float64)
                                  for i, pack in enumerate(packs)], axis=1)
            # Doubles are exact for whole numbers below 2^53; the two halves of a count stay below it.
            n = batch.column(len(packs)).to_numpy()
            for part, scale in ((n & 0xFFFFFF, 1), (n >> 24, 1 << 24)):
                total += ((has * part[:, None]).T @ has).astype(np.int64) * scale
        first, second = np.triu_indices(size, 1)
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(total[first, second])],
                                         names=["i", "j", "n"])

    if size < 2:
        return local_table(df.sparkSession, [], "first string, second string, joint_rows bigint, usable boolean")
    sums = patterns.mapInArrow(add, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("joint_rows"))
    pairs = local_table(df.sparkSession, [(i, j, columns[i], columns[j]) for i in range(size) for j in range(i + 1, size)],
                        "i int, j int, first string, second string")
    return pairs.join(sums, ["i", "j"], "left").select(
        "first", "second", F.coalesce("joint_rows", F.lit(0)).alias("joint_rows"), (F.coalesce("joint_rows", F.lit(0)) >= 2).alias("usable"))
