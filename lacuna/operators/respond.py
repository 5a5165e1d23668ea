"""Responders: where answers to prompts come from. No network client is shipped."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import as_text, is_present, ref, round_half_even
from lacuna.functions.durable import durable
from lacuna.functions.joins import attach_unique
from lacuna.params import ModelParams

RESPONSE_SCHEMA = "cache_key string, response_text string, status string, attempts int"

# A responder takes distinct prompts (cache_key, row_id, column, prompt) and returns cache_key, response_text.
Responder = Callable[[DataFrame], DataFrame]


def table_responder(responses: DataFrame) -> Responder:
    """Answers from a table ``cache_key, response_text`` written elsewhere."""
    return lambda prompts: prompts.select("cache_key").join(
        responses.select("cache_key", "response_text"), "cache_key", "left")


JOURNAL_SCHEMA = "cache_key string, response_text string, attempts int"


def respond(misses: DataFrame, ask: Callable[[str], str], concurrency: int = 8, model: ModelParams = ModelParams(),
            journal: str | None = None, flush: int = 1) -> DataFrame:
    """Call ``ask`` once per prompt in ``concurrency`` tasks, with retries; the answers are written out.

    Failed prompts come back with a NULL text and the status ``failed``. The result is durable before
    anyone reads it, so a lost executor after that never repeats a call. With ``journal`` (a folder that executors reach through
    Arrow's file systems), tasks write every ``flush`` answers there while they run: a task that is tried again reads its own
    answers first, and a later call with the same folder asks only what is not in it. So a lost task repeats ``flush`` calls at most. Failed
    prompts are not written, and are asked again by the next call. ``model.requests_per_minute`` is kept by all tasks together.
    """
    spark = misses.sparkSession
    retries, delay = model.max_retries, model.retry_delay
    pause = 60.0 * concurrency / model.requests_per_minute if model.requests_per_minute else 0.0
    wanted = misses.select("cache_key", "prompt")
    known = None
    if journal is not None:
        spark._jvm.org.apache.hadoop.fs.Path(journal).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
            spark._jvm.org.apache.hadoop.fs.Path(journal))
        found = spark.read.schema(JOURNAL_SCHEMA).parquet(journal).dropDuplicates(["cache_key"])
        known = durable(found.join(wanted.select("cache_key"), "cache_key", "left_semi").select(
            "cache_key", "response_text", F.lit("ok").alias("status"), "attempts"))
        wanted = wanted.join(known.select("cache_key"), "cache_key", "left_anti")
        run = uuid.uuid4().hex

    def call(batches):
        import time

        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet
        from pyspark import TaskContext

        task = TaskContext.get()
        place, done, held = None, {}, []
        names = ["cache_key", "response_text", "attempts"]
        if journal is not None:
            files, folder = pyarrow.fs.FileSystem.from_uri(journal) if ":" in journal else (pyarrow.fs.LocalFileSystem(), journal)
            place = f"{folder}/{run}-{task.partitionId()}-"
            if task.attemptNumber():  # what an earlier attempt of this task has been told
                for f in files.get_file_info(pyarrow.fs.FileSelector(folder)):
                    if f.path.rsplit("/", 1)[-1].startswith(f"{run}-{task.partitionId()}-"):
                        for r in pyarrow.parquet.read_table(f.path, filesystem=files).to_pylist():
                            done[r["cache_key"]] = (r["cache_key"], r["response_text"], "ok", r["attempts"])

        def save() -> None:
            """One file per ``flush`` answers, under its name only once it is whole."""
            if held and place is not None:
                name = f"{place}{uuid.uuid4().hex}.parquet"
                hidden = f"{folder}/_{name.rsplit('/', 1)[-1]}"
                columns = list(zip(*((k, t, n) for k, t, _, n in held)))
                pyarrow.parquet.write_table(pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                                      pa.array(columns[2], pa.int32())], names=names), hidden, filesystem=files)
                files.move(hidden, name)
            held.clear()

        due = time.monotonic()
        for batch in batches:
            rows = []
            for key, prompt in zip(batch["cache_key"], batch["prompt"]):
                if key in done:
                    rows.append(done[key])
                    continue
                for attempt in range(retries + 1):
                    if pause:
                        time.sleep(max(0.0, due - time.monotonic()))
                        due = max(due, time.monotonic()) + pause
                    try:
                        rows.append((key, str(ask(prompt)).strip(), "ok", attempt + 1))
                        held.append(rows[-1])
                        if len(held) >= flush:
                            save()
                        break
                    except Exception:
                        if attempt == retries:
                            rows.append((key, None, "failed", attempt + 1))
                        else:
                            time.sleep(delay * 2**attempt)
            save()
            yield pd.DataFrame(rows, columns=["cache_key", "response_text", "status", "attempts"])

    # Dealt by key, so that every attempt of a task has the same prompts.
    spread = wanted.repartition(concurrency, "cache_key")
    answers = spread.mapInPandas(call, schema=RESPONSE_SCHEMA)
    return durable(answers if known is None else answers.unionByName(known))


def function_responder(ask: Callable[[str], str], concurrency: int = 8, model: ModelParams = ModelParams(),
                       journal: str | None = None) -> Responder:
    return lambda prompts: respond(prompts, ask, concurrency, model, journal).select("cache_key", "response_text")


def modes(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent present value of ``column`` per ``by`` key (smallest on ties): ``by, value, votes, total``."""
    votes = df.where(is_present(df, column)).groupBy(
        *[ref(b).alias(b) for b in by], as_text(df, column).alias("value")
    ).agg(F.count(F.lit(1)).alias("votes"))
    best = F.min(F.struct((-F.col("votes")).alias("v"), F.col("value").alias("value")))
    return votes.groupBy(*by).agg(best.alias("b"), F.sum("votes").alias("total")).select(
        *by, F.col("b.value").alias("value"), (-F.col("b.v")).alias("votes"), "total")


def mode_answers(df: DataFrame, id_col: str, column: str, by: str, rows: DataFrame) -> DataFrame:
    """Mode of the row's ``by`` group, else the overall mode, for the ``row_id``s in ``rows``."""
    overall = modes(df, column).first()  # a single row: the fallback of every group without donors
    value, votes, total = (overall["value"], overall["votes"], overall["total"]) if overall else (None, None, None)
    grouped = modes(df, column, [by])
    needed = rows.join(df.select(ref(id_col).alias("row_id"), ref(by).alias(by)), "row_id")
    joined = attach_unique(needed, grouped, [by], weight="total")
    return joined.select(
        *[ref(c) for c in rows.columns],
        F.coalesce("value", F.lit(value).cast("string")).alias("value"),
        round_half_even(
            F.coalesce("votes", F.lit(votes).cast("bigint")) / F.coalesce("total", F.lit(total).cast("bigint")), 2
        ).alias("confidence"),
    )


def mode_responder(df: DataFrame, id_col: str, column: str, by: str) -> Responder:
    """Offline stand-in for a model: answers with the mode among donors that share ``by``."""
    def answer(prompts: DataFrame) -> DataFrame:
        answers = mode_answers(df, id_col, column, by, prompts.select("cache_key", "row_id"))
        reply = F.struct(
            F.coalesce("value", F.lit("Unknown")).alias("value"), "confidence",
            F.lit(f"most frequent value for the same {by}").alias("reasoning"),
        )
        return answers.select("cache_key", F.to_json(reply).alias("response_text"))

    return answer
