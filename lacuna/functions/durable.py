"""Cut points that outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def _checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only a session that names none (unit tests) gets a scratch folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="lacuna-checkpoint-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet into the session's checkpoint folder and read it from there.

    This cuts the lineage at a table that outlives every executor. Unlike a checkpointed RDD it is
    columnar, so later readers prune columns and know its size when they choose a join.
    """
    path = scratch_path(df.sparkSession, "durable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable_buckets(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Like ``durable``, but in ``buckets`` by the hash of ``column``, so that grouping by it later needs no shuffle.

    Each task writes one file for each bucket it has rows of: meant for a ``column`` with few values in a task. The
    files are in the checkpoint folder; the session's catalog keeps a name for them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "buckets")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).saveAsTable(name)
    return spark.table(name)


def local_table(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """A local relation from a few driver-side rows; through Arrow, so that no tasks are scheduled for it."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    types = [f.dataType for f in schema]
    if any(isinstance(t, (T.TimestampType, T.MapType)) for t in types):
        return spark.createDataFrame(list(rows), schema)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[j] for r in rows], type=f.type) for j, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def small_table(df: DataFrame) -> DataFrame:
    """Materialise control data (rows bounded by the number of columns) as a local relation."""
    return local_table(df.sparkSession, df.collect(), df.schema)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path inside the session's checkpoint folder, which every executor can reach."""
    return f"{_checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
