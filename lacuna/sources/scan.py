"""Reading tables: format gate, delimited text with NA tokens, parquet."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable, local_table
from lacuna.functions.joins import attach_unique
from lacuna.params import NA_TOKENS, InputLimits

CANDIDATE_TYPES = (("boolean", T.BooleanType()), ("bigint", T.LongType()), ("double", T.DoubleType()))
BOOLEAN_WORDS = ("True", "TRUE", "true", "False", "FALSE", "false")


def check_source(spark: SparkSession, path: str, allowed: Sequence[str] = InputLimits().allowed_file_types) -> DataFrame:
    """One row per path: ``path, ok, reason``. Looks at names and sizes only, never at content."""
    suffix = "." + path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    try:
        listed = spark.read.format("binaryFile").load(path).select("path", "length").limit(2).collect()
        found = len(listed)
        is_file = found == 1 and listed[0]["path"].rsplit("/", 1)[-1] == path.rstrip("/").rsplit("/", 1)[-1]
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        found, is_file = 0, False
    if not found:
        verdict = (False, "path does not exist or is empty")
    elif suffix not in allowed:
        verdict = (False, f"file type {suffix or '(none)'} is not one of {', '.join(allowed)}")
    elif not is_file and suffix == ".csv":
        verdict = (True, "directory of part files")
    else:
        verdict = (True, "")
    return local_table(spark, [(path, *verdict)], "path string, ok boolean, reason string")


def na_to_null(value: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~value.isin(*tokens), value)


def _fits(value: Column, name: str) -> Column:
    if name == "boolean":
        return value.isin(*BOOLEAN_WORDS)
    return F.trim(value).try_cast(name).isNotNull()


def infer_types(texts: DataFrame) -> dict[str, T.DataType]:
    """Narrowest of boolean, bigint, double, string that fits all present values; one aggregate pass."""
    row = texts.agg(*[
        F.bool_and(F.when(ref(c).isNotNull(), _fits(ref(c), name))).alias(f"{name}{j}")
        for j, c in enumerate(texts.columns) for name, _ in CANDIDATE_TYPES
    ]).first()
    chosen = {}
    for j, c in enumerate(texts.columns):
        fitting = [kind for name, kind in CANDIDATE_TYPES if row[f"{name}{j}"]]
        # A column without any present value is numeric, as an all-missing column is elsewhere.
        chosen[c] = T.DoubleType() if row[f"boolean{j}"] is None else (fitting[0] if fitting else T.StringType())
    return chosen


def _csv_texts(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None) -> DataFrame:
    """All columns as text, each record whole. A record that goes over several lines shows as a line with an odd number of quotes;
    files with such lines are read file by file, all others in splits."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema]))
    paths = list(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = {r[0] for r in spark.read.text(paths).where(quotes % 2 == 1).select(_file().alias("file")).distinct().collect()}
    split = reader.csv(paths)
    if not odd:
        return split.withColumn(ORIGIN, _origin())
    names = [f for _, f in list_files(spark, paths)]
    rest = [f for f in names if _uri(spark, f) not in odd]
    whole = reader.option("multiLine", True).csv([f for f in names if _uri(spark, f) in odd]).withColumn(ORIGIN, _origin())
    if not rest:
        return whole
    return reader.option("multiLine", False).csv(rest).withColumn(ORIGIN, _origin()).unionByName(whole)


ORIGIN = "__origin"


def _file() -> Column:
    """The file a row is read from, as :func:`_uri` writes it."""
    return F.regexp_replace("_metadata.file_path", "^(\\w+):///", "$1:/")


def _uri(spark: SparkSession, name: str) -> str:
    uri = spark._jvm.org.apache.hadoop.fs.Path(name).toUri().toString()
    return re.sub(r"^(\w+):///", r"\1:/", uri)


def _origin() -> Column:
    """Where a row was read: file, start of the block, and a number that rises within the block."""
    return F.struct(_file().alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"))


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             na_tokens: Sequence[str] = NA_TOKENS, origin: bool = False) -> DataFrame:
    """Delimited text with a header; NA tokens become NULL before types are chosen.

    Quoted values may hold commas, doubled quotes and line breaks. With ``origin`` rows keep where they were read, for ``row_ids``.
    """
    raw = _csv_texts(spark, [path] if isinstance(path, str) else path, schema)
    names = [c for c in raw.columns if c != ORIGIN]
    texts = raw.select(*[na_to_null(ref(c), na_tokens).alias(c) for c in names], *([ORIGIN] if origin else []))
    types = {f.name: f.dataType for f in schema} if schema is not None else infer_types(texts.select(*[ref(c) for c in names]))
    return texts.select(*[
        (ref(c) if isinstance(types[c], T.StringType) else F.trim(ref(c)).try_cast(types[c])).alias(c)
        for c in names
    ], *([ORIGIN] if origin else []))


#: Rows of a file are numbered below this many bits of an id, the files above.
ROW_BITS = 36


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[int, str]]:
    """``position in paths, file`` of every file behind ``paths`` in order; names only, and nothing for a path that does not exist."""
    found = []
    hadoop = spark._jvm.org.apache.hadoop.fs
    for k, path in enumerate(paths):
        place = hadoop.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        names = []
        for top in system.globStatus(place) or []:
            listed = system.listFiles(top.getPath(), True)
            while listed.hasNext():
                names.append(listed.next().getPath())
        visible = [str(n.toString()) for n in names if not n.getName().startswith(("_", "."))]
        found += [(k, name) for name in sorted(visible)]
    return found


def row_ids(df: DataFrame, id_col: str, file_col: str, files: Sequence[tuple[int, str]]) -> DataFrame:
    """``df`` with ``file_col`` (the position of the row's path) and ``id_col``: the file's number in ``files`` and the row's place in its file.

    Ids follow the order of files and rows, and stay the same however the files are split or the cluster is sized. ``df`` comes from
    :func:`scan_parquet` or from :func:`scan_csv` with ``origin``. Places in delimited text are counted block by block: rows of a block have
    neighbouring numbers, and the blocks before it say where they start.
    """
    spark = df.sparkSession
    numbers = local_table(spark, [(_uri(spark, name), n, k) for n, (k, name) in enumerate(files)], "__uri string, __number bigint, __path int")
    if ORIGIN in df.columns:
        blocks = df.groupBy(F.col(f"{ORIGIN}.file").alias("__uri"), F.col(f"{ORIGIN}.block").alias("__block")).agg(
            F.min(f"{ORIGIN}.at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
        earlier = Window.partitionBy("__uri").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = durable(blocks.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0))))
        placed = df.withColumns({"__uri": F.col(f"{ORIGIN}.file"), "__block": F.col(f"{ORIGIN}.block"), "__at": F.col(f"{ORIGIN}.at")})
        placed = attach_unique(placed.drop(ORIGIN), blocks, ["__uri", "__block"], weight="__rows")
        placed = placed.withColumn("__row", F.col("__before") + F.col("__at") - F.col("__first")).drop(
            "__block", "__at", "__first", "__rows", "__before")
    else:
        placed = df.withColumns({"__uri": _file(), "__row": F.col("_metadata.row_index")})
    known = attach_unique(placed, numbers, ["__uri"])
    return known.withColumns({id_col: F.shiftleft("__number", ROW_BITS) + F.col("__row"), file_col: F.col("__path")}).drop(
        "__uri", "__row", "__number", "__path")


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A DataFrame as it is, or the file behind a path."""
    if isinstance(source, DataFrame):
        return source
    if not isinstance(source, str):
        raise TypeError(f"unsupported input type: {type(source).__name__}")
    verdict = check_source(spark, source).first()
    if not verdict["ok"]:
        raise ValueError(f"{source}: {verdict['reason']}")
    if source.lower().endswith(".csv"):
        return scan_csv(spark, source)
    if source.lower().endswith(".parquet"):
        return scan_parquet(spark, source)
    raise ValueError(f"{source}: no reader for this format")
