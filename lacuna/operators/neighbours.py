"""Exact nearest-neighbour fills by descent in a distributed tree of donor boxes.

Distances are nan-Euclidean: ``sqrt(F/p * sum(diff^2))`` over the ``p`` features present on both
sides, ``F`` counting the target too. Rows with the same present features share a pattern; for a
receiver pattern, the donors are split by the features they share with it, and each such donor set
gets one tree. The tree is a grouping of donors by prefixes of an interleaved code of their features,
and each of its cells records how many donors it holds and the box around them. A receiver walks down
all trees of its pattern at once, one join per level: the box corners bound its k-th distance from
above, and cells farther away than the bound are dropped. Only the donors of the leaves that remain
are compared, so the work per receiver does not grow with the number of donors, and no step pairs all
receivers with all donors. A leaf is one row that holds its donors: each receiver keeps its k best of
it there, and only those are sorted and shuffled.

Identical donors are collapsed to their k smallest ids and identical receivers to one before the walk,
which is exact and takes hot values out.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from lacuna.functions.columns import data_type, numeric_columns, present_value, ref
from lacuna.functions.durable import durable
from lacuna.functions.joins import attach_unique
from lacuna.functions.ranking import top_n
from lacuna.operators.cells import patch
from lacuna.operators.impute import Filled, fill_digits, ledger_rows

LEAF_DONORS = 128
CROWDED = 4  # a cell is split further beyond this multiple of LEAF_DONORS
BITS = 24
RECEIVERS_PER_TASK = 50_000
BROADCAST_ROWS = 100_000  # about 10 MB of cells or donors


def _coordinates(m: int, prefix: str) -> list[str]:
    return [f"{prefix}{j}" for j in range(m)]


def _pattern(names: Sequence[str]) -> Column:
    """Bit mask of the present coordinates."""
    mask = F.lit(0).cast("bigint")
    for j, name in enumerate(names):
        mask = mask + F.when(F.col(name).isNotNull(), F.lit(1 << j)).otherwise(F.lit(0)).cast("bigint")
    return mask


def _survey(base: DataFrame, names: Sequence[str]) -> Row:
    """One pass: ranges of the donors' coordinates, donor counts, receiver patterns, target mean."""
    donor, receiver = F.col("y").isNotNull(), F.col("y").isNull()
    vector = F.xxhash64(*names)
    return base.agg(
        F.avg("y").alias("mean"), F.count("y").alias("donors"), F.count_if(receiver).alias("receivers"),
        F.approx_count_distinct(F.when(donor, vector)).alias("vectors"),
        F.collect_set(F.when(receiver, _pattern(names))).alias("patterns"),
        *[x for n in names for x in (
            F.min(F.when(donor, F.col(n))).alias(f"{n}_min"), F.max(F.when(donor, F.col(n))).alias(f"{n}_max"),
            F.percentile_approx(F.when(donor, F.col(n)), [0.25, 0.5, 0.75], 1000).alias(f"{n}_q"),
        )],
    ).first()


def _coded(donors: DataFrame, survey: Row, names: Sequence[str]) -> DataFrame:
    """``donors`` with ``code``, a bit string of the present coordinates; the coordinate whose cells are widest so far gives the next bit.

    So the boxes get about as long in every direction, in the units of the distance, and a narrow coordinate is not split
    while a wide one still tells donors apart. Coordinates are squashed by asinh around their quartiles, so that long tails
    do not leave most donors in one cell. The code only groups donors; distances never use it. Within a tree the same
    coordinates are missing everywhere, so they take no bits.
    """
    bits, widest = {}, []
    for j, n in enumerate(names):
        low, high, quartiles = survey[f"{n}_min"], survey[f"{n}_max"], survey[f"{n}_q"]
        if low is None or low == high:
            bits[f"bits{j}"] = F.when(F.col(n).isNotNull(), "0" * BITS)
            widest.append((0.0, j, 1))
            continue
        centre = quartiles[1]
        spread = (quartiles[2] - quartiles[0]) or (high - low) / 4
        first, last = math.asinh((low - centre) / spread), math.asinh((high - centre) / spread)
        scaled = (F.asinh((F.col(n) - centre) / spread) - first) / (last - first) * float(2**BITS)
        cell = F.least(F.greatest(F.floor(scaled), F.lit(0)), F.lit(2**BITS - 1))
        bits[f"bits{j}"] = F.when(F.col(n).isNotNull(), F.lpad(F.bin(F.coalesce(cell, F.lit(0))), BITS, "0"))
        widest.append((-spread * (last - first), j, 1))  # asinh is steepest, and its cells narrowest, at the centre
    heapq.heapify(widest)
    runs: list[list[int]] = []
    while widest:
        width, j, bit = heapq.heappop(widest)
        if runs and runs[-1][0] == j:
            runs[-1][2] += 1
        else:
            runs.append([j, bit, 1])
        if bit < BITS:
            heapq.heappush(widest, (width / 2, j, bit + 1))
    pieces = ", ".join(f"substring(bits{j}, {start}, {length})" for j, start, length in runs)
    code = F.expr(f"rpad(concat_ws('', {pieces}), {BITS * len(names)}, '0')")
    return donors.withColumns(bits).withColumn("code", code).drop(*bits)


def _cells(donors: DataFrame, depth: int, step: int, names: Sequence[str]) -> DataFrame:
    """Cells of one level with donor count and box."""
    return donors.groupBy("tree", F.substring("code", 1, depth * step).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(n).alias(f"lo_{n}") for n in names], *[F.max(n).alias(f"hi_{n}") for n in names],
    )


def _parents(cells: DataFrame, depth: int, step: int, names: Sequence[str]) -> DataFrame:
    return cells.groupBy("tree", F.substring("cell", 1, depth * step).alias("cell")).agg(
        F.sum("n").alias("n"),
        *[F.min(f"lo_{n}").alias(f"lo_{n}") for n in names], *[F.max(f"hi_{n}").alias(f"hi_{n}") for n in names],
    )


def _sized(cells: DataFrame, rows: int) -> DataFrame:
    """Broadcast a level only when its counted number of cells is small."""
    return F.broadcast(cells) if rows <= BROADCAST_ROWS else cells


def _sum_of_squares(terms: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for term in terms:
        total = total + F.coalesce(term * term, F.lit(0.0))
    return total


def nearest_donors(base: DataFrame, survey: Row, m: int, k: int, leaf: int = LEAF_DONORS) -> DataFrame:
    """The ``k`` nearest donors of every distinct receiver: ``rid, did, y, d2``; ties by smallest donor id.

    ``base`` holds ``id``, ``block``, coordinates ``x0..`` and ``y``, NULL for receivers. A receiver
    that shares no feature with any donor of its block gets no row.
    """
    names = _coordinates(m, "x")
    step = 2 if m == 1 else min(max(m, 4), 8)
    by_id = F.col("did").asc()
    # The walk multiplies every receiver into cells: it is spread by receivers, not by their few bytes.
    spread = max(base.sparkSession.sparkContext.defaultParallelism, survey["receivers"] // RECEIVERS_PER_TASK)
    receivers = distinct_receivers(base, names).withColumn("pr", _pattern(names)).repartition(spread, "rid")
    donors = base.where(F.col("y").isNotNull()).withColumnRenamed("id", "did")

    patterns = F.array(*[F.lit(p) for p in sorted(survey["patterns"]) if p]).cast("array<bigint>")
    unique = top_n(donors, ["block", *names], [by_id], k)
    grown = unique.withColumn("pd", _pattern(names)).withColumn("pr", F.explode(patterns))
    grown = grown.withColumn("shared", F.col("pr").bitwiseAND(F.col("pd"))).where("shared <> 0")
    grown = grown.select(
        "did", "y", F.concat_ws("/", "block", "pr", "shared").alias("tree"),
        *[F.when(F.col("shared").bitwiseAND(F.lit(1 << j)) != 0, F.col(n)).alias(n) for j, n in enumerate(names)],
    )
    if m > 1:
        grown = top_n(grown, ["tree", *names], [by_id], k)
    grown = durable(_coded(grown, survey, names))

    most = min(survey["donors"], k * survey["vectors"])
    base_depth = max(0, round(math.log2(max(most / leaf, 1)) / step))
    deepest = (BITS * m) // step

    # Donors know their leaf: the base level, or deeper where a cell is still crowded.
    placed = grown.withColumn("leaf", F.substring("code", 1, base_depth * step))
    cells, rows = {base_depth: durable(_cells(grown, base_depth, step, names))}, {}
    all_donors = cells[base_depth].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    depth = base_depth
    while True:
        is_heavy = F.col("n") > CROWDED * leaf
        rows[depth], crowds, largest = cells[depth].agg(F.count(F.lit(1)), F.count_if(is_heavy), F.max("n")).first()
        if crowds == 0 or depth == deepest:
            break
        heavy = _sized(cells[depth].where(is_heavy).select("tree", F.col("cell").alias("leaf")), crowds)
        crowded = placed.join(heavy, ["tree", "leaf"], "left_semi")
        depth += 1
        cells[depth] = durable(_cells(crowded, depth, step, names))
        marked = _sized(heavy.withColumn("crowded", F.lit(True)), crowds)
        placed = placed.join(marked, ["tree", "leaf"], "left").withColumn(
            "leaf", F.when(F.col("crowded"), F.substring("code", 1, depth * step)).otherwise(F.col("leaf"))
        ).drop("crowded")
    for upper in range(base_depth - 1, -1, -1):
        cells[upper] = _parents(cells[upper + 1], upper, step, names)
        rows[upper] = rows[upper + 1]  # a parent level never has more cells than its children

    part = F.split("tree", "/")
    roots = cells[0].select(
        "tree", part[0].alias("block"), part[1].cast("bigint").alias("pr"), "n",
        F.bit_count(part[2].cast("bigint")).alias("p"),
    )
    walk = receivers.join(_sized(roots, rows[0]), ["block", "pr"]).select(
        "rid", *names, "tree", (F.lit(float(m + 1)) / F.col("p")).alias("factor"),
        F.lit("").alias("cell"), "n",
        F.lit(0.0).alias("near"), F.lit(math.inf).alias("far"), F.lit(math.inf).alias("bound"),
    )
    per_receiver = Window.partitionBy("rid")
    growing = per_receiver.orderBy("far", "tree", "cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(1, depth + 1):
        kids = cells[level].select(
            F.col("tree").alias("kid_tree"), F.substring("cell", 1, (level - 1) * step).alias("parent"),
            F.col("cell").alias("kid"), F.col("n").alias("kid_n"),
            *[f"lo_{n}" for n in names], *[f"hi_{n}" for n in names],
        )
        kids = _sized(kids, rows[level])
        joined = walk.join(kids, (F.col("tree") == F.col("kid_tree")) & (F.col("cell") == F.col("parent")), "left")
        near = _sum_of_squares([
            F.greatest(F.col(f"lo_{n}") - F.col(n), F.col(n) - F.col(f"hi_{n}"), F.lit(0.0)) for n in names
        ]) * F.col("factor")
        far = _sum_of_squares([
            F.greatest(F.abs(F.col(n) - F.col(f"lo_{n}")), F.abs(F.col(f"hi_{n}") - F.col(n))) for n in names
        ]) * F.col("factor")
        down = F.col("kid").isNotNull()
        walk = joined.select(
            "rid", *names, "tree", "factor",
            F.coalesce("kid", "cell").alias("cell"), F.coalesce("kid_n", "n").alias("n"),
            F.when(down, near).otherwise(F.col("near")).alias("near"),
            F.when(down, far).otherwise(F.col("far")).alias("far"), "bound",
        ).where(F.col("near") <= F.col("bound"))
        walk = walk.withColumn("held", F.sum("n").over(growing)).withColumn(
            "bound", F.least("bound", F.min(F.when(F.col("held") >= k, F.col("far"))).over(per_receiver))
        ).where(F.col("near") <= F.col("bound")).drop("held")

    # A leaf's donors are packed into one row, so that a receiver keeps the k best of them before anything is sorted or
    # shuffled. Only cells of the last level can be crowded; they are packed in shares.
    shares = math.ceil((largest or 0) / (CROWDED * leaf))
    share = F.lit(0) if crowds == 0 else F.when(
        F.length("leaf") == deepest * step, F.pmod(F.xxhash64("did", "y", *names), F.lit(shares))).otherwise(F.lit(0))
    packed = placed.groupBy(F.col("tree").alias("leaf_tree"), "leaf", share.alias("share")).agg(
        F.collect_list(F.struct("did", "y", *names)).alias("donors")).drop("share")
    pairs = walk.join(_sized(packed, all_donors), (F.col("tree") == F.col("leaf_tree")) & (F.col("cell") == F.col("leaf")))

    def measured(d: Column) -> Column:
        d2 = _sum_of_squares([F.col(n) - d[n] for n in names]) * F.col("factor")
        return F.struct(d2.alias("d2"), d["did"].alias("did"), d["y"].alias("y"))

    within = F.filter(F.transform("donors", measured), lambda d: d["d2"] <= F.col("bound"))
    best = pairs.select("rid", F.slice(F.sort_array(within), 1, k).alias("best")).select("rid", F.inline("best")).select("rid", "did", "y", "d2")
    return top_n(best, ["rid"], [F.col("d2").asc(), by_id], k)


def distinct_receivers(base: DataFrame, names: Sequence[str]) -> DataFrame:
    """One receiver per block and coordinates, known by its smallest id."""
    return base.where(F.col("y").isNull()).groupBy("block", *names).agg(F.min("id").alias("rid"), F.count(F.lit(1)).alias("receivers"))


def knn_predictions(df: DataFrame, id_col: str, target: str, features: Sequence[str], k: int = 3,
                    block_by: Sequence[str] = (), leaf: int = LEAF_DONORS) -> DataFrame:
    """``row_id, prediction, neighbours`` for every row that misses ``target``.

    The prediction is the mean of the nearest donors' values, or the column mean where no distance is
    defined. ``block_by`` restricts donors to rows with the same keys.
    """
    features = [f for f in features if f != target]
    names = _coordinates(len(features), "x")
    block = F.sha2(F.to_json(F.struct(*[ref(b) for b in block_by])), 256) if block_by else F.lit("")
    base = df.select(
        ref(id_col).alias("id"), present_value(df, target).cast("double").alias("y"), block.alias("block"),
        *[(present_value(df, f).cast("double") + F.lit(0.0)).alias(n) for f, n in zip(features, names)],
    )
    survey = _survey(base, names)
    wanting = base.where(F.col("y").isNull())
    unique = distinct_receivers(base, names)
    near = nearest_donors(base, survey, len(names), k, leaf)
    means = near.groupBy("rid").agg(F.avg("y").alias("prediction"), F.count(F.lit(1)).alias("neighbours"))
    # Back from distinct receivers to all of them; NULL coordinates match each other.
    answers = durable(unique.join(means, "rid").drop("rid"))
    return attach_unique(wanting, answers, ["block", *names], weight="receivers").select(
        F.col("id").alias("row_id"), F.coalesce("prediction", F.lit(survey["mean"]).cast("double")).alias("prediction"),
        F.coalesce("neighbours", F.lit(0).cast("bigint")).alias("neighbours"),
    )


def knn_impute(df: DataFrame, id_col: str, target: str, run_ts: datetime, features: Sequence[str] | None = None,
               n: int = 3, block_by: Sequence[str] = ()) -> Filled:
    """Fill ``target`` with the mean of its ``n`` nearest donors, two decimals."""
    if features is None:
        features = [c for c in numeric_columns(df, [id_col]) if c != target]
    kind = data_type(df, target)
    reason = f"K-NN imputation based on {len(features)} related numeric columns"
    found = knn_predictions(df, id_col, target, features, n, block_by).withColumn("fill", fill_digits(F.col("prediction"), kind))
    # The fills feed both the table and the ledger: computed once.
    found = durable(found.select("row_id", "fill"))
    ledger = ledger_rows(
        found, F.col("row_id"), target, num=F.col("fill"), confidence=F.lit(0.8), method=F.lit("knn_imputation"),
        reasoning=F.lit(reason), run_ts=run_ts,
    )
    fills = found.select(F.col("row_id").alias("__id"), F.col("fill").alias("__fill"))
    table = df.join(fills, ref(id_col) == F.col("__id"), "left").select(*[
        (patch(df, c, F.col("__fill")) if c == target else ref(c)).alias(c) for c in df.columns
    ])
    return Filled(table, ledger)
