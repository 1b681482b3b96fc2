"""The nearest neighbours of every vector, exactly, with cells and the triangle inequality in place of all pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col
from newsmill.operators.ordering import keep_first
from newsmill.session import cut

# Rows and bytes of the sample that centres are fitted on, rounds of fitting, and the most cells.
SAMPLE_ROWS, SAMPLE_BYTES, ROUNDS, MAX_CELLS = 20_000, 32 << 20, 6, 1024
# Most vectors of a block, and of it in bytes; blocks that small tables are dealt to; vectors that are compared with a
# block in one task.
BLOCK_ROWS, BLOCK_BYTES, FEW_BLOCKS, LEAST_ROWS = 16_384, 64 << 20, 32, 1_024
ASKING_ROWS = 16_384
# Cosines are ranked by so many digits, so that the order of a sum decides nothing.
DIGITS = 9
# Slack of distances for rounding.
SLACK = 1e-6


def unit_rows(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors of an Arrow list column scaled to length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(df: DataFrame, vector: str, width: int) -> DataFrame:
    """Rows with a vector of the given width, of finite numbers that are not all zero."""
    squares = F.aggregate(col(vector), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return df.where((F.size(col(vector)) == width) & (squares > 0) & (squares < float("inf")))


def width_of(df: DataFrame, vector: str) -> int:
    """The most frequent width."""
    best = df.where(col(vector).isNotNull()).groupBy(F.size(col(vector)).alias("w")).count().orderBy(F.desc("count"), "w").first()
    return best["w"] if best else 0


def fit_centres(df: DataFrame, vector: str, width: int, cells: int) -> np.ndarray:
    """Unit centres by k-means on a bounded sample, chosen by hash. It starts with points that are far from each other."""
    rows = min(SAMPLE_ROWS, max(cells, SAMPLE_BYTES // (8 * max(width, 1))))
    sample = df.select(col(vector).cast("array<float>").alias("v")).orderBy(F.xxhash64("v")).limit(rows).toArrow()["v"]
    if not len(sample):
        return np.zeros((0, width))
    points = unit_rows(sample, width)
    chosen, far = [0], np.full(len(points), np.inf)
    while len(chosen) < cells:
        far = np.minimum(far, distances(points, points[chosen[-1:]])[:, 0])
        if far.max() <= SLACK:
            break
        chosen.append(int(np.argmax(far)))
    centres = points[chosen]
    for _ in range(ROUNDS):
        near = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * points @ centres.T))


def reachable(points: np.ndarray, reach: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Which cells may hold a row within ``reach`` of each point: the triangle inequality rules out the others."""
    return distances(points, centres) - radius <= reach[:, None] + SLACK


def rows_of_block(n: int, width: int) -> int:
    """How many of ``n`` vectors a block holds. Every asking row is sent to a block once, so that large blocks mean
    little to shuffle; small tables have smaller ones, for enough tasks."""
    return max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width), max(LEAST_ROWS, n // FEW_BLOCKS)))


def pack_cells(centres: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The group of each cell: cells whose centres are near each other, of at most ``most`` rows together. A larger
    cell is a group of its own."""
    groups, left = np.zeros(len(counts), np.int64), np.ones(len(counts), bool)
    at, group, held = 0, 0, 0
    for _ in range(len(counts)):
        left[at] = False
        if held and held + counts[at] > most:
            group, held = group + 1, 0
        groups[at], held = group, held + counts[at]
        if left.any():
            apart = distances(centres[at : at + 1], centres)[0]
            at = int(np.argmin(np.where(left, apart, np.inf)))
    return groups


def in_cells(df: DataFrame, centres: np.ndarray, vector: str) -> DataFrame:
    """``df`` with the number of the nearest centre (``cell``) and the distance to it (``centre_distance``)."""
    width = centres.shape[1]
    names = df.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = distances(unit_rows(batch.column(vector), width), centres)
            near = np.argmin(d, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], names=[*names, "cell", "centre_distance"])

    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("centre_distance", T.DoubleType())])
    return df.mapInArrow(place, schema)


def _best(asking: pa.Table, members: pa.Table, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of the askers and of their ``k`` best members, and the cosines; a key is not its own neighbour."""
    a, m = unit_rows(asking["v"], width), unit_rows(members["v"], width)
    ka, km = asking["key"].to_numpy(), members["key"].to_numpy()
    rank = np.argsort(np.argsort(km, kind="stable"), kind="stable")
    who, whom, cosines = [], [], []
    for start in range(0, len(a), 512):
        c = np.round(a[start : start + 512] @ m.T, DIGITS)
        c[ka[start : start + 512, None] == km[None, :]] = -np.inf
        keep = min(k, len(m))
        # Ties at the end of the list are weighed by key: every row level with the last one is looked at.
        least = np.partition(c, len(m) - keep, axis=1)[:, len(m) - keep]
        for row in range(len(c)):
            pool = np.flatnonzero((c[row] >= least[row]) & (c[row] > -np.inf))
            pool = pool[np.lexsort((rank[pool], -c[row, pool]))][:k]
            who.append(np.full(len(pool), start + row))
            whom.append(pool)
            cosines.append(c[row, pool])
    return np.concatenate(who), np.concatenate(whom), np.concatenate(cosines)


def nearest_to_all(df: DataFrame, k: int = 10, key: str = "id", vector: str = "embedding", width: int | None = None, cells: int | None = None) -> DataFrame:
    """``key``, ``rank``, ``neighbour``, ``cosine``: the ``k`` nearest other rows of every row by cosine, ties by key.

    Rows are dealt to cells around centres, near cells together to blocks. Each row first looks at its own block: the
    ``k``-th best there is a bound. By the triangle inequality only blocks with a cell whose nearest point may lie
    within that bound are looked at after that, and each of these comparisons passes on ``k`` rows per asking row.
    Keys must be unique. Rows without a usable vector of the width (the most frequent one if not given) have no
    neighbours and are none. How much is pruned depends on the data; the result does not.
    """
    width = width or width_of(df, vector)
    key_type = df.schema[key].dataType.simpleString()
    empty = df.sparkSession.createDataFrame([], f"`{key}` {key_type}, rank int, neighbour {key_type}, cosine double")
    if not width:
        return empty
    rows = usable(df, vector, width).select(col(key).alias("key"), col(vector).cast("array<float>").alias("v"))
    n = rows.count()
    if not n:
        return empty
    centres = fit_centres(rows, "v", width, cells or min(MAX_CELLS, max(1, int(n**0.5) // 2)))
    placed = cut(in_cells(rows, centres, "v"))
    # One row per cell.
    stats = {r["cell"]: (r["n"], r["radius"]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("centre_distance").alias("radius")).collect()}
    numbers = np.array(sorted(stats))
    counts, radius = np.array([stats[c][0] for c in numbers]), np.array([stats[c][1] for c in numbers])
    most = rows_of_block(n, width)
    groups = pack_cells(centres[numbers], counts, most)
    blocks = -(-np.bincount(groups, weights=counts).astype(np.int64) // most)
    # At most ``MAX_CELLS`` entries each.
    of_cell = F.create_map(*[F.lit(int(x)) for item in zip(numbers, groups) for x in item])[F.col("cell")]
    of_group = F.create_map(*[F.lit(int(x)) for item in enumerate(blocks) for x in item])[F.col("cell")]
    blocked = placed.withColumn("cell", of_cell).withColumn("block", F.pmod(F.xxhash64("key"), of_group).cast("int"))

    def bound(table: pa.Table) -> pa.Table:
        who, _, cosines = _best(table, table, width, k)
        counts, lows = np.bincount(who, minlength=table.num_rows), np.full(table.num_rows, np.inf)
        np.minimum.at(lows, who, cosines)
        worst = np.where(counts == k, lows, np.inf)
        reach = np.where(np.isinf(worst), np.inf, np.sqrt(np.maximum(0.0, 2 - 2 * np.where(np.isinf(worst), 1, worst))))
        return pa.table({"key": table["key"], "v": table["v"], "reach": pa.array(reach)})

    bounded = cut(blocked.groupBy("cell", "block").applyInArrow(bound, f"key {key_type}, v array<float>, reach double"))
    by_group = np.argsort(groups, kind="stable")
    starts = np.searchsorted(groups[by_group], np.arange(len(blocks)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                may = reachable(unit_rows(part.column("v"), width), part.column("reach").to_numpy(), centres[numbers], radius)
                who, where = np.nonzero(np.logical_or.reduceat(may[:, by_group], starts, axis=1))
                times = blocks[where]
                block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                take = pa.array(np.repeat(who, times))
                columns = [part.column("key").take(take), part.column("v").take(take), pa.array(np.repeat(where, times).astype(np.int32)), pa.array(block.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "v", "cell", "block"])

    routed = bounded.mapInArrow(route, f"key {key_type}, v array<float>, cell int, block int")
    parts = -(-n // ASKING_ROWS)
    asking = routed.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(parts)).cast("int"))
    members = blocked.select("key", "v", "cell", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"key": right["key"].slice(0, 0), "neighbour": right["key"].slice(0, 0), "cosine": pa.array([], pa.float64())})
        who, whom, cosines = _best(left, right, width, k)
        return pa.table({"key": left["key"].take(pa.array(who)), "neighbour": right["key"].take(pa.array(whom)), "cosine": pa.array(cosines)})

    names = ["cell", "block", "part"]
    pairs = asking.groupBy(*names).cogroup(members.groupBy(*names)).applyInArrow(compare, f"key {key_type}, neighbour {key_type}, cosine double")
    best = keep_first(pairs, [F.col("key")], [F.desc("cosine"), F.col("neighbour")], k, out="rank")
    return best.select(F.col("key").alias(key), F.col("rank").cast("int").alias("rank"), "neighbour", "cosine")
