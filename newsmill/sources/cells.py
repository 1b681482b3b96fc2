"""A stored table of vectors, partitioned by cell, from which a search reads only the cells that it must."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.operators import neighbours
from newsmill.operators.search import vector_search
from newsmill.session import cut

# The most files that one cell of a load is written to, and rows from which a cell gets a further one.
FILES_PER_CELL, ROWS_PER_FILE = 64, 500_000


@dataclass(frozen=True)
class Cells:
    """Numbers, unit centres, radii and row counts of the stored cells."""

    number: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The least distance that a row of each cell can have from a unit vector."""
        return np.maximum(0.0, neighbours.distances(query[None, :], self.centre)[0] - self.radius)


def _write(df: DataFrame, centres: np.ndarray, path: str, vector: str, mode: str) -> None:
    spark = df.sparkSession
    placed = cut(neighbours.in_cells(neighbours.usable(df, vector, centres.shape[1]), centres, vector))
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("centre_distance").alias("radius"))
    files = F.least(F.lit(FILES_PER_CELL), F.ceil(F.col("rows") / ROWS_PER_FILE))
    # One row per cell.
    laid = placed.join(F.broadcast(stats.select("cell", files.alias("_nm_files"))), "cell")
    laid = laid.repartition("cell", F.pmod(F.xxhash64(vector), F.col("_nm_files"))).drop("_nm_files", "centre_distance")
    laid.write.mode(mode).partitionBy("cell").parquet(path)
    centre = spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centres)], "cell int, centre array<double>")
    # Cells without rows stay known, so that later loads find their centres.
    centre.join(stats, "cell", "left").fillna(0, ["rows", "radius"]).coalesce(1).write.mode(mode).parquet(f"{path}/_cells")


def create(df: DataFrame, path: str, vector: str = "embedding", cells: int = 64, width: int | None = None) -> None:
    """Writes the rows with a usable vector to a new table; centres are fitted on a bounded sample."""
    width = width or neighbours.width_of(df, vector)
    if not width:
        raise ValueError("there is no vector")
    _write(df, neighbours.fit_centres(neighbours.usable(df, vector, width), vector, width, cells), path, vector, "errorifexists")


def append(df: DataFrame, path: str, vector: str = "embedding") -> None:
    """Adds rows to the cells that there are; radii and counts follow."""
    _write(df, cells_of(df.sparkSession, path).centre, path, vector, "append")


def cells_of(spark: SparkSession, path: str) -> Cells:
    """The cells of a table: a bounded number, however many rows and loads it has."""
    found = spark.read.parquet(f"{path}/_cells").groupBy("cell").agg(F.first("centre").alias("centre"), F.max("radius").alias("radius"), F.sum("rows").alias("rows"))
    rows = sorted(found.collect(), key=lambda r: r["cell"])
    return Cells(*(np.array([r[n] for r in rows]) for n in ("cell", "centre", "radius", "rows")))


def cells_to_read(spark: SparkSession, path: str, query: Sequence[float], k: int, key: str = "id", vector: str = "embedding") -> list[int]:
    """The cells that may hold one of the ``k`` nearest rows. They are taken in the order of their bounds until they have
    ``k`` rows; the ``k``-th best row of these limits the distance, and the other cells count if their bound is within it."""
    cells = cells_of(spark, path)
    unit = np.asarray(query, "float64")
    bound = cells.bounds(unit / np.linalg.norm(unit))
    order = [c for c in np.argsort(bound, kind="stable") if cells.rows[c]]
    first = order[: int(np.searchsorted(np.cumsum(cells.rows[order]), k)) + 1]
    found = vector_search(_of(spark, path, cells.number[first]), query, k, key=key, vector=vector)
    scores = [r[0] for r in found.select("similarity_score").collect()]
    reach = np.sqrt(max(0.0, 2 - 2 * min(scores))) if len(scores) == k else np.inf
    return [int(cells.number[c]) for c in order if bound[c] <= reach + neighbours.SLACK]


def _of(spark: SparkSession, path: str, numbers: Iterable[int]) -> DataFrame:
    return spark.read.parquet(path).where(F.col("cell").isin([int(n) for n in numbers]))


def search(spark: SparkSession, path: str, query: Sequence[float], k: int = 10, key: str = "id", vector: str = "embedding", keep: Sequence[str] = ()) -> DataFrame:
    """As :func:`newsmill.operators.search.vector_search` over the whole table, exactly, from the cells that it must read."""
    rows = _of(spark, path, cells_to_read(spark, path, query, k, key, vector))
    return vector_search(rows, query, k, key=key, vector=vector, keep=keep)
