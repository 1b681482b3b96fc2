"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Batch = Callable[[pa.RecordBatch], pa.RecordBatch]


# Rows that are turned into Python values at a time; a worker keeps the memory of its largest batch.
SLICE_ROWS = 256


def per_batch(df: DataFrame, make: Callable[[], Batch], schema: str) -> DataFrame:
    """Runs ``make()`` once per task and the function that it returns on slices of the Arrow batches. A
    batch is bounded in rows and bytes by the session, and of it only a slice is held as Python values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield one(batch.slice(start, SLICE_ROWS))

    return df.mapInArrow(run, schema)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a column; NULL counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def each(texts: pa.Array) -> Iterator[str]:
    """The texts of an array one by one, NULL as empty."""
    for start in range(0, len(texts), SLICE_ROWS):
        for text in texts.slice(start, SLICE_ROWS).to_pylist():
            yield text or ""


def bytes_lower(text: str) -> list[bytes]:
    """Words of a text as UTF-8, A-Z lower-cased. The separators are space and U+0009 to U+000D, which
    are exactly those of ``bytes.split``."""
    return text.encode().lower().split()
