"""Layout of a table by several columns at once, so that the statistics of its files skip most of them for each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col, number

# Bits of a column's place in the interleaved number: 64 ranges each.
BITS = 6
# Bytes of a text that decide on its order.
PREFIX = 7


def _ordered(df: DataFrame, name: str) -> Column:
    """A value as a number that rises with it; texts by their first bytes."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(col(name), "UTF-8"), 1, PREFIX)), 2 * PREFIX, "0"), 16, 10).cast("double")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col(name).cast("timestamp")).cast("double")
    return number(df, name).cast("double")


def interleaved(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, str]:
    """``df`` with the interleaved bits of the places of its columns, each among ranges of about equally many rows. The
    cut points are estimates from one pass and become constants of the plan. NULL comes first."""
    points = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    cuts = df.agg(*[F.percentile_approx(_ordered(df, n), points, 1_000).alias(n) for n in names]).first()
    z = "_nm_z"
    places = []
    for name in names:
        # The number of limits below the value: at most 63.
        limits = sorted(set(cuts[name] or []))
        value = _ordered(df, name)
        above = [(value > float(v)).cast("long") for v in limits]
        places.append(F.coalesce(reduce(add, above, F.lit(0).cast("long")), F.lit(0).cast("long")))
    bits = [
        F.call_function("shiftleft", F.shiftright(place, b).bitwiseAND(1), F.lit(b * len(names) + k))
        for k, place in enumerate(places) for b in range(BITS)
    ]
    return df.withColumn(z, reduce(lambda a, b: a.bitwiseOR(b), bits)), z


def write_clustered(df: DataFrame, path: str, names: Sequence[str], files: int) -> None:
    """Replaces the table at ``path`` by about ``files`` files of neighbouring rows, sorted within."""
    if not 0 < len(names) * BITS < 63:
        raise ValueError("between one and ten columns can be interleaved")
    placed, z = interleaved(df, names)
    spread = F.xxhash64(*[col(n) for n in df.columns if not isinstance(df.schema[n].dataType, (T.MapType, T.VariantType))])
    # Rows of one place are told apart by a hash, so that a frequent combination is more than one file.
    placed.repartitionByRange(files, F.col(z), spread).sortWithinPartitions(z).drop(z).write.mode("overwrite").parquet(path)
