"""Choices made on the schema at plan time; none of these starts a job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def first_present(df: DataFrame, names: Iterable[str]) -> str | None:
    return next(iter(present(df, names)), None)


def require(df: DataFrame, name: str) -> str:
    if name not in df.columns:
        raise KeyError(f"missing column: {name}")
    return name


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def stored_number(df: DataFrame, name: str) -> Column:
    """The column as a number. Numeric columns pass untouched, NaN included, so filters on them still reach
    the scan; text is parsed leniently and bad text (``NaN`` too) is NULL."""
    dtype = df.schema[name].dataType
    c = col(name)
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if is_numeric(dtype):
        return c
    return F.nanvl(c.cast("string").try_cast("double"), F.lit(None).cast("double"))


def number(df: DataFrame, name: str) -> Column:
    """The column as a number, NaN as NULL: what is kept, ranked, summed or counted. Filters that should reach
    the scan take :func:`stored_number`."""
    c = stored_number(df, name)
    return F.nanvl(c, F.lit(None).cast(df.schema[name].dataType)) if is_floating(df, name) else c


def missing(df: DataFrame, name: str) -> Column:
    """Whether a value is NULL or NaN."""
    return col(name).isNull() | F.isnan(col(name)) if is_floating(df, name) else col(name).isNull()


def number_or_zero(df: DataFrame, name: str) -> Column:
    """As :func:`number`; an absent column or a NULL counts as zero."""
    if name not in df.columns:
        return F.lit(0.0)
    c = number(df, name)
    return F.coalesce(c, F.lit(0).cast(_type_of_number(df, name)))


def _type_of_number(df: DataFrame, name: str) -> str:
    dtype = df.schema[name].dataType
    if is_numeric(dtype) and not isinstance(dtype, T.DecimalType):
        return dtype.simpleString()
    return "int" if isinstance(dtype, T.BooleanType) else "double"


def text(df: DataFrame, name: str) -> Column:
    """The column as text; nested values as JSON; NaN as NULL."""
    dtype = df.schema[name].dataType
    if is_floating(df, name):
        return number(df, name).cast("string")
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(col(name))
    return col(name) if isinstance(dtype, T.StringType) else col(name).cast("string")


def with_id(df: DataFrame, name: str = "record_id") -> DataFrame:
    """Rows without an id column get a hash of the whole row: it needs no counter and no order."""
    return df if name in df.columns else df.withColumn(name, F.xxhash64(*[text(df, n) for n in df.columns]))


def fingerprint(c: Column) -> Column:
    """A 128-bit stand-in for a value that only has to be told apart: two hashes with unlike seeds,
    so that counting distinct long texts does not shuffle the texts."""
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL and nothing else: call once, right after a load."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({n: F.nanvl(col(n), F.lit(None).cast(df.schema[n].dataType)) for n in floating})


def tall(df: DataFrame, keys: Sequence[str], entries: Sequence[tuple[str, Column]], key: str, value: str, cast: str) -> DataFrame:
    """Wide to long: the keys, then one row per entry with its name and its value. NULLs stay."""
    names = [n for n, _ in entries]
    if set(names) & set(keys):
        raise ValueError(f"columns are both key and value: {set(names) & set(keys)}")
    wide = df.select(*[col(k) for k in keys], *[c.cast(cast).alias(n) for n, c in entries])
    return wide.unpivot([col(k) for k in keys], [col(n) for n in names], key, value)
