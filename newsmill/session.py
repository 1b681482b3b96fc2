"""Session set-up, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after its size was measured and found below this.
BROADCAST_BYTES = 32 << 20

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str = "newsmill", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and a fixed UTC zone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    defaults.update({k: str(v) for k, v in conf.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster, in its configuration or as checkpoint folder. A local one
    serves only a local master (tests); elsewhere other machines could not read it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="newsmill-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that no earlier call has returned."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage, so that later uses neither recompute nor drift."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)


def size_of(df: DataFrame) -> Column:
    """An aggregate for the bytes of all rows: 16 a value, and what texts and nested values hold."""
    wide = [F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{n}`").alias("v"))) if t[:5] in ("array", "struc", "map<s") else F.col(f"`{n}`").cast("string")), F.lit(0)) for n, t in df.dtypes]
    total = reduce(add, wide, F.lit(16 * len(wide)))
    return F.coalesce(F.sum(total.cast("long")), F.lit(0))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Store ``df`` once, measure it, and mark it for broadcast only up to ``max_bytes``.

    Above the bound the plain stored frame comes back: the join then shuffles, and adaptive
    execution splits its skewed partitions.
    """
    stored = cut(df)
    return F.broadcast(stored) if stored.agg(size_of(stored)).first()[0] <= max_bytes else stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
