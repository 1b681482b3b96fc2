"""Quality scores from compression: a text compresses better with a dictionary of its own kind."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm.common import Batch, each, per_batch, strings

# Bounds of what is fitted on: labelled documents per class for the dictionaries, chunks of them, and
# labelled documents for the calibration. Chosen by hash over all labelled rows.
DICTIONARY_DOCS = 6_000
CHUNKS = 8_000
CALIBRATION_DOCS = 20_000
CHUNK_BYTES = 1024
DICTIONARY_BYTES = 112_640
LEVEL = 3

_FEATURES = ["difference", "signed_square", "bad_size", "good_size", "plain_size", "log_length", "per_byte"]


def _compressor(dictionary: bytes, trained: bool, level: int) -> zstandard.ZstdCompressor:
    plain = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**plain)
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=kind)
    data.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=data, **plain)


def measure(bad, good, plain, raw: bytes) -> list[float]:
    """The normalised difference of the sizes under both dictionaries, and the sizes it must be read with."""
    b, g, p, n = len(bad.compress(raw)), len(good.compress(raw)), len(plain.compress(raw)), len(raw) + 30
    d = 2 * (b - g) / (b + g)
    return [d, d * abs(d), b / n, g / n, p / n, float(np.log(n)), (b - g) / n]


@dataclass(frozen=True)
class Model:
    bad: bytes
    good: bytes
    trained: bool
    weights: tuple[float, ...]  # intercept first, on standardised features
    mean: tuple[float, ...]
    spread: tuple[float, ...]
    level: int = LEVEL

    def measures(self) -> Callable[[bytes], list[float]]:
        bad, good = _compressor(self.bad, self.trained, self.level), _compressor(self.good, self.trained, self.level)
        plain = _compressor(b"", False, self.level)
        return lambda raw: measure(bad, good, plain, raw)

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = (features - np.array(self.mean)) / np.array(self.spread)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + z @ np.array(self.weights[1:]), -30, 30)))


def _dictionary(samples: list[bytes]) -> tuple[bytes, bool]:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes(), True
    except zstandard.ZstdError:  # too few samples for a trained one
        return b"\n".join(samples)[:DICTIONARY_BYTES], False


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (intercept first), means and spreads of a logistic regression on standardised columns."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w, mean, spread


def held_out(id_col: Column) -> Column:
    """Rows that no model may learn from: the CRC of the id as text is a multiple of 5."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", level: int = LEVEL) -> Model:
    """Learns from the labelled documents that are not held out.

    Labelled ids are split by hash: one part gives the chunks from which a dictionary per class is
    trained, the other the sizes on which the score is calibrated, so that no text is measured with a
    dictionary that contains it. Both parts are bounded by parameters of this module; only ids within
    these bounds are broadcast, and only dictionaries and size measures reach the driver.

    Rows with a NULL id or label are not learnt from; a repeated label counts once, contradictory ones
    count as both. If a class has no rows, the score is the share of label 1 (0.5 without labels).
    """
    known = labels.select(col(id_col).alias("doc_id"), col(label_col).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).distinct().withColumn("turn", F.xxhash64("doc_id"))
    by_turn = [F.col("turn"), F.col("doc_id"), F.col("label")]
    teach = known.where("turn % 2 = 0")
    chosen = teach.where("label = 0").orderBy(*by_turn).limit(DICTIONARY_DOCS).unionAll(teach.where("label = 1").orderBy(*by_turn).limit(DICTIONARY_DOCS))
    texts = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    chunks = _chunks(texts.join(F.broadcast(chosen), "doc_id"))
    picked = [chunks.where(F.col("label") == k).orderBy("turn", "chunk").limit(CHUNKS) for k in (0, 1)]

    def train(group: pd.DataFrame) -> pd.DataFrame:
        data, trained = _dictionary(group.sort_values(["turn", "chunk"])["chunk"].tolist())
        return pd.DataFrame({"label": group["label"].iloc[:1], "data": [data], "trained": [trained]})

    made = picked[0].unionAll(picked[1]).groupBy("label").applyInPandas(train, "label int, data binary, trained boolean")
    dictionaries = {r.label: (bytes(r.data), r.trained) for r in made.collect()}
    check = known.where("turn % 2 <> 0").orderBy(*by_turn).limit(CALIBRATION_DOCS)
    if len(dictionaries) < 2:
        share = check.agg(F.avg("label")).first()[0]
        share = min(max(0.5 if share is None else share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", False, (float(np.log(share / (1 - share))), *[0.0] * len(_FEATURES)), (0.0,) * len(_FEATURES), (1.0,) * len(_FEATURES), level)
    trained = all(t for _, t in dictionaries.values())
    start = Model(dictionaries[0][0], dictionaries[1][0], trained, (), (), (), level)
    # Rows that repeat a document count once, so that no id can send more than its share to the driver.
    rows = _measured(texts.join(F.broadcast(check), "doc_id"), start).distinct().limit(CALIBRATION_DOCS).toPandas()
    rows = rows.sort_values(["label", *_FEATURES])  # a sum in another order would differ in the last bits
    if rows.empty:
        rows = pd.DataFrame([[1.0, *[0.0] * len(_FEATURES)], [0.0, *[0.0] * len(_FEATURES)]], columns=["label", *_FEATURES])
    w, mean, spread = logistic(rows[_FEATURES].to_numpy(float), rows["label"].to_numpy(float))
    return Model(start.bad, start.good, trained, tuple(map(float, w)), tuple(map(float, mean)), tuple(map(float, spread)), level)


def _chunks(labelled: DataFrame) -> DataFrame:
    def make() -> Batch:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for label, turn, text in zip(batch.column("label").to_pylist(), batch.column("turn").to_pylist(), strings(batch, "text")):
                raw = text.encode()
                rows += [(label, hash_of, raw[s : s + CHUNK_BYTES]) for s, hash_of in ((s, (turn * 31 + s * 2654435761) % 2**62) for s in range(0, len(raw), CHUNK_BYTES))]
            types = [pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows) if rows else [[]] * 3, types)], names=["label", "turn", "chunk"])

        return one

    return per_batch(labelled.select("label", "turn", "text"), make, "label int, turn bigint, chunk binary")


def _measured(labelled: DataFrame, model: Model) -> DataFrame:
    def make() -> Batch:
        sizes = model.measures()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [sizes(t.encode()) for t in strings(batch, "text")]
            columns = [pa.array(v, pa.float64()) for v in (zip(*rows) if rows else [[]] * len(_FEATURES))]
            return pa.RecordBatch.from_arrays([batch.column("label"), *columns], names=["label", *_FEATURES])

        return one

    return per_batch(labelled.select("label", "text"), make, "label int, " + ", ".join(f"{n} double" for n in _FEATURES))


def score(text: Column, model: Model) -> Column:
    """The calibrated probability of label 1 for a text column, from the whole text; NULL counts as empty."""

    def scored(texts: pa.Array) -> pa.Array:
        sizes = model.measures()
        rows = [sizes(t.encode()) for t in each(texts)]
        return pa.array(model.probability(np.array(rows, float).reshape(-1, len(_FEATURES))), pa.float64())

    scored.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(scored, "double")(text)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``. Repeated rows are scored
    alike; a row without an id counts as not held out; further columns are ignored."""
    model = fit(docs, labels, id_col, text_col, label_col)
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(held_out(col(id_col)), F.lit(False)).alias("held_out"), score(col(text_col), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
