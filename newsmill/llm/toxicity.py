"""Toxicity scores learnt from confirmed toxic texts and unlabelled ones, without any text confirmed as clean."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm.common import SLICE_ROWS, each, strings
from newsmill.llm.divergence import terms
from newsmill.session import cut

# Bounds of what a classifier is fitted on: confirmed toxic ids, chosen by hash, and about so many unlabelled rows.
# Word counts are of all rows.
POSITIVE_DOCS = 20_000
UNLABELLED_DOCS = 40_000
# Words that are features: so many at most, in so many toxic texts at least, no longer than this in bytes, with this
# log-likelihood ratio and this share of toxic texts among those that have the word.
WORDS, LEAST_TOXIC, WORD_BYTES, LEAST_RATIO, LEAST_SHARE = 256, 3, 64, 12.0, 0.3
# A word from this share on is strong; whether and how often a text has strong words are features too.
STRONG = 0.6
# Classifiers of the ensemble, each without one part of the rows.
MEMBERS = 4
RIDGE = 3e-4
STEPS = 500
# Distinct words that a task holds before it sends them on.
HELD_WORDS = 400_000


def held_out(id_col: Column) -> Column:
    """Rows that no model may learn from: the CRC of the id as text leaves 1 when divided by 3."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk(g_toxic: np.ndarray, n_toxic: np.ndarray, g_any: np.ndarray, n_any: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the non-negative risk under logistic loss, of margins and how many rows have them: the loss
    of toxic rows taken as toxic, and the loss of clean rows taken as clean. The latter is the loss of unlabelled
    rows less the share that toxic ones have in it, and counts as zero where that is negative."""
    p, u = n_toxic / n_toxic.sum(), n_any / n_any.sum()
    toxic = prior * float(p @ np.logaddexp(0, -g_toxic))
    clean = float(u @ np.logaddexp(0, g_any)) - prior * float(p @ np.logaddexp(0, g_toxic))
    return toxic, max(0.0, clean)


def train(x: np.ndarray, n_toxic: np.ndarray, n_any: np.ndarray, prior: float, steps: int = STEPS, ridge: float = RIDGE, rate: float = 0.05) -> np.ndarray:
    """Weights, the intercept last, of a linear classifier with least non-negative risk. Row ``k`` of ``x`` stands
    for ``n_toxic[k]`` toxic and ``n_any[k]`` unlabelled rows. Where the clean part of the risk is negative, a step
    leads back up on it, so that the classifier does not overfit the toxic rows."""
    z = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    p, u = n_toxic / max(n_toxic.sum(), 1), n_any / max(n_any.sum(), 1)
    w = np.zeros(z.shape[1])
    w[-1] = math.log(prior / (1 - prior))
    penalty = np.full(len(w), ridge)
    penalty[-1] = 0
    first, second = np.zeros(len(w)), np.zeros(len(w))
    for step in range(1, steps + 1):
        g = z @ w
        s = _sigmoid(g)
        clean = u @ np.logaddexp(0, g) - prior * (p @ np.logaddexp(0, g))
        slope = u * s - prior * p * s
        slope = slope - prior * p * (1 - s) if clean >= 0 else -slope
        grad = z.T @ slope + penalty * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


@dataclass(frozen=True)
class Model:
    """``words`` in the order of their numbers, the first ``strong`` of them strong; one row of weights a member."""

    prior: float
    words: tuple[bytes, ...] = ()
    strong: int = 0
    weights: tuple[tuple[float, ...], ...] = ()

    def number(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.words)}

    def features(self, found: list[list[int]]) -> np.ndarray:
        """Of texts by the numbers of the words they have: presence of each, and of strong ones whether and how many."""
        x = np.zeros((len(found), len(self.words) + 2))
        for row, numbers in zip(x, found):
            row[numbers] = 1
        strong = x[:, : self.strong].sum(axis=1)
        x[:, -2], x[:, -1] = strong > 0, np.log1p(strong)
        return x

    def probability(self, found: list[list[int]]) -> np.ndarray:
        if not self.weights:
            return np.full(len(found), self.prior)
        w = np.mean(np.array(self.weights), axis=0)
        return _sigmoid(self.features(found) @ w[:-1] + w[-1])


def _word_counts(rows: DataFrame) -> DataFrame:
    """``word, any, toxic``: rows, and toxic rows, with each word; under a NULL word the numbers of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, toxic = Counter(), Counter()

        def drained() -> pa.RecordBatch:
            words = list(total)
            columns = [pa.array(words, pa.binary()), pa.array(list(total.values()), pa.int64()), pa.array([toxic[w] for w in words], pa.int64())]
            total.clear()
            toxic.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "any", "toxic"])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for text, flag in zip(strings(part, "text"), part.column("toxic").to_pylist()):
                    found = [None, *(w for w in set(terms(text)) if len(w) <= WORD_BYTES)]
                    total.update(found)
                    if flag:
                        toxic.update(found)
                if len(total) >= HELD_WORDS:
                    yield drained()
        yield drained()

    return rows.mapInArrow(run, "word binary, any bigint, toxic bigint").groupBy("word").agg(F.sum("any").alias("any"), F.sum("toxic").alias("toxic"))


def _likelihood_ratio(a: Column, n: float, b: Column, m: float) -> Column:
    """Twice the log-likelihood ratio of ``a`` of ``n`` against ``b`` of ``m`` being unlike shares."""
    whole = (a + b) / F.lit(n + m)
    part = lambda k, q: F.when(k > 0, k * F.ln(k / q)).otherwise(0.0)
    return 2 * (part(a, n * whole) + part(n - a, n * (1 - whole)) + part(b, m * whole) + part(m - b, m * (1 - whole)))


def _with_words(rows: DataFrame, prior: float) -> tuple[Model, int]:
    """A model with words but without weights, and how many rows there are."""
    counts = cut(_word_counts(rows).where(F.col("word").isNull() | (F.col("toxic") >= LEAST_TOXIC)))
    n = counts.where("word IS NULL").first()
    if n is None or not n["toxic"]:
        return Model(prior), n["any"] if n else 0
    share = prior * (F.col("toxic") / n["toxic"]) / ((F.col("any") + 1 / prior) / n["any"])
    ratio = _likelihood_ratio(F.col("toxic"), n["toxic"], F.col("any"), n["any"])
    rated = counts.where("word IS NOT NULL").select("word", share.alias("share"), ratio.alias("ratio"))
    best = rated.where((F.col("share") >= LEAST_SHARE) & (F.col("ratio") >= LEAST_RATIO)).orderBy(F.desc("ratio"), "word").limit(WORDS).collect()
    best.sort(key=lambda r: (r["share"] < STRONG, -r["ratio"], r["word"]))
    return Model(prior, tuple(bytes(r["word"]) for r in best), sum(r["share"] >= STRONG for r in best)), n["any"]


def _patterns(rows: DataFrame, model: Model) -> DataFrame:
    """``part, numbers, any, toxic``: how many rows of each part have which words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, found = model.number(), Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for text, flag, taken, place in zip(strings(part, "text"), *(part.column(n).to_pylist() for n in ("toxic", "taken", "part"))):
                    numbers = tuple(sorted(number[w] for w in number.keys() & terms(text)))
                    if taken:
                        found[place, numbers, 0] += 1
                    if flag:
                        found[place, numbers, 1] += 1
        keys = sorted({k[:2] for k in found})
        columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([list(k[1]) for k in keys], pa.list_(pa.int32())), *(pa.array([found[*k, j] for k in keys], pa.int64()) for j in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "numbers", "any", "toxic"])

    sent = rows.where("toxic OR taken").mapInArrow(run, "part int, numbers array<int>, any bigint, toxic bigint")
    return sent.groupBy("part", "numbers").agg(F.sum("any").alias("any"), F.sum("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learns from the rows that are not held out: those confirmed as toxic, and all of them as unlabelled ones.

    Words are chosen by their counts in all rows. Then each of ``MEMBERS`` classifiers is trained in a task of its
    own on word patterns and how many rows have them: of at most ``POSITIVE_DOCS`` toxic ids and about
    ``UNLABELLED_DOCS`` unlabelled rows, both by hash, without one part of the rows. ``prior`` is the share of toxic
    texts; if not given, it is the share among the labels that may be learnt from.

    Rows with a NULL id or label are not confirmed; a repeated label counts once. Without toxic texts, or if no word
    tells them apart, every text scores the prior (0.5 without any label).
    """
    known = labels.select(col(id_col).alias("doc_id"), col(label_col).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).distinct()
    if prior is None:
        share = known.agg(F.avg("label")).first()[0]
        prior = 0.5 if share is None else share
    prior = min(max(float(prior), 1e-6), 1 - 1e-6)
    toxic = known.where("label = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(POSITIVE_DOCS).withColumn("found", F.lit(True))
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    # Bounded by POSITIVE_DOCS.
    rows = rows.join(F.broadcast(cut(toxic)), "doc_id", "left").withColumn("toxic", F.coalesce("found", F.lit(False)))
    model, n = _with_words(rows.select("text", "toxic"), prior)
    if not model.words:
        return model
    row_hash = F.xxhash64(F.lit(11), "doc_id", "text")
    taken = F.pmod(row_hash, F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, UNLABELLED_DOCS / n))
    patterns = _patterns(rows.select("text", "toxic", taken.alias("taken"), F.pmod(F.xxhash64("doc_id"), F.lit(MEMBERS)).cast("int").alias("part")), model)
    shown = patterns.withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(MEMBERS - 1)))).where("member <> part")

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(key=[tuple(n) for n in rows["numbers"]]).sort_values(["key", "part"])  # sums in one order
        w = train(model.features([list(k) for k in rows["key"]]), rows["toxic"].to_numpy(float), rows["any"].to_numpy(float), prior)
        return pd.DataFrame({"member": rows["member"].iloc[:1], "weights": [w.tolist()]})

    trained = shown.groupBy("member").applyInPandas(one, "member int, weights array<double>").collect()
    return Model(prior, model.words, model.strong, tuple(tuple(r["weights"]) for r in sorted(trained, key=lambda r: r["member"])))


def score(text: Column, model: Model) -> Column:
    """The probability that a text is toxic, from the whole text; NULL counts as empty."""

    def scored(texts: pa.Array) -> pa.Array:
        number = model.number()
        words = number.keys()
        out = [np.empty(0)]
        found = [[number[w] for w in words & terms(t)] for t in each(texts)]
        for start in range(0, len(found), SLICE_ROWS):
            out.append(model.probability(found[start : start + SLICE_ROWS]))
        return pa.array(np.concatenate(out), pa.float64())

    scored.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(scored, "double")(text)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``. Repeated rows are scored alike; a
    row without an id counts as not held out; an empty text has no words and scores low; further columns are ignored."""
    model = fit(docs, labels, None, id_col, text_col, label_col)
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(held_out(col(id_col)), F.lit(False)).alias("held_out"), score(col(text_col), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
