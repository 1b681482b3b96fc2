"""Non-negative learning from toxic and unlabelled texts: the risk, held-out accuracy, and odd rows."""

import random
import zlib

import numpy as np
import pytest

from newsmill.llm import toxicity
from newsmill.session import table


def numeric_risk(w, x, n_toxic, n_any, prior):
    z = np.column_stack([x, np.ones(len(x))]) @ w
    return sum(toxicity.risk(z, n_toxic, z, n_any, prior))


def test_training_lowers_the_risk_to_its_least():
    rnd = np.random.default_rng(5)
    x = rnd.integers(0, 2, (60, 4)).astype(float)
    n_toxic, n_any = (rnd.integers(0, 9, 60) * (x[:, 0] + 0.1)).round(), rnd.integers(1, 30, 60).astype(float)
    w = toxicity.train(x, n_toxic, n_any, 0.2, ridge=0.0, steps=4000, rate=0.01)
    least = numeric_risk(w, x, n_toxic, n_any, 0.2)
    assert least < numeric_risk(np.array([0, 0, 0, 0, np.log(0.25)]), x, n_toxic, n_any, 0.2)
    for _ in range(200):
        assert least <= numeric_risk(w + rnd.normal(0, 0.3, 5), x, n_toxic, n_any, 0.2) + 5e-3


def test_clean_part_of_the_risk_is_never_negative():
    toxic, clean = toxicity.risk(np.array([5.0]), np.array([10.0]), np.array([-9.0]), np.array([50.0]), 0.9)
    assert toxic > 0 and clean == 0.0
    # By hand: the loss of unlabelled rows less the prior's share of toxic ones.
    g = np.array([0.3, -1.0])
    _, clean = toxicity.risk(g, np.array([1.0, 3.0]), g, np.array([2.0, 2.0]), 0.1)
    loss = np.log(1 + np.exp(g))
    assert clean == pytest.approx(loss.mean() - 0.1 * (0.25 * loss[0] + 0.75 * loss[1]))


def corpus(n, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(3, 8))) for _ in range(400)]
    rows = []
    for k in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(20, 200))]
        toxic = k % 8 == 0
        if toxic:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(["Vile!", "grubby,", "nasty###", "ÉCHEC"]))
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_held_out_texts_and_odd_rows(spark):
    rows = corpus(900)
    odd = [(None, "vile grubby nasty"), (10_001, None), (10_002, ""), (10_003, "vile " * 60_000), (10_004, rows[0][1]), (10_004, rows[0][1]), (10_005, "w" * 300_000)]
    docs = spark.createDataFrame([(k, t, 1.0, "x") for k, t, _ in rows] + [(k, t, 1.0, "y") for k, t in odd], "doc_id long, text string, score double, toxic string")
    known = [(k, y) for k, _, y in rows if k % 5] + [(8, 1), (None, 1), (16, None), (24, 7)]
    labels = spark.createDataFrame([(k, y, "a", True) for k, y in known], "doc_id long, toxic int, text string, held_out boolean")
    got = toxicity.scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = [tuple(r) for r in got.collect()]
    assert len(out) == len(rows) + len(odd)
    assert all(h == (k is not None and zlib.crc32(str(k).encode()) % 3 == 1) for k, h, _, _ in out)
    assert all(0 <= s <= 1 and p == int(s >= 0.7) for _, _, s, p in out)
    by_id = {k: s for k, _, s, _ in out}
    truth = {k: y for k, _, y in rows}
    test = [(truth[k], s) for k, h, s, _ in out if h and k in truth]
    assert np.mean([s >= 0.7 for y, s in test if y]) >= 0.95 and np.mean([s >= 0.7 for y, s in test if not y]) <= 0.02
    assert by_id[None] > 0.7 > by_id[10_001] == by_id[10_002] and by_id[10_003] > 0.7 and by_id[10_004] == by_id[0]


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    rows = corpus(400, seed=4)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    held = {k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1}
    one = toxicity.fit(docs, spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int"))
    two = toxicity.fit(docs.repartition(7), spark.createDataFrame([(k, 1 - y if k in held else y) for k, _, y in rows[::-1]], "doc_id long, toxic int"))
    assert one.words == two.words and {b"vile", b"grubby", b"nasty"} <= set(one.words)
    assert np.allclose(one.weights, two.weights, atol=1e-9)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.scores(docs, none).collect()] == [(0.5, 0)] * 2
    clean = spark.createDataFrame([(k, 0) for k in range(20)], "doc_id long, toxic int")
    assert all(r.score < 0.01 for r in toxicity.scores(docs, clean).collect())
    assert toxicity.scores(docs.limit(0), none).count() == 0


def test_held_out_rows_of_the_tables(spark):
    folder = "/root/testdata/sf0.01"
    labels = table(spark, folder, "labels")
    scored = toxicity.scores(table(spark, folder, "documents"), labels)
    rows = scored.where("held_out").join(labels, "doc_id").select("toxic", "score").collect()
    caught = np.mean([r.score >= 0.7 for r in rows if r.toxic])
    assert caught >= 0.6 and np.mean([r.score >= 0.7 for r in rows if not r.toxic]) <= 0.02
