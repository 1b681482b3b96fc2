"""Near-duplicates against brute force."""

import math
import random

import numpy as np
import pytest

from newsmill.llm import graph
from newsmill.llm import near_duplicates as near
from newsmill.llm.near_duplicates import near_duplicates


def test_pairs_at_the_least_similarity_are_missed_alike():
    below = lambda p, m: sum(math.comb(48, k) * p**k * (1 - p) ** (48 - k) for k in range(m))
    assert [near.matches_for(percent, 48) for percent in (85, 80)] == [26, 22]
    for percent in (50, 80, 85, 95):
        m = near.matches_for(percent, 48)
        assert below(percent / 100, m) < 1e-7 <= below(percent / 100, m + 1)
    assert near.matches_for(100, 48) == 48 and near.matches_for(10, 48) == 1


def shingle_set(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)}


def brute_components(docs, words, percent):
    sets = {i: shingle_set(t, words) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def corpus(seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    docs, passage = [], text(60)
    for _ in range(12):
        base = text(rnd.randrange(20, 200))
        for _ in range(rnd.randrange(1, 9)):  # copies with a few changed words, some near the threshold
            copy = list(base)
            for _ in range(rnd.randrange(0, 8)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            docs.append(" ".join(copy))
    docs += [" ".join(passage + text(60)) for _ in range(25)]  # a passage that many share
    base = text(80)
    for _ in range(45):  # a list that is longer than a short one
        copy = list(base)
        copy[rnd.randrange(80)] = rnd.choice(vocab)
        docs.append(" ".join(copy))
    docs += ["", None, "  \n", "one", "One", "one two", "A b C", "a B c", "É é", "É É"]
    order = list(range(len(docs)))
    rnd.shuffle(order)
    return [(i, docs[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("words,percent,block,few", [(3, 85, 512, 4), (5, 80, 8, 100), (3, 85, 8, 1)])
def test_components_as_by_brute_force(spark, monkeypatch, words, percent, block, few):
    """In one block; in many blocks; in many blocks after a round of stars."""
    monkeypatch.setattr(near, "BLOCK_DOCS", block)
    monkeypatch.setattr(near, "FEW_BLOCKS", few)
    docs = corpus()
    labels, sizes = brute_components(docs, words, percent)
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=words, percent=percent).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: r.component_id for r in got} == labels
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    long = " ".join(f"x{k}" for k in range(60_000))
    rows = [(1, "a b c d e f", 7), (1, "a b c d e f", 8), (None, "a b c d e f", 9), (2, "a b c d e f", 1), (3, None, 1), (4, long, 1), (5, long + " y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int").withColumnRenamed("component_id", "kept")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    n = 60_000 - 4
    expected = [(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (2, 2, 1, False), (3, 0, 3, True), (4, n, 4, True), (5, n + 1, 4, False)]
    assert got == sorted(expected, key=str)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 60)] + [(200 + rnd.randrange(80), 200 + rnd.randrange(80)) for _ in range(70)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_many_intersections_as_one_by_one():
    rnd = random.Random(2)
    sets = [np.unique(np.array([rnd.randrange(9000) for _ in range(rnd.randrange(1, 300))], np.int64)) for _ in range(80)]
    a, b = np.triu_indices(80, 1)
    many = near.shared_counts(sets, a, b)
    assert len(a) > 2048 and many.tolist() == [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b)]
    apart = [np.arange(10, dtype=np.int64) + 10 * k for k in range(80)]
    assert not near.shared_counts(apart, a, b).any()


def test_a_round_reads_its_links_without_unions(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (5, 4), (5, 3), (9, 1), (8, 1)], "a long, b long")
    large = graph._large_star(edges)
    both = graph._small_star(large.where("a <> b")).where("a <> b").distinct()
    assert "Union" not in both._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in large.collect()} == {(2, 1), (3, 1), (5, 2), (5, 4), (9, 1), (8, 1)}
    assert {tuple(r) for r in both.collect()} == {(2, 1), (3, 1), (5, 2), (4, 2), (9, 1), (8, 1)}


def test_values_shared_by_chance_form_no_cluster(spark, monkeypatch):
    """Passages in ever other company: each document shares rare values with others and is like none, but for two copies."""
    rnd = random.Random(3)
    passages = [" ".join(f"p{k}w{j}" for j in range(9)) for k in range(60)]
    docs = [(i, " ".join(rnd.sample(passages, 10))) for i in range(120)]
    docs += [(200 + i, docs[i][1] + " end") for i in range(2)]
    labels, _ = brute_components(docs, 3, 85)
    sent, compared = [], near._compared
    monkeypatch.setattr(near, "_compared", lambda members, *limits: sent.append(members.count()) or compared(members, *limits))
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in got} == labels
    assert labels[200] == 0 and labels[201] == 1 and sent == [4]


def test_lists_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near, "LIST_ROWS", 8)
    docs = corpus(seed=6)
    labels, _ = brute_components(docs, 3, 85)
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in got} == labels


@pytest.mark.parametrize("short", [2, 20, 256])
def test_rows_of_a_list_are_connected_over_like_sketches(monkeypatch, short):
    monkeypatch.setattr(near, "SHORT_LIST", short)
    rnd = np.random.default_rng(4)
    lists, nibbles, sizes = np.sort(rnd.integers(-9, 9, 300)), rnd.integers(0, 16, (300, 20)), rnd.integers(80, 110, 300)
    nibbles[:, :14] = rnd.integers(0, 2, (300, 1))  # two groups in a list, whose other coordinates differ
    words = [sum(nibbles[:, c].astype(np.uint64) << np.uint64(4 * (c % 16)) for c in range(k, min(20, k + 16))) for k in (0, 16)]
    parent = list(range(300))
    for a in range(300):
        for b in range(a):
            alike = (nibbles[a] == nibbles[b]).sum() >= 16 and 100 * min(sizes[a], sizes[b]) >= 85 * max(sizes[a], sizes[b])
            if lists[a] == lists[b] and alike and parent[a] != parent[b]:
                one, other = sorted((parent[a], parent[b]))
                parent = [one if p == other else p for p in parent]
    got = near.connected(lists, sizes, words, 4, 85)
    assert got.tolist() == parent and 50 < len(set(parent)) < 300
    assert near.connected(lists[:0], sizes[:0], [w[:0] for w in words], 4, 85).tolist() == []
