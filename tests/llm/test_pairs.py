"""Near-duplicates of documents (op10) and vectors (op2) against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import docs, sentence, words_of


def components(nodes, links):
    root = {i: i for i in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in nodes}


def shingles(text, k):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words_of(text)]
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def expect_docs(rows, k):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c, c == i) for i, c in components(ids, links).items()}


def varied(rng, base, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in base.split())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows = []
    for g in range(6):  # groups of copies whose similarities lie on both sides of 0.8
        base = sentence(rng, 120)
        rows += [varied(rng, base, rng.choice([0, 0.02, 0.05, 0.08])) for _ in range(12)]
    rows += [sentence(rng, rng.randrange(1, 80)) for _ in range(60)]
    rows += ["", "One", "one", "ONE two", "one two", "a b c", "\x0bA\tB\nc\x0c", None, "   ", "É é", "é É", "word " * 5000]
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("k", [2, 5])
def test_documents_against_brute_force(spark, corpus, k):
    from graphloom.llm.near_dup import near_duplicates

    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(spark, corpus, extra=True), k).collect()}
    assert got == expect_docs(corpus, k)


def test_buckets_the_star_leaves_apart_are_compared_in_full(spark, monkeypatch):
    """Many documents around 0.8 to each other, and tiles of a few rows."""
    from graphloom.llm import near_dup

    monkeypatch.setattr(near_dup, "CHUNK_ROWS", 7)
    rng = random.Random(8)
    base = sentence(rng, 150)
    rows = [(i, varied(rng, base, 0.055)) for i in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs(spark, rows), 2).collect()}
    expected = expect_docs(rows, 2)
    assert got == expected
    assert 1 < len({c for _, c, _ in expected.values()}) < 60


def test_one_of_each(spark, corpus):
    from graphloom.llm.near_dup import one_of_each

    rows = corpus + [corpus[0], corpus[0], (None, "no id here"), (None, None)]
    kept = one_of_each(docs(spark, rows, extra=True), 5)
    assert kept.columns == docs(spark, [], extra=True).columns
    expected = sorted(i for i, (_, _, k) in expect_docs(corpus, 5).items() if k)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == expected and ids.count(None) == 2


def test_no_documents(spark):
    from graphloom.llm.near_dup import near_duplicates, one_of_each

    assert near_duplicates(docs(spark, []), 2).count() == 0
    assert one_of_each(docs(spark, []), 2).count() == 0


def test_odd_sketch_estimates():
    from graphloom.llm.shingles import Sketcher, mix, most_flips, similarity

    rng, sk, got = np.random.RandomState(1), Sketcher(32, 5, 512), []
    for _ in range(60):
        x = np.unique(mix(rng.randint(0, 2**62, 600).astype(np.uint64)))
        a, b = sk.samples(x[:500]), sk.samples(x[56:556])
        flips = int(np.bitwise_count(sk.odd(a).view(np.uint64) ^ sk.odd(b).view(np.uint64)).sum())
        assert flips <= most_flips(0.8, 512, 160, 5.2)
        got.append(similarity(flips, 512, 160))
    assert abs(np.mean(got) - 444 / 556) < 0.03


def expect_vectors(rows, cosine):
    good = {i: np.asarray(v, float) for i, v in rows
            if v is not None and len(v) and None not in v and np.isfinite(np.asarray(v, float)).all() and any(v)}
    ids = sorted(good)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if len(good[a]) == len(good[b])
             and good[a] @ good[b] / (np.sqrt(good[a] @ good[a]) * np.sqrt(good[b] @ good[b])) >= cosine]
    n = {i: 0 for i, _ in rows}
    for p in links:
        for i in p:
            n[i] += 1
    comp = components([i for i, _ in rows], links)
    return {i: (n[i], comp[i], comp[i] == i) for i, _ in rows}


@pytest.mark.parametrize("chunk", [2048, 16])
def test_vectors_against_brute_force(spark, monkeypatch, chunk):
    from graphloom.llm import subspace

    monkeypatch.setattr(subspace, "CHUNK", chunk)
    monkeypatch.setattr(subspace, "STRIP", 5)
    monkeypatch.setattr(subspace, "WHOLE_CHUNK", chunk)
    rng = np.random.RandomState(3)
    rows = [rng.standard_normal(64).tolist() for _ in range(150)]
    for c in range(5):  # clusters whose cosines lie on both sides of 0.95
        base = rng.standard_normal(64)
        rows += [(base + rng.standard_normal(64) * s).tolist() for s in (0.1, 0.15, 0.16, 0.17, 0.2) for _ in range(6)]
    rows += [rows[0], rows[0], [3 * x for x in rows[1]], None, [], [0.0] * 64, [float("nan")] * 64, [1.0, None], [1.0, 2.0], [2.0, 4.0],
             [float("inf"), 1.0], [-0.0, 1.0], [0.0, 1.0]]
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("cls", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in subspace.vector_duplicates(df).collect()}
    expected = expect_vectors(rows, 0.95)
    assert got == expected
    assert sum(n for n, _, _ in expected.values()) > 100


def test_no_vectors(spark):
    from graphloom.llm.subspace import vector_duplicates

    assert vector_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_one_of_each_where_a_doc_id_has_two_texts(spark):
    """Text A of document 7 stands for its group though text B of 7 is a copy of document 3."""
    from graphloom.llm.near_dup import one_of_each

    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    d = docs(spark, [(3, b), (7, a), (7, b), (9, a), (7, a)])
    assert sorted((r.doc_id, r.text) for r in one_of_each(d, 5).collect()) == [(3, b), (7, a)]
