"""Near-duplicate classes against all pairs."""

import random

import brute
import numpy as np
import pytest

from simalign.llm import near_dups

WORDS = [f"w{i}" for i in range(400)]


def corpus(seed):
    """Groups of exact and near copies around one base, and unrelated texts."""
    rng = random.Random(seed)
    base = [rng.choice(WORDS) for _ in range(90)]
    rows, n = [], 0
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        rows.append((n, " ".join(copy)))
        n += 1
    rows += [(n + i, " ".join(base).upper()) for i in range(20)]
    n += 20
    rows += [(n + i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 2, 4, 40])))) for i in range(60)]
    rng.shuffle(rows)
    return [(i, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 85, 1024), (3, 85, 7), (5, 80, 16)])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(near_dups, "BLOCK_NODES", block)
    rows = corpus(percent + k)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dups.near_duplicates(docs, k=k, similarity=percent / 100).collect()
    sets = {i: brute.shingles(t, k) for i, t in rows}
    want = brute.components(sets, percent)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}


def test_edge_rows_have_a_defined_class(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t", "x"), (4, "One", "x"), (5, "one", "x"), (6, "one two", "x"), (7, "ONE  two", "x"),
            (None, "null id text", "x"), (None, "null id text", "x"), (None, "one", "x"), (8, "very " * 50_000, "x"), (8, "very " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert got == {
        (1, 0): 1, (2, 0): 2, (3, 0): 3, (4, 1): 4, (5, 1): 4, (6, 1): 6, (7, 1): 6, (None, 1): got[(None, 1)], (8, 1): 8,
    }
    kept = near_dups.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect()), key=str) == sorted(
        [(1, ""), (2, ""), (3, " \t"), (4, "One"), (6, "one t"), (None, "null "), (8, "very ")], key=str
    )
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dups.near_duplicates(empty).count() == 0 and near_dups.keep_one(empty).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 100), (5, 5)], "a long, b long")
    labels = {r["node"]: r["label"] for r in near_dups.components(edges).collect()}
    assert labels == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_odd_sketches_estimate_high_similarity():
    sampler = near_dups.Sampler(24)
    rng = np.random.default_rng(1)
    limit = near_dups.sketch_limit(0.85, sampler.samples)
    passed = {}
    for shared in (0.95, 0.85, 0.6):
        n = round(1000 * 2 * shared / (1 + shared))
        close = 0
        for _ in range(40):
            a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            b = np.concatenate((a[:n], rng.integers(0, 1 << 63, 1000 - n, dtype=np.uint64)))
            x, y = (np.frombuffer(sampler.sketch(sampler.minima(s)), np.uint64) for s in (a, b))
            close += np.bitwise_count(x ^ y).sum() <= limit
        passed[shared] = close
    assert passed[0.95] == passed[0.85] == 40 and passed[0.6] == 0
