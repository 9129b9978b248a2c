import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from simalign.catalog import QUERIES
from simalign.functions import setsearch, vectors
from simalign.operators import buckets, minhash
from simalign.operators import neighbours as nb
from simalign.operators import evaluate, vote
from simalign.plans import classify, lsh

SCHEMA = "fold int, doc_id long, label int, terms array<string>"


def corpus(seed, n, first=0, folds=1):
    """Skewed terms, a third exact copies of one set, some near copies and empty sets."""
    rng = random.Random(seed)
    hot = ["the", "of", "and"]
    base = sorted({f"t{int(rng.paretovariate(0.6))}" for _ in range(30)} | set(hot))
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.33:
            terms = list(base)
        elif kind < 0.45:
            terms = base[: rng.randint(1, len(base))]
        elif kind < 0.5:
            terms = []
        else:
            terms = sorted({f"t{int(rng.paretovariate(0.5))}" for _ in range(rng.randint(1, 25))} | set(hot[: rng.randint(0, 3)]))
        rows.append((rng.randrange(folds), first + i, rng.randint(0, 2), terms))
    return rows


def brute_force(train, test, k, keep=None):
    out = {}
    for fold, tid, _, terms in test:
        side = [(d, l, {t for t in ts if keep is None or t in keep}) for f, d, l, ts in train if f == fold]
        known = set().union(*[s for _, _, s in side]) if side else set()
        a = set(terms) & known
        ranked = []
        for d, label, b in side:
            union = len(a | b)
            ranked.append((0.0 if union == 0 else 1.0 - len(a & b) / union, d, label))
        out[fold, tid] = sorted(ranked)[:k]
    return out


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.fold, r.test_id), []).append((r.rank, r.dist, r.train_id, r.label))
    return {key: [t[1:] for t in sorted(v)] for key, v in out.items()}


@pytest.fixture(params=["one block", "small blocks", "small steps"])
def route(request, monkeypatch):
    if request.param == "small blocks":
        monkeypatch.setattr(nb, "GROUP_BLOCK", 5)
        monkeypatch.setattr(nb, "TEST_BLOCK", 7)
    if request.param == "small steps":
        monkeypatch.setattr(setsearch, "BLOCK", 3)
        monkeypatch.setattr(setsearch, "BATCH", 8)
    return request.param


@pytest.mark.parametrize("k", [1, 4, 15])
def test_equals_brute_force(spark, route, k):
    train, test = corpus(1, 90, folds=2), corpus(2, 40, first=1000, folds=2)
    got = nb.nearest(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), k)
    assert collected(got) == brute_force(train, test, k)


def test_limited_vocabulary_and_few_training_sets(spark, route):
    train, test = corpus(3, 6), corpus(4, 15, first=1000)
    keep = {"the", "t1", "t2", "t3"}
    kept = spark.createDataFrame([(0, t) for t in keep], "fold int, term string")
    got = nb.nearest(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), 9, kept)
    assert collected(got) == brute_force(train, test, 9, keep)


@pytest.mark.parametrize("keep", [None, {"the", "t1", "t2", "t3", "t4"}])
def test_search_among_other_folds(spark, route, keep):
    rows = corpus(5, 100, folds=3)
    kept = None
    if keep is not None:  # fold 2 knows one term less
        known = [(f, t, 1) for f in range(3) for t in sorted(keep) if (f, t) != (2, "t1")]
        kept = spark.createDataFrame(known, "fold int, term string, df long")
    got = collected(nb.nearest_elsewhere(spark.createDataFrame(rows, SCHEMA), 6, 3, kept))
    want = {}
    for f in range(3):
        train = [(0, d, l, ts) for g, d, l, ts in rows if g != f]
        test = [(0, d, l, ts) for g, d, l, ts in rows if g == f]
        mine = keep if keep is None or f != 2 else keep - {"t1"}
        want |= {(f, i): v for (_, i), v in brute_force(train, test, 6, mine).items()}
    assert got == want


def test_compared_pairs_grow_slower_than_both_sides():
    rng = np.random.default_rng(4)

    def sets(n):
        # classes with frequent and rare words of their own, and rare words all share
        values = [
            np.concatenate((1000 * (i % 16) + np.unique(rng.integers(0, 6, 4)), 1000 * (i % 16) + 6 + np.unique(rng.integers(0, 190, 40)), 20_000 + np.unique(rng.integers(0, 99, 3))))
            for i in range(n)
        ]
        return np.concatenate(values), np.concatenate(([0], np.cumsum([len(v) for v in values])))

    shares = []
    for n in (200, 800, 3200):
        (values, bounds), (asked, cut) = sets(n), sets(100)
        index = setsearch.Index.of(values, bounds, np.diff(bounds)[None, :], block=50)
        work = {}
        who, row, far = setsearch.nearest(index, index.order[None, :], asked, cut, np.zeros(100, int), 5, work=work)
        for i in range(0, 100, 17):
            mine = set(asked[cut[i] : cut[i + 1]].tolist())
            every = [(1 - len(mine & s) / len(mine | s), j) for j, s in ((j, set(values[bounds[j] : bounds[j + 1]].tolist())) for j in range(n))]
            assert [(d, j) for d, j in zip(far[who == i], index.order[row[who == i]])] == sorted(every)[:5]
        shares.append(work["pairs"] / (100 * n))
    assert shares[0] > 2 * shares[1] and shares[2] <= shares[1] < 0.1  # a class is a sixteenth


def texts(rows):
    return [(d, " ".join(t), l) for _, d, l, t in rows]


TEXTS = "doc_id long, text string, label int"


def test_own_metric_on_given_pairs(spark):
    rows = [(1, 10, [1, 2], [1, 2]), (1, 11, [1, 2], [3]), (1, 12, [1, 2], [2, 1, 5]), (2, 10, [9], [1, 2])]
    df = spark.createDataFrame(rows, "test_id long, train_id long, x array<int>, y array<int>")
    got = nb.rank_pairs(df, vectors.distance_sets, 2).collect()
    assert {(r.test_id, r.train_id, r.rank) for r in got} == {(1, 10, 1), (1, 12, 2), (2, 10, 1)}


def test_vote_and_k(spark):
    rows = [(1, 1, 2), (1, 2, 1), (1, 3, 2), (1, 4, 1)]
    df = spark.createDataFrame(rows, "test_id int, rank int, label int")
    assert vote.vote(df, "test_id").first().pred == 1
    many = vote.vote_many_k(df, F.array(F.lit(1), F.lit(3), F.lit(4)), "test_id")
    assert {r.k: r.pred for r in many.collect()} == {1: 2, 3: 2, 4: 1}
    ns = [1, 2, 4, 10, 224, 225, 10000]
    assert [vote.adaptive_k(n) for n in ns] == [1, 2, 2, 4, 15, 15, 15]
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    assert [r.k for r in df.select(vote.adaptive_k_column(F.col("n")).alias("k")).collect()] == [1, 2, 2, 4, 15, 15, 15]


def test_scores(spark):
    rows = [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (2, 2)]
    df = spark.createDataFrame(rows, "label int, pred int")
    got = evaluate.scores(df).first()
    f1 = [2 * 1 / 3, 2 * 1 / 4, 2 * 2 / 5]
    assert got.accuracy == pytest.approx(4 / 6) and got.macro_f1 == pytest.approx(sum(f1) / 3)


def test_band_params():
    # published S-curve, midpoint rule
    table = {(16, 0.8): (2, 8), (32, 0.5): (8, 4), (64, 0.3): (21, 3), (64, 0.2): (28, 2), (64, 1.0): (1, 64), (16, 0.05): (16, 1)}
    for (perms, threshold), want in table.items():
        assert minhash.band_params(perms, threshold) == want
        assert want[0] * want[1] <= perms


def test_signatures_estimate_similarity(spark):
    a = [f"w{i}" for i in range(100)]
    b = [f"w{i}" for i in range(50, 150)]
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (3, " ")], "doc_id long, text string")
    sig = {r.doc_id: r.sig for r in lsh.signed(df, "doc_id").collect()}
    assert set(sig) == {1, 2}
    assert abs(sum(x == y for x, y in zip(sig[1], sig[2])) / 64 - 1 / 3) < 0.2
    short = {r.doc_id: r.sig for r in lsh.signed(df, "doc_id", perms=16).collect()}
    assert short[1] == sig[1][:16]


@pytest.mark.parametrize("blocks", [4096, 3])
def test_bucket_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", blocks)
    rng = random.Random(5)
    left = [(rng.randrange(3), rng.choice("aab"), i) for i in range(30)]
    right = [(rng.randrange(3), rng.choice("aab"), 100 + i) for i in range(40)]
    got = minhash.bucket_pairs(
        spark.createDataFrame(left, "band int, band_key string, test_id long"),
        spark.createDataFrame(right, "band int, band_key string, gid long"),
        ["band", "band_key"], "test_id", "gid",
    ).collect()
    want = {(x, y) for b, k, x in left for c, m, y in right if (b, k) == (c, m)}
    assert len(got) == len(want) and {(r.test_id, r.gid) for r in got} == want


@pytest.mark.parametrize("local", [False, True])
@pytest.mark.parametrize("sizes", ["usual", "small"])
def test_lsh_routes(spark, local, sizes, monkeypatch):
    if sizes == "small":
        for name, value in {"BLOCK_ROWS": 4, "CELLS": 30, "PAIRS": 7, "INDEX_BLOCK": 3}.items():
            monkeypatch.setattr(buckets, name, value)
    train, test = texts(corpus(8, 60)), texts(corpus(9, 30, first=1000))
    tr, te = spark.createDataFrame(train, TEXTS), spark.createDataFrame(test, TEXTS)
    got = {r.doc_id: r for r in lsh.knn_lsh(tr, te, 64, 0.5, local).collect()}
    assert set(got) == {d for d, _, _ in test}
    pairs = {}
    for r in lsh.lsh_candidates(tr, te, 64, 0.5).collect():
        pairs.setdefault(r.test_id, set()).add(r.train_id)
    words = {d: {w for w in t.split() if len(w) > 1} for d, t, _ in train + test}
    labels = {d: l for d, _, l in train}
    everything = set().union(*[words[d] for d in labels])
    for d, _, _ in test:
        candidates = pairs.get(d, set())
        assert (got[d].route == "lsh") == bool(candidates) and got[d].n_candidates == len(candidates)
        pool = candidates or set(labels)
        known = set().union(*[words[c] for c in pool]) if local and candidates else everything
        a = words[d] & known
        ranked = sorted((0.0 if not a | words[c] else 1.0 - len(a & words[c]) / len(a | words[c]), c) for c in pool)
        near = [labels[c] for _, c in ranked[: vote.adaptive_k(len(pool))]]
        assert got[d].pred == min(set(near), key=lambda x: (-near.count(x), x))


def test_lsh_equals_brute_force_when_all_are_candidates(spark, monkeypatch):
    monkeypatch.setattr(minhash, "band_params", lambda perms, threshold: (1, 0))
    train, test = corpus(8, 60), corpus(9, 20, first=1000)
    train, test = ([r for r in rows if r[3]] for rows in (train, test))
    tr, te = (spark.createDataFrame(texts(rows), TEXTS) for rows in (train, test))
    monkeypatch.setattr(lsh, "signed", lambda docs, *keys, perms: docs.select(*keys, F.array(F.lit(1)).cast("array<bigint>").alias("sig")))
    a = {r.doc_id: r.pred for r in lsh.knn_lsh(tr, te, 64, 0.1).collect()}
    b = {r.doc_id: r.pred for r in classify.knn_bruteforce(tr, te).collect()}
    assert a == b


def test_the_least_shared_terms_miss_no_pair_at_the_limit():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60_000, 400), rng.integers(0, 60_000, 300)
    shared = np.minimum(rng.integers(0, 60_000, (400, 300)), np.minimum(a[:, None], b[None, :]))
    far = setsearch.distance(shared.astype(float), a[:, None], b[None, :])
    at = far[np.arange(400), rng.integers(0, 300, 400)]  # distances of pairs that are there, so ties with the limit
    near = shared >= setsearch.least_shared(a, b[None, :], at)
    assert near[far <= at[:, None]].all() and near.sum() < 1.01 * (far <= at[:, None]).sum()
    assert (setsearch.least_shared(a, b[None, :], np.full(400, np.inf)) <= 0).all()


def test_wider_blocks_only_where_no_set_repeats_a_term():
    import pyarrow as pa

    def searched(*ids):
        n = len(ids)
        return nb.Searched(pa.table({
            "ids": pa.array(ids, pa.list_(pa.int64())), "sizes": pa.array([[len(x)] for x in ids], pa.list_(pa.int32())),
            "member_ids": pa.array([[i] for i in range(n)], pa.list_(pa.int64())), "labels": pa.array([[0]] * n, pa.list_(pa.int32())),
            "owns": pa.array([[-1]] * n, pa.list_(pa.int32())),
        }))

    def asked(made, *ids):
        values, cut = setsearch.lists(pa.array(ids, pa.list_(pa.int64())))
        found = made.nearest(values, cut, np.zeros(len(ids), int), np.full(len(ids), np.inf), 1)
        return sorted(made.indexes), found[1].tolist()

    made = searched([1, 2], [2, 3], [], [3])
    assert asked(made, [1, 2], [], [3], [3]) == ([True], [0, 2, 3, 3])
    assert asked(made, [1, 2], [2, 2, 3, 3]) == ([False, True], [0, 1])
    assert asked(searched([1, 2], [2, 2]), [1, 2]) == ([False], [0])


def test_a_pair_comes_from_the_first_band_it_shares_and_full_buckets_are_cut_on_both_sides(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 5)
    monkeypatch.setattr(minhash, "TASK_PAIRS", 50)
    rng = random.Random(2)
    bands, rows = 3, 3
    sides = [[(i, [rng.randrange(2) for _ in range(bands * rows)]) for i in range(n)] for n in (30, 40)]

    def banded(side, id_col, out):
        signed = spark.createDataFrame(side, f"{id_col} long, sig array<bigint>")
        codes = minhash.band_codes(F.col("sig"), bands, rows, out)
        return minhash.band_rows(signed.select("*", *codes), bands, rows, id_col, *[f"{out}{i}" for i in range(len(codes))])

    got = minhash.bucket_pairs(
        minhash.earlier_codes(banded(sides[0], "a", "_x"), "_x", bands, rows), banded(sides[1], "b", "_y"), ["band", "band_key"], "a", "b",
        once=minhash.first_shared("_x", "_y", bands, rows),
    ).collect()
    want = {(i, j) for i, x in sides[0] for j, y in sides[1] if any(x[s : s + rows] == y[s : s + rows] for s in range(0, bands * rows, rows))}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_signatures_do_not_travel_with_terms(spark):
    rows = [(0, 1, 0, ["a", "b"], [7, 8]), (0, 1, 0, ["a", "b"], [7, 8]), (0, 2, None, ["b", "z"], [9, 9]), (0, None, 1, [], None)]
    sets = spark.createDataFrame(rows, "fold int, doc_id long, label int, terms array<string>, sig array<long>")
    terms = spark.createDataFrame([(0, "a", 2, 1, 10), (0, "b", 3, 1, 11)], "fold int, term string, df long, mask long, term_id long")
    encoded = nb.encode_sets(sets, terms, "sig")
    got = {r["doc_id"]: (r["ids"], r["sig"]) for r in encoded.collect()}
    assert got == {1: ([11, 11, 10, 10], [7, 8]), 2: ([11], [9, 9]), None: ([], None)}
    plan = encoded._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "Generate explode" in line]
    assert below and not any("sig#" in line for line in below)


def test_a_study_that_is_read_twice_searches_once(spark, tmp_path):
    rows = [(d, " ".join(t), ["de", "en"][l % 2]) for _, d, l, t in corpus(23, 40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["representation_study"].run(spark, str(tmp_path))
    assert "MapInArrow" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.n for r in found.collect()} == {4}


def test_long_lists_are_not_sorted_for_every_few_new_rows(monkeypatch):
    rng = np.random.default_rng(8)
    sorts = []
    first_of = setsearch.first_of
    monkeypatch.setattr(setsearch, "first_of", lambda *rest: sorts.append(1) or first_of(*rest))
    best, bound, every = setsearch.Best([np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)], 2, 1, 40), np.full(3, np.inf), []
    for i in range(100):
        rows = [rng.integers(0, 3, 9), rng.integers(0, 500, 9), rng.integers(0, 6, 9) / 8]
        kept = rows[2] <= bound[rows[0]]
        every += zip(*(x.tolist() for x in rows), strict=True)
        best.add([x[kept] for x in rows], bound)
    who, ids, far = (x.tolist() for x in best.merged(bound))
    want = [(f, i) for o in range(3) for f, i in sorted((f, i) for w, i, f in every if w == o)[:40]]
    assert list(zip(far, ids, strict=True)) == want and who == sorted(who)
    assert len(sorts) < 40 and bound.tolist() == [far[o * 40 + 39] for o in range(3)]
