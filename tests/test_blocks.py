import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from simalign.functions import setsearch
from simalign.operators import blocks, shapes
from simalign.operators import neighbours as nb
from simalign.plans import lsh
from tests.test_neighbours import SCHEMA, brute_force, collected, corpus


def small(monkeypatch):
    monkeypatch.setattr(nb, "GROUP_BLOCK", 5)
    monkeypatch.setattr(nb, "TEST_BLOCK", 7)
    monkeypatch.setattr(nb, "LEAST_TESTS", 4)


def test_a_search_returns_k_rows_a_test_however_many_blocks(spark, monkeypatch):
    small(monkeypatch)
    ranked = []
    top = nb._top
    monkeypatch.setattr(nb, "_top", lambda df, keys, order, k, *out: ranked.append((keys, df)) or top(df, keys, order, k, *out))
    train, test = corpus(11, 80, folds=2), corpus(12, 30, first=1000, folds=2)
    got = nb.nearest(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), 4)
    assert collected(got) == brute_force(train, test, 4)
    lists = [df for keys, df in ranked if "test_id" in keys]
    assert len(lists) == 1 and lists[0].count() == 4 * len(test)


def test_sets_are_not_shuffled_by_the_block(spark, monkeypatch):
    small(monkeypatch)
    train, test = corpus(13, 80), corpus(14, 30, first=1000)
    met = []
    beside = blocks.beside
    monkeypatch.setattr(blocks, "beside", lambda groups, tests, *rest: met.append((groups.count(), tests.count())) or beside(groups, tests, *rest))
    got = nb.nearest(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), 3)
    plan = got._jdf.queryExecution().toString()
    assert met and met[0][0] > 5 and met[0][1] == len(test) and "CartesianProduct" in plan


def test_lists_of_shapes_do_not_grow_with_blocks(spark, monkeypatch):
    rows = [r for r in corpus(15, 90, folds=3)]
    signed = spark.createDataFrame(rows, SCHEMA).withColumn("sig", F.when(F.size("terms") > 0, F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda i: F.array_min(F.transform("terms", lambda t: F.pmod(F.xxhash64(t, i), F.lit(1000))))
    )))
    encoded = nb.stage(nb.encode_sets(signed, nb.vocabulary_elsewhere(signed, 3), "sig", folds=3))
    groups = nb.stage(nb.collapse(encoded, 4, "sig", counted=True))

    def run(local):
        out = shapes.shape_lists(groups, nb.queries_of(encoded, "sig"), [(4, 2), (8, 1)], 4, local).collect()
        best = {}
        for r in out:
            best.setdefault((r.shape, r.test_id), []).append((r.dist, r.train_id, r.label, r.n))
        total = {key: sum(x[3] for x in v) for key, v in best.items()}
        return out, {key: sorted(x[:3] for x in v)[:4] for key, v in best.items()}, total

    for local in (False, True):
        _, one, n_one = run(local)
        with monkeypatch.context() as m:
            small(m)
            m.setattr(shapes, "STEP", 8)
            m.setattr(shapes, "INDEX_BLOCK", 3)
            out, many, n_many = run(local)
        assert one == many and n_one == n_many
        sizes = {}
        for r in out:
            sizes[r.shape, r.test_id] = sizes.get((r.shape, r.test_id), 0) + 1
        assert max(sizes.values()) <= 4  # before: four for every block


def test_agreeing_rows_as_bits():
    rng = np.random.default_rng(3)
    for rows in (1, 7, 8, 13, 64):
        a, b = rng.integers(0, 3, (5, rows)).astype(np.int32), rng.integers(0, 3, (6, rows)).astype(np.int32)
        want = [[sum(1 << r for r in range(rows) if x[r] == y[r]) for y in b.tolist()] for x in a.tolist()]
        assert shapes.agreeing(a, b).tolist() == want


def test_candidates_move_their_sets_once_not_for_every_band(spark, monkeypatch):
    rows = [(d, " ".join(t), l) for _, d, l, t in corpus(16, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    run = lsh.prepare(docs.filter("doc_id % 3 > 0"), docs.filter("doc_id % 3 = 0"), 64, [0.2, 0.5])
    met = []
    beside = blocks.beside
    monkeypatch.setattr(blocks, "beside", lambda groups, tests, *rest: met.append(tests.count()) or beside(groups, tests, *rest))
    plan = lsh.by_candidates(run)._jdf.queryExecution().toString()
    assert met == [run.queries.filter("sig IS NOT NULL").count()] and "CartesianProduct" in plan


def test_the_rows_of_a_block_come_once_to_a_task(spark):
    groups = blocks.group_blocks(spark.range(12).selectExpr("0 AS fold", "int(id % 3) AS g_block", "id"), 4)
    packed = blocks._packed(spark.range(40).selectExpr("0 AS fold", "id").repartitionByRange(2, "id").sortWithinPartitions("id"), 1, 7, "t")
    met = blocks._crossed(groups, packed).collect()
    tests = {r.t_no for r in met}
    assert len(tests) > 2 and len(met) == 3 * len(tests)
    tasks = {t >> 32 for t in tests}
    assert sorted(r.t_no for r in met if r.t_rows is not None) == sorted(tests)  # before: with every group
    assert sorted((r.g_no, r.t_no >> 32) for r in met if r.g_rows is not None) == sorted({(r.g_no, t) for r in met for t in tasks})


def test_runs_are_given_out_before_they_end():
    import pyarrow as pa

    read = []

    def batches():
        for i in range(6):
            read.append(i)
            yield pa.RecordBatch.from_pydict({"k": [0] * 5 if i < 5 else [1] * 5, "v": list(range(5 * i, 5 * i + 5))})

    out, seen = [], []
    for run in blocks.runs(batches(), 1, 7):
        out.append((run["k"].to_pylist()[0], run["v"].to_pylist()))
        seen.append(len(read))
    assert [len(v) for _, v in out] == [7, 7, 7, 4, 5] and [x for _, v in out for x in v] == list(range(30))
    assert [k for k, _ in out] == [0, 0, 0, 0, 1] and seen[0] == 2


def test_shapes_of_equal_rows_are_read_off_one_run():
    rng = np.random.default_rng(5)
    made = [(6, 2), (28, 2), (12, 2), (7, 1), (64, 1), (3, 5), (12, 5), (1, 64)]
    bits, met = rng.integers(0, 2**63, (9, 40)).astype(np.uint64), rng.random((9, 40)) < 0.8
    bits[0, :5] = np.iinfo(np.uint64).max
    tests = shapes.Tests.__new__(shapes.Tests)
    tests.shapes = made
    got = {}
    for alike, places, run in tests.families(met, bits):
        for bands, s in alike:
            got[s] = places[run & shapes.band_starts(bands, made[s][1]) != 0].tolist()
    assert got == {s: np.flatnonzero(met & shapes.share_band(bits, *shape)).tolist() for s, shape in enumerate(made)}


def test_terms_held_under_many_shapes_at_once():
    rng = np.random.default_rng(6)
    sets = [np.sort(rng.choice(60, rng.integers(0, 9), replace=False)) for _ in range(30)]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    index = setsearch.Index.of(np.concatenate(sets), bounds, np.diff(bounds)[None, :], 30, 10)
    asked = [np.sort(rng.choice(70, 12, replace=False)) for _ in range(7)]
    valid = rng.integers(0, 2**20, (7, 30)).astype(np.uint64) * (rng.random((7, 30)) < 0.3)
    got = index.blocks[0].held(index.known(np.concatenate(asked)), np.arange(8) * 12, valid.astype(np.uint64))
    want = [
        int(np.bitwise_or.reduce([valid[i, j] for j, g in enumerate(index.order) if term in sets[g]], initial=0, dtype=np.uint64))
        for i, terms in enumerate(asked) for term in terms
    ]
    assert got.tolist() == want


def test_a_value_is_bounded_by_its_terms_too(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ELEMENTS", 20)
    sizes = [3, 50, 7, 7, 0, 7, 20, 1]
    table = pa.table({"id": list(range(8)), "ids": [list(range(n)) for n in sizes]})
    parts = [part.column("id").to_pylist() for part in blocks.lighter(table, 20)]
    assert parts == [[0], [1], [2, 3, 4], [5], [6], [7]]
    small(monkeypatch)
    rows = corpus(31, 90)
    train, test = (spark.createDataFrame(side, SCHEMA) for side in (rows[:60], rows[60:]))
    assert collected(nb.nearest(train, test, 3)) == brute_force(rows[:60], rows[60:], 3)
    packed = blocks.group_blocks(spark.createDataFrame([(0, 0, [1] * 15)] * 4, "fold int, g_block int, ids array<long>"), 4096)
    assert packed.count() == 4  # before: one value of 60 elements
