import math
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from simalign.functions import vectors, warp
from simalign.operators import dtw

SHORT = ([1, 1, 2, 3, 2, 0], [0, 1, 1, 2, 3, 2, 1])
SEQ1 = [0, 0, 0, 0.2, 1, 1.5, 1.5, 0, -1, 0, 0]
SEQ2 = [0, 0, 0, 1.5, 1.5, -0.2, -1, -0.5, 0, 0, 0, 0.5, 0]
SEQ3 = [i / 9 for i in range(11)]


def pairs(spark, *rows):
    data = [(i, None if a is None else [float(x) for x in a], None if b is None else [float(x) for x in b])
            for i, (a, b) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, a array<double>, b array<double>")


def plain_distance(a, b):
    """Cell by cell."""
    cost = [[math.inf] * (len(b) + 1) for _ in range(len(a) + 1)]
    cost[0][0] = 0.0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            cost[i][j] = abs(x - y) + min(cost[i - 1][j - 1], cost[i - 1][j], cost[i][j - 1])
    return cost[-1][-1]


def kernel(a, b, cost="abs"):
    n, m = np.array([len(a)]), np.array([len(b)])
    return warp.distances(np.array([a], float), np.array([b], float), n, m, cost)[0]


def test_golden_distances(spark):
    df = pairs(spark, SHORT, (SEQ1, SEQ2), (SEQ1, SEQ3))
    got = {r.id: r.distance for r in dtw.dtw_distance(df).collect()}
    assert got[0] == 2.0
    assert got[1] == pytest.approx(1.9)
    assert got[2] == pytest.approx(7.266666666666666)
    for variant in ("sq", "sqrt"):
        assert dtw.dtw_distance(pairs(spark, SHORT), variant).first().distance == pytest.approx(2.0)


def test_golden_matrix_and_paths(spark):
    cells = dtw.dtw_cost_matrix(pairs(spark, SHORT)).orderBy("i", "j").collect()
    rows = [[c.cost for c in cells[i * 7 : (i + 1) * 7]] for i in range(6)]
    assert rows == [
        [1, 1, 1, 2, 4, 5, 5], [2, 1, 1, 2, 4, 5, 5], [4, 2, 2, 1, 2, 2, 3],
        [7, 4, 4, 2, 1, 2, 4], [9, 5, 5, 2, 2, 1, 2], [9, 6, 6, 4, 5, 3, 2],
    ]
    path = dtw.dtw_path(pairs(spark, SHORT, (SEQ1, SEQ2), (SEQ1, SEQ3))).orderBy("id", "step").collect()
    steps = {k: [(r.i, r.j) for r in path if r.id == k] for k in range(3)}
    assert steps[0] == [(5, 6), (4, 5), (3, 4), (2, 3), (1, 2), (0, 1), (0, 0)]
    assert steps[1] == [
        (10, 12), (9, 11), (9, 10), (9, 9), (9, 8), (8, 7), (8, 6), (7, 5), (6, 4), (5, 3), (4, 3), (3, 2),
        (2, 1), (1, 0), (0, 0),
    ]
    assert steps[2] == [
        (10, 10), (9, 9), (8, 8), (7, 7), (6, 7), (5, 6), (4, 5), (3, 4), (3, 3), (3, 2), (3, 1), (2, 0),
        (1, 0), (0, 0),
    ]


def test_unusable_series(spark):
    df = pairs(spark, ([], [1]), (None, [1]), ([1], [float("nan")]), ([2], [5]))
    got = {r.id: r.distance for r in dtw.dtw_distance(df).collect()}
    assert got == {0: None, 1: None, 2: None, 3: 3.0}
    assert dtw.dtw_path(df).count() == 1


values = st.lists(st.integers(-50, 50).map(lambda x: x / 4), min_size=1, max_size=25)


@settings(max_examples=60, deadline=None)
@given(values, values)
def test_kernel_properties(a, b):
    assert kernel(a, b) == plain_distance(a, b) == kernel(b, a)
    assert kernel(a, a) == 0
    if len(a) == len(b):
        assert kernel(a, b) <= sum(abs(x - y) for x, y in zip(a, b))
    total, codes = warp.strip(np.array(a), np.array(b), "abs")
    assert total[-1, -1] == kernel(a, b)
    path = warp.walk_back(codes)
    assert path[0] == (len(a) - 1, len(b) - 1) and path[-1] == (0, 0)
    assert sum(abs(a[i] - b[j]) for i, j in path) == kernel(a, b)


def test_padded_batches_do_not_change_distances(spark):
    rng = np.random.default_rng(7)
    rows = [(list(rng.normal(size=rng.integers(1, 60))), list(rng.normal(size=rng.integers(1, 60)))) for _ in range(80)]
    got = {r.id: r.distance for r in dtw.dtw_distance(pairs(spark, *rows)).collect()}
    for i, (a, b) in enumerate(rows):
        assert got[i] == plain_distance(a, b)


def test_l1_and_series_literals(spark):
    a, b = F.col("a"), F.col("b")
    df = pairs(spark, (SEQ1, SEQ2), (SEQ1, SEQ3))
    l1 = df.select(vectors.l1_timestep(a, vectors.truncate_overlap(b, a)).alias("x")).collect()
    assert [round(r.x, 6) for r in l1] == [7.5, 7.577778]
    texts = ["[1, 2.5, -3e1]", "[1., .5]", "(1, 2)", "[]", "[1,]", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    parsed = [r.v for r in df.select(vectors.parse_series(F.col("s")).alias("v")).collect()]
    assert parsed == [[1.0, 2.5, -30.0], [1.0, 0.5], [1.0, 2.0], [], [1.0], None]


def whole_path(a, b, cost="abs", cells=1 << 22):
    return [tuple(map(int, step)) for piece in warp.path(a, b, cost, cells) for step in piece]


@settings(max_examples=80, deadline=None)
@given(values, values, st.integers(1, 60), st.sampled_from(["abs", "sq", "sqrt"]))
def test_halved_paths_are_those_of_the_matrix(a, b, cells, cost):
    a, b = np.array(a) / 3, np.array(b) / 3  # sums that round
    _, codes = warp.strip(a, b, cost)
    assert whole_path(a, b, cost, cells) == warp.walk_back(codes)


def test_halved_paths_with_many_ties():
    rng = np.random.default_rng(4)
    for n, m in [(1, 1), (1, 9), (8, 1), (2, 2), (5, 9), (90, 70), (3, 200), (150, 150)]:
        for top in (1, 2, 4):
            a, b = rng.integers(0, top, n) * 0.1, rng.integers(0, top, m) * 0.1
            want = warp.walk_back(warp.strip(a, b, "abs")[1])
            assert all(whole_path(a, b, "abs", cells) == want for cells in (1, 7, 100, 5000))


def test_paths_end_with_infinite_values():
    a, b = np.array([np.inf, 1.0, -np.inf, 2.0] * 4), np.array([1.0, np.inf, 3.0] * 3)
    path = whole_path(a, b, "abs", 8)
    assert path[0] == (15, 8) and path[-1] == (0, 0)
    assert all((i - k, j - l) in {(1, 1), (1, 0), (0, 1)} for (i, j), (k, l) in zip(path, path[1:]))


def test_memory_of_a_path_is_linear():
    a = np.sin(np.arange(6000) / 50)
    tracemalloc.start()
    path = whole_path(a, a[:5000], "abs", 1 << 18)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert path[0] == (5999, 4999) and path[-1] == (0, 0)
    assert peak < 8e6  # the codes alone would take 30 MB
    assert kernel(a, a[:5000]) == pytest.approx(sum(abs(a[i] - a[j]) for i, j in path))


def test_strips_are_the_whole_matrix(spark):
    rng = np.random.default_rng(5)
    rows = [(list(rng.normal(size=n)), list(rng.normal(size=m))) for n, m in [(1, 1), (1, 30), (30, 1), (37, 11), (12, 45)]]
    df = pairs(spark, *rows, (None, [1]))
    want = {tuple(r) for r in dtw.dtw_cost_matrix(df).collect()}
    assert len(want) == sum(len(a) * len(b) for a, b in rows)
    for cells in (1, 50):
        got = dtw.dtw_cost_matrix(df, cells=cells).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
        paths = {tuple(r) for r in dtw.dtw_path(df, cells=cells).collect()}
        assert paths == {tuple(r) for r in dtw.dtw_path(df).collect()}


def test_kept_columns_stay_with_their_distance(spark):
    df = pairs(spark, SHORT, (SEQ1, SEQ2), (None, [1])).withColumn("more", F.col("id") * 10)
    got = dtw.dtw_distance(df, keep=("more",)).orderBy("id").collect()
    assert [r.more for r in got] == [0, 10, 20] and got[0].distance == 2.0 and got[2].distance is None
