import hashlib

from pyspark.sql import functions as F

from simalign.operators import rank, split
from simalign.sources import files


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "doc_id")


def shuffled(n, seed=42):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def test_hash_rank_is_the_shuffle(spark):
    got = {r.rn: r.doc_id for r in rank.hash_rank(ids(spark, 500), "doc_id").collect()}
    assert [got[i + 1] for i in range(500)] == shuffled(500)


def test_ordered_rank(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS g")
    rows = rank.ordered_rank(df, "g", "id").collect()
    assert [r.id for r in sorted(rows, key=lambda r: r.rn)] == sorted(range(1000), key=lambda i: (i % 7, i))
    assert sorted(r.rn for r in rows) == list(range(1, 1001))


def test_fold_sizes(spark):
    for n, k in ((10, 4), (7, 3), (3, 5), (100, 5)):
        folded = split.kfold_assign(ids(spark, n), k).collect()
        sizes = [sum(r.fold == f for r in folded) for f in range(k)]
        assert sizes == [n // k + (f < n % k) for f in range(k)]
        order = {d: i for i, d in enumerate(shuffled(n))}
        assert [r.fold for r in sorted(folded, key=lambda r: order[r.doc_id])] == sorted(r.fold for r in folded)


def test_cv_frames(spark):
    train, test = split.cv_frames(split.kfold_assign(ids(spark, 20), 4), 4)
    assert train.count() == 60 and test.count() == 20
    assert train.join(test, ["fold", "doc_id"]).count() == 0


def test_splits(spark):
    df, order = ids(spark, 50), shuffled(50)
    train, test = split.split_fraction(df, 0.25)
    assert {r.doc_id for r in test.collect()} == set(order[:13])
    assert {r.doc_id for r in train.collect()} == set(order[13:])
    train, test = split.split_head_tail(df, 40, 20)
    assert {r.doc_id for r in train.collect()} == set(order[:40])
    assert {r.doc_id for r in test.collect()} == set(order[-20:])
    train, test = split.split_head_tail(df, 80, 70)
    assert train.count() == test.count() == 50
    parts = {r.doc_id: r.part for r in split.split_three_way(df, 10, 5, 5).collect()}
    assert {d for d, p in parts.items() if p == "val"} == set(order[10:15]) and len(parts) == 20
    static = {r.doc_id: r.part for r in split.split_static(df, 30).collect()}
    assert all((p == "train_val") == (d < 30) for d, p in static.items())
    assert {r.doc_id for r in split.subsample_n(df, 5).collect()} == set(order[:5])


def test_batches(spark):
    batches = split.assign_batches(ids(spark, 120), 50).collect()
    assert [sum(r.batch_id == b for r in batches) for b in range(3)] == [50, 50, 20]
    assert all(r.batch_id == r.doc_id // 50 for r in batches)


def test_empty_table(spark):
    assert split.kfold_assign(ids(spark, 0), 4).count() == 0
    assert rank.hash_rank(ids(spark, 0), "doc_id").count() == 0


def test_first_rows_are_found_by_counting(spark):
    ids = [5, -3, None, 2**63 - 1, -(2**63), 7, 7, 7, 0, None, 12_000_000]
    df = spark.createDataFrame([(x, f"r{i % 9}") for i, x in enumerate(ids)], "id long, s string")
    ordered = sorted((-(2**64) if x is None else x) for x in ids)
    for n in (0, 1, 3, 7, 8, 11, 12):
        got = files.first_n(df, n, "id")
        values = sorted(-(2**64) if r.id is None else r.id for r in got.collect())
        assert values == ordered[:n]
        assert sorted(map(str, got.collect())) == sorted(map(str, files.first_n(df.repartition(5), n, "id").collect()))
    rest = spark.createDataFrame([(3,)] * 6, "id long")
    assert files.first_n(rest, 4, "id").count() == 4
    assert files.first_n(df.limit(0), 3, "id").count() == 0
    assert [r.s for r in files.first_n(df, 3, "s").orderBy("s").collect()] == ["r0", "r0", "r1"]
    plan = files.first_n(spark.range(1000), 600, "id")._jdf.queryExecution().toString()
    assert "Limit" not in plan and "Exchange" not in plan


def test_nth_smallest(spark):
    values = [(i * 7919) % 100_003 - 50_000 for i in range(4000)] + [17] * 50
    df = spark.createDataFrame([(v,) for v in values], "v int")
    ordered = sorted(values)
    for n in (1, 2, 2000, 2050, 4049, 4050):
        want = ordered[n - 1]
        assert rank.nth_smallest(df, F.col("v"), n) == (want, sum(v < want for v in values))
    assert rank.nth_smallest(df, F.col("v"), 4051) == (None, 4050) and rank.nth_smallest(df, F.col("v"), 0)[0] is None


def test_static_split_at_the_ends(spark):
    df = spark.createDataFrame([(i,) for i in (4, 9, 1)], "doc_id long")
    for n, want in ((0, 0), (2, 2), (3, 3), (8, 3)):
        assert split.split_static(df, n).filter("part = 'train_val'").count() == want
