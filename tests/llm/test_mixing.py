"""The mix against its targets and a plain water-filling."""

import pytest
from pyspark.sql import functions as F

from simalign.llm import mixing


def targets(sizes: dict) -> dict:
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: 1 + i % 3 for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in capped]
        rest = total - sum(capped.values())
        share = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n: 3.0 * sizes[n] for n in free if share[n] > 3 * sizes[n]}
        if not over:
            return capped | share
        capped |= over


@pytest.mark.parametrize("fan", [8, 1024])
def test_sources_reach_their_targets(spark, monkeypatch, fan):
    monkeypatch.setattr(mixing, "FAN", fan)
    rows = [(i, "hot" if i % 3 else f"s{i % 21}", 5 + i * 37 % 90, "keep") for i in range(900)]
    rows += [(1000 + i, None, 40, "keep") for i in range(9)] + [(2000, "tiny", 1, "keep"), (2001, "zero", 0, "keep"), (2002, "é", None, "keep")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, copies string").repartition(3)
    got = mixing.mix(docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    sizes: dict = {}
    for r in rows:
        sizes[r[1]] = sizes.get(r[1], 0) + (r[2] or 0)
    want = targets(sizes)
    for source in sizes:
        mine = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == sizes[source] for r in mine)
        assert all(abs(r["target"] - want[source]) < 1e-6 for r in mine)
        taken = sum((r["size"] or 0) * r["copies"] for r in mine)
        assert abs(taken - want[source]) <= max(r["size"] or 0 for r in mine) + 1e-6
        rate = want[source] / sizes[source] if sizes[source] else 0
        assert all(int(rate) <= r["copies"] <= rate + 1 or not r["size"] for r in mine)
    again = mixing.mix(docs.repartition(7)).collect()
    assert {r["doc_id"]: r["copies"] for r in got} == {r["doc_id"]: r["copies"] for r in again}


def test_shares_are_kept_on_average(spark):
    rows = [(i, "a" if i % 4 else "b", 10, None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, x string")
    total = {}
    for seed in range(6):
        for r in mixing.mix(docs, seed=seed).collect():
            total.setdefault(r["source"], []).append(r["copies"])
    for source, copies in total.items():
        rate = {"a": 4 / 9, "b": 8 / 3}[source]
        assert abs(sum(copies) / len(copies) - rate) < 0.02


def test_rows_that_share_an_id_draw_the_same_again(spark):
    rows = [(i % 80, "a" if i % 4 else "b", 10, f"text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, text string")
    first, again = (mixing.mix(d).collect() for d in (docs, docs.orderBy(F.rand(5)).repartition(6)))
    assert {r["text"]: r["copies"] for r in first} == {r["text"]: r["copies"] for r in again}


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(empty).count() == 0
    same = spark.createDataFrame([(None, None, 10)] * 5 + [(1, "a", 10)] * 4, "doc_id long, source string, size long")
    got = mixing.mix(same)
    assert got.count() == 9
    kept = mixing.repeat_rows(got, ["doc_id", "source"])
    assert kept.count() == got.agg(F.sum("copies")).first()[0]
    text = spark.createDataFrame([("a  b\x0bc",), (None,), ("",), ("  x",)], "t string").select(mixing.word_count(F.col("t")))
    assert [r[0] for r in text.collect()] == [3, 0, 0, 2]
