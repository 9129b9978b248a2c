import hashlib
import random

import numpy as np
import pytest
from brute_trees import digest, fold, judge, leaf, lloyd, manifest
from pyspark.sql import functions as F

from simalign.llm import merkle, url_rules, vector_codes


# ---- manifest ----------------------------------------------------------------------------


def listed(spark, rows, fanout=3, block_levels=1, extra=""):
    df = spark.createDataFrame(rows, f"lang string, doc_id long, leaf string{extra}").repartition(5)
    return merkle.manifest(df, "leaf", "lang", "doc_id", fanout, block_levels)


def check_trees(spark, rows, fanout=3, block_levels=1):
    want = manifest(rows, fanout)
    got = listed(spark, rows, fanout, block_levels).withColumn("up", merkle.folded(F.col("leaf"), F.col("proof"))).collect()
    assert len(got) == len(rows)
    for r in got:
        proof = [(s["place"], s["others"]) for s in r["proof"]]
        assert (r["subroot"], r["root"], proof) == want[r["lang"], r["doc_id"], r["leaf"]]
        assert r["up"] == r["root"] == fold(r["leaf"], proof)


@pytest.mark.parametrize("sizes", [{"a": 1}, {None: 1, "a": 3}, {"a": 28, "b": 2, "é": 4, None: 10, "z": 1}])
def test_trees_of_uneven_size(spark, sizes):
    rows = [(g, i * 2 - 5, digest(str(g), str(i))) for g, n in sizes.items() for i in range(n)]
    check_trees(spark, rows)


def test_many_groups_and_wide_blocks(spark):
    rnd = random.Random(1)
    rows = [(f"g{k:02}", i, digest(str(k), str(i))) for k in range(11) for i in range(rnd.choice([1, 2, 5, 9, 30]))]
    check_trees(spark, rows, 3, 1)
    check_trees(spark, rows, 2, 2)


def test_ties_nulls_equal_rows_and_other_columns(spark):
    rows = [("a", None, digest("x"), 1), ("a", 1, digest("p"), 2), ("a", 1, digest("o"), 3), (None, None, digest("n"), 4)]
    out = listed(spark, rows, extra=", root int").select("lang", "doc_id", "leaf", "root", "proof").collect()
    want = manifest([r[:3] for r in rows], 3)
    assert {(r["lang"], r["doc_id"], r["leaf"]): r["root"] for r in out} == {k: v[1] for k, v in want.items()}
    same = [("a", 7, digest("same"))] * 20
    got = listed(spark, same).select("root", F.col("proof")[0]["place"].alias("place")).collect()
    assert len({r["root"] for r in got}) == 1 and sorted(r["place"] for r in got) == sorted([i % 3 for i in range(20)])
    assert listed(spark, []).collect() == []


def test_leaf_encoding(spark):
    long = "ä" * 300_000
    rows = [(1, "s", None, 3, "Wörd"), (None, None, None, None, None), (2, "", "en", 0, long)]
    df = spark.createDataFrame(rows, "a long, b string, c string, d long, e string")
    got = [r[0] for r in df.select(merkle.leaf_hash(*[F.col(c) for c in df.columns])).collect()]
    assert got == [leaf(*r) for r in rows]


# ---- vector codes ------------------------------------------------------------------------

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(v):
    return [int(np.floor(float(np.float32(x)) * 4096)) for x in v]


def test_codes_equal_plain_lloyd(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 16))
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(scale=0.3, size=16)], i % 3) for i in range(200)]
    out, books = vector_codes.encode(spark.createDataFrame(rows, SCHEMA).repartition(4), parts=4, entries=6, rounds=5)
    want, plain = lloyd([(i, whole(v)) for i, v, _ in rows], 4, 6, 5)
    assert {r["vec_id"]: (r["code"], r["error"]) for r in out.collect()} == want
    assert books.entries.tolist() == plain
    assert books.digest() == hashlib.sha256(",".join(str(x) for p in plain for e in p for x in e).encode()).hexdigest()


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(5)
    for _ in range(30):
        x = rng.integers(-4, 5, (300, 3, 2))
        before = vector_codes.Codebooks(rng.integers(-3, 4, (3, 6, 2)), np.ones((3, 6), bool))
        code, dist = vector_codes.assign(x, before, None, None)
        moved = rng.random((3, 6)) < 0.3
        after = vector_codes.Codebooks(np.where(moved[..., None], rng.integers(-3, 4, (3, 6, 2)), before.entries), moved)
        for a, b in zip(vector_codes.assign(x, after, code, dist), vector_codes.assign(x, after, None, None), strict=True):
            assert (a == b).all()


def test_vectors_without_a_row_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [1.0, 2.0, 3.0], 1), (1, None, 1), (2, [nan, 1.0, 1.0], 1), (4, [1.0, None, 1.0], 1), (5, [1.0, inf, 1.0], 1),
        (6, [], 1), (7, [1.0, 2.0], 1), (3, [1.0, 2.0, 3.0], None), (None, [0.0, 0.0, 0.0], None),
    ]
    df = spark.createDataFrame([(*r, "old") for r in rows], SCHEMA + ", code string")
    out, books = vector_codes.encode(df, parts=2, entries=16, rounds=3)
    assert sorted((r["vec_id"] or -1, r["code"], r["error"]) for r in out.collect()) == [(-1, "0202", 0), (3, "0000", 0), (3, "0000", 0)]
    assert books.entries.shape == (2, 3, 2)  # three vectors, filled up to four components
    out, books = vector_codes.encode(df.filter("vec_id = 1"))
    assert out.collect() == [] and books is None
    with pytest.raises(ValueError):
        vector_codes.encode(spark.createDataFrame([(1, [1e9], 1)], SCHEMA))


def test_totals_of_hot_and_rare_keys(spark):
    rows = [(None if i % 3 == 0 else (7 if i % 3 == 1 else i), i) for i in range(3000)]
    got = vector_codes.add_total(spark.createDataFrame(rows, "label int, error long"), "label", "error", "t").collect()
    sums = {}
    for k, v in rows:
        sums[k] = sums.get(k, 0) + v
    assert len(got) == len(rows) and all(r["t"] == sums[r["label"]] for r in got)


# ---- URL rules ---------------------------------------------------------------------------

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de", "block"), ("org", "", "block"), ("a.org", "/x/y", "allow"),
    ("a.org", "/x/y", "block"), ("b.org", "/x/y/", "allow"), (None, "/", "block"), ("org", None, "allow"), ("Dup.com", "/", "block"),
    ("dup.com", "/", "block"), ("", "/root", "block"),
]
URLS = [
    None, "", "example.net/en/", "http://example.net", "http://example.net/", "HTTP://WWW.Example.NET/en/a?x=/de#y", "https://xexample.net/en/",
    "http://example.com/deutsch", "http://m.example.com/de/", "http://example.com/", "ftp://a.org/x/y", "ftp://q.a.org/x/yz/w", "http://b.org/x/y/z",
    "http://b.org/x/y", "http://org?net/", "http://a.b#://example.net/en/", "x://y://net/", "http://dup.com/" + "a/" * 200_000, "http://İ.ORG/é",
    "http:///root/a", "http://.net/", "http://net./", "http://a..net/", "http://u@example.net:80/en/", "http://example.net/en/\nnext",
]


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_rules_equal_a_plain_loop(spark, broadcast_rows):
    rows = [(i, u, "old") for i, u in enumerate(URLS * 3)]
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    df = spark.createDataFrame(rows, "page_id int, url string, host string")
    out = url_rules.apply_rules(df, rules, broadcast_rows=broadcast_rows, hot_rows=4).collect()
    plain = [(h and h.lower(), p, v) for h, p, v in RULES]
    assert len(out) == len(rows)
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(r["url"], plain), r["url"]


def test_no_rules_no_urls_and_a_prefix(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([(1, "http://a.b/c"), (1, "http://a.b/c")], "host int, url string")
    out = url_rules.apply_rules(df, none, prefix="u_", default="block")
    assert [tuple(r) for r in out.collect()] == [(1, "http://a.b/c", "a.b", "/c", None, "block")] * 2
    assert url_rules.apply_rules(df.limit(0), spark.createDataFrame(RULES, none.schema)).collect() == []
