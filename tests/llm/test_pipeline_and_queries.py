"""The registered queries on the smallest tables, and the pipeline stage by stage."""

from collections import Counter
from pathlib import Path

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from simalign.llm import mixing, quality_rules
from simalign.llm.queries import ORACLES, QUERIES
from simalign.session import stage

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables not here")


def test_all_thirteen_and_the_pipeline_are_registered():
    names = set(queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES} and set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLES) <= set(oracle_sql()) and "pipeline" not in oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = queries()[name](spark, str(SF))
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(str, found.select(*columns).collect())) == sorted(
        str(type(found.first())(**dict(zip(columns, r, strict=True)))) for r in cur.fetchall()
    )


def test_near_duplicate_query_equals_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute.components({r["doc_id"]: brute.shingles(r["text"], 3) for r in rows}, 85)
    got = queries()["op9_odd_sketches"](spark, str(SF)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def _check_stages(spark, docs, items):
    """Run all stages on `docs` and hold each against a plain version of its own input."""
    steps = dict(corpus_pipeline.STAGES)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "decontamination", "mixing", "token codes"]
    key = lambda r: (r["doc_id"], r["text"])
    plain = docs.collect()

    good = stage(steps["quality rules"](spark, docs, str(SF)))
    assert good.columns == docs.columns
    kept = Counter(map(key, good.collect()))
    judged = Counter(key(r) for r in quality_rules.assess(docs, prefix="_").collect() if r["_kept"])
    assert kept == judged and all(not brute.base_quality(t)[5] for _, t in kept)

    one = stage(steps["near-duplicates"](spark, good, str(SF)))
    assert one.columns == docs.columns
    texts = {i: t for i, t in kept if i is not None}
    classes = brute.components({i: brute.shingles(t, 5) for i, t in texts.items()}, 80)
    assert sorted(r["doc_id"] for r in one.collect() if r["doc_id"] is not None) == sorted(set(classes.values()))

    clean = stage(steps["decontamination"](spark, one, str(SF)))
    assert clean.columns == docs.columns
    want = []
    for r in one.collect():
        n, hit, _ = brute.contamination(r["text"], items)
        if not (hit and 20 * hit >= n):
            want.append(key(r))
    assert Counter(map(key, clean.collect())) == Counter(want)

    mixed = stage(steps["mixing"](spark, clean, str(SF)))
    assert mixed.columns == docs.columns
    copies = Counter(map(key, mixed.collect()))
    assert set(copies) <= set(want) and max(copies.values(), default=0) <= 3
    sized = clean.withColumn("size", mixing.word_count(F.col("text")))
    for s in mixing.mix(sized, prefix="t_").groupBy("source").agg(F.first("t_target").alias("t"), F.max("size").alias("m")).collect():
        taken = sum(len(r["text"].split()) for r in mixed.collect() if r["source"] == s["source"])
        assert abs(taken - s["t"]) <= s["m"] + 1e-6

    last = stage(steps["token codes"](spark, mixed, str(SF))).collect()
    assert Counter(r["doc_id"] for r in last) == Counter(r["doc_id"] for r in mixed.collect())
    start = 0
    for r in sorted(last, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    return plain


def test_pipeline_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    _check_stages(spark, docs, items)
    ran = corpus_pipeline.run(spark, str(SF))
    assert ran.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and ran.count() > 0


def test_pipeline_on_odd_rows(spark):
    """NULLs in any column, repeated rows, and columns with the names that the stages use."""
    some = spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()
    schema = "doc_id long, text string, lang string, source string, n_chars long, copies string, n_words long, kept string, start string, size string"
    rows = [(*r[:5], "c", None, "k", "s", "z") for r in some] * 2
    rows += [(None, some[0]["text"] + " and more", None, None, None, None, None, None, None, None), (900, None, None, None, None, "c", 1, "k", "s", "z"),
             (901, "", "en", None, 0, "c", 1, "k", "s", "z"), (902, some[2]["text"] * 40, "en", None, None, "c", 1, "k", "s", "z")]
    docs = stage(spark.createDataFrame(rows, schema))
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    _check_stages(spark, docs, items)


def test_pipeline_on_an_empty_table(spark):
    docs = stage(spark.read.parquet(f"{SF}/documents.parquet").limit(0))
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(SF)))
        assert docs.count() == 0
