"""Shards and archives: exact round trips."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from simalign.llm import files, shards, warc


@pytest.mark.parametrize("rows", [0, 1, 5, 8, 103])
def test_shards_hold_all_rows(spark, rows):
    data = [(i, None if i % 9 == 0 else f"text {i % 11}" * (1 + i % 5), "s") for i in range(rows)]
    if rows > 8:
        data += [(None, "a", "s"), (None, "b", "s"), (3, "text 3", "s"), (3, "text 3", "s")]
    docs = spark.createDataFrame(data, "doc_id long, text string, slot string")
    out, _ = shards.shard(docs)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((a, b) for a, b, _ in data)
    by_shard: dict[int, list[int]] = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    counts = [len(by_shard.get(s, ())) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    if rows == 103:
        again, _ = shards.shard(docs.repartition(6))
        assert Counter(tuple(r) for r in got) == Counter(tuple(r) for r in again.collect())


def test_hot_ids_and_repetitions_are_scattered_and_repeat(spark):
    rows = [(i % 80 if i % 3 else None, f"text {i}") for i in range(400)] + [(7, "again " * 40)] * 300 + [(None, None)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first, again = (shards.shard(d, bucket_bytes=2000)[0].collect() for d in (docs, docs.orderBy(F.rand(3)).repartition(5)))
    assert Counter(tuple(r) for r in first) == Counter(tuple(r) for r in again)
    assert Counter((r["doc_id"], r["text"]) for r in first) == Counter(rows)
    # the repetitions lie all over the shards
    assert all(15 <= n <= 65 for n in Counter(r["shard"] for r in first if r["doc_id"] == 7 and "again" in r["text"]).values())


def test_archives_give_back_every_payload(spark):
    big = "ü<p>" * 400_000  # several chunks
    rows = [(1, "http://a/?x=%0A\n", "x" * 150), (2, None, "x" * 150), (0, "http://b", "x" * 150), (3, "u", None), (4, "u", ""), (5, "u", "short"),
            (6, "u", "short"), (7, "u", big), (8, "v", big), (None, "n", "y" * 120), (9, "n", "y" * 120), (10, "d", "z" * 100), (10, "d", "z" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = warc.read_archives(warc.archive(pages), chunk_bytes=100_000).collect()
    payloads: dict[str, bytes] = {}
    for r in sorted(got, key=lambda r: (r["record_id"], r["chunk"])):
        payloads[r["record_id"]] = payloads.get(r["record_id"], b"") + bytes(r["data"])
        if r["type"] == "response":
            assert r["digest"] == hashlib.sha256(payloads[r["record_id"]]).hexdigest()
    ends = [r for r in got if r["last"]]
    assert Counter((r["name"], r["uri"]) for r in ends) == Counter((a, b) for a, b, _ in rows)
    want = {a: (h or "").encode() for a, _, h in rows}
    for r in ends:
        assert r["payload_bytes"] == len(want[r["name"]]) and r["digest"] == hashlib.sha256(want[r["name"]]).hexdigest()
        assert payloads[r["record_id"]] == (want[r["name"]] if r["type"] == "response" else b"")
    kinds = {(r["name"], r["type"], r["refers_to"]) for r in ends}
    assert kinds == {
        (0, "response", None), (1, "revisit", 0), (2, "revisit", 0), (3, "response", None), (4, "response", None), (5, "response", None),
        (6, "response", None), (7, "response", None), (8, "revisit", 7), (9, "response", None), (None, "revisit", 9), (10, "response", None), (10, "revisit", 10),
    }


def test_small_archives_roll_over(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(30)], "page_id long, url string, html string").coalesce(1)
    chunks = warc.chunk_table(pages, "page_id", "url", "html", chunk_bytes=64)
    manifest = warc.write_archives(chunks, warc.verdicts(chunks), files.new_folder(spark, "warc"), archive_bytes=200)
    assert manifest.count() > 4
    ends = warc.read_archives(manifest, with_data=False).collect()
    assert sorted(r["name"] for r in ends) == list(range(30)) and all(r["last"] for r in ends)


def test_no_pages_no_archive(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.archive(pages)).count() == 0
