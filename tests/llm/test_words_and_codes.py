"""Word hashes, token codes and the encoder against plain Python."""

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from simalign.llm import files, token_codes, words

TEXTS = [
    "A b  c", "", None, "x" * 50, "Ünïcode words\nnew line\ttab", "same same same", " lead and trail ", "a\x0bb\x0cc\rd", "the end",
    "日本語 text", "  ", "one", "a b", "it's 12 o'clock!!", "tab\t \tx", "line \n next",
]


@pytest.mark.parametrize(("table", "pattern", "fold"), [
    (words.SPACED, r"[^\x20\x09-\x0D]+", True), (words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True), (words.SPACED, r"[^\x20\x09-\x0D]+", False),
])
@pytest.mark.parametrize("group_bytes", [8, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, table, pattern, fold, group_bytes):
    monkeypatch.setattr(words, "GROUP_BYTES", group_bytes)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    names: dict[int, str] = {}
    got: dict[int, list[int]] = {}
    for g in words.groups(pa.array(TEXTS), table, fold):
        for row, low, high in g.slices():
            got[row] = g.hashes[low:high].tolist()
    for i, text in enumerate(TEXTS):
        want = re.findall(pattern, (text or "").translate(lower) if fold else text or "")
        assert len(got[i]) == len(want)
        for h, w in zip(got[i], want, strict=True):
            assert names.setdefault(h, w) == w
    assert len(set(names.values())) == len(names)


def test_long_texts_are_cut_at_separators(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = next(words.groups(pa.array([text]))).hashes
    monkeypatch.setattr(words, "GROUP_BYTES", 1000)
    assert (next(words.groups(pa.array([text]))).hashes == whole).all()
    assert len(next(words.groups(pa.array(["y" * 5000 + " z"]))).hashes) == 2


def test_segment_gives_any_token():
    rng = np.random.default_rng(0)
    ids = [rng.choice([3, 200, 255, 256, 70000, 1 << 25], n).astype(np.uint32) for n in (0, 1, 700, 5000)]
    seg = token_codes.Segment(token_codes.encode_segment([1, None, 3, 4], ids))
    flat = np.concatenate(ids)
    assert seg.doc_ids.tolist() == [1, 0, 3, 4] and seg.nulls.tolist() == [False, True, False, False]
    for at in rng.integers(0, len(flat), 300).tolist():
        assert seg.token(at) == flat[at]
    for _ in range(100):
        low, high = sorted(rng.integers(0, len(flat) + 1, 2).tolist())
        assert (seg.tokens_between(low, high) == flat[low:high]).all()
    empty = token_codes.Segment(token_codes.encode_segment([], []))
    assert empty.tokens == 0


def test_encoder_is_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t or "" for t in TEXTS] * 3
    got = token_codes.Encoder("byte_bpe_50k.json")(texts)
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, np.uint32).tolist() for x in got] == want


def test_written_codes_are_read_back(spark, monkeypatch):
    monkeypatch.setattr(token_codes, "SEGMENT_TOKENS", 40)
    rows = [(i * 7 % 40, TEXTS[i % len(TEXTS)], "x", 1) for i in range(40)]
    rows += [(None, "no id", "x", 1), (5, rows[15][1], "x", 1), (99, "long " * 3000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, tokens int").repartition(5)
    manifest = token_codes.write_codes(docs, files.new_folder(spark, "codes"))
    got = token_codes.read_codes(manifest).orderBy("start").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, stream, seen = 0, [], []
    for r in got:
        ids = np.frombuffer(r["tokens"], "<u4").tolist()
        assert r["start"] == start and r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(bytes(r["tokens"]))
        start += len(ids)
        stream += ids
        seen.append((r["doc_id"], tuple(ids)))
    want = [(r[0], (*library.encode(r[1] or "", add_special_tokens=False).ids, 2)) for r in rows]
    assert sorted(seen, key=str) == sorted(want, key=str)
    assert [d for d, _ in seen] == sorted((d for d, _ in seen), key=lambda d: (d is not None, d or 0))
    picked = spark.range(-2, len(stream) + 3, 7).select(F.col("id").alias("position"))
    found = {r["position"]: r["token"] for r in token_codes.tokens_at(manifest, picked).collect()}
    assert found == {i: stream[i] for i in range(-2, len(stream) + 3, 7) if 0 <= i < len(stream)}


def test_empty_table_writes_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest = token_codes.write_codes(docs, files.new_folder(spark, "codes"))
    assert token_codes.read_index(manifest).count() == 0


def test_special_tokens_are_those_of_the_library():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = next(iter(library.get_added_tokens_decoder().values())).content
    texts = [f"end {special} of it", special, f"a{special}b c d", "plain words"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = [np.frombuffer(x, np.uint32).tolist() for x in token_codes.encoder("byte_bpe_50k.json")(texts)]
    assert got == want
    plain = [np.frombuffer(x, np.uint32).tolist() for x in token_codes.encoder("byte_bpe_50k.json", False)(texts)]
    assert plain[3] == want[3] and all(a != b for a, b in zip(plain[:3], want[:3]))
