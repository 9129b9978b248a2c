"""Quality rules and decontamination against plain Python."""

import random

import brute
import pytest

from simalign.llm import decontaminate, quality_rules

rng = random.Random(3)
VOCAB = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
ITEMS = [(i, " ".join(rng.choice(VOCAB) for _ in range(n))) for i, n in enumerate([20, 13, 14, 5, 2, 1, 40, 0])]
ITEMS += [(None, "no name but a text of more than thirteen words in all so that it has two windows"), (3, "Second text, same id!"), (8, None)]


def documents():
    out = []
    for i in range(60):
        w = [rng.choice(VOCAB) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = (ITEMS[i % len(ITEMS)][1] or "").upper().split()
        out.append((i, ", ".join(w)))
    return [*out, (60, None), (61, ""), (None, ITEMS[0][1]), (61, "ab"), (62, (ITEMS[6][1] + ". ") * 500)]


@pytest.mark.parametrize("block", [200_000, 7])
def test_hits_are_those_of_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    rows = [(a, b, "keep") for a, b in documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(docs, items, prefix="_dc_")
    assert got.columns == ["doc_id", "text", "n_hit", "_dc_n_words", "_dc_n_hit", "_dc_items"]
    for r in got.collect():
        assert (r["_dc_n_words"], r["_dc_n_hit"], r["_dc_items"]) == brute.contamination(r["text"], ITEMS)


def test_empty_sides(spark):
    items, docs = spark.createDataFrame(ITEMS, "item_id long, text string"), spark.createDataFrame(documents(), "doc_id long, text string")
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    clean = decontaminate.contamination(docs, items.limit(0))
    assert {r["n_hit"] for r in clean.collect()} == {0}


TEXTS = [
    None, "", "one two three", "a b c a b c a b c", "line\nline\n\n \nline \nother", "x #*$ %& |<> y", "the " * 200,
    "Ünï cödé 日本語 " * 30, "A good text of the usual kind, " + " ".join(f"word{i} and" for i in range(60)), "\x0b\x0c a", "z" * 100_000,
]


def test_counts_are_those_of_plain_python(spark):
    docs = spark.createDataFrame([(i, t, "xx", i) for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, lang string, kept long")
    got = quality_rules.assess(docs, prefix="_qr_")
    assert got.columns[:4] == docs.columns
    for r in got.collect():
        found = tuple(r[f"_qr_{c}"] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert found == brute.base_quality(r["text"])
        assert not (r["_qr_base_failed"] and r["_qr_kept"])
    assert quality_rules.assess(docs.limit(0)).count() == 0


def test_fertility_separates_prose_from_debris(spark):
    prose = (
        "It was the best of times and it was the worst of times, as people said when they looked back on that year. Nobody in the "
        "village had expected the river to rise so quickly, and the old bridge, which had stood for two centuries, was gone before the "
        "morning. The mayor called a meeting in the school, where everyone agreed that a new one had to be built at once."
    )
    debris = " ".join("".join(chr(33 + (i * 7 + j * 13) % 90) for j in range(9)) for i in range(80))
    foreign = "".join(chr(0x1400 + i % 500) + " " for i in range(300))
    docs = spark.createDataFrame([(0, prose, "en"), (1, debris, "en"), (2, foreign, "en"), (3, prose, None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality_rules.assess(docs).collect()}
    assert got[0]["kept"] and got[3]["kept"] and not got[1]["kept"] and not got[2]["kept"]
    assert got[3]["band"] == "latin" and got[2]["byte_share"] > 0.5


def test_edges_of_the_corpus_reject_symbol_debris(spark):
    """Every word with symbols behind it lies within the fixed limits, but far from its corpus."""
    words = (
        "time people river water house garden letter morning evening number story window children school street market bread summer winter"
        " mother father brother sister doctor village mountain forest island morning question answer paper picture table kitchen travel"
        " between another because through against without nothing something every again always never often before after under over"
        " walked opened carried followed reached turned looked called found given taken written spoken quiet narrow little great early"
    ).split()
    draw = random.Random(8)
    prose = [" ".join(draw.choice(words) for _ in range(draw.randrange(60, 200))) for _ in range(400)]
    symbols = ["%%%", "***", "&&&", "$$$", "###", "|", "<<", "@@"]
    debris = [" ".join(draw.choice(words) + draw.choice(symbols) for _ in range(180)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose + debris)], "doc_id long, text string, lang string")
    fixed = {r["doc_id"]: r["kept"] for r in quality_rules.assess(docs, edges={}).collect()}
    got = {r["doc_id"]: r["kept"] for r in quality_rules.assess(docs).collect()}
    assert all(fixed[i] for i in range(400, 420)) and not any(got[i] for i in range(400, 420))
    assert sum(fixed[i] and not got[i] for i in range(400)) <= 4
    assert quality_rules.corpus_edges(docs.limit(50)) == {}
