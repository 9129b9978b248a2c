from pyspark.sql import functions as F

from simalign.functions import tokens
from simalign.operators import sequences, vocab

ROWS = [(5, "b a b"), (2, "c a"), (9, None), (2, "a d a"), (None, "z a"), (7, ""), (None, "q")]


def test_sequences_by_parts(spark, monkeypatch):
    monkeypatch.setattr(sequences, "PART_BYTES", 2)
    monkeypatch.setattr(sequences, "ROWS", 2)
    docs, column = spark.createDataFrame(ROWS, "doc_id long, text string"), tokens.index_tokens(F.col("text"))
    parts = sequences.term_parts(docs, column)
    known = vocab.index_vocabulary(sequences.occurrences(parts))
    plain = vocab.index_vocabulary(vocab.term_rows(docs, column, "doc_id"))
    index = {r.term: (r.idx, r.cnt) for r in known.collect()}
    assert index == {r.term: (r.idx, r.cnt) for r in plain.collect()} and index["a"] == (1, 5)
    no = {t: i for t, (i, _) in index.items()}
    got = {r.doc_id: r.seq for r in sequences.sequences(parts, known).collect()}
    both = sorted([(0, no["c"]), (1, no["a"]), (0, no["a"]), (1, no["d"]), (2, no["a"])])
    assert got == {5: [no["b"], no["a"], no["b"]], 2: [i for _, i in both], 9: [], 7: [], None: [i for _, i in sorted([(0, no["z"]), (1, no["a"]), (0, no["q"])])]}
    few = {r.doc_id: r.seq for r in sequences.sequences(parts, known.filter("term = 'a'")).collect()}
    assert few == {5: [1], 2: [1, 1, 1], 9: [], 7: [], None: [1]}
    assert sequences.sequences(sequences.term_parts(docs.limit(0), column), known).count() == 0


def test_a_word_of_a_text_is_no_row_of_a_shuffle(spark):
    docs = spark.createDataFrame([(i, "alpha beta " * 400) for i in range(20)], "doc_id long, text string")
    parts = sequences.term_parts(docs, tokens.index_tokens(F.col("text")))
    assert parts.count() <= 20 + 2 * parts.select("part").distinct().count()
