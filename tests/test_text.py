from pyspark.sql import functions as F

from simalign.functions import tokens, vectors
from simalign.functions.stem import porter
from simalign.operators import vocab

D1, D2 = "like hike like tenni difficult", "like tenni appli coach difficult"


def docs(spark, *texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_tokenisers(spark):
    df = docs(spark, " The  cat's a_b é1 x\nNo! ")
    row = df.select(
        tokens.whitespace_tokens(F.col("text")).alias("w"), tokens.word_tokens(F.col("text")).alias("v"),
        tokens.index_tokens(F.col("text")).alias("i"), tokens.space_tokens(F.lit("a  b")).alias("s"),
        tokens.normalise(F.col("text"), ["the"]).alias("n"),
        tokens.word_tokens(tokens.fill_text(F.lit(None).cast("string"))).alias("e"),
    ).first()
    assert row.w == ["The", "cat's", "a_b", "é1", "x", "No!"]
    assert row.v == ["the", "cat", "a_b", "é1", "no"]
    assert row.i == ["the", "cat's", "a", "b", "é1", "x", "no"]
    assert row.s == ["a", "", "b"]
    assert row.n == "cat s a b é x no"
    assert row.e == []


def test_golden_vectors(spark):
    df = docs(spark, D1, D2)
    dt = vocab.doc_term_counts(df, tokens.word_tokens(F.col("text")), "doc_id").cache()
    known = vocab.alphabetical_vocabulary(vocab.term_stats(dt)).cache()
    index = {r.term: r.idx for r in known.collect()}
    assert index == {"appli": 0, "coach": 1, "difficult": 2, "hike": 3, "like": 4, "tenni": 5}
    counts = {(r.doc_id, r.idx): r.tf for r in vocab.count_vectors(dt, known).collect()}
    assert [counts.get((1, i), 0) for i in range(6)] == [0, 0, 1, 1, 2, 1]
    assert [counts.get((2, i), 0) for i in range(6)] == [1, 1, 1, 0, 1, 1]
    w = {(r.doc_id, r.idx): round(r.w, 6) for r in vocab.tfidf_vectors(dt, known, 2).collect()}
    assert [w.get((1, i), 0) for i in range(6)] == [0, 0, 0.3541, 0.497675, 0.708199, 0.3541]
    assert [w.get((2, i), 0) for i in range(6)] == [0.533098, 0.533098, 0.379303, 0, 0.379303, 0.379303]
    assert {r.term for r in vocab.top_terms(vocab.term_stats(dt), 3).collect()} == {"like", "difficult", "tenni"}


def test_golden_sequences(spark):
    df = docs(spark, D1, D2, "")
    col = tokens.index_tokens(F.col("text"))
    known = vocab.index_vocabulary(vocab.term_rows(df, col, "doc_id"))
    assert {r.term: r.idx for r in known.collect()} == {
        "like": 1, "tenni": 2, "difficult": 3, "hike": 4, "appli": 5, "coach": 6,
    }
    seqs = vocab.texts_to_sequences(df, col, known)
    assert {r.doc_id: r.seq for r in seqs.collect()} == {1: [1, 4, 1, 2, 3], 2: [1, 2, 5, 6, 3], 3: []}
    padded = seqs.select("doc_id", vectors.pad_post(F.col("seq"), 6).alias("p"), vectors.pad_post(F.col("seq"), 3).alias("c"))
    rows = {r.doc_id: r for r in padded.collect()}
    assert rows[1].p == [1, 4, 1, 2, 3, 0] and rows[2].p == [1, 2, 5, 6, 3, 0] and rows[3].p == [0] * 6
    assert rows[1].c == [1, 2, 3] and rows[2].c == [5, 6, 3]
    x, y = (F.array(*map(F.lit, rows[i].p)) for i in (1, 2))
    assert df.select(vectors.similarity_sets(x, y).alias("s")).first().s == 4 / 7


def test_array_distances(spark):
    a = F.array(*map(F.lit, (0, 0, 1, 1, 2, 1)))
    b = F.array(*map(F.lit, (1, 1, 1, 0, 1, 1)))
    zero = F.array(F.lit(0), F.lit(0))
    row = spark.range(1).select(
        vectors.similarity_binary(a, b).alias("s"), vectors.distance_binary(a, b).alias("d"),
        vectors.similarity_binary(zero, zero).alias("z"), vectors.one_hot(F.lit(0), F.lit(3)).alias("h"),
    ).first()
    assert (row.s, row.d, row.z, row.h) == (0.5, 0.5, None, [1.0, 0.0, 0.0, 0.0])


def test_porter():
    # pairs from the published description of the algorithm
    for word, stem in {
        "caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "plastered": "plaster",
        "motoring": "motor", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi",
        "sky": "sky", "relational": "relat", "conditional": "condit", "triplicate": "triplic",
        "hopefulness": "hope", "adoption": "adopt", "probate": "probat", "rate": "rate", "tennis": "tenni",
        "controll": "control", "applied": "appli",
    }.items():
        assert porter(word) == stem, word
