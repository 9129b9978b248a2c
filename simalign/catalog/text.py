"""Tokens, vocabularies and document representations."""

from __future__ import annotations

from pyspark.sql import functions as F

from simalign.catalog.base import BY_LANGUAGE, SPLIT, WORDS, by_language, documents, query
from simalign.functions import tokens as tk
from simalign.functions import vectors
from simalign.operators import sequences, vocab
from simalign.session import stage

# A short stop-word list over the four languages of the corpus.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "it", "la", "le", "les", "de", "des", "der", "die", "das", "und", "el", "los", "en"]

INDEX_TOKENS = (
    "list_filter(string_split(translate(lower(text), '!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~' || chr(9) || chr(10),"
    " repeat(' ', 33)), ' '), lambda x: x <> '')"
)
OCC = f"occ AS (SELECT doc_id, term, pos FROM (SELECT doc_id, unnest({INDEX_TOKENS}) AS term, generate_subscripts({INDEX_TOKENS}, 1) - 1 AS pos FROM documents))"
WORD_ROWS = f"w AS (SELECT doc_id, unnest({WORDS}) AS term FROM documents)"
VOCAB = (
    "dt AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),"
    " vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, sum(tf) AS cf, count(*) AS df FROM dt GROUP BY term)"
)
INDEX_VOCAB = (
    "firsts AS (SELECT term, doc_id, pos, row_number() OVER (PARTITION BY term ORDER BY doc_id, pos) AS r,"
    " count(*) OVER (PARTITION BY term) AS cnt FROM occ),"
    " vocab AS (SELECT term, row_number() OVER (ORDER BY cnt DESC, doc_id, pos) AS idx, cnt FROM firsts WHERE r = 1)"
)
SEQ = (
    "seq AS (SELECT d.doc_id, coalesce(list(v.idx ORDER BY o.pos) FILTER (WHERE v.idx IS NOT NULL), []) AS seq"
    " FROM documents d LEFT JOIN occ o ON o.doc_id = d.doc_id LEFT JOIN vocab v ON v.term = o.term GROUP BY d.doc_id)"
)


def _token_query(name, column, sql):
    query(name, "doc_id long, tokens array<string>", f"SELECT doc_id, {sql} AS tokens FROM documents")(
        lambda spark, sf: documents(spark, sf).select("doc_id", column(F.col("text")).alias("tokens"))
    )


_token_query("tokens_whitespace", tk.whitespace_tokens, SPLIT)
_token_query("tokens_word", tk.word_tokens, WORDS)
_token_query("tokens_keras", tk.index_tokens, INDEX_TOKENS)
_token_query("tokens_space", tk.space_tokens, "string_split(text, ' ')")


@query("normalise_text", "doc_id long, text string",
       "SELECT doc_id, array_to_string(list_filter(string_split(regexp_replace(lower(text), '[^\\p{L}]+', ' ', 'g'), ' '),"
       f" lambda x: x <> '' AND x NOT IN ({', '.join(repr(w) for w in STOP_WORDS)})), ' ') AS text FROM documents")
def normalise_text(spark, sf):
    return documents(spark, sf).select("doc_id", tk.normalise(F.col("text"), STOP_WORDS).alias("text"))


def _doc_terms(spark, sf, again: bool = False):
    """Term counts of every document; written once if read again."""
    counts = vocab.doc_term_counts(documents(spark, sf), tk.word_tokens(F.col("text")), "doc_id")
    return stage(counts) if again else counts


@query("vocab_count", "term string, idx long, cf long, df long", f"WITH {WORD_ROWS}, {VOCAB} SELECT term, idx, cf, df FROM vocab")
def vocab_count(spark, sf):
    return vocab.alphabetical_vocabulary(vocab.term_stats(_doc_terms(spark, sf)))


@query("vocab_top_features", "term string, cf long, df long",
       f"WITH {WORD_ROWS}, {VOCAB} SELECT term, cf, df FROM vocab ORDER BY cf DESC, term LIMIT 60000")
def vocab_top_features(spark, sf):
    return vocab.top_terms(vocab.term_stats(_doc_terms(spark, sf)), 60000)


@query("dataset_shape", "n_rows long, n_terms long",
       f"WITH {WORD_ROWS} SELECT (SELECT count(*) FROM documents) AS n_rows, (SELECT count(DISTINCT term) FROM w) AS n_terms")
def dataset_shape(spark, sf):
    docs = documents(spark, sf)
    terms = vocab.term_rows(docs, tk.word_tokens(F.col("text")), "doc_id")
    rows = docs.agg(F.count("*").alias("n_rows"))
    # one row each
    return rows.crossJoin(terms.agg(F.count_distinct("term").alias("n_terms")))


@query("vectors_count", "doc_id long, idx long, tf long",
       f"WITH {WORD_ROWS}, {VOCAB} SELECT doc_id, idx, tf FROM dt JOIN vocab USING (term)")
def vectors_count(spark, sf):
    dt = _doc_terms(spark, sf, again=True)
    return vocab.count_vectors(dt, vocab.alphabetical_vocabulary(vocab.term_stats(dt)))


@query("vectors_binary", "doc_id long, idx long, present int",
       f"WITH {WORD_ROWS}, {VOCAB} SELECT doc_id, idx, 1 AS present FROM dt JOIN vocab USING (term)")
def vectors_binary(spark, sf):
    dt = _doc_terms(spark, sf, again=True)
    return vocab.binary_vectors(dt, vocab.alphabetical_vocabulary(vocab.term_stats(dt)))


@query("vectors_tfidf", "doc_id long, idx long, w double",
       f"WITH {WORD_ROWS}, {VOCAB}, x AS (SELECT doc_id, idx, tf * (ln((1.0 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1) AS w"
       " FROM dt JOIN vocab USING (term)) SELECT doc_id, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS w FROM x")
def vectors_tfidf(spark, sf):
    dt = _doc_terms(spark, sf, again=True)
    known = vocab.alphabetical_vocabulary(vocab.term_stats(dt))
    out = vocab.tfidf_vectors(dt, known, documents(spark, sf).count())
    return out.withColumn("w", F.round("w", 6))


def _occurrences(spark, sf):
    return vocab.term_rows(documents(spark, sf), tk.index_tokens(F.col("text")), "doc_id")


@query("vocab_index", "term string, idx long, cnt long", f"WITH {OCC}, {INDEX_VOCAB} SELECT term, idx, cnt FROM vocab WHERE idx < 25000")
def vocab_index(spark, sf):
    return vocab.index_vocabulary(_occurrences(spark, sf), 25000)


def _sequences(spark, sf):
    parts = sequences.term_parts(documents(spark, sf), tk.index_tokens(F.col("text")))
    return sequences.sequences(parts, vocab.index_vocabulary(sequences.occurrences(parts)))


@query("texts_to_sequences", "doc_id long, seq array<long>", f"WITH {OCC}, {INDEX_VOCAB}, {SEQ} SELECT doc_id, seq FROM seq")
def texts_to_sequences(spark, sf):
    return _sequences(spark, sf)


@query("pad_sequences", "doc_id long, seq array<long>",
       f"WITH {OCC}, {INDEX_VOCAB}, {SEQ} SELECT doc_id, list_concat(seq[greatest(len(seq) - 511, 1):],"
       " list_transform(range(greatest(512 - len(seq), 0)), lambda i: 0)) AS seq FROM seq")
def pad_sequences(spark, sf):
    return _sequences(spark, sf).withColumn("seq", vectors.pad_post(F.col("seq"), 512))


@query("max_sequence_length", "max_len long", f"WITH {OCC}, {INDEX_VOCAB}, {SEQ} SELECT max(len(seq)) AS max_len FROM seq")
def max_sequence_length(spark, sf):
    return _sequences(spark, sf).agg(F.max(F.size("seq")).alias("max_len"))


@query("top_terms_by_class", "label int, term string, cnt long, rank int",
       f"WITH {BY_LANGUAGE}, w AS (SELECT label, unnest({WORDS}) AS term FROM corpus) SELECT label, term, cnt, rank FROM ("
       "SELECT label, term, count(*) AS cnt, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, term) AS rank"
       " FROM w GROUP BY label, term) WHERE rank <= 50")
def top_terms_by_class(spark, sf):
    counts = vocab.doc_term_counts(by_language(spark, sf), tk.word_tokens(F.col("text")), "label")
    return vocab.top_terms_by_class(counts, 50)
