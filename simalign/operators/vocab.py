"""Vocabularies and document vectors in long form (doc_id, idx, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simalign.operators import sequences
from simalign.operators.rank import ordered_rank
from simalign.session import stage


def term_rows(docs: DataFrame, tokens: Column, *keys: str) -> DataFrame:
    """One row per token occurrence: keys, pos (0-based), term."""
    rows = docs.select(*keys, F.posexplode_outer(tokens).alias("pos", "term"))
    return rows.filter(F.col("term").isNotNull())


def doc_term_counts(docs: DataFrame, tokens: Column, *keys: str) -> DataFrame:
    """(keys, term, tf)."""
    return term_rows(docs, tokens, *keys).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def term_stats(doc_terms: DataFrame, *by: str) -> DataFrame:
    """(by, term, cf, df) from (by, doc_id, term, tf)."""
    return doc_terms.groupBy(*by, "term").agg(F.sum("tf").alias("cf"), F.count("*").alias("df"))


def alphabetical_vocabulary(stats: DataFrame) -> DataFrame:
    """(term, idx, cf, df), idx from 0 in term order."""
    ranked = ordered_rank(stats, "term")
    return ranked.select("term", (F.col("rn") - 1).alias("idx"), "cf", "df")


def top_terms(stats: DataFrame, n: int) -> DataFrame:
    """The n terms of highest corpus count, ties by term; per `fold` if there is one.

    How many terms have each count gives the least count that can still be among the n; only
    terms from there on are sorted. There are few distinct counts: their sum is that of the
    corpus.
    """
    by = [c for c in stats.columns if c == "fold"]
    stats = stage(stats)
    above = Window.partitionBy(*by).orderBy(F.desc("cf"))
    counts = stats.groupBy(*by, "cf").agg(F.count("*").alias("_n")).withColumn("_above", F.sum("_n").over(above) - F.col("_n"))
    least = counts.filter(F.col("_above") < n).groupBy(*by).agg(F.min("cf").alias("_least"))
    # one row, or one per fold
    met = stats.join(F.broadcast(least), by) if by else stats.crossJoin(F.broadcast(least))
    near = met.filter(F.col("cf") >= F.col("_least")).drop("_least")
    ranked = ordered_rank(near, *by, F.desc("cf"), "term")
    if not by:
        return ranked.filter(F.col("rn") <= n).drop("rn")
    first = ranked.groupBy("fold").agg(F.min("rn").alias("_first"))
    kept = ranked.join(F.broadcast(first), "fold").filter(F.col("rn") - F.col("_first") < n)
    return kept.drop("rn", "_first")


def index_vocabulary(occurrences: DataFrame, num_words: int | None = None) -> DataFrame:
    """(term, idx, cnt): 1-based by count, ties by first appearance in (doc_id, pos) order.

    `num_words` keeps idx < num_words. A row may stand for `n` occurrences, of which it names the first.
    """
    count = F.sum("n") if "n" in occurrences.columns else F.count("*")
    counted = occurrences.groupBy("term").agg(
        count.alias("cnt"), F.min(F.struct("doc_id", "pos")).alias("_first")
    )
    ranked = ordered_rank(counted, F.desc("cnt"), "_first").withColumnRenamed("rn", "idx")
    if num_words is not None:
        ranked = ranked.filter(F.col("idx") < num_words)
    return ranked.select("term", "idx", "cnt")


def count_vectors(doc_terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, idx, tf); terms outside the vocabulary are dropped."""
    return doc_terms.join(vocabulary.select("term", "idx"), "term").select("doc_id", "idx", "tf")


def binary_vectors(doc_terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, idx, present)."""
    return count_vectors(doc_terms, vocabulary).select("doc_id", "idx", F.lit(1).alias("present"))


def tfidf_vectors(doc_terms: DataFrame, vocabulary: DataFrame, n_docs: int) -> DataFrame:
    """(doc_id, idx, w): tf * (ln((1 + n) / (1 + df)) + 1), each document scaled to length 1."""
    weight = F.col("tf") * (F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1)
    weighted = doc_terms.join(vocabulary.select("term", "idx", "df"), "term").select(
        "doc_id", "idx", weight.alias("_w")
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("doc_id")))
    return weighted.select("doc_id", "idx", (F.col("_w") / norm).alias("w"))


def texts_to_sequences(docs: DataFrame, tokens: Column, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, seq): word indices in text order, unknown words dropped."""
    return sequences.sequences(sequences.term_parts(docs, tokens), vocabulary)


def top_terms_by_class(doc_terms: DataFrame, n: int) -> DataFrame:
    """(label, term, cnt, rank): the n most frequent terms of every class."""
    counts = doc_terms.groupBy("label", "term").agg(F.sum("tf").alias("cnt"))
    ranked = counts.withColumn(
        "rank", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("cnt"), "term"))
    )
    return ranked.filter(F.col("rank") <= n)
