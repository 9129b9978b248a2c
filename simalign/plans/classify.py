"""k-nearest-neighbour text classification: holdout, folds, many k, unlabelled texts.

Corpora have columns (doc_id LONG, text STRING, label INT), cross-validation frames also
`fold`.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simalign.functions.tokens import fill_text, word_tokens
from simalign.operators import evaluate, vocab
from simalign.operators.neighbours import nearest, nearest_elsewhere
from simalign.operators.split import assign_batches, kfold_assign
from simalign.operators.vote import adaptive_k, vote, vote_many_k
from simalign.session import stage


def word_lists(docs: DataFrame, *also: str) -> DataFrame:
    """(fold, doc_id, label, also, words): the words of every document in text order."""
    fold = F.col("fold") if "fold" in docs.columns else F.lit(0)
    label = F.col("label") if "label" in docs.columns else F.lit(None)
    return docs.select(
        fold.cast("int").alias("fold"), "doc_id", label.cast("int").alias("label"), *also,
        word_tokens(fill_text(F.col("text"))).alias("words"),
    )


def distinct_words(listed: DataFrame) -> DataFrame:
    """The same with `terms`, the distinct words, instead of `words`."""
    return listed.withColumn("terms", F.array_distinct("words")).drop("words")


def term_sets(docs: DataFrame, *also: str) -> DataFrame:
    """(fold, doc_id, label, also, terms): the distinct words of every document."""
    return distinct_words(word_lists(docs, *also))


def _word_stats(listed: DataFrame) -> DataFrame:
    counts = vocab.doc_term_counts(listed.select("fold", "doc_id", "words"), F.col("words"), "fold", "doc_id")
    return vocab.term_stats(counts, "fold")


def _sides(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Word lists of both sides, tokenised once."""
    both = stage(word_lists(train, F.lit(False).alias("is_test")).unionByName(word_lists(test, F.lit(True).alias("is_test"))))
    return both.filter(~F.col("is_test")).drop("is_test"), both.filter("is_test").drop("is_test")


def _neighbours(train: DataFrame, test: DataFrame, k: int, max_features: int | None = None) -> DataFrame:
    """Neighbour lists from word lists."""
    keep = None if max_features is None else vocab.top_terms(_word_stats(train), max_features)
    return nearest(distinct_words(train), distinct_words(test), k, keep, of_train=True)


def neighbour_lists(
    train: DataFrame, test: DataFrame, k: int, max_features: int | None = None
) -> DataFrame:
    """(fold, test_id, test_label, train_id, label, dist, rank)."""
    return _neighbours(*_sides(train, test), k, max_features)


def _stats_without_own_fold(listed: DataFrame, folds: int) -> DataFrame:
    """(fold, term, cf, df) over the training side of every fold: all rows less the fold's own.

    Tokens are counted once, not once for each fold that trains on them.
    """
    own = F.struct(F.col("cf").alias("cf"), F.col("df").alias("df"))
    every = _word_stats(listed).groupBy("term").agg(
        F.sum("cf").alias("_cf"), F.sum("df").alias("_df"), F.map_from_entries(F.collect_list(F.struct("fold", own))).alias("_own")
    )
    spread = every.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    mine = F.try_element_at("_own", F.col("fold"))
    return spread.select(
        "fold", "term", (F.col("_cf") - F.coalesce(mine["cf"], F.lit(0))).alias("cf"), (F.col("_df") - F.coalesce(mine["df"], F.lit(0))).alias("df")
    ).filter("df > 0")


def predictions(neighbours: DataFrame, *by: str) -> DataFrame:
    """(by, doc_id, label, pred) from neighbour lists."""
    return vote(neighbours, *by, "test_id", "test_label").withColumnsRenamed(
        {"test_id": "doc_id", "test_label": "label"}
    )


def knn_classify(
    train: DataFrame, test: DataFrame, ks: list[int], max_features: int | None = None
) -> DataFrame:
    """(k, doc_id, label, pred) for every k of `ks`, from one neighbour list."""
    listed = neighbour_lists(train, test, max(ks), max_features)
    voted = vote_many_k(listed, F.array(*map(F.lit, ks)), "test_id", "test_label")
    return voted.withColumnsRenamed({"test_id": "doc_id", "test_label": "label"})


def knn_bruteforce(train: DataFrame, test: DataFrame) -> DataFrame:
    """(doc_id, label, pred) with k set by the number of training rows."""
    train, test = _sides(train, test)
    return predictions(_neighbours(train, test, adaptive_k(train.count())))


def knn_kfold(
    docs: DataFrame, folds: int, ks: list[int], max_features: int | None = None
) -> DataFrame:
    """(fold, k, doc_id, label, pred), all folds in one search that refuses a row its own fold.

    The list of k also holds floor(sqrt(training rows of the fold)).
    """
    folded = kfold_assign(docs, folds)
    listed = stage(word_lists(folded))
    sets = distinct_words(listed)
    sizes = sets.groupBy("fold").agg(F.count("*").alias("n"))
    n = sets.count()
    k_max = max(*ks, math.isqrt(n))
    keep = None
    if max_features is not None:
        keep = vocab.top_terms(_stats_without_own_fold(listed, folds), max_features)
    near = nearest_elsewhere(sets, k_max, folds, keep)
    roots = sizes.select("fold", F.floor(F.sqrt(n - F.col("n"))).cast("int").alias("root"))
    # one row per fold
    with_root = near.join(F.broadcast(roots), "fold")
    all_k = F.concat(F.array(*map(F.lit, ks)), F.array("root"))
    voted = vote_many_k(with_root, all_k, "fold", "test_id", "test_label")
    return voted.withColumnsRenamed({"test_id": "doc_id", "test_label": "label"})


def score_unlabelled(
    train: DataFrame, unlabelled: DataFrame, k: int, batch_rows: int, max_features: int | None = None
) -> DataFrame:
    """(batch_id, id, predicted) of unlabelled texts, batches in id order."""
    batches = assign_batches(unlabelled.select("doc_id"), batch_rows)
    predicted = predictions(neighbour_lists(train, unlabelled, k, max_features))
    return batches.join(predicted, "doc_id").select(
        "batch_id", F.col("doc_id").alias("id"), F.col("pred").alias("predicted")
    )


def holdout_records(train: DataFrame, test: DataFrame, ks: list[int], max_features: int | None = None) -> list[DataFrame]:
    """One run record per k: k, sizes, accuracy, macro-F1 and seconds of the whole run."""
    start = time.perf_counter()
    predicted = stage(knn_classify(train, test, ks, max_features))
    seconds = time.perf_counter() - start
    n_train, n_test = train.count(), test.count()
    return [
        evaluate.scores(predicted.filter(F.col("k") == k)).select(
            F.lit(k).alias("k"), F.lit(n_train).alias("n_train"), F.lit(n_test).alias("n_test"), "accuracy", "macro_f1",
            F.lit(seconds).alias("seconds"),
        )
        for k in ks
    ]


def kfold_records(docs: DataFrame, folds: int, ks: list[int], max_features: int | None = None) -> DataFrame:
    """(fold, k, accuracy, macro_f1, seconds): the scores of a cross-validation and what it took.

    All folds run in one job, so the seconds are those of the job.
    """
    start = time.perf_counter()
    predicted = stage(knn_kfold(docs, folds, ks, max_features))
    seconds = time.perf_counter() - start
    return evaluate.scores(predicted, "fold", "k").withColumn("seconds", F.lit(seconds))
