"""Distances, nearest neighbours, votes and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from simalign.catalog import text as tx
from simalign.catalog.corpus import scratch
from simalign.catalog.base import (
    ADAPTIVE_K, BY_LANGUAGE, LABELLED, RANKED, UNLABELLED, WORDS, by_language, documents, folds,
    holdout, labelled, macro_f1, neighbours, query, table, unlabelled, voted,
)
from simalign.functions import tokens as tk
from simalign.functions import vectors
from simalign.operators import evaluate
from simalign.operators.split import split_fraction
from simalign.plans import classify
from simalign.plans.representation import representation_study
from simalign.session import stage
from simalign.sources import files

HOLD = f"{LABELLED}, {RANKED}, {holdout(0.25)}"
HOLD_LANG = f"{BY_LANGUAGE}, {RANKED}, {holdout(0.1)}"


def _halves(spark, sf, fraction=0.25):
    return split_fraction(labelled(spark, sf), fraction)


def _pairs(spark, sf):
    """Every document beside the one with the next id."""
    docs = documents(spark, sf).select("doc_id", "text")
    right = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("other"))
    return docs.join(right, "doc_id")


PAIRS = "pairs AS (SELECT a.doc_id, a.text, b.text AS other FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)"
OTHER_WORDS = WORDS.replace("text", "other")
SETS = f"sets AS (SELECT doc_id, list_distinct({WORDS}) AS x, list_distinct({OTHER_WORDS}) AS y FROM pairs)"


def _set_query(name, column, sign):
    counts = "len(list_intersect(x, y))::DOUBLE / nullif(len(list_distinct(list_concat(x, y))), 0)"
    sql = f"WITH {PAIRS}, {SETS} SELECT doc_id, {sign}{counts} AS value FROM sets"

    def build(spark, sf):
        x, y = tk.word_tokens(F.col("text")), tk.word_tokens(F.col("other"))
        return _pairs(spark, sf).select("doc_id", column(x, y).alias("value"))

    query(name, "doc_id long, value double", sql)(build)


_set_query("jaccard_sim_sets", vectors.similarity_sets, "")
_set_query("jaccard_dist_sets", vectors.distance_sets, "1 - ")

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _binary_query(name, column, sign):
    flags = "list_transform(string_split('" + ",".join(LETTERS) + "', ','), lambda c: contains(lower({}), c)::INT)"
    both = "list_sum(list_transform(list_zip(x, y), lambda p: (p[1] = 1 AND p[2] = 1)::INT))"
    any_ = "list_sum(list_transform(list_zip(x, y), lambda p: (p[1] = 1 OR p[2] = 1)::INT))"
    sql = (
        f"WITH {PAIRS}, flags AS (SELECT doc_id, {flags.format('text')} AS x, {flags.format('other')} AS y FROM pairs)"
        f" SELECT doc_id, {sign}{both}::DOUBLE / nullif({any_}, 0) AS value FROM flags"
    )

    def build(spark, sf):
        def flag(c):
            return F.array(*[F.contains(F.lower(F.col(c)), F.lit(x)).cast("int") for x in LETTERS])

        return _pairs(spark, sf).select("doc_id", column(flag("text"), flag("other")).alias("value"))

    query(name, "doc_id long, value double", sql)(build)


_binary_query("jaccard_sim_binary", vectors.similarity_binary, "")
_binary_query("jaccard_dist_binary", vectors.distance_binary, "1 - ")


@query("jaccard_vocab", "test_id long, train_id long, dist double",
       f"WITH {HOLD}, {neighbours()} SELECT test_id, train_id, dist FROM near WHERE rank = 1")
def jaccard_vocab(spark, sf):
    """Distance of every test document to its nearest training document."""
    return classify.neighbour_lists(*_halves(spark, sf), 1)


@query("jaccard_padded", "doc_id long, value double",
       f"WITH {tx.OCC}, {tx.INDEX_VOCAB}, {tx.SEQ}, longest AS (SELECT max(len(seq)) AS n FROM seq),"
       " p AS (SELECT doc_id, CASE WHEN len(seq) < n THEN list_append(list_distinct(seq), 0) ELSE list_distinct(seq) END AS s FROM seq, longest)"
       " SELECT a.doc_id, 1 - len(list_intersect(a.s, b.s))::DOUBLE / len(list_distinct(list_concat(a.s, b.s))) AS value"
       " FROM p a JOIN p b ON b.doc_id = a.doc_id + 1")
def jaccard_padded(spark, sf):
    """Set distance of zero-padded sequences of neighbouring documents."""
    # padding adds one element, 0, to the set of every sequence below the longest
    seqs = stage(tx._sequences(spark, sf).select("doc_id", F.size("seq").alias("n"), F.array_distinct("seq").alias("x")))
    longest = seqs.agg(F.max("n").alias("longest"))  # one row
    padding = F.when(F.col("n") < F.col("longest"), F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>"))
    padded = seqs.crossJoin(F.broadcast(longest)).select("doc_id", F.concat(F.col("x").cast("array<long>"), padding).alias("x"))
    right = padded.select((F.col("doc_id") - 1).alias("doc_id"), F.col("x").alias("y"))
    joined = padded.join(right, "doc_id")
    return joined.select("doc_id", vectors.distance_sets(F.col("x"), F.col("y")).alias("value"))


@query("allpairs_jaccard", "test_id long, train_id long, label int, dist double, rank int",
       f"WITH {LABELLED}, {RANKED}, train AS (SELECT 0 AS fold, * FROM corpus), {UNLABELLED},"
       f" test AS (SELECT 0 AS fold, doc_id, text, NULL AS label FROM unlabelled), {neighbours()}"
       " SELECT test_id, train_id, label, dist, rank FROM near WHERE rank <= 5")
def allpairs_jaccard(spark, sf):
    """Every unlabelled document against every labelled one, the five nearest kept."""
    return classify.neighbour_lists(labelled(spark, sf), unlabelled(spark, sf), 5)


@query("knn_topk", "test_id long, train_id long, label int, dist double, rank int",
       f"WITH {HOLD_LANG}, {neighbours()} SELECT test_id, train_id, label, dist, rank FROM near WHERE rank <= 9")
def knn_topk(spark, sf):
    return classify.neighbour_lists(*split_fraction(by_language(spark, sf), 0.1), 9)


@query("knn_vote", "doc_id long, label int, pred int",
       f"WITH {HOLD}, {neighbours()} SELECT test_id AS doc_id, test_label AS label, pred FROM"
       f" ({voted('(SELECT * FROM near WHERE rank <= 4)', 'test_id, test_label')})")
def knn_vote(spark, sf):
    """An even k, so that ties happen."""
    return classify.predictions(classify.neighbour_lists(*_halves(spark, sf), 4))


def many_k(ks: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    spread = f"(SELECT near.*, k FROM near, (SELECT unnest([{ks}]) AS k) WHERE rank <= k)"
    return voted(spread, f"{keys}k, test_id, test_label")


@query("knn_classify", "k int, doc_id long, label int, pred int",
       f"WITH {HOLD}, {neighbours(75000)} SELECT k, test_id AS doc_id, test_label AS label, pred FROM ({many_k('5, 9')})")
def knn_classify(spark, sf):
    return classify.knn_classify(*_halves(spark, sf), [5, 9], max_features=75000)


@query("append_metrics", "k int, n_train long, n_test long, accuracy double, macro_f1 double",
       f"WITH {HOLD}, {neighbours(75000)}, predicted AS (SELECT k, test_label AS label, pred FROM ({many_k('5, 9')}))"
       " SELECT a.k, (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM test) AS n_test, round(accuracy, 6) AS accuracy,"
       " round(macro_f1, 6) AS macro_f1 FROM (SELECT k, avg((label = pred)::INT) AS accuracy FROM predicted GROUP BY k) a"
       f" JOIN ({macro_f1('predicted', 'k')}) f ON a.k = f.k")
def append_metrics(spark, sf):
    """The records of a holdout run, one per k, appended to a log; the log also has seconds."""
    train, test = _halves(spark, sf)
    path = scratch(spark, "metrics")
    for record in classify.holdout_records(train, test, [5, 9], 75000):
        files.append_metrics(record, path)
    log = spark.read.parquet(path)
    return log.withColumns({c: F.round(c, 6) for c in ("accuracy", "macro_f1")})


@query("knn_bruteforce", "doc_id long, label int, pred int",
       f"WITH {HOLD}, {neighbours()}, picked AS (SELECT * FROM near WHERE rank <= (SELECT {ADAPTIVE_K.format(n='count(*)')} FROM train))"
       f" SELECT test_id AS doc_id, test_label AS label, pred FROM ({voted('picked', 'test_id, test_label')})")
def knn_bruteforce(spark, sf):
    return classify.knn_bruteforce(*_halves(spark, sf))


FOLDS = (
    f"{LABELLED}, {folds(5)}, {neighbours(60000)},"
    " sizes AS (SELECT fold, count(*) AS n FROM train GROUP BY fold),"
    " ks AS (SELECT DISTINCT fold, unnest([1, 3, 5, 7, 9, 15, floor(sqrt(n))::INT]) AS k FROM sizes),"
    " spread AS (SELECT near.*, k FROM near JOIN ks USING (fold) WHERE rank <= k),"
    f" predicted AS (SELECT fold, k, test_id AS doc_id, test_label AS label, pred FROM ({voted('spread', 'fold, k, test_id, test_label')}))"
)


def _kfold(spark, sf):
    return classify.knn_kfold(labelled(spark, sf), 5, [1, 3, 5, 7, 9, 15], max_features=60000)


@query("knn_k_sweep", "fold int, k int, doc_id long, label int, pred int",
       f"WITH {FOLDS} SELECT fold, k, doc_id, label, pred FROM predicted")
def knn_k_sweep(spark, sf):
    return _kfold(spark, sf)


@query("kfold_evaluate", "fold int, k int, accuracy double, macro_f1 double",
       f"WITH {FOLDS} SELECT a.fold, a.k, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1 FROM"
       " (SELECT fold, k, avg((label = pred)::INT) AS accuracy FROM predicted GROUP BY fold, k) a"
       f" JOIN ({macro_f1('predicted', 'fold, k')}) f ON a.fold = f.fold AND a.k = f.k")
def kfold_evaluate(spark, sf):
    """Scores per fold and k; the plan also measures seconds, which no oracle can repeat."""
    out = classify.kfold_records(labelled(spark, sf), 5, [1, 3, 5, 7, 9, 15], max_features=60000)
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "macro_f1")})


UNLABELLED_RUN = (
    f"{LABELLED}, train AS (SELECT 0 AS fold, * FROM corpus), {UNLABELLED},"
    f" test AS (SELECT 0 AS fold, doc_id, text, NULL AS label FROM unlabelled), {neighbours(70000)},"
    f" votes AS ({voted('(SELECT * FROM near WHERE rank <= 3)', 'test_id')}),"
    " batches AS (SELECT doc_id, floor((row_number() OVER (ORDER BY doc_id) - 1) / 250) AS batch_id FROM unlabelled)"
)


@query("knn_score_unlabelled", "batch_id int, id long, predicted int",
       f"WITH {UNLABELLED_RUN} SELECT batch_id, doc_id AS id, pred AS predicted FROM batches JOIN votes ON test_id = doc_id")
def knn_score_unlabelled(spark, sf):
    return classify.score_unlabelled(labelled(spark, sf), unlabelled(spark, sf), 3, 250, 70000)


@query("attach_predictions", "id long, source string, predicted int",
       f"WITH {HOLD_LANG}, {neighbours()}, votes AS ({voted('(SELECT * FROM near WHERE rank <= 3)', 'test_id')})"
       " SELECT d.doc_id AS id, d.source, pred AS predicted FROM documents d JOIN votes ON test_id = d.doc_id")
def attach_predictions(spark, sf):
    near = classify.neighbour_lists(*split_fraction(by_language(spark, sf), 0.1), 3)
    sources = table(spark, sf, "documents").select("doc_id", "source")
    return classify.predictions(near).join(sources, "doc_id").select(
        F.col("doc_id").alias("id"), "source", F.col("pred").alias("predicted")
    )


@query("union_results", "batch_id int, n long, n_positive long",
       f"WITH {UNLABELLED_RUN}, scored AS (SELECT batch_id, pred FROM batches JOIN votes ON test_id = doc_id),"
       " per_batch AS (SELECT batch_id, count(*) AS n, sum(pred) AS n_positive FROM scored GROUP BY batch_id)"
       " SELECT * FROM per_batch UNION ALL SELECT -1, sum(n), sum(n_positive) FROM per_batch")
def union_results(spark, sf):
    """Batch results with a row for all batches (-1) appended."""
    scored = knn_score_unlabelled(spark, sf)
    totals = [F.count("*").alias("n"), F.sum("predicted").alias("n_positive")]
    per_batch = scored.groupBy("batch_id").agg(*totals)
    total = per_batch.agg(F.sum("n").alias("n"), F.sum("n_positive").alias("n_positive"))
    return per_batch.unionByName(total.withColumn("batch_id", F.lit(-1)))


PREDICTED = f"{HOLD_LANG}, {neighbours()}, p AS (SELECT test_id, test_label AS label, pred FROM ({voted('(SELECT * FROM near WHERE rank <= 5)', 'test_id, test_label')}))"


def _predicted(spark, sf):
    return classify.predictions(classify.neighbour_lists(*split_fraction(by_language(spark, sf), 0.1), 5))


@query("accuracy", "accuracy double", f"WITH {PREDICTED} SELECT avg((label = pred)::INT) AS accuracy FROM p")
def accuracy(spark, sf):
    return evaluate.accuracy(_predicted(spark, sf))


@query("macro_f1", "macro_f1 double", f"WITH {PREDICTED} SELECT round(macro_f1, 6) AS macro_f1 FROM ({macro_f1('p')})")
def macro_f1_query(spark, sf):
    return evaluate.macro_f1(_predicted(spark, sf)).withColumn("macro_f1", F.round("macro_f1", 6))


@query("confusion_counts", "label int, pred int, n long",
       f"WITH {PREDICTED} SELECT label, pred, count(*) AS n FROM p GROUP BY label, pred")
def confusion_counts(spark, sf):
    return evaluate.confusion_counts(_predicted(spark, sf))


def _study_sql() -> str:
    base = f"{HOLD_LANG}, {neighbours()}"
    tokens = tx.INDEX_TOKENS
    padded = (
        f"xtr AS (SELECT doc_id, unnest({tokens}) AS term FROM train), xte AS (SELECT doc_id, unnest({tokens}) AS term FROM test"
        "), xk AS (SELECT doc_id, term FROM xtr UNION ALL SELECT doc_id, term FROM xte WHERE term IN (SELECT term FROM xtr)),"
        " len AS (SELECT doc_id, count(*) AS c FROM xk GROUP BY doc_id), top AS (SELECT max(c) AS m FROM len),"
        " short AS (SELECT r.doc_id FROM ranked r LEFT JOIN len ON len.doc_id = r.doc_id WHERE coalesce(c, 0) < (SELECT m FROM top))"
    )
    pads = "SELECT 0 AS fold, doc_id, term FROM {0} UNION ALL SELECT 0, doc_id, chr(10) FROM {1} WHERE doc_id IN (SELECT doc_id FROM short)"
    second = neighbours(train_terms=pads.format("xtr", "train"), test_terms=pads.format("xte", "test"))
    for name in ("tr_raw", "te_raw", "tr_t", "te_t", "tr_n", "te_n", "inter", "dist", "near"):
        second = second.replace(f"{name} AS (", f"{name}2 AS (").replace(f"FROM {name}", f"FROM {name}2").replace(f"JOIN {name} ", f"JOIN {name}2 ")
    first_votes = voted("(SELECT * FROM near WHERE rank <= 5)", "test_id, test_label")
    second_votes = voted("(SELECT * FROM near2 WHERE rank <= 5)", "test_id, test_label")
    return (
        f"WITH {base}, {padded}, {second}, v1 AS ({first_votes}), v2 AS ({second_votes}),"
        " every AS (SELECT unnest(['counts', 'one_hot', 'tfidf']) AS representation, test_label AS label, pred FROM v1"
        " UNION ALL SELECT 'padded_sequence', test_label, pred FROM v2)"
        " SELECT representation, avg((label = pred)::INT) AS accuracy, count(*) AS n FROM every GROUP BY representation"
    )


@query("representation_study", "representation string, accuracy double, n long", _study_sql())
def representation(spark, sf):
    predicted = stage(representation_study(*split_fraction(by_language(spark, sf), 0.1)))  # read twice
    sizes = predicted.groupBy("representation").agg(F.count("*").alias("n"))
    return evaluate.accuracy(predicted, "representation").join(sizes, "representation")
