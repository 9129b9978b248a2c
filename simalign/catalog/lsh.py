"""MinHash signatures, candidates, the two-route classifier, sweeps and their analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simalign.catalog.base import (
    ADAPTIVE_K, LABELLED, RANKED, SPLIT, UNLABELLED, WORDS, documents, folds, holdout, labelled, neighbours, query, unlabelled, voted,
)
from simalign.functions import tokens as tk
from simalign.functions import vectors
from simalign.operators import evaluate, minhash, results, vote
from simalign.operators.neighbours import rank_pairs
from simalign.operators.split import kfold_assign, split_fraction
from simalign.plans import lsh, sweep
from simalign.session import stage

PERMS, THRESHOLD = 64, 0.3
# Low enough to serve most documents and to give long candidate lists.
LOW_THRESHOLD = 0.2

MINIMA = ", ".join(f"min((h * {a} + {b}) % {minhash.PRIME})" for a, b in minhash.hash_family())


def sig_sql(source: str) -> str:
    return (
        f"tok AS (SELECT doc_id, unnest({SPLIT}) AS t FROM {source}),"
        " hashed AS (SELECT doc_id, CAST('0x' || substr(md5(t), 1, 7) AS BIGINT) AS h FROM tok),"
        f" sig AS (SELECT doc_id, [{MINIMA}] AS sig FROM hashed GROUP BY doc_id)"
    )


def bands_sql(perms: int, threshold: float) -> str:
    bands, rows = minhash.band_params(perms, threshold)
    return (
        f"bk AS (SELECT doc_id, band, array_to_string(sig[band * {rows} + 1 : band * {rows} + {rows}], '-') AS band_key"
        f" FROM sig, range({bands}) x(band))"
    )


def cand_sql(perms: int, threshold: float) -> str:
    return (
        f"{sig_sql('corpus')}, {bands_sql(perms, threshold)},"
        " cand AS (SELECT DISTINCT a.doc_id AS test_id, b.doc_id AS train_id FROM bk a JOIN bk b"
        " ON a.band = b.band AND a.band_key = b.band_key WHERE a.doc_id IN (SELECT doc_id FROM test)"
        " AND b.doc_id IN (SELECT doc_id FROM train))"
    )


HOLD = f"{LABELLED}, {RANKED}, {holdout(0.25)}"


def _halves(spark, sf):
    return split_fraction(labelled(spark, sf), 0.25)


@query("minhash_signature", "doc_id long, sig array<long>", f"WITH {sig_sql('documents')} SELECT doc_id, sig FROM sig")
def minhash_signature(spark, sf):
    return lsh.signed(documents(spark, sf), "doc_id")


@query("lsh_bands", "doc_id long, band int, band_key string",
       f"WITH {sig_sql('documents')}, {bands_sql(PERMS, THRESHOLD)} SELECT doc_id, band, band_key FROM bk")
def lsh_bands(spark, sf):
    bands, rows = minhash.band_params(PERMS, THRESHOLD)
    return minhash.band_rows(lsh.signed(documents(spark, sf), "doc_id", perms=bands * rows), bands, rows, "doc_id")


BAND_GRID = (
    "areas AS (SELECT p.perms, t.threshold, b.bands, r.rows,"
    " round((SELECT sum(CASE WHEN (s + 0.5) / 1000 < t.threshold THEN 1 - pow(1 - pow((s + 0.5) / 1000, r.rows), b.bands)"
    " ELSE pow(1 - pow((s + 0.5) / 1000, r.rows), b.bands) END) FROM range(1000) g(s)) / 2000, 9) AS area"
    f" FROM (SELECT unnest([16, 32, 64]) AS perms) p, (SELECT unnest({sweep.THRESHOLDS}) AS threshold) t,"
    " (SELECT unnest(range(1, 65)) AS bands) b, (SELECT unnest(range(1, 65)) AS rows) r WHERE b.bands * r.rows <= p.perms),"
    " best AS (SELECT *, row_number() OVER (PARTITION BY perms, threshold ORDER BY area, bands, rows) AS x FROM areas)"
)


@query("lsh_band_params", "perms int, threshold double, bands int, rows int, n_entries long",
       f"WITH {BAND_GRID} SELECT perms, threshold, bands, rows, bands * (SELECT count(*) FROM documents"
       f" WHERE len({SPLIT}) > 0) AS n_entries FROM best WHERE x = 1")
def lsh_band_params(spark, sf):
    """Bands and rows of every grid point, with the index entries they give on the corpus."""
    signed = lsh.signed(documents(spark, sf), "doc_id", perms=1).agg(F.count("*").alias("_n"))
    # a few dozen grid rows beside one count
    grid = sweep.param_grid(spark).crossJoin(signed)
    return grid.withColumn("n_entries", F.col("bands") * F.col("_n"))




def grid_sql(thresholds) -> str:
    points = ((p, t, *minhash.band_params(p, t)) for p in sweep.PERMS for t in thresholds)
    values = ", ".join(f"({p}, {t}::DOUBLE, {bands}, {rows})" for p, t, bands, rows in points)
    return f"grid AS (SELECT * FROM (VALUES {values}) g(perms, threshold, bands, rows))"


GRID = grid_sql(sweep.THRESHOLDS)


@query("param_grid", "perms int, threshold double, fold int, n_train long, n_test long",
       f"WITH {LABELLED}, {folds(4)}, {GRID} SELECT perms, threshold, fold, (SELECT count(*) FROM corpus) - n_test AS n_train,"
       " n_test FROM grid, (SELECT fold, count(*) AS n_test FROM test GROUP BY fold)")
def param_grid(spark, sf):
    """Permutations x thresholds x folds, with the sizes of each fold."""
    sizes = kfold_assign(labelled(spark, sf), 4).groupBy("fold").agg(F.count("*").alias("n_test"))
    total = sizes.agg(F.sum("n_test").alias("_n"))
    # folds and the grid are both a few dozen rows
    grid = sweep.param_grid(spark).crossJoin(sizes).crossJoin(total)
    return grid.withColumn("n_train", F.col("_n") - F.col("n_test"))


@query("lsh_candidates", "test_id long, train_id long",
       f"WITH {HOLD}, {cand_sql(PERMS, LOW_THRESHOLD)} SELECT test_id, train_id FROM cand")
def lsh_candidates(spark, sf):
    train, test = _halves(spark, sf)
    return lsh.lsh_candidates(train, test, PERMS, LOW_THRESHOLD)


@query("nearest_by_metric", "test_id long, train_id long, dist double, rank int",
       f"WITH {HOLD}, {cand_sql(PERMS, THRESHOLD)}, sets AS (SELECT doc_id, list_distinct({WORDS}) AS s FROM corpus),"
       " scored AS (SELECT test_id, train_id, 1 - len(list_intersect(a.s, b.s))::DOUBLE"
       " / nullif(len(list_distinct(list_concat(a.s, b.s))), 0) AS dist FROM cand JOIN sets a ON a.doc_id = test_id"
       " JOIN sets b ON b.doc_id = train_id), ordered AS (SELECT *, row_number() OVER"
       " (PARTITION BY test_id ORDER BY dist NULLS FIRST, train_id) AS rank FROM scored)"
       " SELECT test_id, train_id, dist, rank FROM ordered WHERE rank <= 5")
def nearest_by_metric(spark, sf):
    """The five nearest candidates of every test document under a metric passed as a function of two columns."""
    # 64-bit hashes of the words: a document carries eight bytes a word
    hashed = F.transform(F.array_distinct(tk.word_tokens(F.col("text"))), lambda w: F.xxhash64(w))
    return rank_pairs(lsh.candidates_beside(*_halves(spark, sf), PERMS, THRESHOLD, hashed), vectors.distance_sets, 5)


@query("adaptive_k", "doc_id long, n long, k int",
       f"WITH {HOLD}, {cand_sql(PERMS, THRESHOLD)}, c AS (SELECT test_id, count(*) AS n FROM cand GROUP BY test_id),"
       " s AS (SELECT doc_id, coalesce(c.n, (SELECT count(*) FROM train)) AS n FROM test LEFT JOIN c ON test_id = doc_id)"
       f" SELECT doc_id, n, {ADAPTIVE_K.format(n='n')} AS k FROM s")
def adaptive_k(spark, sf):
    """k of every test document: from its candidates, or from the training side if it has none."""
    train, test = _halves(spark, sf)
    counts = lsh.lsh_candidates(train, test, PERMS, THRESHOLD).groupBy(F.col("test_id").alias("doc_id")).agg(F.count("*").alias("n"))
    sized = test.select("doc_id").join(counts, "doc_id", "left").withColumn("n", F.coalesce("n", F.lit(train.count())))
    return sized.withColumn("k", vote.adaptive_k_column(F.col("n")))


@query("split_by_candidates", "doc_id long, served boolean",
       f"WITH {HOLD}, {cand_sql(PERMS, THRESHOLD)} SELECT doc_id, doc_id IN (SELECT test_id FROM cand) AS served FROM test")
def split_by_candidates(spark, sf):
    train, test = _halves(spark, sf)
    served = stage(lsh.lsh_candidates(train, test, PERMS, THRESHOLD).select("test_id").distinct())  # read by both sides
    served, rest = lsh.split_by_candidates(test, served)
    return served.withColumn("served", F.lit(True)).unionByName(rest.withColumn("served", F.lit(False)))


def routes_sql(threshold: float, local: bool = False) -> str:
    """`routed`: predictions of both routes."""
    if local:
        # sizes of test sets count only what their own candidates hold
        scored = (
            "la AS (SELECT x.doc_id AS test_id, count(DISTINCT x.term) AS a FROM te_t x JOIN cand c ON c.test_id = x.doc_id"
            " JOIN tr_t y ON y.doc_id = c.train_id AND y.term = x.term GROUP BY x.doc_id),"
            " scored AS (SELECT c.test_id, c.train_id, e.label AS test_label, r.label, CASE WHEN coalesce(la.a, 0) + b = 0 THEN 0.0"
            " ELSE 1.0 - CAST(coalesce(i, 0) AS DOUBLE) / (coalesce(la.a, 0) + b - coalesce(i, 0)) END AS dist"
            " FROM cand c JOIN te_n e ON e.doc_id = c.test_id JOIN tr_n r ON r.doc_id = c.train_id LEFT JOIN la ON la.test_id = c.test_id"
            " LEFT JOIN inter q ON q.test_id = c.test_id AND q.train_id = c.train_id)"
        )
    else:
        scored = "scored AS (SELECT d.test_id, d.train_id, d.test_label, d.label, d.dist FROM dist d JOIN cand c ON c.test_id = d.test_id AND c.train_id = d.train_id)"
    return (
        f"{HOLD}, {neighbours()}, {cand_sql(PERMS, threshold)},"
        f" nc AS (SELECT test_id, count(*) AS n FROM cand GROUP BY test_id), {scored},"
        " rs AS (SELECT s.*, n, row_number() OVER (PARTITION BY s.test_id ORDER BY dist, train_id) AS r FROM scored s JOIN nc ON nc.test_id = s.test_id),"
        f" pick AS (SELECT * FROM rs WHERE r <= {ADAPTIVE_K.format(n='n')}),"
        f" rest AS (SELECT * FROM near WHERE test_id NOT IN (SELECT test_id FROM nc) AND rank <= (SELECT {ADAPTIVE_K.format(n='count(*)')} FROM train)),"
        f" v1 AS ({voted('pick', 'test_id, test_label, n')}), v2 AS ({voted('rest', 'test_id, test_label')}),"
        " routed AS (SELECT test_id AS doc_id, test_label AS label, pred, 'lsh' AS route, n AS n_candidates FROM v1"
        " UNION ALL SELECT test_id, test_label, pred, 'all', 0 FROM v2)"
    )


ROUTED = "doc_id long, label int, pred int, route string, n_candidates long"


@query("knn_lsh_global", ROUTED, f"WITH {routes_sql(LOW_THRESHOLD)} SELECT * FROM routed")
def knn_lsh_global(spark, sf):
    return lsh.knn_lsh(*_halves(spark, sf), PERMS, LOW_THRESHOLD)


@query("knn_lsh_local", ROUTED, f"WITH {routes_sql(LOW_THRESHOLD, True)} SELECT * FROM routed")
def knn_lsh_local(spark, sf):
    return lsh.knn_lsh(*_halves(spark, sf), PERMS, LOW_THRESHOLD, local=True)


@query("knn_on_candidates", "doc_id long, pred int, n_candidates long",
       f"WITH {routes_sql(THRESHOLD)} SELECT doc_id, pred, n_candidates FROM routed WHERE route = 'lsh'")
def knn_on_candidates(spark, sf):
    return lsh.candidate_route(lsh.prepare(*_halves(spark, sf), PERMS, [THRESHOLD]))


@query("bf_fallback", "doc_id long, pred int",
       f"WITH {routes_sql(THRESHOLD)} SELECT doc_id, pred FROM routed WHERE route = 'all'")
def bf_fallback(spark, sf):
    return lsh.all_route(lsh.prepare(*_halves(spark, sf), PERMS, [THRESHOLD]))


@query("union_routes", "doc_id long, pred int",
       f"WITH {routes_sql(THRESHOLD)} SELECT doc_id, pred FROM routed")
def union_routes(spark, sf):
    return lsh.knn_lsh(*_halves(spark, sf), PERMS, THRESHOLD)


@query("lsh_coverage", "n_lsh long, n_all long, n_test long, accuracy double",
       f"WITH {routes_sql(THRESHOLD)} SELECT count(*) FILTER (WHERE route = 'lsh') AS n_lsh,"
       " count(*) FILTER (WHERE route = 'all') AS n_all, count(*) AS n_test, avg((label = pred)::INT) AS accuracy FROM routed")
def lsh_coverage(spark, sf):
    predicted = stage(lsh.knn_lsh(*_halves(spark, sf), PERMS, THRESHOLD))
    # one row each
    return lsh.coverage(predicted).crossJoin(evaluate.accuracy(predicted))


# ---- sweep and analysis ---------------------------------------------------------------

RANKED_CANDIDATES = (
    " rs AS (SELECT c.bands, c.rows, c.test_id, d.label, n, row_number() OVER (PARTITION BY c.bands, c.rows, c.test_id ORDER BY dist, d.train_id) AS r"
    " FROM cand c JOIN dist d ON d.fold = c.fold AND d.test_id = c.test_id AND d.train_id = c.train_id"
    " JOIN nc ON nc.bands = c.bands AND nc.rows = c.rows AND nc.test_id = c.test_id),"
)
# the same with test sets limited to what their own candidates hold
RANKED_LOCALLY = (
    " la AS (SELECT c.bands, c.rows, c.test_id, count(DISTINCT x.term) AS la FROM cand c JOIN te_t x ON x.fold = c.fold AND x.doc_id = c.test_id"
    " JOIN tr_t y ON y.fold = c.fold AND y.doc_id = c.train_id AND y.term = x.term GROUP BY ALL),"
    " ls AS (SELECT c.bands, c.rows, c.test_id, c.train_id, r.label, CASE WHEN coalesce(la, 0) + b = 0 THEN 0.0"
    " ELSE 1.0 - CAST(coalesce(i, 0) AS DOUBLE) / (coalesce(la, 0) + b - coalesce(i, 0)) END AS dist FROM cand c"
    " JOIN tr_n r ON r.fold = c.fold AND r.doc_id = c.train_id"
    " LEFT JOIN la ON la.bands = c.bands AND la.rows = c.rows AND la.test_id = c.test_id"
    " LEFT JOIN inter q ON q.fold = c.fold AND q.test_id = c.test_id AND q.train_id = c.train_id),"
    " rs AS (SELECT ls.*, n, row_number() OVER (PARTITION BY ls.bands, ls.rows, ls.test_id ORDER BY dist, train_id) AS r"
    " FROM ls JOIN nc ON nc.bands = ls.bands AND nc.rows = ls.rows AND nc.test_id = ls.test_id),"
)
SWEEP = (
    f"{LABELLED}, {folds(4)}, {neighbours()}, {sig_sql('corpus')}, {GRID},"
    " shapes AS (SELECT DISTINCT bands, rows FROM grid),"
    " bk AS (SELECT s.doc_id, own, bands, rows, band, array_to_string(sig[band * rows + 1 : band * rows + rows], '-') AS band_key"
    " FROM sig s JOIN folded f ON f.doc_id = s.doc_id, (SELECT bands, rows, unnest(range(bands)) AS band FROM shapes)),"
    " cand AS (SELECT DISTINCT x.bands, x.rows, x.own AS fold, x.doc_id AS test_id, y.doc_id AS train_id FROM bk x JOIN bk y"
    " ON x.bands = y.bands AND x.rows = y.rows AND x.band = y.band AND x.band_key = y.band_key AND x.own <> y.own),"
    " nc AS (SELECT bands, rows, test_id, count(*) AS n FROM cand GROUP BY ALL),"
    + RANKED_CANDIDATES +
    f" pick AS (SELECT * FROM rs WHERE r <= {ADAPTIVE_K.format(n='n')}),"
    f" chosen AS ({voted('pick', 'bands, rows, test_id, n')}),"
    " sizes AS (SELECT own AS fold, count(*) AS n_test, (SELECT count(*) FROM corpus) - count(*) AS n_train FROM folded GROUP BY own),"
    " brute_pick AS (SELECT near.* FROM near JOIN sizes ON sizes.fold = near.fold WHERE rank <= "
    + ADAPTIVE_K.format(n="n_train") + "),"
    f" brute AS ({voted('brute_pick', 'fold, test_id, test_label')}),"
    " signed AS (SELECT own AS fold, count(*) AS c FROM sig JOIN folded ON folded.doc_id = sig.doc_id GROUP BY own),"
    " points AS (SELECT b.fold, g.perms, g.threshold, g.bands, b.test_label, b.pred AS all_pred, c.pred AS lsh_pred, c.n"
    " FROM brute b CROSS JOIN grid g LEFT JOIN chosen c ON c.bands = g.bands AND c.rows = g.rows AND c.test_id = b.test_id),"
    " scored AS (SELECT p.fold, 'lsh' AS method, perms, threshold, count(lsh_pred) AS n_lsh,"
    " avg((coalesce(lsh_pred, all_pred) = test_label)::INT) AS accuracy,"
    " any_value(bands) * ((SELECT count(*) FROM sig) - any_value(coalesce(c, 0))) AS build_work,"
    " coalesce(sum(n), 0) AS query_work,"
    " coalesce(sum(n), 0) + (count(*) - count(lsh_pred)) * any_value(n_train) AS compare_work"
    " FROM points p JOIN sizes ON sizes.fold = p.fold LEFT JOIN signed ON signed.fold = p.fold GROUP BY p.fold, perms, threshold"
    " UNION ALL SELECT b.fold, 'brute_force', NULL, NULL, 0, avg((pred = test_label)::INT), 0, 0, count(*) * any_value(n_train)"
    " FROM brute b JOIN sizes ON sizes.fold = b.fold GROUP BY b.fold),"
    " sweep AS (SELECT *, build_work + query_work + compare_work AS total_work FROM scored),"
    " lsh AS (SELECT * FROM sweep WHERE method = 'lsh')"
)
STAGES = ["build_work", "query_work", "compare_work"]
RESULT = (
    "fold int, method string, perms int, threshold double, n_lsh long, accuracy double,"
    " build_work long, query_work long, compare_work long, total_work long"
)


SWEEP_LOCAL = SWEEP.replace(RANKED_CANDIDATES, RANKED_LOCALLY).replace(GRID, grid_sql(sweep.LOCAL_THRESHOLDS))


@query("lsh_sweep", RESULT, f"WITH {SWEEP} SELECT * FROM sweep")
def lsh_sweep(spark, sf):
    return sweep.lsh_sweep(labelled(spark, sf))


@query("lsh_sweep_local", RESULT, f"WITH {SWEEP_LOCAL} SELECT * FROM sweep")
def lsh_sweep_local(spark, sf):
    return sweep.lsh_sweep(labelled(spark, sf), thresholds=sweep.LOCAL_THRESHOLDS, local=True)


_tables: dict[tuple, object] = {}


def _results(spark, sf, local: bool = False):
    """A sweep result, written once per session: its analyses read a finished table."""
    key = (spark.sparkContext.applicationId, sf, local)
    if key not in _tables:
        _tables[key] = stage((lsh_sweep_local if local else lsh_sweep)(spark, sf))
    return _tables[key]


@query("mean_by_threshold", "threshold double, mean_total double",
       f"WITH {SWEEP} SELECT threshold, round(avg(total_work), 6) AS mean_total FROM lsh GROUP BY threshold")
def mean_by_threshold(spark, sf):
    out = results.mean_by_threshold(_results(spark, sf), "total_work")
    return out.withColumn("mean_total", F.round("mean_total", 6))


@query("results_by_perms", RESULT, f"WITH {SWEEP} SELECT * FROM lsh")
def results_by_perms(spark, sf):
    """The rows of every permutation count, one selection after the other."""
    rows = _results(spark, sf)
    return reduce(DataFrame.unionByName, [results.results_by_perms(rows, p) for p in sweep.PERMS])


@query("total_time", "total double", f"WITH {SWEEP} SELECT round(sum(total_work) / 3600.0, 6) AS total FROM sweep")
def total_time(spark, sf):
    return results.total_cost(_results(spark, sf), "total_work").withColumn("total", F.round("total", 6))


@query("accuracy_per_second", "fold int, perms int, threshold double, accuracy_per_cost double",
       f"WITH {SWEEP} SELECT fold, perms, threshold, round(accuracy / nullif(total_work, 0), 9) AS accuracy_per_cost FROM lsh")
def accuracy_per_second(spark, sf):
    out = results.accuracy_per_cost(_results(spark, sf), "total_work")
    return out.withColumn("accuracy_per_cost", F.round("accuracy_per_cost", 9))


SHARES = ", ".join(f"round(100.0 * {s} / nullif(total_work, 0), 6) AS {s}" for s in STAGES)


@query("time_share", "fold int, perms int, threshold double, build_work double, query_work double, compare_work double",
       f"WITH {SWEEP} SELECT fold, perms, threshold, {SHARES} FROM lsh")
def time_share(spark, sf):
    out = results.stage_share(_results(spark, sf), STAGES, "total_work")
    return out.withColumns({s: F.round(s, 6) for s in STAGES})


@query("time_share_long", "fold int, perms int, threshold double, stage string, percent double",
       f"WITH {SWEEP}, wide AS (SELECT fold, perms, threshold, {SHARES} FROM lsh) "
       + " UNION ALL ".join(f"SELECT fold, perms, threshold, '{s}' AS stage, {s} AS percent FROM wide" for s in STAGES))
def time_share_long(spark, sf):
    out = results.stage_share_long(_results(spark, sf), STAGES, "total_work")
    return out.withColumn("percent", F.round("percent", 6))


@query("baseline_vs_lsh", "fold int, perms int, threshold double, accuracy double, total long, base_accuracy double, base_total long",
       f"WITH {SWEEP} SELECT l.fold, l.perms, l.threshold, l.accuracy, l.total_work AS total, b.accuracy AS base_accuracy,"
       " b.total_work AS base_total FROM lsh l JOIN sweep b ON b.fold = l.fold AND b.method = 'brute_force'")
def baseline_vs_lsh(spark, sf):
    return results.baseline_beside(_results(spark, sf), "total_work")


def _cte(text: str, prefix: str) -> str:
    """A chain of CTEs as one subquery, under a name of its own."""
    return f"{prefix} AS (WITH {text} SELECT * FROM lsh)"


@query("compare_runs", "fold int, perms int, threshold double, total_1 long, accuracy_1 double, total_2 long, accuracy_2 double",
       f"WITH {_cte(SWEEP, 'first')}, {_cte(SWEEP_LOCAL, 'second')} SELECT x.fold, x.perms, x.threshold, x.total_work AS total_1,"
       " x.accuracy AS accuracy_1, y.total_work AS total_2, y.accuracy AS accuracy_2 FROM first x JOIN second y"
       " ON x.fold = y.fold AND x.perms = y.perms AND x.threshold = y.threshold")
def compare_runs(spark, sf):
    """The sweep with the vocabulary of the training side beside that of each candidate list."""
    both = (results.grid_rows(_results(spark, sf, local)) for local in (False, True))
    return results.compare_runs(*both, "total_work")


# ---- the unlabelled set ------------------------------------------------------------------

ROUTES = " UNION ALL ".join(
    f"SELECT {t}::DOUBLE AS threshold, {minhash.band_params(PERMS, t)[0]} AS bands, {minhash.band_params(PERMS, t)[1]} AS rows"
    for t in lsh.UNLABELLED_THRESHOLDS
)


@query("knn_lsh_unlabelled", "threshold double, id long, sentiment int",
       f"WITH {LABELLED}, train AS (SELECT 0 AS fold, * FROM corpus), {UNLABELLED},"
       f" test AS (SELECT 0 AS fold, doc_id, text, NULL AS label FROM unlabelled), {neighbours()}, {sig_sql('documents')}, grid AS ({ROUTES}),"
       " shapes AS (SELECT DISTINCT bands, rows FROM grid),"
       " bk AS (SELECT doc_id, bands, rows, band, array_to_string(sig[band * rows + 1 : band * rows + rows], '-') AS band_key"
       " FROM sig, (SELECT bands, rows, unnest(range(bands)) AS band FROM shapes)),"
       " cand AS (SELECT DISTINCT x.bands, x.rows, x.doc_id AS test_id, y.doc_id AS train_id FROM bk x JOIN bk y"
       " ON x.bands = y.bands AND x.rows = y.rows AND x.band = y.band AND x.band_key = y.band_key"
       " WHERE x.doc_id IN (SELECT doc_id FROM test) AND y.doc_id IN (SELECT doc_id FROM train)),"
       " nc AS (SELECT bands, rows, test_id, count(*) AS n FROM cand GROUP BY ALL),"
       " rs AS (SELECT c.bands, c.rows, c.test_id, d.label, n, row_number() OVER (PARTITION BY c.bands, c.rows, c.test_id ORDER BY dist, d.train_id) AS r"
       " FROM cand c JOIN dist d ON d.test_id = c.test_id AND d.train_id = c.train_id"
       " JOIN nc ON nc.bands = c.bands AND nc.rows = c.rows AND nc.test_id = c.test_id),"
       f" pick AS (SELECT * FROM rs WHERE r <= {ADAPTIVE_K.format(n='n')}), chosen AS ({voted('pick', 'bands, rows, test_id')}),"
       f" near_pick AS (SELECT * FROM near WHERE rank <= (SELECT {ADAPTIVE_K.format(n='count(*)')} FROM train)),"
       f" brute AS ({voted('near_pick', 'test_id')})"
       " SELECT g.threshold, b.test_id AS id, coalesce(c.pred, b.pred) AS sentiment FROM brute b CROSS JOIN grid g"
       " LEFT JOIN chosen c ON c.bands = g.bands AND c.rows = g.rows AND c.test_id = b.test_id")
def knn_lsh_unlabelled(spark, sf):
    """Every unlabelled document at every threshold: (threshold, id, sentiment)."""
    return lsh.score_unlabelled(labelled(spark, sf), unlabelled(spark, sf), PERMS)
