"""The classifier with MinHash candidates and a brute-force route for documents without any."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simalign.functions.tokens import fill_text, whitespace_tokens
from simalign.operators import minhash
from simalign.operators import neighbours as nb
from simalign.operators.buckets import candidate_lists
from simalign.operators.candidates import candidate_pairs
from simalign.operators.vote import FULL_K, adaptive_k, adaptive_k_column, vote
from simalign.plans.classify import term_sets
from simalign.session import stage


def signed(docs: DataFrame, *keys: str, perms: int = minhash.MAX_PERMS) -> DataFrame:
    """(keys, sig) over the whitespace tokens of every document that has any."""
    return minhash.signatures(docs, whitespace_tokens(fill_text(F.col("text"))), *keys, perms=perms)


def lsh_candidates(train: DataFrame, test: DataFrame, perms: int, threshold: float) -> DataFrame:
    """(test_id, train_id) sharing at least one band bucket."""
    bands, rows = minhash.band_params(perms, threshold)

    def banded(docs: DataFrame, id_col: str, out: str) -> DataFrame:
        made = stage(signed(docs.select(F.col("doc_id").alias(id_col), "text"), id_col, perms=bands * rows))
        codes = minhash.band_codes(F.col("sig"), bands, rows, out)
        return minhash.band_rows(made.select("*", *codes), bands, rows, id_col, *[f"{out}{i}" for i in range(len(codes))])

    return minhash.bucket_pairs(
        minhash.earlier_codes(banded(test, "test_id", "_x"), "_x", bands, rows), banded(train, "train_id", "_y"),
        ["band", "band_key"], "test_id", "train_id",
        once=minhash.first_shared("_x", "_y", bands, rows),
    )


def candidates_beside(train: DataFrame, test: DataFrame, perms: int, threshold: float, content: Column) -> DataFrame:
    """(test_id, train_id, x, y): the same pairs with a column of both documents, for any metric of two columns."""
    bands, rows = minhash.band_params(perms, threshold)

    def side(docs: DataFrame) -> DataFrame:
        met = docs.select("doc_id", content.alias("content")).join(signed(docs, "doc_id", perms=bands * rows), "doc_id")
        return stage(met.select(F.col("doc_id").alias("id"), "sig", "content"))

    return candidate_pairs(side(train), side(test), bands, rows)


def split_by_candidates(test: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with candidates, documents without)."""
    served = candidates.select(F.col("test_id").alias("doc_id"))
    return test.join(served, "doc_id", "left_semi"), test.join(served, "doc_id", "left_anti")


def signed_sets(docs: DataFrame, perms: int, *also: str) -> DataFrame:
    """(fold, doc_id, label, also, terms, sig); `sig` is NULL without tokens."""
    return term_sets(docs, *also).join(signed(docs, "doc_id", perms=perms), "doc_id", "left")


@dataclass(frozen=True)
class Run:
    """Collapsed training groups and the queries, both staged with signatures, and the band shapes."""

    groups: DataFrame
    queries: DataFrame
    shapes: list[tuple[int, int]]
    n_train: int


def prepare(train: DataFrame, test: DataFrame, perms: int, thresholds: list[float]) -> Run:
    """Signatures and term ids once, for every band shape the thresholds ask for."""
    shapes = sorted({minhash.band_params(perms, t) for t in thresholds})
    used = max(bands * rows for bands, rows in shapes)
    marked = train.withColumn("is_test", F.lit(False)).unionByName(
        test.withColumn("is_test", F.lit(True)), allowMissingColumns=True
    )
    sides = stage(signed_sets(marked, used, "is_test"))
    train_sets = sides.filter(~F.col("is_test"))
    encoded = stage(nb.encode_sets(sides, nb.vocabulary(train_sets), "sig", by=("is_test",)))
    # one grouping serves both routes: equal sets with other signatures are two groups, which does no harm
    groups = stage(nb.collapse(encoded.filter(~F.col("is_test")), FULL_K, "sig", counted=True))
    queries = encoded.filter("is_test")
    return Run(groups, nb.queries_of(queries, "sig"), shapes, train_sets.count())


def by_candidates(run: Run, local: bool = False) -> DataFrame:
    """(bands, rows, test_id, n_candidates, pred) of the test documents with candidates.

    `local` counts only those terms of a test document that its own candidates hold;
    otherwise all terms of the training side count.
    """
    lists = candidate_lists(run.groups, run.queries, run.shapes, FULL_K, local)
    per_test = Window.partitionBy("shape", "test_id")
    ranked = lists.withColumns({
        "n_candidates": F.sum("n").over(per_test),
        "rank": F.row_number().over(per_test.orderBy("dist", "train_id")),
    })
    near = ranked.filter(F.col("rank") <= adaptive_k_column(F.col("n_candidates")))
    shape = [F.array(*[F.lit(s[i]) for s in run.shapes])[F.col("shape")].alias(c) for i, c in enumerate(SHAPE)]
    return vote(near, "shape", "test_id", "n_candidates").select(*shape, "test_id", "n_candidates", "pred")


def by_all(run: Run, tests: DataFrame) -> DataFrame:
    """(test_id, pred) of the given test documents from the whole training side."""
    rest = run.queries.join(tests, "test_id", "left_semi")
    return vote(nb.search(run.groups, rest, adaptive_k(run.n_train)), "test_id")


def without_candidates(run: Run) -> DataFrame:
    """(test_id) of test documents that have no candidate in some of the shapes."""
    def keyed(df: DataFrame, *columns: str) -> DataFrame:
        keys = F.explode(F.concat(*[shape_keys(b, r) for b, r in run.shapes])).alias("_k")
        return df.filter("sig IS NOT NULL").select(*columns, keys).select(*columns, "_k.*")

    on = [*SHAPE, "band", "band_key"]
    met = keyed(run.queries, "test_id").join(keyed(run.groups).distinct(), on, "left_semi")
    return _unserved(run, met)


def _unserved(run: Run, served: DataFrame) -> DataFrame:
    every = served.groupBy("test_id").agg(F.count_distinct(*SHAPE).alias("_n")).filter(F.col("_n") == len(run.shapes))
    return run.queries.select("test_id").join(every, "test_id", "left_anti")


SHAPE = ["bands", "rows"]


def shape_keys(bands: int, rows: int) -> Column:
    """Band keys with the shape they belong to."""

    def tag(entry):
        return F.struct(
            F.lit(bands).alias("bands"), F.lit(rows).alias("rows"),
            entry["band"].alias("band"), entry["band_key"].alias("band_key"),
        )

    return F.transform(minhash.band_keys(F.col("sig"), bands, rows), tag)


def candidate_route(run: Run, local: bool = False) -> DataFrame:
    """(doc_id, label, pred, route, n_candidates) of the documents the candidates serve."""
    voted = by_candidates(run, local).withColumn("route", F.lit("lsh"))
    return _labelled(run, voted)


def all_route(run: Run, rest: DataFrame | None = None) -> DataFrame:
    """The same for the documents without candidates; `rest` (test_id) if they are known."""
    rest = without_candidates(run) if rest is None else rest
    voted = by_all(run, rest).withColumn("route", F.lit("all"))
    return _labelled(run, voted.withColumn("n_candidates", F.lit(0).cast("bigint")))


def _labelled(run: Run, voted: DataFrame) -> DataFrame:
    return voted.join(run.queries.select("test_id", "test_label"), "test_id").select(
        F.col("test_id").alias("doc_id"), F.col("test_label").alias("label"), "pred", "route", "n_candidates"
    )


def knn_lsh(train: DataFrame, test: DataFrame, perms: int, threshold: float, local: bool = False) -> DataFrame:
    """(doc_id, label, pred, route, n_candidates), one row per test document: both routes."""
    run = prepare(train, test, perms, [threshold])
    served = stage(candidate_route(run, local))
    rest = run.queries.select("test_id").join(served.select(F.col("doc_id").alias("test_id")), "test_id", "left_anti")
    return served.unionByName(all_route(run, rest))


# The thresholds the unlabelled set is scored at.
UNLABELLED_THRESHOLDS = [0.35, 0.4, 0.5, 0.6, 0.7, 0.8]


def score_unlabelled(
    train: DataFrame, unlabelled: DataFrame, perms: int, thresholds: list[float] = UNLABELLED_THRESHOLDS
) -> DataFrame:
    """(threshold, id, sentiment): every unlabelled document at every threshold.

    Signatures are made once, thresholds with equal bands share their candidates, and a
    document without candidates at some threshold is compared with all training documents.
    """
    run = prepare(train, unlabelled, perms, thresholds)
    points = [(float(t), *minhash.band_params(perms, t)) for t in thresholds]
    grid = train.sparkSession.createDataFrame(points, "threshold double, bands int, rows int")
    chosen = stage(by_candidates(run).select(*SHAPE, "test_id", F.col("pred").alias("_lsh")))
    rest = by_all(run, _unserved(run, chosen)).select("test_id", F.col("pred").alias("_all"))
    # the grid is a handful of literal rows
    every = run.queries.select("test_id").crossJoin(F.broadcast(grid))
    return (
        every.join(chosen, [*SHAPE, "test_id"], "left").join(rest, "test_id", "left")
        .select("threshold", F.col("test_id").alias("id"), F.coalesce("_lsh", "_all").alias("sentiment"))
    )


def coverage(predicted: DataFrame) -> DataFrame:
    """Test documents served by each route."""
    lsh: Column = F.col("route") == "lsh"
    return predicted.agg(
        F.count_if(lsh).alias("n_lsh"), F.count_if(~lsh).alias("n_all"), F.count("*").alias("n_test")
    )
