"""Which document representation classifies best under Jaccard distance?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simalign.functions.tokens import fill_text, index_tokens
from simalign.operators.neighbours import nearest
from simalign.plans.classify import neighbour_lists, predictions
from simalign.session import stage

# Stands for the padding value 0; no token can hold a line break.
PAD = "\n"


def padded_sets(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct elements of zero-padded index sequences, as sets of terms.

    A sequence shorter than the longest one is padded, and the padding value then counts as
    one more element. Words the training side does not know are dropped before measuring.
    """
    tokens = index_tokens(fill_text(F.col("text")))
    both = stage(
        train.select("doc_id", "label", tokens.alias("tokens"), F.lit(False).alias("is_test")).unionByName(
            test.select("doc_id", "label", tokens.alias("tokens"), F.lit(True).alias("is_test"))
        )
    )
    words = both.select("doc_id", "is_test", F.explode_outer("tokens").alias("term")).filter(
        F.col("term").isNotNull()
    )
    known = words.filter(~F.col("is_test")).select("term").distinct()
    lengths = (
        words.join(known, "term", "left_semi").groupBy("doc_id", "is_test").agg(F.count("*").alias("n"))
    )
    sized = both.join(lengths, ["doc_id", "is_test"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    longest = lengths.agg(F.max("n").alias("longest"))  # one row
    padded = F.when(F.col("n") < F.col("longest"), F.array(F.lit(PAD))).otherwise(
        F.array().cast("array<string>")
    )
    sets = stage(
        sized.crossJoin(F.broadcast(longest)).select(
            F.lit(0).alias("fold"), "doc_id", "label", "is_test",
            F.concat(F.array_distinct("tokens"), padded).alias("terms"),
        )
    )
    return sets.filter(~F.col("is_test")).drop("is_test"), sets.filter("is_test").drop("is_test")


def representation_study(train: DataFrame, test: DataFrame, k: int = 5) -> DataFrame:
    """(representation, doc_id, label, pred) for four representations.

    Counts, one-hot and TF-IDF vectors differ in weights only; Jaccard distance looks at
    presence, so the three share one neighbour list.
    """
    shared = predictions(neighbour_lists(train, test, k))
    sequences = predictions(nearest(*padded_sets(train, test), k))
    names = F.explode(F.array(*map(F.lit, ("counts", "one_hot", "tfidf"))))
    return shared.withColumn("representation", names).unionByName(
        sequences.withColumn("representation", F.lit("padded_sequence"))
    )
