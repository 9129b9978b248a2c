"""Neighbour lists to predictions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# From this many training rows on, k is constant.
FULL_K_FROM = 225
FULL_K = 15


def adaptive_k(n: int) -> int:
    return math.ceil(math.sqrt(n)) if n < FULL_K_FROM else FULL_K


def adaptive_k_column(n: Column) -> Column:
    return F.when(n < FULL_K_FROM, F.ceil(F.sqrt(n))).otherwise(FULL_K).cast("int")


def vote(neighbours: DataFrame, *by: str) -> DataFrame:
    """(by, pred): the most frequent label; ties go to the smallest label."""
    return neighbours.groupBy(*by).agg(F.mode("label", True).alias("pred"))


def vote_many_k(neighbours: DataFrame, ks: Column, *by: str) -> DataFrame:
    """(by, k, pred) for several k from one neighbour list; `ks` is an array of k values.

    A list is gathered once per test row, where it already lies, and every k counts its first
    k labels: rows are not repeated for each k.
    """
    gathered = neighbours.groupBy(*by).agg(
        F.collect_list(F.struct("rank", "label")).alias("_n"), F.first(F.array_distinct(ks)).alias("_ks")
    )
    labels = F.array_distinct(F.filter(F.transform("_n", lambda x: x["label"]), lambda v: v.isNotNull()))

    def best(k: Column) -> Column:
        def votes(label: Column) -> Column:
            mine = F.filter("_n", lambda x: (x["rank"] <= k) & (x["label"] == label))
            return F.struct(F.size(mine).alias("n"), (-label).alias("m"))

        return -F.array_max(F.transform("_labels", votes))["m"]

    return gathered.withColumn("_labels", labels).select(
        *by, F.inline(F.transform("_ks", lambda k: F.struct(k.alias("k"), best(k).alias("pred"))))
    )
