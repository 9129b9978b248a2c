"""Seeded shuffles, holdout splits and folds over stable row ids."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simalign.operators.rank import hash_rank, nth_smallest, ordered_rank, shuffle_order

SEED = 42


def shuffle_seeded(df: DataFrame, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Every row with its position `rn` in the seeded shuffle."""
    return hash_rank(df, id_col, seed)


def split_head_tail(
    df: DataFrame, n_train: int, n_test: int, id_col: str = "doc_id", seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """First `n_train` shuffled rows, last `n_test` shuffled rows (they may overlap)."""
    order = shuffle_order(df, id_col, seed, lambda n: [n_train, max(n - n_test, 0)])
    head, tail = (type(order)(id_col, seed, order.size, (c,)) for c in order.cuts)
    return df.filter(head.slot() == 0), df.filter(tail.slot() == 1)


def split_fraction(
    df: DataFrame, test_fraction: float, id_col: str = "doc_id", seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test): the first ceil(n * fraction) shuffled rows are the test set."""
    order = shuffle_order(df, id_col, seed, lambda n: [math.ceil(n * test_fraction)])
    return df.filter(order.slot() == 1), df.filter(order.slot() == 0)


def split_three_way(
    df: DataFrame, n_train: int, n_val: int, n_test: int, id_col: str = "doc_id", seed: int = SEED
) -> DataFrame:
    """Consecutive train / val / test slices of the shuffle, as column `part`."""
    order = shuffle_order(
        df, id_col, seed, lambda n: [n_train, n_train + n_val, n_train + n_val + n_test]
    )
    slot = order.slot()
    part = F.when(slot == 0, "train").when(slot == 1, "val").when(slot == 2, "test")
    return df.withColumn("part", part).filter(F.col("part").isNotNull())


def split_static(df: DataFrame, n_first: int, id_col: str = "doc_id") -> DataFrame:
    """Unshuffled: first `n_first` rows by id are `train_val`, the rest `test`.

    The last id of the first part is found by counting (whole-number ids), so no row moves. A
    NULL id is in the test part.
    """
    edge, total = nth_smallest(df, F.col(id_col), n_first)
    if edge is None:  # the first part is all rows or none
        edge = df.agg(F.max(id_col)).first()[0] if n_first > total else None
    return df.withColumn("part", F.when(F.col(id_col) <= F.lit(edge), "train_val").otherwise("test"))


def subsample_n(df: DataFrame, n: int, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The first n rows of the seeded shuffle."""
    return df.filter(shuffle_order(df, id_col, seed, lambda total: [n]).slot() == 0)


def kfold_assign(df: DataFrame, k: int, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Column `fold` 0..k-1; the first (n mod k) folds hold one row more."""

    def edges(n: int) -> list[int]:
        size, extra = divmod(n, k)
        return [size * (i + 1) + min(i + 1, extra) for i in range(k - 1)]

    return df.withColumn("fold", shuffle_order(df, id_col, seed, edges).slot())


def cv_frames(folded: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) of all folds at once, keyed by `fold`.

    A row is a test row in its own fold and a training row in the k-1 others.
    """
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f != F.col("_own"))
    train = folded.withColumnRenamed("fold", "_own").withColumn("fold", F.explode(others)).drop("_own")
    return train, folded


def assign_batches(df: DataFrame, batch_rows: int, id_col: str = "doc_id") -> DataFrame:
    """Contiguous batches of `batch_rows` rows in id order, as `batch_id` from 0."""
    batch = F.floor((F.col("rn") - 1) / batch_rows).cast("int")
    return ordered_rank(df, id_col).withColumn("batch_id", batch).drop("rn")
