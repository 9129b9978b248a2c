"""MinHash signatures, banding and candidate pairs."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simalign.session import stage

# Modulus of the hash family and the hex digits of md5 kept per token
# (h < 2**28), so that a * h + b stays far below 2**63.
PRIME = 2**31 - 1
HEX_DIGITS = 7
MAX_PERMS = 64

# Rows of either side of one bucket that meet in one task; fuller buckets are split in blocks.
BLOCK_ROWS = 4096
# Pairs that are worth a task of their own.
TASK_PAIRS = 1 << 23


def hash_family(perms: int = MAX_PERMS) -> list[tuple[int, int]]:
    """(a, b) of each permutation. The first n of a longer family are the family of n."""
    state, out = 42, []
    for _ in range(perms):
        pair = []
        for _ in range(2):
            state = (state * 48271) % PRIME  # Lehmer generator
            pair.append(state)
        out.append((pair[0], pair[1]))
    return out


def token_hash(token: Column) -> Column:
    return F.conv(F.substring(F.md5(token), 1, HEX_DIGITS), 16, 10).cast("bigint")


def signatures(docs: DataFrame, tokens: Column, *keys: str, perms: int = MAX_PERMS) -> DataFrame:
    """(keys, sig): per permutation the minimum hash over the tokens of a document.

    Documents without tokens have no signature. All tokens of a document sit in one task
    before the aggregation, so one row per document is shuffled.
    """
    rows = docs.select(*keys, F.explode_outer(tokens).alias("_token"))
    hashed = rows.filter(F.col("_token").isNotNull()).select(
        *keys, token_hash(F.col("_token")).alias("_h")
    )
    minima = [
        F.expr(f"min((_h * {a}L + {b}L) % {PRIME}L) AS _m{i}")
        for i, (a, b) in enumerate(hash_family(perms))
    ]
    return (
        hashed.groupBy(*keys)
        .agg(*minima)
        .select(*keys, F.array(*[f"_m{i}" for i in range(perms)]).alias("sig"))
    )


@lru_cache(maxsize=None)
def band_params(perms: int, threshold: float) -> tuple[int, int]:
    """(bands, rows) with the least false-positive plus false-negative area at `threshold`.

    Documents of similarity s share a bucket with chance 1 - (1 - s**rows)**bands. Midpoint
    rule, step 0.001; ties go to fewer bands, then fewer rows.
    """
    import numpy as np

    s = (np.arange(1000) + 0.5) / 1000
    below = s < threshold
    best = None
    for bands in range(1, perms + 1):
        for rows in range(1, perms // bands + 1):
            hit = 1 - (1 - s**rows) ** bands
            area = round(float(hit[below].sum() + (1 - hit[~below]).sum()) / 2000, 9)
            if best is None or area < best[0]:
                best = (area, bands, rows)
    return best[1], best[2]


def band_keys(sig: Column, bands: int, rows: int) -> Column:
    """Array of (band, band_key) over the first bands * rows signature values."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.struct(
            b.alias("band"),
            F.concat_ws("-", F.slice(sig, b * rows + 1, rows).cast("array<string>")).alias("band_key"),
        ),
    )


def band_rows(signed: DataFrame, bands: int, rows: int, *keys: str) -> DataFrame:
    """(keys, band, band_key), one row per band."""
    return signed.select(*keys, F.inline(band_keys(F.col("sig"), bands, rows)))


def band_codes(sig: Column, bands: int, rows: int, out: str) -> list[Column]:
    """The values of all bands as longs out0, out1, ..., two values to a long: as many longs for every band.

    Columns of their own, as they are compared for every pair.
    """
    def value(at: int) -> Column:
        return F.coalesce(F.get(sig, F.lit(at)), F.lit(0).cast("long"))

    codes = []
    for start in range(0, bands * rows, rows):
        for at in range(start, start + rows, 2):
            codes.append(F.shiftleft(value(at), 31) + value(at + 1) if at + 1 < start + rows else value(at))
    return [code.alias(f"{out}{i}") for i, code in enumerate(codes)]


def earlier_codes(banded: DataFrame, out: str, bands: int, rows: int) -> DataFrame:
    """Rows of a band with the codes of the bands before it; the others are -1, which no code is."""
    longs = -(-rows // 2)
    return banded.withColumns({
        f"{out}{i}": F.when(F.col("band") > i // longs, F.col(f"{out}{i}")).otherwise(F.lit(-1).cast("long")) for i in range(bands * longs)
    })


def first_shared(x: str, y: str, bands: int, rows: int) -> Column:
    """Whether no earlier band has the same values, from the `earlier_codes` x of one side and the `band_codes` y of the other."""
    longs = -(-rows // 2)
    same = [[F.col(f"{x}{i}") == F.col(f"{y}{i}") for i in range(b, b + longs)] for b in range(0, (bands - 1) * longs, longs)]
    return ~reduce(Column.__or__, [reduce(Column.__and__, s) for s in same], F.lit(False))


def bucket_pairs(
    test_bands: DataFrame, train_bands: DataFrame, on: list[str], test_id: str, train_id: str,
    keep: Column | None = None, once: Column | None = None,
) -> DataFrame:
    """Distinct (on[:-2], test_id, train_id) sharing at least one bucket.

    `on` ends with band and band_key. Buckets with more than BLOCK_ROWS rows of a side are
    cut into blocks of both: a row belongs to one block of its side and visits all of the other.
    There is a task for about every TASK_PAIRS pairs, counted beforehand. `once` is true of a pair in one of
    the buckets it shares only; without it equal pairs are found by shuffling them.
    """
    sizes = [side.groupBy(*on).agg(F.count("*").alias(n)) for side, n in ((test_bands, "_n_test"), (train_bands, "_n_train"))]
    counts = stage(sizes[0].join(sizes[1], on))
    pairs = counts.agg(F.sum(F.col("_n_test") * F.col("_n_train"))).first()[0] or 0
    tasks = max(counts.sparkSession.sparkContext.defaultParallelism, -(-pairs // TASK_PAIRS))
    full = counts.filter(F.greatest("_n_test", "_n_train") > BLOCK_ROWS).select(
        *on, *[F.ceil(F.col(n) / BLOCK_ROWS).cast("int").alias(out) for n, out in (("_n_test", "_tests"), ("_n_train", "_trains"))]
    )

    def placed(side: DataFrame, row: str, own: str, other: str) -> DataFrame:
        blocks = {c: F.coalesce(c, F.lit(1)) for c in (own, other)}
        cut = side.join(full, on, "left").withColumn("_own", F.pmod(F.hash(row), blocks[own]))
        every = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks[other] - 1)))
        return every.drop("_tests", "_trains").withColumnsRenamed({"_own": own, "_other": other}).repartition(tasks, *on, "_tests", "_trains")

    test, train = placed(test_bands, test_id, "_tests", "_trains"), placed(train_bands, train_id, "_trains", "_tests")
    met = test.join(train, [*on, "_tests", "_trains"])
    if keep is not None:
        met = met.filter(keep)
    if once is not None:
        return met.filter(once).select(*on[:-2], test_id, train_id)
    return met.select(*on[:-2], test_id, train_id).distinct()
