"""Global row numbers without sorting a whole table in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simalign.session import stage

# Leading hex digits of the md5 key that name a bucket: at most 16**4 = 65,536 buckets,
# whatever the table size, so the bucket table may be broadcast or collected.
BUCKET_DIGITS = 4
# Ranges counted in one pass of a selection.
SELECT_BINS = 4096


def shuffle_key(id_col: str, seed: int) -> Column:
    """Pseudo-random, reproducible order key of a row id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def hash_rank(df: DataFrame, id_col: str, seed: int = 42, out: str = "rn") -> DataFrame:
    """1-based position of every row in the order (md5(seed:id), id).

    Rows are ranked inside md5-prefix buckets, which spread evenly, and shifted by the
    number of rows in the buckets before.
    """
    keyed = df.withColumn("_key", shuffle_key(id_col, seed)).withColumn(
        "_bucket", F.substring("_key", 1, BUCKET_DIGITS)
    )
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", id_col))
    return (
        keyed.join(F.broadcast(offsets), "_bucket")
        .withColumn(out, local + F.col("_offset"))
        .drop("_key", "_bucket", "_offset")
    )


def ordered_rank(df: DataFrame, *order: str | Column, out: str = "rn") -> DataFrame:
    """1-based position of every row in the given total order.

    A range partitioning places the rows; each partition then needs only the number of
    rows in the partitions before it. Placement is staged, because a second evaluation
    could choose other range bounds.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    part = F.shiftright("_pos", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    # one offset row per shuffle partition: a size set by configuration, not by data
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, within + F.col("_offset") + 1)
        .drop("_pos", "_part", "_offset")
    )


@dataclass(frozen=True)
class ShuffleOrder:
    """Boundaries in the seeded shuffle of a table, found without ranking its rows."""

    id_col: str
    seed: int
    size: int
    cuts: tuple[tuple[str, int] | None, ...]

    def slot(self) -> Column:
        """How many cuts lie strictly before a row: 0 for rows up to the first cut."""
        key, row_id = shuffle_key(self.id_col, self.seed), F.col(self.id_col)
        slot = F.lit(0)
        for cut in self.cuts:
            if cut is None:  # a cut before the first row
                slot = slot + 1
                continue
            after = (key > cut[0]) | ((key == cut[0]) & (row_id > cut[1]))
            slot = slot + after.cast("int")
        return slot


def shuffle_order(df: DataFrame, id_col: str, seed: int, ranks) -> ShuffleOrder:
    """Find the rows at given positions of the seeded shuffle.

    `ranks` is a function of the row count returning the positions to cut after. Only
    the bucket sizes (at most 65,536 numbers) and one row per cut reach the driver; the
    table itself is then split by a plain filter, with no shuffle of its rows.
    """
    keyed = df.select(shuffle_key(id_col, seed).alias("_key"), F.col(id_col).alias("_id"))
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    sizes = sorted(
        (r["_bucket"], r["n"]) for r in keyed.groupBy("_bucket").agg(F.count("*").alias("n")).collect()
    )
    total = sum(n for _, n in sizes)
    wanted = [min(r, total) for r in ranks(total)]
    starts, acc = {}, 0
    for bucket, n in sizes:
        starts[bucket] = (acc, n)
        acc += n
    local = {}
    for r in wanted:
        for bucket, (start, n) in starts.items():
            if start < r <= start + n:
                local[r] = (bucket, r - start)
    rows = []
    if local:
        hit = keyed.filter(F.col("_bucket").isin(sorted({b for b, _ in local.values()})))
        numbered = hit.withColumn(
            "_rn", F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", "_id"))
        )
        cond = F.lit(False)
        for bucket, pos in set(local.values()):
            cond = cond | ((F.col("_bucket") == bucket) & (F.col("_rn") == pos))
        rows = numbered.filter(cond).collect()
    found = {(r["_bucket"], r["_rn"]): (r["_key"], r["_id"]) for r in rows}
    cuts = tuple(found[local[r]] if r in local else None for r in wanted)
    return ShuffleOrder(id_col, seed, total, cuts)


def nth_smallest(df: DataFrame, key: Column, n: int) -> tuple[int | None, int]:
    """The n-th smallest of whole numbers, repeats counted and NULLs left out, and how many are smaller.

    (None, how many there are) if they are fewer than n. Counts of `SELECT_BINS` equal ranges show in
    which one it lies, which is then cut again: a range shrinks to one number in six passes at
    most. Each pass reads the key alone, and no row moves.
    """
    keys = df.select(key.alias("k")).filter("k IS NOT NULL")
    low, high, total = keys.agg(F.min("k"), F.max("k"), F.count("k")).first()
    if n < 1 or total < n:
        return None, total
    below = 0
    while low < high:
        width = (high - low) // SELECT_BINS + 1
        # decimals, as the difference of two long values need not be one
        place = F.expr(f"(CAST(k AS decimal(20, 0)) - ({low})) div {width}").alias("bin")
        for r in sorted(keys.filter(F.col("k").between(low, high)).groupBy(place).count().collect()):
            if below + r["count"] >= n:
                break
            below += r["count"]
        low, high = low + r["bin"] * width, min(high, low + (r["bin"] + 1) * width - 1)
    return low, below
