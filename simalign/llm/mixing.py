"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted target / size times, a whole number of copies and a
fraction. Fractions are rounded in pairs: mass, counted in words, moves at random from one
document to the other until one of the two is wanted a whole number of times. A move keeps
the words of the pair and, on average, each document's share, so a source ends within one
document of its target. Documents are dealt to small groups by a seeded hash; a group leaves
one document at most, and the rests of `FAN` groups form a group of the next level, up to
one rest per source, which a seeded draw decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from simalign.operators.rank import ordered_rank
from simalign.session import stage

FAN = 1024
WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0


def word_count(text: Column) -> Column:
    """Runs of anything but space and 0x09-0x0D; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source_col: str, size_col: str, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, documents, weight, target), one row per source.

    Sources in code-point order, NULL last, take the weights in turn and share the total
    size; a target stops at `cap` times its source's size and the excess is shared again by
    weight. Each round is one aggregate over the sources, of which one row reaches the driver.
    """
    stats = sized.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(size_col).alias("source_size"), F.count("*").alias("documents")
    )
    ranked = ordered_rank(stats, F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rn") - 1) % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumn("weight", turn).drop("rn"))
    full = F.lit(cap) * F.col("source_size")
    first = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total = float(first[0] or 0)
    level, capped = total / (first[1] or 1.0), -1
    while True:  # the level only rises: each round caps at least one more source
        over = F.lit(level) * F.col("weight") > full
        held, free, n = ranked.agg(
            F.coalesce(F.sum(F.when(over, full)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1)),
        ).first()
        if n == capped or free <= 0:
            break
        capped = n
        level = max(level, (total - held) / free)
    over = F.lit(level) * F.col("weight") > full
    return ranked.withColumn("target", F.when(over, full).otherwise(F.lit(level) * F.col("weight")))


def _uniform(*parts) -> Column:
    """A reproducible number in [0, 1) from a hash of the given values."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pivotal rounding along rows sorted by group; the last columns are its state.

    A row leaves when it is decided, or undecided as the rest of its group.
    """
    held = None  # (group, share, size, one-row batch)

    def out(rows: pa.RecordBatch, share, done) -> pa.RecordBatch:
        names = rows.schema.names
        columns = [rows.column(n) for n in names if n not in ("_mx_share", "_mx_done", "_mx_draw")]
        kept = [n for n in names if n not in ("_mx_share", "_mx_done", "_mx_draw")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(share, pa.float64()), pa.array(done, pa.bool_())], [*kept, "_mx_share", "_mx_done"]
        )

    for batch in batches:
        sources, buckets = batch.column("_mx_source").to_pylist(), batch.column("_mx_bucket").to_pylist()
        shares, sizes = batch.column("_mx_share").to_pylist(), batch.column("_mx_size").to_pylist()
        draws = batch.column("_mx_draw").to_pylist()
        here, at = None, -1  # the undecided row: in this batch (at >= 0) or held from before
        left = []  # rows of this batch that end undecided
        if held is not None:
            here = held[:3]
        for i, group in enumerate(zip(sources, buckets, strict=True)):
            p, s = shares[i], sizes[i]
            if here is not None and here[0] != group:
                if at >= 0:
                    left.append(at)
                else:
                    yield out(held[3], [here[1]], [False])
                    held = None
                here, at = None, -1
            if here is None:
                here, at = (group, p, s), i
                continue
            q, t = here[1], here[2]
            gain, loss = min((1 - q) * t, p * s), min(q * t, (1 - p) * s)
            if draws[i] * (gain + loss) < loss:  # the undecided row takes `gain` words
                full = (1 - q) * t <= p * s
                first_whole, second_whole = full, p * s <= (1 - q) * t
                new_q, new_p = (1.0 if first_whole else q + gain / t), (0.0 if second_whole else p - gain / s)
            else:
                first_whole, second_whole = q * t <= (1 - p) * s, (1 - p) * s <= q * t
                new_q, new_p = (0.0 if first_whole else q - loss / t), (1.0 if second_whole else p + loss / s)
            shares[i] = new_p
            if at >= 0:
                shares[at] = new_q
            if first_whole and at < 0:
                yield out(held[3], [new_q], [True])
                held = None
            if first_whole and second_whole:
                here, at = None, -1
            elif first_whole:
                here, at = (group, new_p, s), i
            else:
                here = (group, new_q, t)
        open_rows = set(left)
        if at >= 0:
            open_rows.add(at)
        rows = [i for i in range(len(shares)) if i != at]
        if rows:
            kept = batch.take(pa.array(rows, pa.int64())) if at >= 0 else batch
            yield out(kept, [shares[i] for i in rows], [i not in open_rows for i in rows])
        if at >= 0:
            held = (*here, batch.take(pa.array([at], pa.int64())))
        elif here is not None:
            held = (*here, held[3])
    if held is not None:
        yield out(held[3], [held[1]], [False])


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
    weights=WEIGHTS, cap: float = CAP, seed: int = 42, prefix: str = "",
) -> DataFrame:
    """`docs` with source_size, target and copies (0 to ceil(cap)), one row per row.

    The new columns take `prefix`; all others are kept, apart from earlier ones of these names. Reruns agree, as
    every draw is a hash of seed, level and all columns but maps; which of equal rows takes a
    copy does not show. A NULL source is a source
    of its own, a NULL size counts 0, a NULL id is an id. Rows of size 0 have no copy. An
    empty table gives an empty result.
    """
    new = [prefix + c for c in ("source_size", "target", "copies")]
    docs = docs.drop(*new)
    wanted = docs.columns
    tie = F.xxhash64(*[f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    sized = docs.withColumn("_mx_source", F.col(source_col)).withColumn("_mx_tie", tie).withColumn(
        "_mx_size", F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    )
    targets = source_targets(sized, "_mx_source", "_mx_size", weights, cap)
    targets = targets.select(
        F.col("source").alias("_mx_key"), F.col("source_size").alias("_mx_total"), F.col("target").alias("_mx_target"),
        F.col("documents").alias("_mx_documents"),
    )
    rate = F.when(F.col("_mx_total") > 0, F.col("_mx_target") / F.col("_mx_total")).otherwise(0.0)
    rate = F.least(rate, F.lit(cap))
    groups = F.ceil(F.col("_mx_documents") / FAN)
    # one small row per source: whether it is broadcast is left to its size
    joined = (
        sized.join(targets, F.col("_mx_source").eqNullSafe(F.col("_mx_key")))
        .withColumn("_mx_whole", F.floor(rate))
        .withColumn("_mx_share", rate - F.col("_mx_whole"))
        .withColumn("_mx_bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("_mx_tie")), groups))
        .select(*wanted, "_mx_total", "_mx_target", "_mx_source", "_mx_size", "_mx_tie", "_mx_whole", "_mx_bucket", "_mx_share")
    )
    settled = (F.col("_mx_size") <= 0) | (F.col("_mx_share") <= 0)
    columns = [*wanted, F.col("_mx_total").alias(new[0]), F.col("_mx_target").alias(new[1])]

    def finished(df: DataFrame) -> DataFrame:
        copies = F.when(F.col("_mx_size") > 0, F.col("_mx_whole") + F.round("_mx_share")).otherwise(0)
        return df.select(*columns, copies.cast("int").alias(new[2]))

    most = targets.agg(F.max("_mx_documents")).first()[0] or 0
    parts = [finished(joined.filter(settled).withColumn("_mx_share", F.lit(0.0)))]
    open_rows, level, buckets = joined.filter(~settled), 0, -(-most // FAN)
    while True:
        draw = _uniform(F.lit(seed), F.lit(level), F.col("_mx_tie"))
        dealt = (
            open_rows.withColumn("_mx_draw", draw)
            .repartition("_mx_source", "_mx_bucket")
            .sortWithinPartitions("_mx_source", "_mx_bucket", "_mx_draw", "_mx_tie")
        )
        fields = [f for f in dealt.schema.fields if f.name not in ("_mx_share", "_mx_draw")]
        schema = StructType([
            *(StructField(f.name, f.dataType) for f in fields), StructField("_mx_share", dealt.schema["_mx_share"].dataType),
            StructField("_mx_done", BooleanType()),
        ])
        # read twice: its decided rows are results, its rests the next level
        rounded = stage(dealt.mapInArrow(_pair_up, schema))
        parts.append(finished(rounded.filter("_mx_done")))
        open_rows = rounded.filter("not _mx_done").drop("_mx_done")
        level += 1
        if buckets <= 1:
            break
        buckets = -(-buckets // FAN)
        open_rows = open_rows.withColumn("_mx_bucket", F.floor(F.col("_mx_bucket") / FAN).cast(LongType()))
    last = _uniform(F.lit(seed), F.lit("last"), F.col("_mx_tie")) < F.col("_mx_share")
    parts.append(finished(open_rows.withColumn("_mx_share", last.cast("double"))))
    return reduce(DataFrame.unionByName, parts)


def repeat_rows(mixed: DataFrame, columns: list[str], copies: str = "copies") -> DataFrame:
    """Every row as often as it has copies."""
    times = F.when(F.col(copies) > 0, F.sequence(F.lit(1), F.col(copies))).otherwise(F.array().cast("array<int>"))
    return mixed.withColumn("_mx_copy", F.explode(times)).select(*columns)
