"""Sharding by a two-pass external shuffle.

The first pass scatters rows uniformly into buckets that fit in memory, by a seeded hash.
The second holds one bucket at a time, shuffles it by Fisher-Yates and writes it. Bucket
after bucket, the rows form one uniformly shuffled sequence, which is cut into shards whose
row counts differ by one at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from simalign.llm import files
from simalign.session import stage

BUCKET_BYTES = 16 << 20
#: Buckets for each shuffle partition, so that partitions hold about equally many rows.
BUCKETS_PER_TASK = 4


def shard(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
    seed: int = 42, bucket_bytes: int = BUCKET_BYTES,
) -> tuple[DataFrame, str]:
    """(rows read back, folder): `docs` with columns shard and slot, written by shard.

    Slots count from 0 in each shard and have no gap. All columns are kept, apart from
    earlier ones of these two names. NULL texts weigh nothing. Rows are scattered by a hash of all
    columns but maps, so rows that share an id, or have none, go their own ways; reruns agree, as
    rows of equal hash repeat whole and are interchangeable. Repetitions that would fill a bucket are
    counted, and scattered by a number as well. With fewer rows than
    shards some shards are empty, and an empty table gives no row.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    total = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text_col)).alias("bytes")).first()
    rows, size = total["n"], total["bytes"] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(-(-size // bucket_bytes), tasks * BUCKETS_PER_TASK)
    columns = docs.columns
    docs = _scattered(docs, text_col, seed, bucket_bytes)
    bucket = F.pmod("_sh_key", F.lit(buckets)).cast("int")
    # one row per bucket, and their number is the data's size over that of a bucket
    sizes = docs.groupBy(bucket.alias("_sh_bucket")).agg(F.count("*").alias("_sh_n"))
    before = Window.orderBy("_sh_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("_sh_bucket", F.coalesce(F.sum("_sh_n").over(before), F.lit(0)).alias("_sh_first"))

    dealt = (
        docs.withColumn("_sh_bucket", bucket)
        .repartition(tasks, "_sh_bucket")
        .join(firsts, "_sh_bucket")
        .sortWithinPartitions("_sh_bucket", "_sh_key")
        .select(*columns, "_sh_bucket", "_sh_first")
    )
    schema = StructType([
        *(StructField(f.name, f.dataType) for f in docs.schema.fields if f.name in columns),
        StructField("shard", IntegerType()), StructField("slot", LongType()),
    ])

    def shuffled(held: list[pa.RecordBatch], number: int, first: int) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        order = np.random.default_rng([seed, number]).permutation(len(table))  # Fisher-Yates
        place = first + np.arange(len(table), dtype=np.int64)
        home = place * shards // rows
        slot = place - -(-home * rows // shards)
        step = max(1, int(len(table) * (4 << 20) // max(1, table.nbytes)))
        for low in range(0, len(table), step):
            part = table.take(pa.array(order[low : low + step])).combine_chunks()
            part = part.append_column("shard", pa.array(home[low : low + step], pa.int32()))
            part = part.append_column("slot", pa.array(slot[low : low + step], pa.int64()))
            yield from part.to_batches()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, first = [], None, 0
        for batch in batches:
            numbers = batch.column("_sh_bucket").to_numpy()
            if not len(numbers):
                continue
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            plain = batch.select(columns)
            for low, high in zip(cuts, cuts[1:], strict=False):
                if numbers[low] != current:
                    if held:
                        yield from shuffled(held, current, first)
                    held, current = [], int(numbers[low])
                    first = batch.column("_sh_first")[low].as_py()
                # a copy: the bucket alone stays in memory, not the batches it came in
                held.append(plain.slice(low, high - low).take(pa.array(np.arange(high - low))))
        if held:
            yield from shuffled(held, current, first)

    folder = files.new_folder(spark, "shards")
    dealt.mapInArrow(write, schema).write.partitionBy("shard").parquet(folder)
    return spark.read.schema(schema).parquet(folder), folder


def _scattered(docs: DataFrame, text_col: str, seed: int, bucket_bytes: int) -> DataFrame:
    """`docs` with _sh_key, a hash of all columns but maps.

    Rows that repeat whole have one key. Where their texts would fill a bucket, they are counted
    before they move, and each repetition gets a key of its own from its number.
    """
    columns = docs.columns
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    keyed = docs.withColumn("_sh_key", F.xxhash64(F.lit(seed), *hashed))
    size = F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 64)
    repeated = keyed.groupBy("_sh_key").agg(F.count("*").alias("_sh_n"), size.alias("_sh_size"))
    # each of them fills a bucket, so there are fewer of them than buckets
    heavy = stage(repeated.filter((F.col("_sh_n") > 1) & (F.col("_sh_size") > bucket_bytes)).select("_sh_key"))
    if len(hashed) < len(columns) or heavy.isEmpty():
        return keyed
    alike = keyed.join(F.broadcast(heavy), "_sh_key", "left_semi").groupBy("_sh_key", *columns).agg(F.count("*").alias("_sh_n"))
    numbered = alike.withColumn("_sh_number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_sh_n"))))
    spread = numbered.select(*columns, F.xxhash64("_sh_key", "_sh_number").alias("_sh_key"))
    return keyed.join(F.broadcast(heavy), "_sh_key", "left_anti").select(*columns, "_sh_key").unionByName(spread)
