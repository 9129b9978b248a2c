"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from simalign.operators.rank import nth_smallest, ordered_rank
from simalign.sources import quoted


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: The usual size of a Parquet row group, which one task reads whole.
ROW_GROUP_BYTES = 128 << 20


def dealt(df: DataFrame, by: str) -> DataFrame:
    """A table of less than a row group for every core, dealt out over all cores by a column.

    However many splits such a table has, its rows may lie in a single one. Its size is what the
    optimizer knows of the files, so nothing is read for this, and what moves is bounded by
    the cores. Larger tables have row groups for all cores and stay where they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # by an expression of its own: a union of such tables is not taken for partitioned by the column
    return df.repartition(cores, F.xxhash64(by)) if size < cores * ROW_GROUP_BYTES else df


#: Quoted fields may hold line breaks and doubled quotes.
CSV = {
    "multiLine": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """UTF-8 CSV with a header, every file in as many tasks as it has splits.

    Quoted fields may hold line breaks and doubled quotes; fields without quotes hold none. An
    empty field is NULL, quoted or not. Line breaks inside fields stay as they are written.
    """
    return quoted.parsed(quoted.records(spark, path), schema, CSV)


def read_whole_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One task a file: for files with quotes inside unquoted fields.

    In files whose lines end in \\r\\n those inside fields come back as \\n.
    """
    return spark.read.schema(schema).options(**CSV).csv(path, header=True, encoding="UTF-8")


def write_csv(df: DataFrame, path: str, index_by: str | None = None) -> None:
    """CSV with a header; `index_by` adds a 0-based `index` column in the order of a column."""
    if index_by is not None:
        df = ordered_rank(df, index_by).withColumn("index", F.col("rn") - 1).drop("rn")
    df.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', encoding="UTF-8", emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def first_n(df: DataFrame, n: int, by: str) -> DataFrame:
    """The first n rows in the order of `by`, NULLs first.

    Of a whole-number column the n-th value is found by counting, and the rest is a filter: rows
    are neither sorted nor gathered. Where more rows share that value than are wanted, the same
    search goes over a hash of the whole row, so only rows alike in all columns are
    interchangeable. Other columns are ranked by range partitions.
    """
    if not isinstance(df.schema[by].dataType, IntegralType):
        return ordered_rank(df, by).filter(F.col("rn") <= n).drop("rn")
    key = F.col(by)
    nulls = df.filter(key.isNull()).count()
    if n <= nulls:
        sure, ties, wanted = F.lit(False), key.isNull(), n
    else:
        value, below = nth_smallest(df, key, n - nulls)
        if value is None:
            return df
        sure, ties, wanted = key.isNull() | (key < value), key == value, n - nulls - below
    tied = df.filter(ties)
    if tied.count() <= wanted:
        return df.filter(sure | ties)
    tie = F.xxhash64(*df.columns)
    last, before = nth_smallest(tied, tie, wanted)
    if last is None:
        return df.filter(sure)
    alike = tied.filter(tie == last).limit(wanted - before)
    return df.filter(sure | (ties & (tie < last))).unionByName(alike)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append run records to a log table."""
    metrics.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
