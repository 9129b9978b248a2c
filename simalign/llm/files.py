"""Own file formats in the shared folder: where they lie, how they are opened and committed.

A task writes under a name of its own and returns one row for the file. Spark commits the
rows of one attempt per task as a Parquet table, the manifest, so files of lost or doubled
attempts are never read.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simalign.session import shared_dir


def new_folder(spark: SparkSession, what: str) -> str:
    """Name of a fresh folder below the folder that all executors share."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def file_system(uri: str):
    """(file system, path in it) of a URI or a plain path."""
    from pyarrow import fs

    if "://" not in uri:
        local = os.path.abspath(uri.removeprefix("file:"))
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(uri)


def create(folder: str, name: str):
    """(output stream, URI) of a new file; the folder is made if needed."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None), f"{folder}/{name}"


def open_file(uri: str):
    system, path = file_system(uri)
    return system.open_input_file(path)


def open_stream(uri: str):
    system, path = file_system(uri)
    return system.open_input_stream(path, compression=None)


def stage_at(df: DataFrame) -> tuple[DataFrame, str]:
    """(`df` written to the shared folder and read back, where it lies)."""
    path = new_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(folder: str) -> None:
    """Remove a folder of `new_folder` that nothing reads any more."""
    system, path = file_system(folder)
    system.delete_dir(path)


def hash_share(df: DataFrame, order: Column, rows: int) -> DataFrame:
    """The rows with the smallest values of a 64-bit hash: a fifth more than `rows` of them, or all.

    Rows are dropped where they lie, so what is sorted and sent afterwards grows neither with
    the table nor with its number of partitions.
    """
    total = df.count()
    edge = -(1 << 63) + int((1 << 64) * min(1.0, 1.2 * rows / max(1, total))) - 1
    return df.filter(order <= F.lit(edge))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Arrow batches of few rows for the jobs run inside, as whole texts travel in them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def one_file_per_task(manifest: DataFrame) -> DataFrame:
    """Manifest rows dealt out singly. Their number is that of the files."""
    return manifest.repartition(max(1, manifest.count()))
