"""Quoted CSV cut at any line of a file, so that one file is read by many tasks.

A split of a file does not know whether it starts inside a quoted field. It does once the quotes
before it are counted: an even number closes every field, doubled quotes included. The quotes of
every split are counted first and added up along the file; then every split cuts its own lines
into records, and the few records that cross splits are put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PIECES = "path string, start long, text string, starts boolean, ends boolean, first boolean"


class _Cutter:
    """The lines of one split, in order, cut into (text, starts, ends, first)."""

    def __init__(self, path: str, start: int, opened: bool):
        self.path, self.start = path, start
        self.inside, self.starts = int(opened), not opened
        self.head = start == 0
        self.pending: list[str] = []

    def cut(self, lines: pa.Array) -> Iterator[tuple]:
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        inside = (np.cumsum(quotes) + self.inside) & 1
        texts = lines.to_pylist()
        at = 0
        for end in np.flatnonzero(inside == 0).tolist():
            text = "\n".join(self.pending + texts[at : end + 1]).removesuffix("\r")
            self.pending, at = [], end + 1
            if text or not self.starts:  # blank lines between records are no records
                yield text, self.starts, True, self.head
                self.head = False
            self.starts = True
        self.pending += texts[at:]
        self.inside = int(inside[-1])

    def rest(self) -> Iterator[tuple]:
        """What the split leaves open."""
        if self.pending:
            yield "\n".join(self.pending), self.starts, False, self.head


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("path", pa.string()), ("start", pa.int64()), ("text", pa.string()), ("starts", pa.bool_()), ("ends", pa.bool_()),
        ("first", pa.bool_()),
    ])

    def rows(cutter: _Cutter, found) -> pa.RecordBatch:
        found = list(found)
        columns = list(zip(*found)) or [()] * 4
        keys = [[cutter.path] * len(found), [cutter.start] * len(found)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*keys, *columns], schema)], schema=schema)

    cutter = None
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, starts = batch.column("path"), batch.column("start")
        # splits follow each other whole within a task
        new = np.flatnonzero(
            pc.or_(pc.not_equal(paths[1:], paths[:-1]), pc.not_equal(starts[1:], starts[:-1])).to_numpy(zero_copy_only=False)
        ) + 1
        edges = [0, *new.tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            path, start = paths[low].as_py(), starts[low].as_py()
            if cutter is None or (cutter.path, cutter.start) != (path, start):
                if cutter is not None:
                    yield rows(cutter, cutter.rest())
                cutter = _Cutter(path, start, batch.column("opened")[low].as_py())
            yield rows(cutter, cutter.cut(batch.column("value").slice(low, high - low)))
    if cutter is not None:
        yield rows(cutter, cutter.rest())


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, value): lines, each in the split that it begins in."""
    found = spark.read.option("lineSep", "\n").text(path)
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _splits(lines: DataFrame) -> DataFrame:
    """(path, start, opened, left): whether a split starts and whether it ends inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("path", "start").agg(F.sum(quotes).alias("quotes"))
    upto = F.sum("quotes").over(Window.partitionBy("path").orderBy("start"))
    return counted.select("path", "start", ((upto - F.col("quotes")) % 2 == 1).alias("opened"), (upto % 2 == 1).alias("left"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(text, first): the records of all files below a path; `first` marks the first of each file.

    A quoted field may hold line breaks and doubled quotes, and may cross any number of splits. A
    quote inside an unquoted field is not allowed: it would open a field. The file is scanned
    three times: quotes, records, and the splits that have a part of a crossing record. Lines
    are not shuffled; what is broadcast is one row for each split that starts or ends inside
    a field, of the size of a path.
    """
    lines = _lines(spark, path)
    crossed = F.broadcast(_splits(lines).filter("opened OR left").select("path", "start", "opened"))
    known = lines.join(crossed, ["path", "start"], "left").withColumn("opened", F.coalesce("opened", F.lit(False)))
    whole = known.mapInArrow(_pieces, PIECES).filter("starts AND ends").select("text", "first")
    parts = lines.join(crossed, ["path", "start"]).mapInArrow(_pieces, PIECES).filter("NOT (starts AND ends)")
    # of one split the end of a record comes before the start of another
    along = Window.partitionBy("path").orderBy("start", "starts")
    numbered = parts.withColumn("record", F.sum(F.col("starts").cast("long")).over(along))
    ordered = F.array_sort(F.collect_list(F.struct("start", "starts", "text")))
    joined = numbered.groupBy("path", "record").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), "\n").alias("text"), F.max("first").alias("first")
    )
    return whole.unionByName(joined.select("text", "first"))


def parsed(found: DataFrame, schema: StructType | str, options: dict[str, str]) -> DataFrame:
    """The records after the header of each file, as columns."""
    ddl = schema.toDDL() if isinstance(schema, StructType) else schema
    return found.filter(~F.col("first")).select(F.from_csv("text", ddl, options).alias("row")).select("row.*")
