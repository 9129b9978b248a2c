"""Every block of test sets beside every block of training groups, without moving either by the pair.

Rows of one side are packed into blocks, a block into one value. The training blocks are written once to
the shared folder, the test blocks are dealt to tasks, and a Cartesian product hands each task its own test blocks
beside all training blocks, one after the other. A task keeps what it has found so far for
its test sets, so it returns final lists: what is shuffled and written grows with the rows, not with the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simalign.session import stage

#: Tasks for every core where there are test sets enough for them; each prepares all training blocks for itself.
WAVES = 1
#: Elements of all lists of one value, about. Long sets lie together, so rows alone would not bound its memory.
ELEMENTS = 1 << 21


def runs(batches: Iterator[pa.RecordBatch], keys: int, most: int | None = None) -> Iterator[pa.Table]:
    """Rows of equal leading key columns, which come one after the other; with `most`, as soon as there are so many."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            here = tuple(c[low] for c in columns)
            if here != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = here
            held.append(batch.slice(low, high - low))
            if most is not None and sum(x.num_rows for x in held) >= most:
                table = pa.Table.from_batches(held)
                full = table.num_rows // most * most
                for at in range(0, full, most):
                    yield table.slice(at, most)
                held = table.slice(full).to_batches()
                del table
        batch = None  # not to be kept while the next one is read
    if held:
        yield pa.Table.from_batches(held)


def lighter(table: pa.Table, most: int) -> Iterator[pa.Table]:
    """The rows in the same order, in parts of at most `most` list elements or of one row."""
    sizes = np.zeros(table.num_rows, np.int64)
    for column in table.columns:
        if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
            sizes += pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    total, first = np.cumsum(sizes), 0
    while first < table.num_rows:
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + most, "right")))
        yield table.slice(first, last - first)
        first = last


def _packed(df: DataFrame, keys: int, rows: int, prefix: str) -> DataFrame:
    """(prefix_key, prefix_no, prefix_rows): rows with equal leading `keys`, at most `rows` and about ELEMENTS to a value.

    The first column is the fold, and `no` numbers the values.
    """
    most = ELEMENTS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for run in (part for met in runs(batches, keys, rows) for part in lighter(met, most)):
            part = run.combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_table(part)
            yield pa.RecordBatch.from_pydict({
                "k": pa.array([part.column(0)[0].as_py()], pa.int32()), "n": pa.array([number], pa.int64()),
                "r": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            })
            number += 1
            run = part = sink = None
        pa.default_memory_pool().release_unused()

    named = df.mapInArrow(pack, "k int, n long, r binary")
    return named.toDF(f"{prefix}_key", f"{prefix}_no", f"{prefix}_rows")


def unpacked(value: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(value.as_buffer()).read_all()


def group_blocks(groups: DataFrame, rows: int) -> DataFrame:
    """Groups as staged values of at most `rows` rows; the first two columns are fold and block.

    A file holds one value, so that a reader holds one at a time.
    """
    met = groups.repartition(*groups.columns[:2]).sortWithinPartitions(*groups.columns[:2])
    return stage(_packed(met, 2, rows, "g"), maxRecordsPerFile=1)


def _crossed(groups: DataFrame, packed: DataFrame) -> DataFrame:
    """Every training block beside every test block of a task; the rows of a block come once, the other times NULL.

    Those of a training block come beside the first test block of the task, those of a test block beside the first training block.
    """
    # every task reads all training blocks, one after the other
    one_by_one = groups.coalesce(1).withColumn("g_at", F.monotonically_increasing_id()).hint("shuffle_replicate_nl")
    first = F.col("t_no").bitwiseAND(F.lit((1 << 32) - 1)) == 0
    return one_by_one.crossJoin(packed).select(
        "g_key", "g_no", F.when(first, F.col("g_rows")).alias("g_rows"), "t_key", "t_no", F.when(F.col("g_at") == 0, F.col("t_rows")).alias("t_rows"),
    )


def beside(
    groups: DataFrame, tests: DataFrame, order: list[str], rows: int, most: int, least: int, schema: str,
    start: Callable, work: Callable, end: Callable, during: Callable | None = None,
) -> DataFrame:
    """What `end` makes of all tests after they met all groups of their fold.

    `groups` come from `group_blocks`. `tests` are staged, the fold first, and are dealt in the given order,
    `rows` to a block, at most about `most` and not fewer than `least` to a task. `start(table)` makes the state of a test block,
    `work(state, table)` shows it groups and gets from them what `work` returned when the block
    before met these groups (None at first), `end(state)` yields record batches, and so does `during(state, made)`
    after every `work`.
    """
    cores = tests.sparkSession.sparkContext.defaultParallelism
    n = tests.count()
    parts = max(1, -(-n // most), min(-(-n // least), WAVES * cores))
    dealt = tests.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, states, seen, made, value = {}, {}, None, None, None
        for batch in batches:
            g_key, g_no, g_rows, t_key, t_no, t_rows = (batch.column(i) for i in range(6))
            for i in range(batch.num_rows):
                test, group = t_no[i].as_py(), g_no[i].as_py()
                # copies, as the batch is not to be kept
                if t_rows[i].is_valid:
                    waiting[test] = t_rows[i].as_py()
                if group != seen:
                    seen, made = group, None
                    value = pa.scalar(g_rows[i].as_py(), pa.binary())
                if g_key[i] != t_key[i]:
                    continue
                if test not in states:
                    states[test] = start(pa.ipc.open_stream(waiting.pop(test)).read_all())
                made = work(states[test], value, made)
                if during is not None:
                    yield from during(states[test], made)
            batch = g_key = g_no = g_rows = t_key = t_no = t_rows = None  # not to be kept while the next one is read
        made = value = None
        for test in list(states):
            yield from end(states.pop(test))
        pa.default_memory_pool().release_unused()

    return _crossed(groups, _packed(dealt, 1, rows, "t")).mapInArrow(find, schema)
