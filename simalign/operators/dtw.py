"""Dynamic time warping of series pairs (id LONG, a ARRAY<DOUBLE>, b ARRAY<DOUBLE>).

A pair is one row, so distances and paths need no shuffle: batches of pairs go through Arrow. A missing or
empty series, or one with NULL or NaN values, gives NULL (distance) or no rows (matrix, path).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simalign.functions import warp

# Tasks get the kernels with the function: executors need not have this package installed.
register_pickle_by_value(warp)

# Values of one kernel call, cells of a strip or rectangle, rows handed over at a time: these
# bound the memory of a task.
DISTANCE_VALUES = 1 << 20
CELLS = 1 << 22
OUT_ROWS = 1 << 18


def pair_by_offset(series: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """(id, a, b): every series beside the one with the next id."""
    left = series.select(F.col(id_col).alias("id"), F.col(value_col).alias("a"))
    right = series.select((F.col(id_col) - 1).alias("id"), F.col(value_col).alias("b"))
    return left.join(right, "id")


def dtw_distance(pairs: DataFrame, cost: str = "abs", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, distance) and the columns to keep."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.full(len(pdf), np.nan)
            for rows, a, b, n, m in warp.padded_batches(pdf, DISTANCE_VALUES):
                out[rows] = warp.distances(a, b, n, m, cost)
            distance = pd.Series(out, dtype="object").where(~np.isnan(out), None)
            yield pd.DataFrame({"id": pdf["id"], "distance": distance, **{c: pdf[c] for c in keep}})

    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in pairs.select(*keep).schema) if keep else ""
    return pairs.select("id", "a", "b", *keep).mapInPandas(run, "id long, distance double" + kept)


def dtw_cost_matrix(pairs: DataFrame, cost: str = "abs", cells: int = CELLS) -> DataFrame:
    """(id, i, j, cost, dir), 0-based; dir 0 match, 1 from (i-1, j), 2 from (i, j-1).

    A matrix is cut into strips of about `cells` cells. A first pass over a pair keeps only the
    row of costs above each strip; the strips, dealt to all tasks, then make their cells each
    for itself. A task holds one strip, and a long matrix is written by many.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row_id, a, b in zip(pdf["id"], pdf["a"], pdf["b"]):
                if not warp.usable(a, b):
                    continue
                a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
                every = max(1, cells // len(b))
                yield _strip(row_id, 0, a[:every], b, None)
                for top, above in warp.last_rows(a, b, cost, every):
                    yield _strip(row_id, top, a[top : top + every], b, above)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row_id, top, a, b, above in pdf.itertuples(index=False):
                total, codes = warp.strip(a, b, cost, above)
                m = len(b)
                rows = max(1, OUT_ROWS // m)
                for low in range(0, len(a), rows):
                    piece = total[low : low + rows]
                    yield pd.DataFrame({
                        "id": row_id,
                        "i": np.repeat(np.arange(top + low, top + low + len(piece)), m),
                        "j": np.tile(np.arange(m), len(piece)),
                        "cost": piece.ravel(),
                        "dir": codes[low : low + rows].ravel().astype(int),
                    })

    strips = pairs.select("id", "a", "b").mapInPandas(cut, "id long, top int, a array<double>, b array<double>, above array<double>")
    # a stated number: few bytes of strips become many rows, so partitions must not be merged by size
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return strips.repartition(tasks, "id", "top").mapInPandas(fill, "id long, i int, j int, cost double, dir int")


def _strip(row_id: int, top: int, a: np.ndarray, b: np.ndarray, above: np.ndarray | None) -> pd.DataFrame:
    return pd.DataFrame({"id": [row_id], "top": [top], "a": [a], "b": [b], "above": [above]})


def _walks(pairs: DataFrame, cost: str, cells: int) -> DataFrame:
    """(id, step, i, j, x, y) from the last cell (step 0) to (0, 0), x and y the values met.

    Memory is linear in the length of a series: codes are kept for rectangles of at most `cells`
    cells, into which the path is halved. Steps of many pairs leave together.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held, size = [], 0
            for row_id, a, b in zip(pdf["id"], pdf["a"], pdf["b"]):
                if not warp.usable(a, b):
                    continue
                a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
                low = 0
                for steps in warp.path(a, b, cost, cells):
                    i, j = steps.T
                    held.append((np.full(len(i), row_id), np.arange(low, low + len(i)), i, j, a[i], b[j]))
                    low += len(i)
                    size += len(i)
                    if size >= OUT_ROWS:
                        yield _steps(held)
                        held, size = [], 0
            if held:
                yield _steps(held)

    return pairs.select("id", "a", "b").mapInPandas(run, "id long, step int, i int, j int, x double, y double")


def _steps(held: list[tuple]) -> pd.DataFrame:
    columns = [np.concatenate(c) for c in zip(*held)]
    return pd.DataFrame(dict(zip(("id", "step", "i", "j", "x", "y"), columns)))


def dtw_path(pairs: DataFrame, cost: str = "abs", cells: int = CELLS) -> DataFrame:
    """(id, step, i, j) from the last cell (step 0) to (0, 0)."""
    return _walks(pairs, cost, cells).drop("x", "y")


def dtw_matching(pairs: DataFrame, every: int = 1, cost: str = "abs", cells: int = CELLS) -> DataFrame:
    """(id, step, i, j, x, y): the values matched along the path, optionally every n-th step."""
    return _walks(pairs, cost, cells).filter(F.col("step") % every == 0)


def heatmap_rows(pairs: DataFrame) -> DataFrame:
    """(id, x, y, cost): the cost matrix transposed, b along the rows."""
    cells = dtw_cost_matrix(pairs)
    return cells.select("id", F.col("j").alias("x"), F.col("i").alias("y"), "cost")


def pairwise_cost_rows(pairs: DataFrame, local_cost) -> DataFrame:
    """(id, i, j, cost): local costs of every value of a with every value of b."""
    left = pairs.select("id", "b", F.posexplode("a").alias("i", "_x"))
    cells = left.select("id", "i", "_x", F.posexplode("b").alias("j", "_y"))
    return cells.select("id", "i", "j", local_cost(F.col("_x"), F.col("_y")).alias("cost"))
