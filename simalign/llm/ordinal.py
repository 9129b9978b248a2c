"""Quality by ordinal cumulative-link regression on graded ratings.

One weight per hashed word, shared by all grades, gives a document a score; ordered
thresholds cut the scores into grades: P(grade <= g) = sigmoid(threshold_g - score). So the
grades are one scale, and a document gets its expected grade and, for selection, the chance
of at least a given grade.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from simalign.llm import files, words

#: Hashed weights, rated rows that the fit may use at most, its steps, and in how many of the
#: rows a place must occur to get a weight: rarer words would only be learnt by heart.
BITS, TRAIN_ROWS, STEPS, RATE, RIDGE, LEAST_ROWS = 18, 20_000, 200, 0.05, 1e-4, 20
_SHAPE_BINS = 12


def shape_bins(data: np.ndarray, n_words: int, n_distinct: int) -> list[int]:
    """Share of capitals, of symbols and of distinct words, as three numbered bins."""
    size = max(1, len(data))
    capitals = np.count_nonzero((data >= 0x41) & (data <= 0x5A)) / size
    symbols = np.count_nonzero(~words.ALNUM[data] & ~words.SPACES[data]) / size
    distinct = n_distinct / max(1, n_words)
    return [k * _SHAPE_BINS + min(_SHAPE_BINS - 1, int(x * _SHAPE_BINS)) for k, x in enumerate((capitals * 1.5, symbols * 3, distinct))]


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Places in the weights of every text's distinct words and of its shape."""
    for group in words.groups(texts, words.ALNUM, fold=True):
        places = (group.hashes >> np.uint64(64 - BITS)).astype(np.int32)
        for row, low, high in group.slices():
            i = row - group.first
            mine = np.unique(places[low:high])
            shape = shape_bins(group.data[group.offsets[i] : group.offsets[i + 1]], high - low, len(mine))
            yield np.concatenate((mine, np.array(shape, np.int32) + (1 << BITS)))


WIDTH = (1 << BITS) + 3 * _SHAPE_BINS


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def damping(n):
    """Factor on the sum of a text's weights: long texts have more words, but not more of each."""
    return np.asarray(n, float) ** -0.25


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of largest likelihood, by Adam over all rows.

    Thresholds are a first value and positive gaps, so they stay ordered. Without rows, or
    with one grade alone, the weights are 0.
    """
    weights = np.zeros(WIDTH)
    start = np.linspace(-1, 1, n_grades - 1)
    free = np.concatenate(([start[0]], np.log(np.diff(start))))
    if not rows:
        return weights, start
    flat, sizes = np.concatenate(rows).astype(np.int64), np.array([len(r) for r in rows])
    scale = damping(sizes)
    frequent = np.bincount(flat, minlength=WIDTH) >= min(LEAST_ROWS, len(rows))
    frequent[1 << BITS :] = True  # shape
    owner = np.repeat(np.arange(len(rows)), sizes)[frequent[flat]]
    flat = flat[frequent[flat]]
    firsts = np.searchsorted(owner, np.arange(len(rows)))  # every text has its shape places
    state = [np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(len(free)), np.zeros(len(free))]
    above, below = grades < n_grades - 1, grades > 0
    for step in range(1, steps + 1):
        gaps = np.exp(free[1:])
        cuts = free[0] + np.concatenate(([0], np.cumsum(gaps)))
        score = np.add.reduceat(weights[flat], firsts) * scale
        high = np.where(above, _sigmoid(cuts[np.minimum(grades, n_grades - 2)] - score), 1.0)
        low = np.where(below, _sigmoid(cuts[np.maximum(grades - 1, 0)] - score), 0.0)
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = np.where(above, high * (1 - high), 0.0) / p, np.where(below, low * (1 - low), 0.0) / p
        slope = (d_low - d_high) / len(rows)  # of the log-likelihood by the score
        grad_w = np.bincount(flat, (slope * scale)[owner], WIDTH) - RIDGE * weights
        by_cut = np.bincount(np.minimum(grades, n_grades - 2), d_high, n_grades - 1)
        by_cut -= np.bincount(np.maximum(grades - 1, 0), d_low, n_grades - 1)
        by_cut /= len(rows)
        tail = np.cumsum(by_cut[::-1])[::-1]
        grad_f = np.concatenate(([tail[0]], tail[1:] * gaps))
        for value, grad, m, v in ((weights, grad_w, state[0], state[1]), (free, grad_f, state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return weights, free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:]))))


def train(rated: DataFrame, text_col: str, grade_col: str, id_col: str, n_grades: int, rows: int = TRAIN_ROWS):
    """Fit on at most `rows` rated documents, the first in the order of a hash of their id.

    Only their feature places reach the driver. Rows with a NULL grade or one outside the
    range are left out.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.pieces(batches):
            places = [x.astype(np.int32).tobytes() for x in features(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.binary())], ["o", "grade", "places"])

    known = rated.filter(F.col(grade_col).between(0, n_grades - 1)).select(
        F.xxhash64(F.lit(5), F.col(id_col)).alias("o"), F.col(grade_col).cast("int").alias("grade"), F.col(text_col).alias("text")
    )
    some = files.hash_share(known, F.col("o"), rows).mapInArrow(read, "o long, grade int, places binary")
    got = sorted(some.orderBy("o").limit(rows).collect(), key=lambda r: (r["o"], r["places"]))
    grades = np.array([r["grade"] for r in got], np.int64)
    return fit([np.frombuffer(r["places"], np.int32) for r in got], grades, n_grades)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The columns `keep` (all by default), expected_grade and p_at_least_1 .. of every row.

    A NULL or empty text has a score of its shape alone. Rows that repeat score alike, an
    empty table gives no row; earlier columns of the new names give way. No row moves
    between tasks. The model is broadcast: its size is that of the hash space.
    """
    weights, cuts = model
    names = [f"{prefix}expected_grade", *(f"{prefix}p_at_least_{g}" for g in range(1, len(cuts) + 1))]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    read = list(dict.fromkeys([*kept, text_col]))
    schema = StructType([*(docs.schema[c] for c in kept), *(StructField(n, DoubleType()) for n in names)])
    shared = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, thresholds = shared.value
        for batch in words.pieces(batches):
            value = np.array([float(w[x].sum(dtype=np.float64) * damping(len(x))) for x in features(batch.column(text_col))])
            tails = [_sigmoid(value - c) for c in thresholds]
            columns = [sum(tails) if len(value) else value, *tails]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(c, pa.float64()) for c in columns)], [*kept, *names]
            )

    return docs.select(*read).mapInArrow(run, schema)


def grade(quality, toxic):
    """0 for toxic, 1 for poor, 2 for good; NULL where no label is known."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)
