"""Batch kernels for dynamic time warping, run on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

MATCH, INSERTION, DELETION = 0, 1, 2


def local_cost(x: np.ndarray, y: np.ndarray, cost: str) -> np.ndarray:
    if cost == "abs":
        return np.abs(x - y)
    if cost == "sq":
        return (x - y) * (x - y)
    if cost == "sqrt":
        return np.sqrt(np.abs(x - y))
    raise ValueError(f"unknown cost {cost!r}")


def usable(a, b) -> bool:
    """Both series present and non-empty, without missing values."""
    if a is None or b is None or len(a) == 0 or len(b) == 0:
        return False
    for s in (a, b):
        values = np.asarray(s, dtype=float)
        if np.isnan(values).any():
            return False
    return True


def _size_class(n: int) -> int:
    """Lengths within about a quarter of each other share a class."""
    return int(np.log(n) / np.log(1.25))


def padded_batches(
    pdf: pd.DataFrame, limit: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row positions, A, B, lengths of A, lengths of B) for usable rows of similar lengths.

    Shorter series are padded; a cell depends on earlier cells only, so padding never
    reaches the cell a pair ends in. A batch holds about `limit` values.
    """
    classes: dict[tuple[int, int], list[int]] = {}
    for pos, (a, b) in enumerate(zip(pdf["a"], pdf["b"])):
        if usable(a, b):
            classes.setdefault((_size_class(len(a)), _size_class(len(b))), []).append(pos)
    for rows in classes.values():
        widest = max(len(pdf["a"].iat[p]) + len(pdf["b"].iat[p]) for p in rows)
        step = max(1, limit // widest)
        for i in range(0, len(rows), step):
            pick = rows[i : i + step]
            sides = [[np.asarray(pdf[c].iat[p], dtype=float) for p in pick] for c in ("a", "b")]
            lengths = [np.array([len(s) for s in side]) for side in sides]
            stacked = [np.zeros((len(pick), n.max())) for n in lengths]
            for out, side in zip(stacked, sides):
                for r, s in enumerate(side):
                    out[r, : len(s)] = s
            yield np.array(pick), *stacked, *lengths


def distances(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, cost: str) -> np.ndarray:
    """Warped distance of the first n[r] values of row r of `a` and the first m[r] of `b`.

    Cells with equal i + j do not depend on each other, so whole anti-diagonals are updated
    for all rows at once. Three diagonals are kept, indexed by i: memory grows with the
    length of a series, not with its square.
    """
    rows, width = a.shape
    height = b.shape[1]
    out, ends = np.empty(rows), n + m
    before = np.full((rows, width + 1), np.inf)  # diagonal d - 2
    last = np.full((rows, width + 1), np.inf)  # diagonal d - 1
    before[:, 0] = 0.0
    for d in range(2, int(ends.max()) + 1):
        lo, hi = max(1, d - height), min(width, d - 1)
        i = np.arange(lo, hi + 1)
        step = local_cost(a[:, i - 1], b[:, d - i - 1], cost)
        best = np.minimum(before[:, lo - 1 : hi], np.minimum(last[:, lo - 1 : hi], last[:, lo : hi + 1]))
        current = np.full((rows, width + 1), np.inf)
        current[:, lo : hi + 1] = step + best
        before, last = last, current
        done = np.flatnonzero(ends == d)
        out[done] = current[done, n[done]]
    return out


def last_rows(a: np.ndarray, b: np.ndarray, cost: str, every: int) -> Iterator[tuple[int, np.ndarray]]:
    """(r, cumulated costs of row r - 1) for r = every, 2 * every, ... below the length of `a`.

    Rows between are passed in strips of `every` rows, of which only the last row is kept.
    """
    above = None
    for top in range(0, len(a) - every, every):
        above = strip(a[top : top + every], b, cost, above)[0][-1].copy()
        yield top + every, above


def strip(a: np.ndarray, b: np.ndarray, cost: str, above: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Cumulated costs and direction codes of some consecutive rows, both (len(a), m).

    `above` are the costs of the row before them, none for the first rows of a matrix.
    Direction: where the smallest of (i-1, j-1), (i-1, j), (i, j-1) lies, first one on ties.
    """
    n, m = len(a), len(b)
    total = np.full((n + 1, m + 1), np.inf)
    if above is None:
        total[0, 0] = 0.0
    else:
        total[0, 1:] = above
    codes = np.zeros((n, m), dtype=np.int8)
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        j = d - i
        origin = np.stack([total[i - 1, j - 1], total[i - 1, j], total[i, j - 1]])
        codes[i - 1, j - 1] = origin.argmin(axis=0)
        total[i, j] = local_cost(a[i - 1], b[j - 1], cost) + origin.min(axis=0)
    return total[1:, 1:], codes


def _diagonals(a: np.ndarray, b: np.ndarray, cost: str, start: float) -> Iterator[tuple]:
    """(d, lo, hi, costs by i, codes of i in lo..hi) for every anti-diagonal d = i + j, cells 1-based.

    The costs hold `start` in cell (1, 1) and infinity beside the diagonal; they are only good
    until the diagonal after the next.
    """
    n, m = len(a), len(b)
    before, last, current = (np.full(n + 1, np.inf) for _ in range(3))
    last[1] = start
    yield 2, 1, 1, last, np.zeros(1, dtype=np.int8)
    for d in range(3, n + m + 1):
        lo, hi = max(1, d - m), min(n, d - 1)
        match, up, left = before[lo - 1 : hi], last[lo - 1 : hi], last[lo : hi + 1]
        best = np.minimum(match, np.minimum(up, left))
        codes = np.where(match == best, MATCH, np.where(up == best, INSERTION, DELETION)).astype(np.int8)
        # The first row and column have one origin only, also where every cost is infinite.
        if lo == 1:
            codes[0] = DELETION
        if hi == d - 1:
            codes[-1] = INSERTION
        # An old diagonal reaches one cell further on either side at most.
        current[max(lo - 2, 0) : hi + 2] = np.inf
        current[lo : hi + 1] = local_cost(a[lo - 1 : hi], b[d - hi - 1 : d - lo][::-1], cost) + best
        yield d, lo, hi, current, codes
        before, last, current = last, current, before


def _crossing(a: np.ndarray, b: np.ndarray, cost: str, start: float) -> tuple[int, int, float]:
    """First cell (0-based) of the path on or behind the middle diagonal, and its cumulated cost."""
    n, m = len(a), len(b)
    middle = (n + m + 2) // 2
    # By i: where the path of a cell crossed, twice its i, plus 1 on the diagonal after the middle.
    before, last, current = (np.zeros(n + 1, dtype=np.int64) for _ in range(3))
    costs = []
    for d, lo, hi, total, codes in _diagonals(a, b, cost, start):
        if d < middle:
            continue
        own = 2 * np.arange(lo, hi + 1)
        if d <= middle + 1:
            costs.append(total.copy())
        if d == middle:
            current[lo : hi + 1] = own
        else:
            match = own + 1 if d == middle + 1 else before[lo - 1 : hi]
            step = np.where(codes == INSERTION, last[lo - 1 : hi], last[lo : hi + 1])
            current[lo : hi + 1] = np.where(codes == MATCH, match, step)
        before, last, current = last, current, before
    i, late = divmod(int(last[n]), 2)
    return i - 1, middle + late - i - 1, float(costs[late][i])


def path(a: np.ndarray, b: np.ndarray, cost: str, cells: int) -> Iterator[np.ndarray]:
    """Steps (i, j) from the last cell to (0, 0), in pieces, with memory for `cells` codes.

    A larger rectangle is passed once with three diagonals of costs; each cell hands on where its
    path crossed the middle diagonal, which halves the rectangle. A half starts with the cost
    its first cell has in the whole matrix. The cells beside it could only offer more than the
    cell the path comes from, or as much in a later place, so ties fall as in the whole matrix.
    """
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    # Rectangles from (top, left) to (bottom, right), both ends on the path; the last one is next.
    open_ = [(0, 0, len(a) - 1, len(b) - 1, float(local_cost(a[:1], b[:1], cost)[0]))]
    while open_:
        top, left, bottom, right, start = open_.pop()
        x, y = a[top : bottom + 1], b[left : right + 1]
        if len(x) * len(y) > cells and len(x) + len(y) > 4:
            i, j, value = _crossing(x, y, cost, start)
            open_.append((top, left, top + i, left + j, start))
            open_.append((top + i, left + j, bottom, right, value))
            continue
        steps = np.array(walk_back(_codes(x, y, cost, start))) + (top, left)
        # The first cell of a half is the last one of the half before.
        yield steps if top == left == 0 else steps[:-1]


def _codes(a: np.ndarray, b: np.ndarray, cost: str, start: float) -> np.ndarray:
    n, m = len(a), len(b)
    codes = np.zeros((n, m), dtype=np.int8)
    flat = codes.reshape(-1)
    for d, lo, hi, _, diagonal in _diagonals(a, b, cost, start):
        i = np.arange(lo, hi + 1)
        flat[(i - 1) * m + d - i - 1] = diagonal
    return codes


def walk_back(codes: np.ndarray) -> list[tuple[int, int]]:
    """Steps (i, j) from the last cell to (0, 0)."""
    i, j = codes.shape[0] - 1, codes.shape[1] - 1
    path = [(i, j)]
    while i or j:
        code = codes[i, j]
        i, j = i - (code != DELETION), j - (code != INSERTION)
        path.append((int(i), int(j)))
    return path
