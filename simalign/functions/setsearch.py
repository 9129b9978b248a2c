"""Shared terms of many sets with many sets, and the k nearest under Jaccard distance, in one task.

Sets are arrays of whole-number term ids. An `Index` keeps some sets in blocks of similar ones:
the terms most frequent in a block as a 0/1 matrix, whose products with other sets count
shared terms at once, and the other terms as posting lists. A set first visits the block that
can offer it most, which gives it a k-th best distance, then the others, and leaves out a block
as soon as no set of it can be nearer than the k-th best so far.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Sets of one block, and its most frequent terms that make the matrix.
BLOCK, HEAD = 128, 256
#: So many times larger are both where no set holds a term twice, which makes results the same for every size of block.
WIDER_BLOCK, WIDER_HEAD = 4, 2
#: Sets asked for at once.
BATCH = 512
#: Marks a row of an index that does not count for some asking set.
NOBODY = np.iinfo(np.int64).max


def lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds) of an Arrow list column: set i holds values[bounds[i]:bounds[i + 1]]."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def take_lists(values: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for some of the sets, in the given order."""
    sizes = (bounds[1:] - bounds[:-1])[rows]
    out = np.concatenate(([0], np.cumsum(sizes)))
    return values[np.repeat(bounds[rows] - out[:-1], sizes) + np.arange(out[-1])], out


def repeats(values: np.ndarray, bounds: np.ndarray) -> bool:
    """Whether any set lists a term twice, one after the other, as a document that is there twice does."""
    alike = values[1:] == values[:-1]
    starts = bounds[1:-1]
    alike[starts[(starts > 0) & (starts < len(values))] - 1] = False
    return bool(alike.any())


def by_leading_terms(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sets in the order of their first ids, then of their sizes."""
    sizes = np.diff(bounds)
    lead = np.full((4, len(sizes)), -1, np.int64)
    for j in range(4):
        has = sizes > j
        lead[j, has] = values[bounds[:-1][has] + j]
    return np.lexsort((sizes, *lead[::-1]))


@dataclass
class Block:
    """Sets low .. low + n - 1 of an index; `local` numbers its terms, the matrix terms first."""

    low: int
    n: int
    local: np.ndarray
    head: np.ndarray
    starts: np.ndarray
    postings: np.ndarray

    def shared(self, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, int]:
        """(how many terms each asked set shares with each set here, posting entries visited)."""
        m, width = len(bounds) - 1, self.head.shape[0]
        at = self.local[values]
        owner = np.repeat(np.arange(m), np.diff(bounds))
        frequent = (at >= 0) & (at < width)
        asked = np.zeros((m, width), np.float32)
        asked[owner[frequent], at[frequent]] = 1
        out = asked @ self.head
        rare = at >= width
        at, owner = at[rare] - width, owner[rare]
        sizes = self.starts[at + 1] - self.starts[at]
        total = int(sizes.sum())
        if total:
            place = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
            cells = np.repeat(owner * self.n, sizes) + self.postings[place]
            out += np.bincount(cells, minlength=m * self.n).reshape(m, self.n)
        return out, total


    def held(self, values: np.ndarray, bounds: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """For every term the bits of `valid` [asked set, set] of all sets here that hold it, as one 64-bit number."""
        width = self.head.shape[0]
        at = self.local[values]
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        out = np.zeros(len(values), np.uint64)
        holders = self.head != 0
        for i in np.flatnonzero(valid.any(axis=1)).tolist():
            mine = at[bounds[i] : bounds[i + 1]]
            frequent = np.flatnonzero((mine >= 0) & (mine < width))
            some = np.flatnonzero(valid[i])
            bits = valid[i, some]
            if len(frequent):
                met = np.where(holders[np.ix_(mine[frequent], some)], bits, np.uint64(0))
                out[bounds[i] + frequent] = np.bitwise_or.reduce(met, axis=1)
        rare = np.flatnonzero(at >= width)
        lists_of = at[rare] - width
        sizes = self.starts[lists_of + 1] - self.starts[lists_of]
        total = int(sizes.sum())
        if total:
            ends = np.cumsum(sizes)
            place = np.repeat(self.starts[lists_of] - (ends - sizes), sizes) + np.arange(total)
            # a term of the block is in one of its sets at least
            out[rare] = np.bitwise_or.reduceat(valid[np.repeat(owner[rare], sizes), self.postings[place]], ends - sizes)
        return out


@dataclass
class Index:
    """Sets in blocks. `order` names the caller's rows in the order they are kept in; `sizes`
    holds, for every group of asking sets, how many terms of each set count."""

    terms: np.ndarray
    order: np.ndarray
    sizes: np.ndarray
    blocks: list[Block] = field(default_factory=list)

    @classmethod
    def of(cls, values: np.ndarray, bounds: np.ndarray, sizes: np.ndarray, block: int | None = None, head: int | None = None) -> Index:
        """Sets whose ids are listed most frequent first; sets with the same leading ids meet."""
        block, head = block or BLOCK, head or HEAD
        n = len(bounds) - 1
        terms, dense = np.unique(values, return_inverse=True)
        order = by_leading_terms(dense, bounds)
        out = cls(terms, order, sizes[:, order])
        dense, bounds = take_lists(dense, bounds, order)
        for low in range(0, n, block):
            high = min(low + block, n)
            out.blocks.append(cls._block(low, dense[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], len(terms), head))
        return out

    @staticmethod
    def _block(low: int, values: np.ndarray, bounds: np.ndarray, n_terms: int, most: int) -> Block:
        n = len(bounds) - 1
        known, counts = np.unique(values, return_counts=True)
        by_count = np.argsort(-counts, kind="stable")
        width = min(most, len(known))
        local = np.full(n_terms + 1, -1, np.int32)
        local[known[by_count]] = np.arange(len(known), dtype=np.int32)
        at, owner = local[values], np.repeat(np.arange(n), np.diff(bounds))
        head = np.zeros((width, n), np.float32)
        frequent = at < width
        head[at[frequent], owner[frequent]] = 1
        at, owner = at[~frequent] - width, owner[~frequent]
        starts = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(known) - width))))
        return Block(low, n, local, head, starts, owner[np.argsort(at, kind="stable")])

    def known(self, values: np.ndarray) -> np.ndarray:
        """Term ids as places among this index's terms; unknown ones get the place after the last."""
        if not len(self.terms):
            return np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(self.terms, values), len(self.terms) - 1)
        return np.where(self.terms[at] == values, at, len(self.terms))


def distance(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard distance from counts; two empty sets are at distance 0."""
    union = a + b - shared
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(union == 0, 0.0, 1.0 - shared / union)


def least_distance(known: np.ndarray, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The smallest distance a set of `a` terms, `known` of them in a block, can have to a set of
    low .. high terms there. It is the distance of a pair that could exist, so rounding is alike."""
    b = np.clip(known, low, high)
    return distance(np.minimum(known, b), a, b)


def least_shared(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> np.ndarray:
    """[asked set, set]: fewer shared terms than this mean a distance above `far` [asked set].

    In single precision and less by more than its rounding, so that none is missed.
    """
    with np.errstate(invalid="ignore"):
        share = np.where(far < 1, (1 - far) / (2 - far), 0.0) * (1 - 1e-5)
    return (share * a - 1e-3).astype(np.float32)[:, None] + share.astype(np.float32)[:, None] * b.astype(np.float32)


def nearest(
    index: Index, ids: np.ndarray, values: np.ndarray, bounds: np.ndarray, groups: np.ndarray, k: int,
    limit: np.ndarray | None = None, work: dict | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(asked set, index row, distance) of the k nearest by (distance, id) for every asked set.

    `ids` is [group, row] in the order of the index: the id by which ties are broken, NOBODY
    where the row does not count for a group. `limit` is a distance already reached k times
    elsewhere; what is farther is left out. `work` counts pairs and posting entries.
    """
    found = [[], [], []]
    n_blocks = len(index.blocks)
    edges = np.array([b.low for b in index.blocks] + [len(index.order)])
    least = np.array([s[lo:hi].min() for s in index.sizes for lo, hi in zip(edges, edges[1:], strict=False)]).reshape(len(index.sizes), n_blocks)
    most = np.array([s[lo:hi].max() for s in index.sizes for lo, hi in zip(edges, edges[1:], strict=False)]).reshape(len(index.sizes), n_blocks)
    dense = index.known(values)
    for first in range(0, len(bounds) - 1, BATCH):
        last = min(first + BATCH, len(bounds) - 1)
        mine, own = dense[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        a, group, m = np.diff(own), groups[first:last], last - first
        # what a block can offer each set at best
        offer = np.empty((m, n_blocks))
        for j, block in enumerate(index.blocks):
            held = np.concatenate(([0], np.cumsum(block.local[mine] >= 0)))
            offer[:, j] = least_distance(held[own[1:]] - held[own[:-1]], a, least[group, j], most[group, j])
        bound = np.full(m, np.inf) if limit is None else limit[first:last].copy()
        best = Best([np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)], 2, 3, k)
        home = offer.argmin(axis=1)
        visits = [(j, True) for j in np.unique(home).tolist()] + [(j, False) for j in np.argsort(offer.mean(axis=0), kind="stable").tolist()]
        for j, at_home in visits:
            block, mine_here = index.blocks[j], home == j
            rows = np.flatnonzero(mine_here if at_home else (offer[:, j] <= bound) & ~mine_here)
            if not len(rows):
                continue
            asked, cut = (mine, own) if len(rows) == m else take_lists(mine, own, rows)
            shared, visited = block.shared(asked, cut)
            here = slice(block.low, block.low + block.n)
            if len(index.sizes) == 1:  # alike for all asked sets
                b, tie = index.sizes[:1, here], ids[:1, here]
            else:
                b, tie = index.sizes[group[rows], here], ids[group[rows], here]
            if work is not None:
                work["pairs"] = work.get("pairs", 0) + shared.size
                work["entries"] = work.get("entries", 0) + visited
            near = shared >= least_shared(a[rows], b, bound[rows])
            if np.count_nonzero(near) * 8 > near.size:  # many may count: the k nearest here tell
                far = distance(shared.astype(np.float64), a[rows][:, None], b)
                far[np.broadcast_to(tie == NOBODY, far.shape)] = np.inf
                edge = bound[rows]
                if block.n > k:
                    edge = np.minimum(np.partition(far, k - 1, axis=1)[:, k - 1], edge)
                i, c = np.nonzero((far <= edge[:, None]) & (far < np.inf))
                far = far[i, c]
            else:
                i, c = np.nonzero(near)
                far = distance(shared[i, c].astype(np.float64), a[rows[i]], np.broadcast_to(b, near.shape)[i, c])
                kept = (far <= bound[rows[i]]) & (np.broadcast_to(tie, near.shape)[i, c] != NOBODY)
                i, c, far = i[kept], c[kept], far[kept]
            best.add([rows[i], c + block.low, far, np.broadcast_to(tie, near.shape)[i, c]], bound)
        best = best.merged(bound)
        for out, x in zip(found, (best[0] + first, best[1], best[2]), strict=True):
            out.append(x)
    return tuple(np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(found, (np.int64, np.int64, float), strict=True))


def first_of(owner: np.ndarray, far: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k by (distance, tie) of every owner, owner after owner."""
    order = np.lexsort((tie, far))
    who = owner[order]
    if not len(who) or 0 <= who.min() and who.max() < 1 << 16:
        who = who.astype(np.uint16)  # short numbers are sorted without comparing them
    by_owner = np.argsort(who, kind="stable")
    order, who = order[by_owner], who[by_owner]
    return order[np.arange(len(who)) - np.searchsorted(who, who) < k]


class Best:
    """The k best rows of every owner, the first column; new rows wait until there are a quarter as many as are kept.

    `far` and `tie` are the places of the columns of distance and id. So long lists are not sorted for every few new rows.
    """

    def __init__(self, columns: list[np.ndarray], far: int, tie: int, k: int):
        self.columns, self.far, self.tie, self.k = columns, far, tie, k
        self.new, self.n_new = [], 0

    def add(self, rows: list[np.ndarray], bound: np.ndarray) -> None:
        """`bound` is lowered to the k-th best distance of every owner that has as many."""
        self.new.append(rows)
        self.n_new += len(rows[0])
        if self.n_new and self.n_new * 4 >= len(self.columns[0]):
            self.merged(bound)

    def merged(self, bound: np.ndarray) -> list[np.ndarray]:
        if not self.n_new:
            return self.columns
        every = [np.concatenate(x) for x in zip(self.columns, *self.new, strict=True)]
        self.new, self.n_new = [], 0
        kept = first_of(every[0], every[self.far], every[self.tie], self.k)
        self.columns = [x[kept] for x in every]
        owner, far = self.columns[0], self.columns[self.far]
        full = np.flatnonzero(np.bincount(owner) >= self.k)
        bound[full] = np.minimum(bound[full], far[np.searchsorted(owner, full, "right") - 1])
        return self.columns


def bit_words(held: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The flags of every set as 64-bit words."""
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        raw = np.zeros(-(-(high - low) // 64) * 8, np.uint8)
        packed = np.packbits(held[low:high], bitorder="little")
        raw[: len(packed)] = packed
        out.append(raw.view(np.int64))
    return out
