"""Benchmark decontamination by a prefix-filtered join of word windows.

A benchmark item is cut into windows of `WINDOW` words, or is one window if it is shorter.
A window, as the set of its shingles of `SHINGLE` words, is contained in a document only if
each of its shingles is, so one shingle is enough to look for: its prefix, the rarest of
them in the corpus. Documents are joined with the prefixes alone; a match at a position
fixes where the window would lie, which must be inside the document (the length and
positional bounds), and there all words are compared.

The benchmark is cut into blocks of at most `BLOCK_WINDOWS` windows. The index of a block is
broadcast, so its size is bounded; the documents pass the blocks one after the other and
never move between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from simalign.llm import words
from simalign.session import stage

WINDOW, SHINGLE, BLOCK_WINDOWS = 13, 5, 200_000
_FILTER_BITS = 22


def item_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, words): the windows of every item as word hashes, 8 bytes to a word, staged."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.pieces(batches):
            names, items, out = batch.column(0).to_pylist(), [], []
            for group in words.groups(batch.column(1), words.ALNUM, fold=True):
                for row, low, high in group.slices():
                    size = min(WINDOW, high - low)
                    for at in range(low, high - size + 1 if size else low):
                        items.append(names[row])
                        out.append(group.hashes[at : at + size].tobytes())
            yield pa.RecordBatch.from_pydict({"item": pa.array(items, pa.string()), "words": pa.array(out, pa.binary())})

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).alias("text"))
    return stage(rows.mapInArrow(cut, "item string, words binary"))


class Block:
    """The windows of some items: their words, shingles and items."""

    def __init__(self, rows: list[tuple[str, bytes]]):
        names = sorted({item for item, _ in rows})
        number = {item: i for i, item in enumerate(names)}
        owners: dict[bytes, set[int]] = {}
        for item, window in rows:
            owners.setdefault(window, set()).add(number[item])
        windows = list(owners)
        self.names = names
        self.lengths = np.array([len(w) // 8 for w in windows], np.int64)
        self.words = np.zeros((len(windows), WINDOW), np.uint64)
        for i, w in enumerate(windows):
            self.words[i, : len(w) // 8] = np.frombuffer(w, np.uint64)
        self.item_ends = np.cumsum([len(owners[w]) for w in windows], dtype=np.int64)
        self.items = np.array([i for w in windows for i in sorted(owners[w])], np.int64)
        # every shingle: (hash, its width, window, place in the window)
        hashes, widths, owner, places = [], [], [], []
        for i, n in enumerate(self.lengths.tolist()):
            k = min(SHINGLE, n)
            found = words.shingles(self.words[i, :n], k)
            hashes.append(found)
            widths.append(np.full(len(found), k))
            owner.append(np.full(len(found), i))
            places.append(np.arange(len(found)))
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        self.hashes, self.widths = join(hashes, np.uint64), join(widths, np.int64)
        self.owner, self.places = join(owner, np.int64), join(places, np.int64)

    def shingles(self) -> "Lookup":
        return Lookup(self.hashes, self.widths)

    def prefixes(self, counts: dict[int, int]) -> None:
        """Keep the rarest shingle of every window; a window with one that no document has goes."""
        df = np.array([counts.get(int(h), 0) for h in self.hashes.view(np.int64)], np.int64)
        order = np.lexsort((self.places, self.hashes, df, self.owner))
        first = np.ones(len(order), bool)
        first[1:] = self.owner[order][1:] != self.owner[order][:-1]
        chosen = order[first]
        chosen = chosen[df[chosen] > 0]
        chosen = chosen[np.argsort(self.hashes[chosen], kind="stable")]
        self.hashes, self.widths = self.hashes[chosen], self.widths[chosen]
        self.owner, self.places = self.owner[chosen], self.places[chosen]
        self.lookup = Lookup(self.hashes, self.widths)


class Lookup:
    """Which hashes of a long array are among a few."""

    def __init__(self, hashes: np.ndarray, widths: np.ndarray):
        self.values = np.unique(hashes)
        self.widths = np.unique(widths).tolist()
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def positions(self, hashes: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(maybe):
            return maybe
        at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
        return maybe[self.values[at] == hashes[maybe]]

    def matches(self, group: words.Group, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, hashes) of the group's shingles, for each width in use."""
        for k in self.widths:
            if len(owner) < k:
                continue
            found = words.shingles(group.hashes, k)
            at = self.positions(found)
            at = at[owner[at] == owner[at + k - 1]]  # not across two texts
            yield at, found[at]


def _shingle_counts(docs: DataFrame, text_col: str, lookup) -> dict[int, int]:
    """In how many documents each shingle of a block occurs; absent: none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup.value
        total = np.zeros(len(table.values), np.int64)
        for batch in words.pieces(batches):
            for group in words.groups(batch.column(0), words.ALNUM, fold=True):
                owner = group.owner
                for at, hashes in table.matches(group, owner):
                    which = np.searchsorted(table.values, hashes)
                    pairs = np.unique(owner[at] * len(table.values) + which)
                    total += np.bincount(pairs % len(table.values), minlength=len(table.values))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"shingle": table.values[some].view(np.int64), "n": total[some]})

    found = docs.select(text_col).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {r["shingle"]: r["n"] for r in found.collect()}  # at most one row per shingle of the block


def _contained(block: Block, group: words.Group, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, window) of every occurrence of a window, some thousand candidates at a time."""
    text_starts = group.ends - group.counts
    for at, hashes in block.lookup.matches(group, owner):
        low, high = np.searchsorted(block.hashes, hashes, "left"), np.searchsorted(block.hashes, hashes, "right")
        ends = np.cumsum(high - low)
        done = 0
        while done < len(at):
            stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + 65536, "right")))
            n = high[done:stop] - low[done:stop]
            entry = np.repeat(low[done:stop], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            position = np.repeat(at[done:stop], n)
            window, text = block.owner[entry], owner[position]
            start = position - block.places[entry]
            length = block.lengths[window]
            fits = (start >= text_starts[text]) & (start + length <= group.ends[text])
            start, window, length = start[fits], window[fits], length[fits]
            columns = np.arange(WINDOW)
            there = group.hashes[np.minimum(start[:, None] + columns, len(owner) - 1)]
            equal = ((there == block.words[window]) | (columns >= length[:, None])).all(axis=1)
            yield start[equal], window[equal]
            done = stop


def contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    keep: list[str] | None = None, prefix: str = "",
) -> DataFrame:
    """The columns `keep` (all by default), n_words, n_hit and items of every document.

    Words are runs of letters, digits and characters beyond ASCII, A-Z as a-z. `n_hit` counts
    the words inside any occurrence of a window of any item, `items` has the ids of the items
    with occurring windows, as strings in code-point order. New columns take `prefix` and
    replace earlier ones of their name. NULL and empty texts have no words; items without
    words have no window; items that repeat an id count as one; a NULL id reads "null". An
    empty benchmark hits nothing, an empty table gives no row.
    """
    windows = item_windows(benchmark, item_col, item_text_col)
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    new = [f"{prefix}n_words", f"{prefix}n_hit", f"{prefix}items"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    state = ["_dc_hits", "_dc_items"]
    current = docs
    for number in range(blocks):
        mine = windows.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        block = Block([(r["item"], r["words"]) for r in mine.collect()])  # a block has a bounded number of windows
        context = docs.sparkSession.sparkContext
        block.prefixes(_shingle_counts(docs, text_col, context.broadcast(block.shingles())))
        current = _pass(current, text_col, kept, state, new, context.broadcast(block), number == 0, number == blocks - 1)
    return current


def _pass(docs: DataFrame, text_col, kept, state, new, shared, first: bool, last: bool) -> DataFrame:
    """One block: adds its hits and items to those of the blocks before."""
    through = kept if last else list(dict.fromkeys([*kept, text_col]))
    read = list(dict.fromkeys([*through, text_col, *([] if first else state)]))
    extra = [StructField(n, k) for n, k in zip(new, (LongType(), LongType(), ArrayType(StringType())), strict=True)] if last else [
        StructField(state[0], BinaryType()), StructField(state[1], ArrayType(StringType()))
    ]
    schema = StructType([*(docs.schema[c] for c in through), *extra])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in words.pieces(batches):
            n_words, hits, items = [], [], []
            for group in words.groups(batch.column(text_col), words.ALNUM, fold=True):
                owner = group.owner
                edge = np.zeros(len(owner) + 1, np.int64)
                found = []
                for start, window in _contained(block, group, owner):
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + block.lengths[window], -1)
                    found.append(np.unique(owner[start] * len(block.lengths) + window) if len(start) else start)
                hit = np.cumsum(edge[:-1]) > 0
                items_of: dict[int, set[int]] = {}
                for pair in np.unique(np.concatenate(found)).tolist() if found else []:
                    text, window = divmod(pair, len(block.lengths))
                    low = int(block.item_ends[window - 1]) if window else 0
                    items_of.setdefault(text, set()).update(block.items[low : int(block.item_ends[window])].tolist())
                for row, low, high in group.slices():
                    mine, names = hit[low:high], [block.names[i] for i in items_of.get(row - group.first, ())]
                    if not first:
                        before = np.frombuffer(batch.column(state[0])[row].as_buffer(), np.uint8)
                        mine = mine | np.unpackbits(before, count=high - low).astype(bool)
                        names += batch.column(state[1])[row].as_py()
                    n_words.append(high - low)
                    hits.append(int(np.count_nonzero(mine)) if last else np.packbits(mine).tobytes())
                    items.append(sorted(names))
            plain = [batch.column(c) for c in through]
            strings = pa.array(items, pa.list_(pa.string()))
            added = [pa.array(n_words, pa.int64()), pa.array(hits, pa.int64()), strings] if last else [pa.array(hits, pa.binary()), strings]
            yield pa.RecordBatch.from_arrays([*plain, *added], [*through, *(f.name for f in extra)])

    return docs.select(*read).mapInArrow(search, schema)


def is_contaminated(n_words, n_hit):
    """Some words are hit, and at least a twentieth of all."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
