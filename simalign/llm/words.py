"""Words of UTF-8 text as 64-bit hashes, vectorised over the bytes of an Arrow column.

Both word classes used here are decided byte by byte, as every byte of a character beyond
ASCII is 0x80 or more: `SPACED` takes runs of anything but space and 0x09-0x0D, `ALNUM`
runs of letters, digits and anything beyond ASCII. Texts are handled in groups of about
`GROUP_BYTES`; a longer text is a group of its own and is cut at separators, so that the
temporaries stay small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
SPACED = ~SPACES
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[0x0A] = False

_bytes = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
BYTE_VALUE = {False: _bytes, True: _bytes.copy()}
BYTE_VALUE[True][0x41:0x5B] = _bytes[0x61:0x7B]  # A-Z as a-z

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        base = np.uint64(_BASE if kind == "up" else _INVERSE)
        with np.errstate(over="ignore"):
            grown = np.full(max(n, GROUP_BYTES + 1024), base, np.uint64)
            grown[0] = 1
            have = np.multiply.accumulate(grown)
        if n <= 4 * GROUP_BYTES:
            _powers[kind] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass
class Group:
    """Words of consecutive texts: `ends[i]` is one past the last word of text i."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray
    ends: np.ndarray
    starts: np.ndarray
    stops: np.ndarray

    @property
    def size(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.size), self.counts)

    def slices(self) -> Iterator[tuple[int, int, int]]:
        low = 0
        for i, high in enumerate(self.ends.tolist()):
            yield self.first + i, low, high
            low = high

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return np.diff(total[self.offsets])


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, where, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def spans(data: np.ndarray, bounds: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; no run passes a bound between texts."""
    inside = word[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    before[cut] = False
    after[cut - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit hash of each span; `fold` takes A-Z as a-z."""
    n = len(data)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[fold][data] * _power("up", n), out=total[1:])
        return mix((total[stops] - total[starts]) * _power("down", n + 1)[starts] + (stops - starts).astype(np.uint64))


def hashed(data: np.ndarray, offsets: np.ndarray, word: np.ndarray, fold: bool):
    """Starts, ends and hashes of all words; a long text is cut at separators."""
    if len(data) <= 2 * GROUP_BYTES:
        starts, stops = spans(data, offsets, word)
        return starts, stops, span_hashes(data, starts, stops, fold)
    parts, low = [], 0
    while low < len(data):
        high = min(low + GROUP_BYTES, len(data))
        while high < len(data):
            gap = np.flatnonzero(~word[data[high : high + GROUP_BYTES]])
            if len(gap):
                high += int(gap[0])
                break
            high = min(high + GROUP_BYTES, len(data))
        piece = data[low:high]
        starts, stops = spans(piece, offsets - low, word)
        parts.append((starts + low, stops + low, span_hashes(piece, starts, stops, fold)))
        low = high
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def groups(texts: pa.Array, word: np.ndarray = SPACED, fold: bool = False) -> Iterator[Group]:
    """Word hashes of a string column, in groups of consecutive texts."""
    raw, offsets = text_buffer(texts)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        data = raw[offsets[first] : offsets[last]]
        local = (offsets[first : last + 1] - offsets[first]).astype(np.int64)
        starts, stops, hashes = hashed(data, local, word, fold)
        ends = np.searchsorted(starts, local[1:], "left")
        yield Group(first, data, local, hashes, ends, starts, stops)
        first = last


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of k consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, k, np.uint64)
        for j in range(k):
            total = total * np.uint64(_BASE) + hashes[j : j + n]
        return mix(total)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles; with fewer than k words the whole sequence is one."""
    if not len(hashes):
        return hashes
    return np.unique(shingles(hashes, min(k, len(hashes))))


class WordMemory:
    """Codes of words, made once per worker and remembered within about `limit` bytes.

    A worker has one memory at a time: the first use of another empties it.
    """

    #: What a word takes beside its characters: two objects and their place in a table.
    ENTRY = 200
    _used: WordMemory | None = None

    def __init__(self, encode, limit: int = 80 << 20, longest: int = 48):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.known: dict[str, bytes] = {}
        self.held = 0

    def forget(self) -> None:
        self.known.clear()
        self.held = 0

    def __call__(self, texts: list[list[str]]) -> list[bytes]:
        """The codes of every text's words, one after the other."""
        if WordMemory._used is not self:
            if WordMemory._used is not None:
                WordMemory._used.forget()
            WordMemory._used = self
        every = set().union(*texts)
        new = list(every.difference(self.known))
        size = len(new) * self.ENTRY + 2 * sum(map(len, new))
        if self.held + size > self.limit:
            self.forget()
            new = list(every)
            size = len(new) * self.ENTRY + 2 * sum(map(len, new))
        known = self.known
        known.update(zip(new, self.encode(new), strict=True))
        self.held += size
        out = [b"".join(map(known.__getitem__, x)) for x in texts]
        for w in new:
            if len(w) > self.longest:
                del known[w]
                self.held -= self.ENTRY + 2 * len(w)
        return out


def steps(texts: list[str], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with about so many characters."""
    low = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= chars:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of at most so many rows, so that little is held as Python objects."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
