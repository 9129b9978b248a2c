"""Token ids of documents as directly addressable codes.

Ids are split into chunks of 8 bits. Level 0 holds the lowest chunk of every id, level 1
the next chunk of the ids that need one, and so on. A bitmap per level says which ids go
on; a rank directory (set bits before each block of 512) leads from a position to its place
on the next level, so any id is found by one look-up per level, without decoding what lies
before it.

A file is a row of segments of about `SEGMENT_TOKENS` ids. A segment holds whole documents,
their ids and where they end:

    "DACS" version levels documents tokens | doc ids | null flags | ends |
    per level: count, chunks, bitmap, rank directory

and the file ends with the places of its segments and their number.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simalign.llm import files
from simalign.llm.words import WordMemory, pieces, steps
from simalign.session import stage

SEGMENT_TOKENS = 1 << 20
BLOCK_BITS = 512

_HEAD = struct.Struct("<4sHHQQ")
MANIFEST = "part int, file string, documents long, tokens long, bytes long"
_POPCOUNT = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def _pad(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % 8)


def encode_segment(doc_ids: list, token_ids: list[np.ndarray]) -> bytes:
    """One segment; `doc_ids` may hold None."""
    ids = np.concatenate(token_ids) if token_ids else np.zeros(0, np.uint32)
    ends = np.cumsum([len(x) for x in token_ids], dtype=np.uint64)
    levels, rest = [], ids.astype(np.uint32)
    while True:
        goes_on = rest > 0xFF
        bitmap = np.packbits(goes_on, bitorder="little")
        blocks = np.zeros(-(-len(rest) // BLOCK_BITS) * (BLOCK_BITS // 8), np.uint8)
        blocks[: len(bitmap)] = bitmap
        per_block = _POPCOUNT[blocks].reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate(([0], np.cumsum(per_block, dtype=np.uint64)[:-1])) if len(per_block) else per_block
        levels.append(
            struct.pack("<Q", len(rest)) + _pad((rest & 0xFF).astype(np.uint8).tobytes())
            + _pad(bitmap.tobytes()) + ranks.astype("<u8").tobytes()
        )
        rest = rest[goes_on] >> 8
        if not len(rest):
            break
    flags = np.array([x is None for x in doc_ids], np.uint8)
    names = np.array([x or 0 for x in doc_ids], "<i8")
    return b"".join([
        _HEAD.pack(b"DACS", 1, len(levels), len(doc_ids), len(ids)), names.tobytes(),
        _pad(flags.tobytes()), ends.astype("<u8").tobytes(), *levels,
    ])


class Segment:
    """A segment in memory; its ids are read by position."""

    def __init__(self, raw: bytes):
        magic, version, n_levels, self.documents, self.tokens = _HEAD.unpack_from(raw)
        if magic != b"DACS" or version != 1:
            raise ValueError("not a segment of token codes")
        at = _HEAD.size

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += -(-out.nbytes // 8) * 8
            return out

        self.doc_ids = take(self.documents, "<i8")
        self.nulls = take(self.documents, "u1").astype(bool)
        self.ends = take(self.documents, "<u8").astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(take(1, "<u8")[0])
            self.levels.append((
                take(n, "u1"), take(-(-n // 8), "u1"), take(-(-n // BLOCK_BITS), "<u8"),
            ))

    def _rank(self, level: int, position: int) -> int:
        """Set bits before a position: the directory, and at most one block of the bitmap."""
        _, bitmap, ranks = self.levels[level]
        block = position // BLOCK_BITS
        if block >= len(ranks):
            block = len(ranks) - 1
        low = block * (BLOCK_BITS // 8)
        whole = int(_POPCOUNT[bitmap[low : position // 8]].sum())
        last = position % 8
        part = bin(int(bitmap[position // 8]) & ((1 << last) - 1)).count("1") if last else 0
        return int(ranks[block]) + whole + part

    def token(self, position: int) -> int:
        """The id at one position."""
        out = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            out |= int(chunks[position]) << (8 * level)
            if not bitmap[position // 8] >> (position % 8) & 1:
                break
            position = self._rank(level, position)
        return out

    def tokens_between(self, start: int, stop: int) -> np.ndarray:
        """The ids of positions start .. stop - 1; only their own chunks are touched."""
        out = np.zeros(stop - start, np.uint32)
        where = None
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            if stop <= start:
                break
            part = chunks[start:stop].astype(np.uint32) << np.uint32(8 * level)
            if where is None:
                out |= part
            else:
                out[where] |= part
            bits = np.unpackbits(bitmap[start // 8 : -(-stop // 8)], bitorder="little")
            goes_on = bits[start % 8 : start % 8 + stop - start].astype(bool)
            more = int(np.count_nonzero(goes_on))
            if not more:
                break
            where = np.flatnonzero(goes_on) if where is None else where[goes_on]
            start = self._rank(level, start)
            stop = start + more
        return out


def segments(file) -> Iterator[Segment]:
    """The segments of an open file, one in memory at a time."""
    size = file.size()
    n = struct.unpack("<Q", file.read_at(8, size - 8))[0]
    places = [*np.frombuffer(file.read_at(8 * n, size - 8 - 8 * n), "<u8").tolist(), size - 8 - 8 * n]
    for low, high in zip(places, places[1:], strict=False):
        yield Segment(file.read_at(high - low, low))


# ---- text to ids -----------------------------------------------------------------------


class Encoder:
    """Whole texts to ids by the tokenizers library.

    Byte-level vocabularies split a text by a fixed pattern before any merge, and no piece
    of that pattern goes on past a space, apart from runs of white space. So the ids of a
    text are those of its first word and of each further word with its space; the library
    encodes a word once and its ids are remembered. Texts with a longer run of white space
    around a space, or with characters outside the Latin blocks (the pattern of two Unicode
    versions may differ there), go to the library whole, and so do texts with the string of an
    added token, which the library takes for that token. Without `special` such strings are
    ordinary text.
    """

    def __init__(self, vocabulary: str, special: bool = True):
        import re

        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.library.encode_special_tokens = not special
        self.added = [x.content for x in self.library.get_added_tokens_decoder().values()] if special else []
        self.usual = re.compile("[\t\n\r -~¡-¬®-ɏ‐-‧‰-›€]*").fullmatch
        self.words = WordMemory(self._encode_words, limit=170 << 20)
        #: Ids that begin with a space, by id.
        entries = self.library.get_vocab()
        self.opens = np.zeros(max(entries.values()) + 1, bool)
        self.opens[[i for piece, i in entries.items() if piece.startswith("Ġ")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word after a space. Many words are encoded as one line and told apart
        by the ids that begin with a space; words that hold white space go one by one."""
        out: list[bytes] = [b""] * len(words)
        odd = [i for i, w in enumerate(words) if not w or "\n" in w or "\t" in w or "\r" in w]
        for i, raw in zip(odd, self._encode([f" {words[i]}" for i in odd]), strict=True):
            out[i] = raw
        skip = set(odd)
        plain = [i for i in range(len(words)) if i not in skip]
        lines = [plain[k : k + 2000] for k in range(0, len(plain), 2000)]
        texts = ["".join([f" {words[i]}" for i in line]) for line in lines]
        for line, raw in zip(lines, self._encode(texts), strict=True):
            ids = np.frombuffer(raw, np.uint32)
            cuts = (np.flatnonzero(self.opens[ids]) * 4).tolist()
            if len(cuts) != len(line):
                raise ValueError("the vocabulary does not mark words by their space")
            for i, low, high in zip(line, cuts, [*cuts[1:], len(raw)], strict=True):
                out[i] = raw[low:high]
        return out

    def _whole(self, text: str) -> bool:
        return (
            "  " in text or " \n" in text or " \t" in text or " \r" in text or text.endswith(" ") or not self.usual(text)
            or any(x in text for x in self.added)
        )

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, four bytes to an id."""
        parts = [[x] if self._whole(x) else x.split(" ") for x in texts]
        firsts = self._encode([x[0] for x in parts])
        return [a + b for a, b in zip(firsts, self.words([x[1:] for x in parts]), strict=True)]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(vocabulary: str, special: bool = True) -> Encoder:
    """The encoder of this Python worker: vocabularies load once."""
    if (vocabulary, special) not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[vocabulary, special] = Encoder(vocabulary, special)
    return _encoders[vocabulary, special]


# ---- Spark -------------------------------------------------------------------------------


def write_codes(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json", end_id: int = 2, special_tokens: bool = True,
) -> DataFrame:
    """Encode every whole text, end each with `end_id`, write code files; returns the manifest.

    The string of a special token in a text is that token, as the library has it, or ordinary
    text without `special_tokens`.

    Documents are written in ascending id order, NULL ids first; equal ids are ordered by
    text hash. A NULL or empty text is the end id alone. Rows that repeat are all written.
    An empty table gives an empty manifest. Other columns are ignored. Texts move once, to
    the range of their id; a task holds one segment and one Arrow batch.
    """
    ordered = (
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
            F.xxhash64(F.col(text_col)).alias("_tie"),
        )
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(vocabulary, special_tokens), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        sink, uri, places, size = None, None, [], 0
        names, ids, held, documents, tokens = [], [], 0, 0, 0

        def flush():
            nonlocal held, size, sink, uri
            if sink is None:
                sink, uri = files.create(folder, f"part-{part:06d}-{uuid.uuid4().hex}.dac")
            raw = encode_segment(names, ids)
            sink.write(raw)
            places.append(size)
            size += len(raw)
            names.clear()
            ids.clear()
            held = 0

        for batch in pieces(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            doc_ids = batch.column(0).to_pylist()
            for low, high in steps(texts):
                for doc_id, raw in zip(doc_ids[low:high], encode(texts[low:high]), strict=True):
                    row = np.frombuffer(raw + end, "<u4")
                    names.append(doc_id)
                    ids.append(row)
                    held += len(row)
                    documents += 1
                    tokens += len(row)
                    if held >= SEGMENT_TOKENS:
                        flush()
        if names:
            flush()
        if sink is not None:
            sink.write(np.array([*places, len(places)], "<u8").tobytes())
            sink.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [uri], "documents": [documents],
                "tokens": [tokens], "bytes": [size],
            })

    with files.small_batches(docs.sparkSession):
        return stage(ordered.mapInArrow(write, MANIFEST))


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids in the files before each; one row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_codes(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, tokens) read back from the files, one task per file.

    Each document is read by its position in the codes. `tokens` holds its ids as bytes,
    little-endian and four to an id.
    """
    return _read(manifest, True)


def read_index(manifest: DataFrame) -> DataFrame:
    """As `read_codes`, without the ids."""
    return _read(manifest, False)


def _read(manifest: DataFrame, with_tokens: bool) -> DataFrame:
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", tokens binary" * with_tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = row["start"]
                with files.open_file(row["file"]) as file:
                    for seg in segments(file):
                        low, counts, sums, raws = 0, [], [], []
                        for high in seg.ends.tolist():
                            raw = seg.tokens_between(low, high).astype("<u4").tobytes()
                            counts.append(high - low)
                            sums.append(zlib.crc32(raw))
                            if with_tokens:
                                raws.append(raw)
                            low = high
                        firsts = start + seg.ends - np.array(counts, np.int64)
                        out = {
                            "doc_id": pa.array(seg.doc_ids, pa.int64(), mask=seg.nulls), "start": pa.array(firsts),
                            "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
                        }
                        if with_tokens:
                            out["tokens"] = pa.array(raws, pa.binary())
                        yield pa.RecordBatch.from_pydict(out)
                        start += seg.tokens

    return files.one_file_per_task(with_starts(manifest)).mapInArrow(read, schema)


def tokens_at(manifest: DataFrame, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """(position, token) of single positions in the whole stream of ids.

    A position is looked up in its file by rank directories alone. Positions outside the
    stream, and NULL, have no row. The driver holds one number per file.
    """
    rows = with_starts(manifest).orderBy("start").select("file", "start", "tokens").collect()
    uris, starts = [r["file"] for r in rows], np.array([r["start"] for r in rows], np.int64)
    total = int(starts[-1] + rows[-1]["tokens"]) if rows else 0
    wanted = positions.select(F.col(position_col).cast("long").alias("position"))
    wanted = wanted.filter((F.col("position") >= 0) & (F.col("position") < total))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(starts, batch.column(0).to_numpy(), "right") - 1
            yield pa.RecordBatch.from_pydict({"position": batch.column(0), "_file": pa.array(at, pa.int64())})

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, low, seg, rest, file = None, 0, None, iter(()), None
        for batch in batches:
            found = []
            for position, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at != current:
                    if file is not None:
                        file.close()
                    current, low, file = at, int(starts[at]), files.open_file(uris[at])
                    rest = segments(file)
                    seg = next(rest)
                while position >= low + seg.tokens:
                    low += seg.tokens
                    seg = next(rest)
                found.append(seg.token(position - low))
            yield pa.RecordBatch.from_pydict({"position": batch.column(0), "token": pa.array(found, pa.int64())})

    placed = wanted.mapInArrow(place, "position long, _file long")
    placed = placed.repartition("_file").sortWithinPartitions("_file", "position")
    return placed.mapInArrow(look, "position long, token long")
