"""Quality rules by tokeniser fertility.

A public vocabulary shows how well a text fits written language: characters per token fall
and byte fall-backs rise on debris, and the entropy of the tokens falls on repetition. A
document is rejected outside the band of its language, or of its script where no language
is known. Counts of words, symbols, repeated lines and repeated word windows come first.

The lower edges of a band are those of the corpus: documents that pass the counts are
grouped by band and by the octave of their number of tokens, and what lies far below the
median of its group is rejected. Fixed limits hold beside them, alone where a band has too
few documents to tell.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from simalign.llm import words
from simalign.session import stage

VOCABULARY = "piece_bpe_32k.model"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A modified z-score below -3.5 is the usual mark of an outlier; in median absolute deviations.
MADS = 3.5 / 0.6745
#: Documents that make an edge of their own, and the width of the bins in which values are counted.
LEAST_GROUP, BIN = 100, 0.002
#: Octaves of the number of tokens that have an entry in a table of edges.
OCTAVES = 48
#: Limits in any corpus: (least, most) characters per token, most byte share, least entropy in bits.
BANDS = {
    "en": (1.8, 9.0, 0.05, 5.2), "de": (1.85, 9.0, 0.05, 5.2), "fr": (1.6, 9.0, 0.05, 5.2), "es": (1.65, 9.0, 0.05, 5.2),
    "latin": (1.3, 9.0, 0.15, 5.0), "greek": (0.6, 9.0, 0.7, 4.0), "cyrillic": (1.2, 9.0, 0.2, 4.5),
    "arabic": (0.6, 9.0, 0.7, 4.0), "han": (0.4, 3.0, 0.9, 4.0), "other": (0.25, 12.0, 1.0, 3.5),
}
#: First and last code point of the letters that name a script.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)], "greek": [(0x370, 0x3FF)], "cyrillic": [(0x400, 0x52F)],
    "arabic": [(0x600, 0x6FF)], "han": [(0x3040, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7A3)],
}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

METRICS = (
    ("n_words", LongType()), ("word_chars", LongType()), ("n_symbols", LongType()), ("n_dup_lines", LongType()),
    ("n_repeat_words", LongType()), ("base_failed", BooleanType()), ("chars_per_token", DoubleType()),
    ("byte_share", DoubleType()), ("token_entropy", DoubleType()), ("n_tokens", LongType()), ("band", StringType()),
    ("kept", BooleanType()),
)


Edges = dict[tuple[str, int], tuple[float, float]]


class Vocabulary:
    """Token ids of words, as a worker remembers them."""

    def __init__(self, name: str):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.is_byte = np.array([model.IsByte(i) for i in range(model.GetPieceSize())])
        self.memory = words.WordMemory(lambda new: [array("I", x).tobytes() for x in model.encode(new, num_threads=1)] if new else [], limit=54 << 20)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint32) for x in self.memory([t.split() for t in texts])]


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(name: str) -> Vocabulary:
    if name not in _vocabularies:
        _vocabularies[name] = Vocabulary(name)
    return _vocabularies[name]


def script(text: str) -> str:
    """The script of most letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = {
        name: sum(int(((points >= low) & (points <= high)).sum()) for low, high in ranges)
        for name, ranges in SCRIPTS.items()
    }
    best = max(counts, key=counts.get)
    return best if counts[best] * 2 > sum(counts.values()) else "other"


def fertility(ids: np.ndarray, chars: int, is_byte: np.ndarray) -> tuple[float, float, float]:
    """Characters per token, share of byte tokens and entropy of the tokens in bits."""
    if not len(ids):
        return 0.0, 0.0, 0.0
    counts = np.unique(ids, return_counts=True)[1]
    p = counts / len(ids)
    return chars / len(ids), float(is_byte[ids].mean()), float(-(p * np.log2(p)).sum())


def least_values(edges: Edges, band: str, octave: int) -> tuple[float, float, int]:
    """Edges for characters per token and relative entropy, and the octave they come from.

    An octave without an edge takes that of the next shorter one that has one; (0, 0, 0) if none.
    """
    for shorter in range(octave, 0, -1):
        if (band, shorter) in edges:
            return *edges[band, shorter], shorter
    return 0.0, 0.0, 0


def low_edge(bins: dict[int, int]) -> float:
    """Median less `MADS` median absolute deviations, of values counted in bins."""
    values, n = np.array(sorted(bins)), np.array([bins[b] for b in sorted(bins)])

    def middle(x: np.ndarray) -> float:
        order = np.argsort(x, kind="stable")
        return float(x[order][np.searchsorted(np.cumsum(n[order]) * 2, n.sum())])

    median = middle(values)
    return BIN * (median + 0.5 - MADS * max(1.0, middle(np.abs(values - median))))


def corpus_edges(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", bands: dict = BANDS, name: str = VOCABULARY) -> Edges:
    """The edges of a corpus, see `edges_of`."""
    return edges_of(measure(docs, text_col, lang_col, [], bands, name))


def edges_of(measured: DataFrame, prefix: str = "") -> Edges:
    """Least characters per token and least entropy over log2 of the tokens, by band and octave.

    Groups of fewer than `LEAST_GROUP` documents have no edge. One aggregate over all
    documents that pass the base rules; what reaches the driver are counts of bins, whose
    number does not grow with the corpus.
    """
    seen = measured.select(*(F.col(prefix + n).alias(n) for n, _ in METRICS[:-1])).filter("NOT base_failed AND chars_per_token > 0")
    values = F.array(*(
        F.struct(F.lit(k).alias("measure"), F.floor(value / BIN).cast("long").alias("bin"))
        for k, value in enumerate((F.col("chars_per_token"), F.col("token_entropy") / F.log2("n_tokens")))
    ))
    counted = (
        seen.filter("n_tokens > 1").select("band", _octave(F.col("n_tokens")).alias("octave"), F.explode(values).alias("v"))
        .groupBy("band", "octave", "v.measure", "v.bin").count().collect()
    )
    groups: dict[tuple[str, int], tuple[dict, dict]] = {}
    for r in counted:
        groups.setdefault((r["band"], r["octave"]), ({}, {}))[r["measure"]][r["bin"]] = r["count"]
    return {key: (low_edge(a), low_edge(b)) for key, (a, b) in groups.items() if sum(a.values()) >= LEAST_GROUP}


def _octave(n: Column) -> Column:
    return F.length(F.bin(n)) - 1


def verdict(edges: Edges, bands: dict = BANDS, prefix: str = "") -> Column:
    """Whether a measured row is kept.

    Entropy rises with length, but falls relative to its greatest value: the edge of a shorter
    octave holds at the upper end of that octave.
    """
    column = {n: F.col(prefix + n) for n, _ in METRICS[:-1]}
    octave = F.least(_octave(column["n_tokens"]), F.lit(OCTAVES - 1))
    kept = F.lit(False)
    for band, (least, most, bytes_, bits) in bands.items():
        chars, entropy, end = zip(*(least_values(edges, band, o) for o in range(OCTAVES)))
        chars, entropy, end = (F.element_at(F.lit([float(x) for x in v]), octave + 1) for v in (chars, entropy, [o + 1 for o in end]))
        lowest = F.greatest(F.lit(bits), entropy * F.least(F.log2(column["n_tokens"]), end))
        inside = (
            (column["chars_per_token"] >= F.greatest(F.lit(least), chars)) & (column["chars_per_token"] <= most)
            & (column["byte_share"] <= bytes_) & (column["token_entropy"] >= lowest)
        )
        kept = F.when(column["band"] == band, inside).otherwise(kept)
    return ~column["base_failed"] & kept


def _count_repeats(owner: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    """Which entries have an equal hash elsewhere in their text, and whether it is earlier."""
    with np.errstate(over="ignore"):
        keys = words.mix(hashes + owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return np.stack((any_, later))


def base_counts(group: words.Group) -> dict[str, np.ndarray]:
    """The counts of every text of a group."""
    data, size = group.data, group.size
    inside = words.SPACED[data]
    out = {
        "n_words": group.counts, "word_chars": group.per_text(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": group.per_text(_SYMBOL[data]),
    }
    starts, stops, hashes = words.hashed(data, group.offsets, words.NOT_NEWLINE, False)
    seen = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    real = seen[stops] > seen[starts]
    owner = np.searchsorted(group.offsets, starts[real], "right") - 1
    later = _count_repeats(owner, hashes[real], size)[1]
    out["n_dup_lines"] = np.bincount(owner[later], minlength=size)
    owner = group.owner
    covered = np.zeros(len(owner), bool)
    if len(owner) >= 3:
        within = np.flatnonzero(owner[2:] == owner[:-2])
        windows = words.shingles(group.hashes, 3)[within]
        repeated = within[_count_repeats(owner[within], windows, size)[0]]
        for j in range(3):
            covered[repeated + j] = True
    out["n_repeat_words"] = np.bincount(owner[covered], minlength=size)
    return out


def assess(
    docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", keep: list[str] | None = None,
    bands: dict = BANDS, name: str = VOCABULARY, prefix: str = "", edges: Edges | None = None,
) -> DataFrame:
    """The columns `keep` (all by default) of every row, the counts, the fertility and `kept`.

    New columns are those of `METRICS`, with `prefix`; earlier columns of these names give
    way. A NULL or empty text has no words, fails the base rules and has fertility 0. A NULL
    or unknown language is judged by script. Rows that repeat are judged alike; an empty
    table gives no row. No row moves between tasks. `edges` are those of `docs` itself if none
    are given: measures and kept columns are then written once, when this is called, and the
    written rows are judged. {} leaves the limits of `bands`.
    """
    measured = measure(docs, text_col, lang_col, keep, bands, name, prefix)
    if edges is None:
        measured = stage(measured)
        edges = edges_of(measured, prefix)
    return measured.withColumn(prefix + "kept", verdict(edges, bands, prefix))


def measure(
    docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", keep: list[str] | None = None,
    bands: dict = BANDS, name: str = VOCABULARY, prefix: str = "",
) -> DataFrame:
    """The columns of `assess` but for the verdict."""
    new = [prefix + n for n, _ in METRICS]
    kept_columns = [c for c in (docs.columns if keep is None else keep) if c not in new]
    fields = [docs.schema[c] for c in kept_columns]
    schema = StructType([*fields, *(StructField(prefix + n, kind) for n, kind in METRICS[:-1])])
    read = list(dict.fromkeys([*kept_columns, text_col, *([lang_col] if lang_col in docs.columns else [])]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(name)
        for batch in words.pieces(batches):
            texts = [x or "" for x in batch.column(text_col).to_pylist()]
            langs = batch.column(lang_col).to_pylist() if lang_col in read else [None] * len(texts)
            counts: dict[str, list[np.ndarray]] = {}
            for group in words.groups(batch.column(text_col)):
                for key, values in base_counts(group).items():
                    counts.setdefault(key, []).append(values)
            n = {k: np.concatenate(v).astype(np.int64) for k, v in counts.items()}
            if not texts:
                n = {k: np.zeros(0, np.int64) for k, _ in METRICS[:5]}
            failed = (n["n_words"] < MIN_WORDS) | (100 * n["n_repeat_words"] > MAX_REPEAT_PERCENT * n["n_words"])
            measured, sizes, used = [], [], []
            for low, high in words.steps(texts):
                for i, ids in zip(range(low, high), vocab(texts[low:high]), strict=True):
                    measured.append(fertility(ids, int(n["word_chars"][i]), vocab.is_byte))
                    sizes.append(len(ids))
                    used.append(langs[i] if langs[i] in bands else script(texts[i]))
            columns = [
                *(pa.array(n[k]) for k, _ in METRICS[:5]), pa.array(failed, pa.bool_()),
                *(pa.array([m[j] for m in measured], pa.float64()) for j in range(3)),
                pa.array(sizes, pa.int64()), pa.array(used, pa.string()),
            ]
            plain = [batch.column(c) for c in kept_columns]
            yield pa.RecordBatch.from_arrays([*plain, *columns], [*kept_columns, *new[:-1]])

    return docs.select(*read).mapInArrow(run, schema)
