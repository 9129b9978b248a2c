"""Texts as numbers of words, encoded part by part.

Documents are dealt to parts by id. A part numbers its own terms, so one row for each term of a
part meets the vocabulary, not one for each word of a text; a text moves as whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simalign.session import stage

#: Bytes of text of one part, about: they bound the memory of a task, not what it may hold.
PART_BYTES = 32 << 20
#: Rows of one batch.
ROWS = 1 << 16

PARTS = "part int, place int, term string, n long, doc_id long, pos long, codes array<int>"


def term_parts(docs: DataFrame, tokens: Column) -> DataFrame:
    """Rows of two kinds, staged: the terms of every part (part, place, term, n, doc_id, pos), where doc_id and pos are
    the first occurrence and n counts all, and its documents (part, doc_id, codes), codes naming places."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, t in docs.dtypes if t == "string"), F.lit(0).cast("long"))
    n = docs.agg(F.sum(size)).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    dealt = docs.repartition(max(cores, -(-n // PART_BYTES)), "doc_id")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, sizes, ids = [], [], []
        for batch in batches:
            chunks.append(batch.column(1).flatten().dictionary_encode())
            sizes.append(batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            ids.append(batch.column(0))
        if not ids:
            return
        met = pa.chunked_array(chunks).unify_dictionaries()
        terms = met.chunk(0).dictionary if met.num_chunks else pa.array([], pa.string())
        codes = np.concatenate([c.indices.to_numpy() for c in met.chunks]).astype(np.int32)
        sizes, ids = np.concatenate(sizes), pa.concat_arrays(ids)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        # documents in the order of their ids, NULL first; rows of one id are one document
        missing, known = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        order = np.lexsort((known, ~missing))
        step = np.concatenate(([False], (known[order][1:] != known[order][:-1]) | (missing[order][1:] != missing[order][:-1])))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(step)
        pos = np.arange(len(codes)) - np.repeat(bounds[:-1], sizes)
        first = np.full(len(terms), np.iinfo(np.int64).max)
        np.minimum.at(first, codes, (np.repeat(rank, sizes) << 32) + pos)
        of = pa.array(order[np.concatenate(([0], np.flatnonzero(step)))])  # a row of each id
        counts = np.bincount(codes, minlength=len(terms))
        part = TaskContext.get().partitionId()
        for low in range(0, len(terms), ROWS):
            some = slice(low, min(low + ROWS, len(terms)))
            m = some.stop - low
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(m, part, np.int32)), "place": pa.array(np.arange(low, some.stop, dtype=np.int32)),
                "term": terms.slice(low, m), "n": pa.array(counts[some]), "doc_id": ids.take(of.take(pa.array(first[some] >> 32))),
                "pos": pa.array(first[some] & 0xFFFFFFFF), "codes": pa.nulls(m, pa.list_(pa.int32())),
            })
        for low in range(0, len(ids), ROWS):
            high = min(low + ROWS, len(ids))
            cut = bounds[low : high + 1]
            lists = pa.ListArray.from_arrays(pa.array(cut - cut[0], pa.int32()), pa.array(codes[cut[0] : cut[-1]]))
            m = high - low
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(m, part, np.int32)), "place": pa.nulls(m, pa.int32()), "term": pa.nulls(m, pa.string()),
                "n": pa.nulls(m, pa.int64()), "doc_id": ids.slice(low, m), "pos": pa.nulls(m, pa.int64()), "codes": lists,
            })

    return stage(dealt.select("doc_id", tokens.alias("terms")).mapInArrow(number, PARTS))


def occurrences(parts: DataFrame) -> DataFrame:
    """(term, n, doc_id, pos): the terms of all parts, for `vocab.index_vocabulary`."""
    return parts.filter("term IS NOT NULL").select("term", "n", "doc_id", "pos")


def sequences(parts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, seq): numbers of the vocabulary (term, idx) in text order, unknown words dropped.

    Rows of one document id are one document, its words by (place, number).
    """
    last = parts.agg(F.max("part")).first()[0] or 0
    held = parts.filter("term IS NOT NULL").join(vocabulary.select("term", F.col("idx").cast("long").alias("idx")), "term")
    texts = parts.filter("term IS NULL").select("part", "doc_id", "codes")
    met = held.select("part", "place", "idx").unionByName(texts, allowMissingColumns=True)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, numbers, ids, codes = [], [], [], []
        for batch in batches:
            named = batch.column("place").is_valid()
            places.append(batch.column("place").filter(named).to_numpy())
            numbers.append(batch.column("idx").filter(named).to_numpy())
            rest = batch.filter(pc.invert(named))
            ids.append(rest.column("doc_id"))
            codes.append(rest.column("codes"))
        if not sum(map(len, ids)):
            return
        ids, codes = pa.concat_arrays(ids), pa.concat_arrays(codes)
        sizes = codes.value_lengths().to_numpy()
        at = codes.flatten().to_numpy()
        table = np.full(int(at.max(initial=0)) + 1, -1, np.int64)
        places = np.concatenate(places)
        table[places] = np.concatenate(numbers)
        idx, owner = table[at], np.repeat(np.arange(len(ids)), sizes)
        encoded = ids.dictionary_encode(null_encoding="encode")
        which, shown = encoded.indices.to_numpy(), encoded.dictionary
        if len(shown) < len(ids):  # some rows are of one document
            pos = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            order = np.lexsort((idx, pos, which[owner]))
            idx, owner = idx[order], which[owner][order]
        else:
            shown = ids
        idx, owner = idx[idx >= 0], owner[idx >= 0]
        cut = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(shown)))))
        for low in range(0, len(shown), ROWS):
            mine = cut[low : low + ROWS + 1]
            seq = pa.ListArray.from_arrays(pa.array(mine - mine[0], pa.int32()), pa.array(idx[mine[0] : mine[-1]]))
            yield pa.RecordBatch.from_arrays([shown.slice(low, ROWS), seq], ["doc_id", "seq"])

    # one part to a task
    return met.repartitionById(last + 1, "part").mapInArrow(number, "doc_id long, seq array<long>")
