"""Product codes of vectors by Lloyd rounds that compare only what moved.

A vector is cut into equal consecutive parts; every part position has a codebook of its own.
A round assigns each part to the nearest entry and then moves every entry to the floor of
the mean of its parts. Between rounds a part keeps its entry and the exact squared distance to
it. If that entry stayed where it was, no other unmoved entry can have become nearer, so
only the entries that moved are compared with the kept distance; otherwise all entries are.
All numbers are integers, so nothing depends on the order of rows.

Vectors and states lie in one table, written once a round. Each task adds up its parts by
entry and writes one row of sums, which Spark adds up further; the driver sees one number per
entry and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simalign.llm import files
from simalign.session import stage

PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Components are floor(SCALE * x); beyond LARGEST a sum of squares may not fit 64 bits.
SCALE, LARGEST = 4096, 1 << 27
#: Vectors handled at once in a task.
STEP_ROWS = 8192


@dataclass
class Codebooks:
    """Entries as integers, [part, entry, component], and which of them moved last."""

    entries: np.ndarray
    moved: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and place, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Vectors that are not NULL and hold no NULL, NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def assign(parts: np.ndarray, books: Codebooks, code: np.ndarray | None, dist: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(code, dist) of vectors [row, part, component]: nearest entry, the lower index on ties.

    With the code and distances of the round before, parts whose entry stayed fixed look at
    the moved entries only.
    """
    n, n_parts = parts.shape[:2]
    out, far = np.zeros((n, n_parts), np.uint8), np.zeros((n, n_parts), np.int64)
    for p in range(n_parts):
        entries, moved = books.entries[p], books.moved[p]
        fixed = np.zeros(n, bool) if code is None else ~moved[code[:, p]]
        for rows, asked in ((np.flatnonzero(fixed), np.flatnonzero(moved)), (np.flatnonzero(~fixed), np.arange(len(entries)))):
            if not len(rows):
                continue
            x = parts[rows, p]
            if fixed[rows[0]]:
                best, least = code[rows, p].astype(np.int64), dist[rows, p].copy()
            else:
                best, least = np.full(len(rows), len(entries)), np.full(len(rows), np.iinfo(np.int64).max)
            for e in asked.tolist():
                away = x - entries[e]
                d = np.einsum("ij,ij->i", away, away)
                nearer = (d < least) | ((d == least) & (e < best))
                best[nearer], least[nearer] = e, d[nearer]
            out[rows, p], far[rows, p] = best, least
    return out, far


def _sums(parts: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """[part, entry, component + 1]: sums of the parts by entry, their number last."""
    n, n_parts, width = parts.shape
    out = np.zeros((n_parts, entries, width + 1), np.int64)
    for p in range(n_parts):
        order = np.argsort(code[:, p], kind="stable")
        present, lows = np.unique(code[order, p], return_index=True)
        out[p, present, :width] = np.add.reduceat(parts[order, p], lows, axis=0)
        out[p, present, width] = np.diff(np.append(lows, n))
    return out


def _round(table: DataFrame, books: Codebooks, first: bool) -> DataFrame:
    """The table with new states; one more row per task holds its sums."""
    names = [c for c in table.columns if c not in ("_vc_code", "_vc_dist", "_vc_sums")]
    n_parts, n_entries, width = books.entries.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_parts, n_entries, width + 1), np.int64)
        schema = None
        for batch in batches:
            for low in range(0, batch.num_rows, STEP_ROWS):
                some = batch.slice(low, STEP_ROWS)
                parts = some.column("_vc_vector").flatten().to_numpy(zero_copy_only=False)
                parts = parts.astype(np.int64).reshape(-1, n_parts, width)
                code = dist = None
                if not first:
                    code = np.frombuffer(b"".join(some.column("_vc_code").to_pylist()), np.uint8).reshape(-1, n_parts)
                    dist = some.column("_vc_dist").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_parts)
                code, dist = assign(parts, books, code, dist)
                total += _sums(parts, code, n_entries)
                made = {c: some.column(c) for c in names}
                made["_vc_code"] = pa.array([x.tobytes() for x in code], pa.binary())
                made["_vc_dist"] = pa.ListArray.from_arrays(np.arange(len(code) + 1, dtype=np.int32) * n_parts, dist.reshape(-1))
                made["_vc_sums"] = pa.nulls(len(code), pa.list_(pa.int64()))
                out = pa.RecordBatch.from_pydict(made)
                schema = out.schema
                yield out
        if schema is not None:
            last = [pa.nulls(1, t) for t in schema.types[:-1]]
            yield pa.RecordBatch.from_arrays([*last, pa.array([total.reshape(-1)], pa.list_(pa.int64()))], schema=schema)

    fields = [f for f in table.schema.fields if f.name in names]
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return table.mapInArrow(step, f"{declared}, _vc_code binary, _vc_dist array<long>, _vc_sums array<long>")


def _moved(table: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: floors of means, unused entries as they were."""
    sums = table.filter("_vc_sums IS NOT NULL").select(F.posexplode("_vc_sums").alias("at", "v"))
    shape = (*books.entries.shape[:2], books.entries.shape[2] + 1)
    total = np.zeros(shape, np.int64).reshape(-1)
    for r in sums.groupBy("at").agg(F.sum("v").alias("v")).collect():  # one row per entry and component
        total[r["at"]] = r["v"]
    total = total.reshape(shape)
    count = total[..., -1:]
    entries = np.where(count > 0, total[..., :-1] // np.maximum(count, 1), books.entries)
    return Codebooks(entries, (entries != books.entries).any(axis=2))


def _start(ready: DataFrame, id_col: str, n_parts: int, n_entries: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; None for an empty table."""
    order = [F.asc_nulls_last(id_col), F.asc("_vc_vector")]
    seeds = [r[0] for r in ready.orderBy(*order).limit(n_entries).select("_vc_vector").collect()]
    if not seeds:
        return None
    width = len(seeds[0]) // n_parts
    entries = np.array(seeds, np.int64).reshape(len(seeds), n_parts, width).transpose(1, 0, 2).copy()
    return Codebooks(entries, np.ones(entries.shape[:2], bool))


def encode(
    vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """(`vectors` without the vector column but with code and error, the final codebooks).

    `code` holds the index of each part's entry as two hex digits, `error` the sum of the
    squared distances. Vectors that are NULL, empty or hold a NULL or non-finite component
    have no row, nor have vectors of another length than that of the smallest id. A length that
    the parts do not divide is filled up with zeros. Codebooks begin as the parts of the smallest ids
    (NULL last, equal ids by their components); with fewer vectors than entries there are fewer
    entries. Repeated rows are coded alike, earlier columns named code and error go, all others
    are kept. An empty table gives no row and no codebooks. Components of LARGEST / SCALE
    and more in absolute value raise a ValueError, as their errors need not fit a long.
    """
    spark = vectors.sparkSession
    kept = [c for c in vectors.columns if c not in (vector_col, "code", "error")]
    ready = vectors.filter(usable(F.col(vector_col)) & (F.size(vector_col) > 0)).select(*kept, whole_numbers(F.col(vector_col)).alias("_vc_vector"))
    shape = ready.agg(
        F.min_by(F.size("_vc_vector"), F.struct(F.col(id_col).isNull(), id_col, "_vc_vector")).alias("length"),
        F.max(F.array_max(F.transform("_vc_vector", F.abs))).alias("largest"),
    ).first()
    empty = ready.select(*kept, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")).limit(0)
    if shape["length"] is None:
        return empty, None
    if shape["largest"] >= LARGEST:
        raise ValueError(f"components reach {shape['largest'] / SCALE}, the most is {LARGEST // SCALE}")
    length = -(-shape["length"] // parts) * parts
    fill = F.array_repeat(F.lit(0).cast("long"), length - shape["length"])
    ready = ready.filter(F.size("_vc_vector") == shape["length"]).withColumn(
        "_vc_vector", F.concat("_vc_vector", fill).cast("array<int>")
    )
    table, path = files.stage_at(ready)
    books = _start(table, id_col, parts, entries)
    for turn in range(rounds + 1):
        after, new = files.stage_at(_round(table.drop("_vc_sums").filter("_vc_vector IS NOT NULL"), books, turn == 0))
        files.remove(path)  # what was written last has all of it
        table, path = after, new
        if turn < rounds:
            books = _moved(table, books)
            if not books.moved.any():  # every further round would repeat this one
                break
    code = F.lower(F.hex("_vc_code"))
    error = F.aggregate("_vc_dist", F.lit(0).cast("long"), lambda s, d: s + d)
    return table.filter("_vc_vector IS NOT NULL").select(*kept, code.alias("code"), error.alias("error")), books


def add_total(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """`rows` with the sum of `value` over all rows of equal `key`, NULL being one of the keys.

    Keys that hold a thousandth of all rows and more, at most a thousand, are broadcast; the
    others are joined by a shuffle, in which no key has more rows than that.
    """
    sums = stage(rows.groupBy(F.col(key).alias("_vc_key")).agg(F.sum(value).alias(out), F.count("*").alias("_vc_n")))
    edge = (sums.agg(F.sum("_vc_n")).first()[0] or 0) / 1000
    heads, rest = sums.filter(F.col("_vc_n") >= edge).drop("_vc_n"), sums.filter(F.col("_vc_n") < edge).drop("_vc_n")
    same = F.col(key).eqNullSafe(F.col("_vc_key"))
    large = rows.join(F.broadcast(heads), same).drop("_vc_key")
    small = rows.join(F.broadcast(heads.select("_vc_key")), same, "left_anti").join(rest, same).drop("_vc_key")
    return large.unionByName(small)
