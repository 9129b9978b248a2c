"""Near-duplicate documents by MinHash bands, odd sketches and exact sets.

1. A document becomes its set of word shingles, of which only a digest, the band keys of
   its MinHash samples and an odd sketch are kept: every sample flips one bit of a bitmap,
   so two bitmaps differ in about as many bits as the samples of two documents differ.
   Documents with equal sets are one node from here on.
2. Nodes that share a band key are candidates. Their sketches are compared in blocks of
   bounded size, and a block gives back no pairs but a star per group of nodes that look
   alike, at most one row per node.
3. Connected candidates form clusters. The texts of clustered nodes are read once more, and
   their full sets are compared exactly, again in blocks that return stars.
4. Connected links are the classes.

A search from a node compares it with the nodes not yet reached, so a class of near copies
costs little more than its size, and no pair of nodes in one block is left out. Two nodes
with the asked similarity share no band key with a chance of `MISS`, and their sketches
differ by more than `SIGMAS` standard deviations about as rarely.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simalign.llm import files, words
from simalign.session import stage

#: In a million simulated pairs at a similarity of 0.85 or 0.8, at most one differs by more than six deviations.
ROWS, MISS, SIGMAS = 5, 1e-6, 6.0
SAMPLES, SKETCH_BITS = 256, 1024
#: Nodes of one bucket or cluster that meet in one block, and bytes of sets in a block.
BLOCK_NODES, BLOCK_BYTES = 1024, 16 << 20
_SEED = 7


def band_count(similarity: float) -> int:
    """Bands of `ROWS` samples that miss a pair of this similarity with a chance of MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - similarity**ROWS))


def sketch_limit(similarity: float, samples: int) -> float:
    """Most differing bits of two sketches that may belong to sets of this similarity."""
    least = similarity - SIGMAS * math.sqrt(similarity * (1 - similarity) / samples)
    return SKETCH_BITS / 2 * (1 - math.exp(-4 * samples * (1 - least) / SKETCH_BITS))


class Sampler:
    """MinHash samples of a set, its band keys and its odd sketch."""

    def __init__(self, bands: int):
        self.bands, self.samples = bands, max(SAMPLES, bands * ROWS)
        rng = np.random.default_rng(_SEED)
        self.times = rng.integers(0, 1 << 31, (self.samples, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.plus = rng.integers(0, 1 << 32, (self.samples, 1), dtype=np.uint32)
        self.salt = rng.integers(1, 1 << 63, self.samples, dtype=np.uint64)
        self.turn = rng.integers(1, 1 << 63, (bands, ROWS), dtype=np.uint64) | np.uint64(1)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(self.samples, 0xFFFFFFFF, np.uint32)
        with np.errstate(over="ignore"):
            for low in range(0, len(short), 2048):
                part = self.times * short[None, low : low + 2048] + self.plus
                np.minimum(out, part.min(axis=1), out=out)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            banded = minima[: self.bands * ROWS].reshape(self.bands, ROWS).astype(np.uint64)
            return words.mix((banded * self.turn).sum(axis=1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64)).view(np.int64)

    def sketch(self, minima: np.ndarray) -> bytes:
        with np.errstate(over="ignore"):
            bit = words.mix(minima.astype(np.uint64) + self.salt) % np.uint64(SKETCH_BITS)
        odd = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of a column; A-Z count as a-z."""
    for group in words.groups(texts, words.SPACED, fold=True):
        for row, low, high in group.slices():
            yield row, words.shingle_set(group.hashes[low:high], k)


# ---- searches within a block -------------------------------------------------------------


def stars(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, np.ndarray]]:
    """(first, others) of every connected group of 0 .. n-1.

    `near(u, rest)` says which of `rest` are linked to u.
    """
    out, open_nodes = [], np.arange(n)
    while len(open_nodes) > 1:
        root, rest = int(open_nodes[0]), open_nodes[1:]
        waiting, reached = [root], []
        while waiting and len(rest):
            hit = near(waiting.pop(), rest)
            if hit.any():
                new = rest[hit]
                rest = rest[~hit]
                reached.append(new)
                waiting.extend(new.tolist())
        if reached:
            out.append((root, np.concatenate(reached)))
        open_nodes = rest
    return out


def _sketch_near(sketches: np.ndarray, sizes: np.ndarray, limit: float, similarity: float):
    def near(u: int, rest: np.ndarray) -> np.ndarray:
        differ = np.bitwise_count(sketches[rest] ^ sketches[u]).sum(axis=1, dtype=np.int64)
        small, large = np.minimum(sizes[rest], sizes[u]), np.maximum(sizes[rest], sizes[u])
        return (differ <= limit) & (small >= similarity * large - 1e-9)

    return near


def _exact_near(sets: list[np.ndarray], sizes: np.ndarray, looks: Callable, percent: int):
    def near(u: int, rest: np.ndarray) -> np.ndarray:
        out = looks(u, rest)
        tried = np.flatnonzero(out)
        mine = sets[u]
        for low in range(0, len(tried), 256):
            some = tried[low : low + 256]
            theirs = [sets[i] for i in rest[some]]
            flat = np.concatenate(theirs)
            at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
            ends = np.cumsum([len(x) for x in theirs])
            both = np.diff(np.concatenate(([0], np.cumsum(mine[at] == flat)))[np.concatenate(([0], ends))])
            union = len(mine) + sizes[rest[some]] - both
            out[some] = 100 * both >= percent * union
        return out

    return near


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of equal leading key columns, which come one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[low] for c in columns)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


EDGES = "a long, b long"


def _edge_batches(found: Iterator[tuple[np.ndarray, list]]) -> Iterator[pa.RecordBatch]:
    """Stars as edges (centre, other), a few thousand rows at a time."""
    a, b, n = [], [], 0
    for nodes, groups in found:
        for root, others in groups:
            a.append(np.full(len(others), nodes[root]))
            b.append(nodes[others])
            n += len(others)
        if n > 50_000:
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})
            a, b, n = [], [], 0
    if n:
        yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})


def _in_blocks(rows: DataFrame, key: str, blocks, *columns: str) -> DataFrame:
    """Rows dealt to the pairs of blocks of their group, sorted for `_runs`.

    A group within the bounds is one block. A larger one is cut by hash and its blocks meet
    two by two, so that every pair of its rows meets in some task of bounded size.
    """
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("_blocks")).cast("int")
    pairs = F.when(
        F.col("_blocks") == 1, F.array(F.lit(0).cast("long"))
    ).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("_blocks").cast("int") - 1), lambda j: j != F.col("_own")),
            lambda j: F.least(F.col("_own"), j).cast("long") * F.col("_blocks") + F.greatest(F.col("_own"), j),
        )
    )
    return (
        rows.withColumn("_blocks", blocks.cast("long")).withColumn("_own", own)
        .withColumn("_pair", F.explode(pairs))
        .select(F.col(key).alias("_key"), "_pair", *columns)
        .repartition("_key", "_pair")
        .sortWithinPartitions("_key", "_pair")
    )


# ---- connected components -----------------------------------------------------------------


#: Stars of so many edges, and more than one in STARS of all, have their centre broadcast: fewer than STARS of them.
STAR_ROWS, STARS = 500, 1000


def _joined(rows: DataFrame, least: DataFrame, edge: float) -> DataFrame:
    """`rows` with the `m` of their `a`; `least` is (a, m, n), and those of more than `edge` rows are broadcast."""
    stars = F.broadcast(least.filter(F.col("n") > edge).drop("n"))
    rest = least.filter(F.col("n") <= edge).drop("n")
    return rows.join(stars, "a").unionByName(rows.join(stars.select("a"), "a", "left_anti").join(rest, "a"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; the label is the smallest node of its class.

    Alternating large and small stars; each round is written to the shared folder. The
    number of rounds grows with the logarithm of the longest path.
    """
    edges = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, n_edges = None, edges.count()
    while True:
        # fewer than STARS centres have more rows than this
        edge = max(STAR_ROWS, 2 * n_edges / STARS)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = _joined(both.filter("b > a"), lowest, edge).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # every edge now leads to a smaller node: small star over the neighbours below
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = stage(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, n_edges = now, now[0]
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


# ---- the operator --------------------------------------------------------------------------


def row_key(id_col: str, text_col: str) -> Column:
    """Hash of the id and text of a row; joins on it check the id as well."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col).cast("long"), F.col(text_col))


def _same_id(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) == F.col(b), F.col(a).isNull() & F.col(b).isNull())


HEADS = "doc_id long, tkey long, n_shingles long, h1 long, h2 long, keys array<long>, sketch binary"


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: float = 0.8,
) -> DataFrame:
    """(doc_id, tkey, n_shingles, component_id, class) of every row.

    Words are runs of anything but space and 0x09-0x0D, A-Z count as a-z; a set holds the
    distinct windows of k words, or the whole sequence if it has fewer. Rows are linked if
    their sets have a Jaccard similarity of at least `similarity` (whole per cents), and
    classes are what links connect. `component_id` is the smallest doc_id of the class,
    `class` names the class itself. A NULL text, and one without words, is a class of its
    own, as `class` NULL. A NULL id is never the smallest; a class of NULL ids has
    component NULL. `tkey` is a hash of id and text, the same for rows that repeat. An empty table gives no row. Other columns are ignored.
    """
    percent = round(100 * similarity)
    bands = band_count(percent / 100)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("tkey"), F.col(text_col).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(bands)
        empty = np.zeros(bands, np.int64)
        for batch in words.pieces(batches):
            n, h1, h2, keys, sketches = [], [], [], [], []
            last, known = None, None
            for _, found in shingle_sets(batch.column("text"), k):
                n.append(len(found))
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                h1.append(int.from_bytes(digest[:8], "little", signed=True))
                h2.append(int.from_bytes(digest[8:], "little", signed=True))
                if not len(found):
                    keys.append(empty)
                    sketches.append(b"")
                    continue
                if digest != last:
                    minima = sampler.minima(found)
                    last, known = digest, (sampler.keys(minima), sampler.sketch(minima))
                keys.append(known[0])
                sketches.append(known[1])
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "tkey": batch.column("tkey"), "n_shingles": pa.array(n, pa.int64()),
                "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()),
                "keys": pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * bands, pa.int32()), pa.array(flat)),
                "sketch": pa.array(sketches, pa.binary()),
            })

    with files.small_batches(docs.sparkSession):
        heads = stage(texts.mapInArrow(describe, HEADS))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")
    nodes = stage(
        heads.filter("n_shingles > 0").groupBy("h1", "h2")
        .agg(F.min_by(F.struct("doc_id", "tkey", "n_shingles", "keys", "sketch"), order).alias("r"))
        .select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "r.*")
    )

    # candidates: nodes of band keys that occur twice; the sketch joins only those
    banded = nodes.select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members = banded.join(shared, "key").join(nodes.select("node", "n_shingles", "sketch"), "node")
    dealt = _in_blocks(members, "key", F.ceil(F.col("members") / BLOCK_NODES), "node", "n_shingles", "sketch")
    limit = sketch_limit(percent / 100, Sampler(bands).samples)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for run in _runs(batches, 2):
                ids, sizes = run.column("node").to_numpy(), run.column("n_shingles").to_numpy()
                raw = b"".join(run.column("sketch").to_pylist())
                sketches = np.frombuffer(raw, np.uint64).reshape(len(ids), -1)
                yield ids, stars(len(ids), _sketch_near(sketches, sizes, limit, percent / 100))

        yield from _edge_batches(found())

    clusters = components(dealt.mapInArrow(look, EDGES).distinct())
    clusters = stage(clusters)

    # exact sets of clustered nodes only; a text is found by the id and hash of its row
    sizes = (
        clusters.join(nodes.select("node", "n_shingles"), "node").groupBy("label")
        .agg(F.count("*").alias("members"), F.sum("n_shingles").alias("total"))
    )
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_NODES, F.col("total") * 8 / BLOCK_BYTES))
    wanted = (
        clusters.join(nodes.select("node", "n_shingles", "sketch", F.col("doc_id").alias("_id"), F.col("tkey").alias("_tkey")), "node")
        .join(sizes.select("label", blocks.alias("_n_blocks")), "label")
    )
    met = texts.join(wanted, (F.col("tkey") == F.col("_tkey")) & _same_id("doc_id", "_id")).select(
        "node", "label", "_n_blocks", "n_shingles", "sketch", "text"
    )

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.pieces(batches):
            sets = [x.tobytes() for _, x in shingle_sets(batch.column("text"), k)]
            rows = batch.select(["node", "label", "_n_blocks", "n_shingles", "sketch"])
            yield rows.append_column("shingles", pa.array(sets, pa.binary()))

    with_sets = met.mapInArrow(
        full_sets, "node long, label long, _n_blocks long, n_shingles long, sketch binary, shingles binary"
    )
    dealt = _in_blocks(with_sets, "label", F.col("_n_blocks"), "node", "n_shingles", "sketch", "shingles")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for run in _runs(batches, 2):
                ids, n = run.column("node").to_numpy(), run.column("n_shingles").to_numpy()
                ids, first = np.unique(ids, return_index=True)  # rows that repeat
                n = n[first]
                run = run.take(pa.array(first))
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in run.column("shingles")]
                sketches = np.frombuffer(b"".join(run.column("sketch").to_pylist()), np.uint64).reshape(len(ids), -1)
                looks = _sketch_near(sketches, n, limit, percent / 100)
                yield ids, stars(len(ids), _exact_near(sets, n, looks, percent))

        yield from _edge_batches(found())

    labels = components(dealt.mapInArrow(verify, EDGES))
    classed = nodes.select("node", "h1", "h2", "doc_id").join(labels, "node", "left").select(
        "h1", "h2", "doc_id", F.coalesce("label", "node").alias("class")
    )
    classed = stage(classed)
    smallest = classed.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    # rows of one set may be many: the join is on a hash, and skewed keys are split
    named = classed.join(smallest, "class").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "class", "component_id")
    out = heads.drop("keys", "sketch").join(
        named, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left"
    )
    return out.select(
        "doc_id", "tkey", "n_shingles", "class",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: float = 0.8) -> DataFrame:
    """`docs` with one row of each class: that with the smallest id, or of a class of NULL
    ids that with the smallest hash. Rows without words all stay, apart from rows
    that repeat id and text, of which one stays. Columns are those of `docs`.
    """
    classes = near_duplicates(docs, id_col, text_col, k, similarity)
    picked = classes.groupBy(F.coalesce(F.col("class"), F.lit(-1)).alias("_class"), F.when(F.col("class").isNull(), F.struct("doc_id", "tkey")).alias("_own")).agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tkey"))).alias("r")
    )
    picked = picked.select(F.col("r.doc_id").alias("_nd_id"), F.col("r.tkey").alias("_nd_key"))
    keyed = docs.withColumn("_nd_tkey", row_key(id_col, text_col)).withColumn("_nd_own", F.col(id_col).cast("long"))
    met = keyed.join(picked, (F.col("_nd_tkey") == F.col("_nd_key")) & _same_id("_nd_own", "_nd_id"))
    same = Window.partitionBy("_nd_tkey", "_nd_own").orderBy("_nd_tkey")  # the join's partitioning
    return met.withColumn("_nd_n", F.row_number().over(same)).filter("_nd_n = 1").select(*docs.columns)
