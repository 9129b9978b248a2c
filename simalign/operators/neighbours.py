"""Exact k nearest training documents under Jaccard distance, block by block.

Input "sets" have columns (fold INT, doc_id LONG, label INT, terms ARRAY<STRING>), terms
distinct. `nearest` compares a test set with the training sets of its own fold number;
`nearest_elsewhere` searches one table in itself, each set among those of all other folds.
Test terms the training side does not hold are dropped before the distance, as a vectoriser
fitted on the training side would drop them.

There is one way, at every size:

1.  Terms get whole-number ids, sets list them most frequent first. Equal training sets collapse into one
    group that remembers its k smallest members (of each fold); the rest can never be in a top k.
2.  Groups are ordered by their leading terms and size and cut into blocks. A test set first meets
    the block it would itself lie in, which gives it a k-th best distance. Then test sets are dealt
    evenly to tasks, which read all blocks one after the other (see `operators/blocks.py`) and leave out
    what cannot come below the best so far (see `functions/setsearch.py`). A set moves twice, whatever
    the number of blocks; no pair of documents and no term is a key of a shuffle here.
3.  A task returns the k nearest members per test set, ranked by (distance, train_id).

Pairs without a shared term take part at distance 1 (two empty sets at 0), so every test
set gets k neighbours if its fold has them. A search among other folds is one search: a training
document is there once, with the folds it must not serve, and a term once, with the folds whose
training side knows it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simalign.functions import setsearch
from simalign.operators import blocks
from simalign.operators.rank import ordered_rank
from simalign.session import stage

# Training groups and test sets of one task. They bound its memory, never the result.
GROUP_BLOCK = 4096
TEST_BLOCK = 4096
# Test sets that are worth a task of their own where cores would be idle.
LEAST_TESTS = 256


def term_rows(sets: DataFrame, *keys: str) -> DataFrame:
    """(fold, keys, term), one row per element of a set."""
    # outer: an inner explode would evaluate the terms a second time to filter empty sets
    rows = sets.select("fold", *keys, F.explode_outer("terms").alias("term"))
    return rows.filter(F.col("term").isNotNull())


def _numbered(terms: DataFrame) -> DataFrame:
    return stage(terms.withColumn("term_id", F.monotonically_increasing_id()))


def vocabulary(train: DataFrame, keep: DataFrame | None = None, of_train: bool = False) -> DataFrame:
    """(fold, term, df, mask, term_id) of the training side; `keep` (fold, term) limits it.

    `of_train`: `keep` holds terms of the training side only, with their df.
    """
    if keep is not None and of_train:
        known = keep.select("fold", "term", "df")
    else:
        known = term_rows(train).groupBy("fold", "term").agg(F.count("*").alias("df"))
        if keep is not None:
            known = known.join(keep.select("fold", "term"), ["fold", "term"], "left_semi")
    return _numbered(known.withColumn("mask", F.lit(1).cast("long")))


def vocabulary_elsewhere(sets: DataFrame, folds: int, keep: DataFrame | None = None) -> DataFrame:
    """The same for a search among other folds, all in fold 0: bit f of `mask` says that the
    sets outside of fold f know the term. `keep` (fold, term, df) names those terms itself."""
    if keep is not None:
        known = keep.groupBy("term").agg(F.max("df").alias("df"), F.bit_or(F.expr("shiftleft(1L, fold)")).alias("mask"))
    else:
        counts = term_rows(sets).groupBy("term").agg(
            F.count("*").alias("df"), F.min("fold").alias("_lo"), F.max("fold").alias("_hi")
        )
        every = (1 << folds) - 1
        single = F.expr(f"shiftleft(1L, _lo) ^ {every}L")  # what one fold alone holds is unknown to its training side
        known = counts.withColumn("mask", F.when(F.col("_lo") < F.col("_hi"), F.lit(every).cast("long")).otherwise(single))
    return _numbered(known.filter("mask <> 0").select(F.lit(0).alias("fold"), "term", "df", "mask"))


def encode_sets(sets: DataFrame, terms: DataFrame, *also: str, folds: int = 0, by: tuple[str, ...] = ()) -> DataFrame:
    """(fold, own, doc_id, label, by, ids, asked, sizes, also): sets as arrays of term ids, most frequent first.

    `asked` is what the set looks for and `sizes` the number of its terms for every fold that
    may ask for it: with `folds`, terms count for a fold only by their mask. Terms outside the
    vocabulary are dropped. An empty set keeps its row through a place-holder no vocabulary holds; it
    differs by document, so that many empty documents do not meet in one task.
    """
    holder = F.array(F.concat(F.lit(" "), F.col("doc_id").cast("string")))
    content = F.when(F.size("terms") > 0, F.col("terms")).otherwise(holder)
    space, own = (F.lit(0), F.col("fold")) if folds else (F.col("fold"), F.lit(-1))
    key = ["fold", "own", "doc_id", "label", *by]
    rows = sets.select(space.alias("fold"), own.alias("own"), *key[2:], F.explode_outer(content).alias("term"))
    entry = F.when(F.col("term_id").isNotNull(), F.struct((-F.col("df")).alias("d"), "term_id", "mask"))
    entries = rows.join(terms, ["fold", "term"], "left").select(*key, entry.alias("_entry"))
    if also:
        # once for every document, not with each of its terms
        beside = sets.select(space.alias("fold"), own.alias("own"), *key[2:], *also)
        entries = entries.unionByName(beside, allowMissingColumns=True)
    gathered = entries.groupBy(*key).agg(
        F.sort_array(F.collect_list("_entry")).alias("_t"), *[F.any_value(c, True).alias(c) for c in also]
    )

    def known_to(bit: Column) -> Column:
        return F.filter("_t", lambda x: F.getbit(x["mask"], bit) == 1)

    if folds:
        asked = F.transform(known_to(F.col("own")), lambda x: x["term_id"])
        sizes = F.array(*[F.size(known_to(F.lit(f))) for f in range(folds)])
    else:
        asked, sizes = F.col("ids"), F.array(F.size("ids"))
    listed = gathered.withColumn("ids", F.transform("_t", lambda x: x["term_id"]))
    return listed.select(*key, "ids", asked.alias("asked"), sizes.alias("sizes"), *also)


def collapse(encoded: DataFrame, k: int, *also: str, counted: bool = False) -> DataFrame:
    """One row per distinct (set, also): (fold, gid, ids, sizes, also, members), gid the smallest member.

    `members` holds the k smallest documents of every fold as (train_id, label, own). `counted`
    adds `n`, the number of all its documents by fold as (own, n). Rows are grouped by a 128-bit digest of the set, which
    alone is compared and sorted. The rank filter keeps k rows per set and fold before the
    shuffle, however many copies there are.
    """
    digest = F.md5(F.to_json(F.struct("ids", *also)))
    keyed = encoded.withColumn("_set", digest)
    same = ["fold", "_set", "own"]
    smallest = _top(keyed, same, [F.col("doc_id")], k, "_rn")
    member = F.struct(F.col("doc_id").alias("train_id"), "label", "own")
    values = [F.min_by(c, "doc_id").alias(c) for c in ("ids", "sizes", *also)]
    groups = smallest.groupBy("fold", "_set").agg(
        F.min("doc_id").alias("gid"), F.sort_array(F.collect_list(member)).alias("members"), *values
    )
    if not counted:
        return groups.drop("_set")
    counts = keyed.groupBy(*same).agg(F.count("*").alias("n")).groupBy("fold", "_set").agg(
        F.sort_array(F.collect_list(F.struct("own", "n"))).alias("n")
    )
    return groups.join(counts, ["fold", "_set"]).drop("_set")


def _top(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(out) <= k)


def queries_of(encoded: DataFrame, *also: str) -> DataFrame:
    """(fold, own, test_id, test_label, asked, also) of the sets that look for neighbours.

    Without folds they are of own fold 0, which no training document is of.
    """
    return encoded.select("fold", F.greatest("own", F.lit(0)).alias("own"), F.col("doc_id").alias("test_id"), F.col("label").alias("test_label"), "asked", *also)


def nearest(
    train: DataFrame, test: DataFrame, k: int, keep: DataFrame | None = None, of_train: bool = False
) -> DataFrame:
    """(fold, test_id, test_label, train_id, label, dist, rank): the k nearest per test set."""
    columns = ["fold", "doc_id", "label", "terms"]
    sides = train.select(*columns, F.lit(False).alias("is_test")).unionByName(test.select(*columns, F.lit(True).alias("is_test")))
    encoded = stage(encode_sets(sides, vocabulary(train, keep, of_train), by=("is_test",)))
    groups = stage(collapse(encoded.filter(~F.col("is_test")), k))
    return search(groups, queries_of(encoded.filter("is_test")), k).drop("own")


def nearest_elsewhere(sets: DataFrame, k: int, folds: int, keep: DataFrame | None = None) -> DataFrame:
    """The same for every set among the sets of the other folds, in one search."""
    terms = vocabulary_elsewhere(sets, folds, keep)
    encoded = stage(encode_sets(sets, terms, folds=folds))
    groups = stage(collapse(encoded, k))
    return search(groups, queries_of(encoded), k).drop("fold").withColumnRenamed("own", "fold")


def search(groups: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(fold, own, test_id, test_label, train_id, label, dist, rank) from collapsed groups and queries, both staged."""
    counted = groups.groupBy("fold").agg(F.count("*").alias("n")).orderBy("fold").collect()  # one row per fold
    n_blocks = sum(-(-r["n"] // GROUP_BLOCK) for r in counted)
    if max((r["n"] for r in counted), default=0) <= GROUP_BLOCK:
        lists = _at_home(groups.withColumn("g_block", F.lit(0)), queries.withColumn("g_block", F.lit(0)), n_blocks, LIST, _lists_of(k))
    else:
        placed = _in_blocks(groups, counted)
        asked = queries.join(F.broadcast(_heads(placed)), "fold")
        lead = F.struct(F.slice("asked", 1, 4).alias("_lead"), F.size("asked").alias("_size"))
        home = F.greatest(F.size(F.filter("_starts", lambda s: s <= lead)) - 1, F.lit(0))
        homed = stage(_at_home(placed, asked.withColumn("g_block", home), n_blocks, HOMED, _limits_of(k)))
        packed = blocks.group_blocks(placed.select(
            "fold", "g_block", "ids", "sizes", F.col("members.train_id").alias("member_ids"), F.col("members.label").alias("labels"),
            F.col("members.own").alias("owns"),
        ), GROUP_BLOCK)
        # what a task has found stays below some 4 million rows
        most = max(TEST_BLOCK, min(8 * TEST_BLOCK, (1 << 22) // k))
        lists = blocks.beside(
            packed, homed, ["fold", F.xxhash64("id"), "id"], TEST_BLOCK, most, LEAST_TESTS, LIST, lambda tests: Found(tests, k), Found.meet, Found.lists,
        )
    return _top(lists, ["fold", "own", "test_id"], [F.col("dist"), F.col("train_id")], k)


def _in_blocks(groups: DataFrame, counted: list) -> DataFrame:
    """Groups of every fold in the order of their leading terms and size, GROUP_BLOCK to a block."""
    placed = ordered_rank(
        groups.withColumns({"_lead": F.slice("ids", 1, 4), "_size": F.size("ids")}), "fold", "_lead", "_size", "gid", out="_rn"
    )
    firsts, before = [], 0
    for r in counted:
        firsts.append((r["fold"], before))
        before += r["n"]
    starts = groups.sparkSession.createDataFrame(firsts, "fold int, _before long")  # one row per fold
    block = F.floor((F.col("_rn") - 1 - F.col("_before")) / GROUP_BLOCK).cast("int")
    return stage(placed.join(F.broadcast(starts), "fold").withColumn("g_block", block).drop("_rn", "_before"))


def _heads(placed: DataFrame) -> DataFrame:
    """(fold, _starts): where every block begins, an entry for GROUP_BLOCK groups."""
    ends = placed.groupBy("fold", "g_block").agg(F.min(F.struct("_lead", "_size")).alias("start"))
    rows = ends.groupBy("fold").agg(F.sort_array(F.collect_list(F.struct("g_block", "start"))).alias("_h"))
    return rows.select("fold", F.transform("_h", lambda h: h["start"]).alias("_starts"))


def tasks_by_block(asked: DataFrame, blocks: int) -> DataFrame:
    """(fold, g_block, _tasks): into how many tasks the test sets that ask for a block are cut."""
    idle = -(-asked.sparkSession.sparkContext.defaultParallelism // max(1, blocks))
    n = F.count("*")
    tasks = F.greatest(F.ceil(n / TEST_BLOCK), F.least(F.ceil(n / LEAST_TESTS), F.lit(idle)), F.lit(1))
    return asked.groupBy("fold", "g_block").agg(tasks.cast("int").alias("_tasks"))


LIST = "fold int, own int, test_id long, test_label int, train_id long, label int, dist double"
HOMED = "fold int, g_block int, id long, test_label int, own int, ids array<bigint>, limit double"


def _at_home(groups: DataFrame, asked: DataFrame, n_blocks: int, schema: str, work: Callable) -> DataFrame:
    """What `work` makes of the tests and the groups of the one block that each row of `asked` names."""
    counts = tasks_by_block(asked, n_blocks)
    # one row per block
    left = groups.join(F.broadcast(counts), ["fold", "g_block"]).select(
        "fold", "g_block", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1)).alias("task"), F.lit(0).alias("side"),
        F.col("gid").alias("id"), F.lit(None).cast("int").alias("test_label"), F.lit(None).cast("int").alias("own"), "ids", "sizes",
        F.col("members.train_id").alias("member_ids"), F.col("members.label").alias("labels"), F.col("members.own").alias("owns"),
    )
    right = asked.join(F.broadcast(counts), ["fold", "g_block"]).select(
        "fold", "g_block", F.pmod(F.hash("test_id"), F.col("_tasks")).alias("task"), F.lit(1).alias("side"),
        F.col("test_id").alias("id"), "test_label", "own", F.col("asked").alias("ids"), F.lit(None).cast("array<int>").alias("sizes"),
        F.lit(None).cast("array<bigint>").alias("member_ids"), F.lit(None).cast("array<int>").alias("labels"),
        F.lit(None).cast("array<int>").alias("owns"),
    )
    key = ["fold", "g_block", "task"]
    met = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "side", "id")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in blocks.runs(batches, len(key)):
            at = int(np.searchsorted(run.column("side").to_numpy(), 1))
            if 0 < at < run.num_rows:
                yield from work(run.slice(0, at), run.slice(at))

    return met.mapInArrow(find, schema)


def _met(groups: pa.Table, tests: pa.Table, k: int, most: int) -> list[Found]:
    """The tests, cut by their terms, after they met the groups, which are shown in parts of bounded size too."""
    founds = [Found(part, k) for part in blocks.lighter(tests, most)]
    for part in blocks.lighter(groups, most):
        made = None
        for found in founds:
            made = found.meet(part, made)
    for found in founds:
        found.best.merged(found.limit)
    return founds


def _lists_of(k: int) -> Callable:
    most = blocks.ELEMENTS

    def work(groups: pa.Table, tests: pa.Table) -> Iterator[pa.RecordBatch]:
        for found in _met(groups, tests, k, most):
            yield from found.lists()

    return work


def _limits_of(k: int) -> Callable:
    """The tests themselves, with the k-th best distance in their block where they have as many."""
    most = blocks.ELEMENTS

    def work(groups: pa.Table, tests: pa.Table) -> Iterator[pa.RecordBatch]:
        for part, found in zip(blocks.lighter(tests, most), _met(groups, tests, k, most), strict=True):
            kept = part.select(["fold", "g_block", "id", "test_label", "own", "ids"]).take(pa.array(found.order))
            limit = pa.array(found.limit, mask=np.isinf(found.limit))
            yield from kept.append_column("limit", limit).combine_chunks().to_batches()

    return work


class Members:
    """Documents of the groups of one task: ids, labels and folds, as lists by group."""

    def __init__(self, groups: pa.Table):
        self.ids, self.bounds = setsearch.lists(groups.column("member_ids"))
        self.labels = flat(groups.column("labels")).flatten()
        self.owns = setsearch.lists(groups.column("owns"))[0]

    def smallest(self, own: int) -> np.ndarray:
        """The smallest member of every group that is not of fold `own`."""
        return np.minimum.reduceat(np.where(self.owns != own, self.ids, setsearch.NOBODY), self.bounds[:-1])

    def all(self, asked: np.ndarray, groups: np.ndarray, far: np.ndarray, own: np.ndarray):
        """(asked, member, distance): all members, own folds refused."""
        places, cut = setsearch.take_lists(np.arange(len(self.ids)), self.bounds, groups)
        sizes = np.diff(cut)
        asked, far, own = np.repeat(asked, sizes), np.repeat(far, sizes), np.repeat(own, sizes)
        ok = self.owns[places] != own
        return asked[ok], places[ok], far[ok]

    def first(self, asked: np.ndarray, groups: np.ndarray, far: np.ndarray, own: np.ndarray, k: int):
        """The same for the k nearest members by (distance, id)."""
        asked, places, far = self.all(asked, groups, far, own)
        best = setsearch.first_of(asked, far, self.ids[places], k)
        return asked[best], places[best], far[best]


class Searched:
    """Training groups of one block, ready to be asked."""

    def __init__(self, groups: pa.Table):
        values, bounds = setsearch.lists(groups.column("ids"))
        sizes = setsearch.lists(groups.column("sizes"))[0].reshape(groups.num_rows, -1).T
        self.low, self.high = int(sizes.min()), int(sizes.max())
        self.table, self.values, self.bounds, self.sizes = groups, values, bounds, sizes
        self.repeats, self.indexes, self.members = setsearch.repeats(values, bounds), {}, None

    def _index(self, wide: bool) -> setsearch.Index:
        if wide not in self.indexes:
            shape = (setsearch.BLOCK * setsearch.WIDER_BLOCK, setsearch.HEAD * setsearch.WIDER_HEAD) if wide else ()
            made = self.indexes[wide] = setsearch.Index.of(self.values, self.bounds, self.sizes, *shape)
            if self.members is None:
                self.members = Members(self.table)
                self.smallest = np.array([self.members.smallest(f) for f in range(len(self.sizes))])[:, made.order]
        return self.indexes[wide]

    def nearest(self, asked: np.ndarray, cut: np.ndarray, own: np.ndarray, limit: np.ndarray, k: int):
        """(asked set, member, distance) of the k nearest members that are not beyond `limit`."""
        index = self._index(not (self.repeats or setsearch.repeats(asked, cut)))
        who, found, far = setsearch.nearest(index, self.smallest, asked, cut, np.maximum(own, 0), k, limit)
        return self.members.first(who, index.order[found], far, own[who], k)


#: Stands for a label that is missing.
NO_LABEL = np.iinfo(np.int64).min


class Found:
    """Test sets of one block and the k nearest members of all groups they have met."""

    def __init__(self, tests: pa.Table, k: int):
        self.k = k
        asked, cut = setsearch.lists(tests.column("ids"))
        self.order = setsearch.by_leading_terms(asked, cut)
        self.asked, self.cut = setsearch.take_lists(asked, cut, self.order)
        self.tests = tests.select(["fold", "id", "test_label"]).take(pa.array(self.order))
        self.own = tests.column("own").to_numpy()[self.order]
        self.limit = np.full(tests.num_rows, np.inf)
        if "limit" in tests.column_names:
            given = tests.column("limit").to_numpy().astype(float)[self.order]
            self.limit = np.where(np.isnan(given), np.inf, given)
        self.best = setsearch.Best([np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)], 3, 1, k)

    def meet(self, groups: pa.Table | pa.BinaryScalar, made: Searched | None = None) -> Searched:
        if made is None:
            made = Searched(groups if isinstance(groups, pa.Table) else blocks.unpacked(groups))
        a = np.diff(self.cut)
        # no set of a block is nearer than one that holds, or is held by, the whole test set
        some = np.flatnonzero(setsearch.least_distance(a, a, made.low, made.high) <= self.limit)
        if not len(some):
            return made
        asked, cut = (self.asked, self.cut) if len(some) == len(a) else setsearch.take_lists(self.asked, self.cut, some)
        who, places, far = made.nearest(asked, cut, self.own[some], self.limit[some], self.k)
        labels = made.members.labels.take(pa.array(places)).cast(pa.int64()).fill_null(NO_LABEL).to_numpy()
        new = [some[who], made.members.ids[places], labels, far]
        self.best.add(new, self.limit)
        return made

    def lists(self) -> Iterator[pa.RecordBatch]:
        who, ids, labels, far = self.best.merged(self.limit)
        rows = pa.array(who)
        yield pa.RecordBatch.from_pydict({
            "fold": flat(self.tests.column("fold").take(rows)), "own": pa.array(self.own[who], pa.int32()),
            "test_id": flat(self.tests.column("id").take(rows)), "test_label": flat(self.tests.column("test_label").take(rows)),
            "train_id": pa.array(ids), "label": pa.array(labels, pa.int32(), mask=labels == NO_LABEL) if len(who) else pa.array([], pa.int32()),
            "dist": pa.array(far),
        })


def count_held(bits: DataFrame, *keys: str) -> DataFrame:
    """(keys, a): how many bits of `words` (64-bit words, alike within keys) any row of the keys has set."""
    nothing, zero = F.array().cast("array<bigint>"), F.lit(0).cast("bigint")
    every = F.aggregate(F.collect_list("words"), nothing, lambda s, w: F.zip_with(
        s, w, lambda x, y: F.coalesce(x, zero).bitwiseOR(F.coalesce(y, zero))
    ))
    size = F.aggregate("_w", F.lit(0), lambda s, w: s + F.bit_count(w))
    return bits.groupBy(*keys).agg(every.alias("_w")).select(*keys, size.alias("a"))


def flat(column) -> pa.Array:
    if not isinstance(column, pa.ChunkedArray):
        return column
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def rank_pairs(pairs: DataFrame, metric: Callable[[Column, Column], Column], k: int, *keys: str) -> DataFrame:
    """The k nearest of given pairs (keys, test_id, train_id, x, y) under any distance.

    `metric` builds a Column from the two array columns, so it runs inside Spark's own
    expressions. Pairs come from a candidate join; ties go to the smallest train_id.
    """
    scored = pairs.withColumn("dist", metric(F.col("x"), F.col("y")))
    return _top(scored, [*keys, "test_id"], [F.col("dist"), F.col("train_id")], k)
