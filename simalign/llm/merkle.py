"""A Merkle manifest of a table: one tree per group of rows, one root over all groups.

A row is a leaf, the SHA-256 of its encoded columns. In every group the leaves ascend by an
order column; as long as several nodes remain, every `fanout` consecutive ones become their
parent, the hash of their hex digests. The roots of the groups, in the order of the groups,
become the root of the table in the same way. The proof of a leaf holds, level by level, its
place in its run and the digests of the others of the run.

The leaves are cut into aligned blocks of fanout ** `LEVELS` consecutive ones, complete
subtrees that one task holds. Block roots then go up by a butterfly exchange. In a round the
blocks below `fanout` sibling nodes swap their subtree roots: a block meets those of its own
place below the other siblings, and each of them hashes the common parent itself. So every
block knows its ancestor of each level, and all siblings beside it, when the last round ends,
and nothing has to be handed down. Where siblings are of unequal width, the blocks of a
narrow one serve several places in turn. The rounds above the group roots go the same way,
with all blocks of `fanout` neighbouring groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simalign.operators.rank import ordered_rank
from simalign.session import stage

FANOUT = 8
#: A block is a subtree of so many levels: 8 ** 4 = 4,096 leaves.
LEVELS = 4
#: Blocks of one group that meet one copy of the group's numbers.
CHUNK = 4096
STEP = "array<struct<place: int, others: array<string>>>"


def encoded(value: Column) -> Column:
    """`-` for NULL, else the UTF-8 bytes of the value in decimal, `:`, the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    """Digest of a row: SHA-256 of its encoded values, as lower-case hex."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def up(node: Column, step: Column) -> Column:
        before = F.slice(step["others"], F.lit(1), step["place"])
        after = F.slice(step["others"], step["place"] + 1, F.size(step["others"]))
        return F.sha2(F.concat(F.concat_ws("", before), node, F.concat_ws("", after)), 256)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.flatten(F.transform(proof, lambda s: s["others"]))), 256)


def levels_of(n: int, fanout: int) -> int:
    """Levels above n nodes."""
    return 0 if n <= 1 else 1 + levels_of(-(-n // fanout), fanout)


def manifest(
    rows: DataFrame, leaf_col: str, group_col: str = "lang", order_col: str = "doc_id",
    fanout: int = FANOUT, block_levels: int = LEVELS,
) -> DataFrame:
    """`rows` with subroot, root and proof, one row per row.

    Earlier columns of these names go, all others are kept and travel with their row, so leave
    texts out. The proof is an array of (place, others), the lowest level first; a leaf that
    is alone in its group, and the only group, have no level. Groups ascend bytewise, NULL
    first, and so do the leaves by `order_col`; rows of equal order ascend by their leaf, and
    rows that are equal in both are interchangeable. An empty table gives no row.
    """
    new = ["subroot", "root", "proof"]
    kept = [c for c in rows.columns if c not in new]
    placed, trees = _positions(rows.select(*kept), leaf_col, group_col, order_col)
    block_size = fanout**block_levels
    placed = placed.withColumn("_mk_block", F.floor(F.col("_mk_pos") / block_size))

    def local(df: DataFrame) -> DataFrame:
        """The levels inside a block, on every row of it; one sort serves all of them."""
        steps = []
        spans = [fanout ** (level + 1) for level in range(block_levels)]
        digits = [F.floor(F.col("_mk_pos") / span).alias(f"_mk_d{i}") for i, span in enumerate(spans)]
        df = df.select("*", *digits, F.col(leaf_col).alias("_mk_node"))
        key = ["_mk_tree", "_mk_block"]
        names = [f"_mk_d{i}" for i in range(block_levels)]
        df = df.repartition(*key).sortWithinPartitions(*key, *reversed(names), "_mk_pos")
        for level in range(block_levels):
            run = Window.partitionBy(*key, *reversed(names[level:]))
            below = F.floor(F.col("_mk_pos") / fanout**level)
            place = F.pmod(below, F.lit(fanout)).cast("int")
            nodes = F.sort_array(F.collect_set(F.struct(place.alias("p"), F.col("_mk_node").alias("h"))).over(run))
            df = df.withColumn("_mk_run", nodes)
            active = F.col("_mk_n") > fanout**level
            parent = F.sha2(F.concat_ws("", F.transform("_mk_run", lambda x: x["h"])), 256)
            step = F.when(active, F.array(F.struct(place.alias("place"), _others(place, "p").alias("others"))))
            df = df.withColumns({
                f"_mk_s{level}": F.coalesce(step, F.array().cast(STEP)),
                "_mk_node": F.when(active, parent).otherwise(F.col("_mk_node")),
            })
            steps.append(f"_mk_s{level}")
        return df.withColumn("_mk_low", F.concat(*steps)).drop("_mk_run", *steps, *names)

    first = F.pmod(F.col("_mk_pos"), F.lit(block_size)) == 0
    blocks = local(placed.select("_mk_tree", "_mk_n", "_mk_block", "_mk_pos", leaf_col)).filter(first)
    upper = stage(_butterfly(stage(blocks.select("_mk_tree", "_mk_n", "_mk_block", F.col("_mk_node").alias("node"))), trees, fanout, block_size))
    key = ["_mk_tree", "_mk_block"]
    return (
        local(placed).drop("_mk_node").join(upper, key)
        .select(*kept, "subroot", "root", F.concat("_mk_low", "_mk_high").alias("proof"))
    )


def _others(place: Column, field: str) -> Column:
    """Digests of a run without that at a place."""
    return F.transform(F.filter("_mk_run", lambda x: x[field] != place), lambda x: x["h"])


def _positions(rows: DataFrame, leaf_col: str, group_col: str, order_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with _mk_tree, _mk_pos and _mk_n, groups as (_mk_tree, _mk_n)).

    Positions count from 0 in each group, trees from 0 in the order of the groups. A range
    partitioning places the rows; a group begins anew in every partition, so no join here has
    a key with more rows than a partition.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a number tells equal rows apart; it is written first, so that every pass sees the same
    numbered = stage(rows.withColumn("_mk_row", F.xxhash64(F.monotonically_increasing_id())))
    order = [F.asc_nulls_first(group_col), F.asc_nulls_first(order_col), F.asc(leaf_col), F.asc("_mk_row")]
    placed = stage(
        numbered.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_mk_at", F.monotonically_increasing_id()).drop("_mk_row")
    )
    part = F.shiftright("_mk_at", 33).alias("_mk_part")
    pieces = placed.groupBy(part, F.col(group_col).alias("_mk_group")).agg(F.count("*").alias("_mk_k"), F.min("_mk_at").alias("_mk_first"))
    before = Window.partitionBy("_mk_group").orderBy("_mk_part")
    pieces = pieces.withColumn("_mk_shift", F.sum("_mk_k").over(before) - F.col("_mk_k") - F.col("_mk_first"))
    groups = pieces.groupBy("_mk_group").agg(F.sum("_mk_k").alias("_mk_n"))
    trees = ordered_rank(groups, F.asc_nulls_first("_mk_group"), out="_mk_tree").withColumn("_mk_tree", F.col("_mk_tree") - 1)
    named = pieces.join(trees.withColumnRenamed("_mk_group", "_mk_same"), F.col("_mk_group").eqNullSafe(F.col("_mk_same")))
    named = stage(named.select("_mk_part", "_mk_group", "_mk_tree", "_mk_n", "_mk_shift"))
    met = placed.withColumn("_mk_part", part).join(
        named.withColumnRenamed("_mk_part", "_mk_of"),
        (F.col("_mk_part") == F.col("_mk_of")) & F.col(group_col).eqNullSafe(F.col("_mk_group")),
    )
    out = met.withColumn("_mk_pos", F.col("_mk_at") + F.col("_mk_shift")).drop("_mk_at", "_mk_part", "_mk_of", "_mk_group", "_mk_shift")
    return out, trees.select("_mk_tree", "_mk_n")


def _exchange(members: DataFrame, key: list[str], number: int, active: Column) -> DataFrame:
    """One round: members of `fanout` sibling nodes swap the digests of their nodes.

    `key` names the sibling group. A member has `child`, the place of its node in the group,
    `seat`, its own place below that node, `width`, the members of that node, and `most`, the
    members of the widest sibling. It serves the seats seat, seat + width, ... and so meets one
    member of each sibling at its own. Members that are not active keep their node.
    """
    seats = F.sequence(F.col("seat"), F.when(active, F.col("most")).otherwise(F.col("seat") + 1) - 1, F.col("width"))
    alone = F.when(active, F.lit(-1).cast("long")).otherwise(F.col("_mk_block"))
    run = Window.partitionBy(*key, "_mk_alone", "_mk_to")
    met = (
        members.withColumn("_mk_alone", alone).withColumn("_mk_to", F.explode(seats))
        .withColumn("_mk_run", F.sort_array(F.collect_list(F.struct("child", F.col("node").alias("h"))).over(run)))
        .filter(F.col("_mk_to") == F.col("seat"))
    )
    parent = F.sha2(F.concat_ws("", F.transform("_mk_run", lambda x: x["h"])), 256)
    others = _others(F.col("child"), "child").alias("others")
    step = F.array(F.struct(F.col("child").cast("int").alias("place"), others))
    return met.withColumns({
        "steps": F.when(active, F.concat("steps", step)).otherwise(F.col("steps")),
        "node": F.when(active, parent).otherwise(F.col("node")),
    }).drop("_mk_alone", "_mk_to", "_mk_run")


def _butterfly(blocks: DataFrame, trees: DataFrame, fanout: int, block_size: int) -> DataFrame:
    """(_mk_tree, _mk_block, subroot, root, _mk_high): the ancestors and upper proof of every block."""
    trees = stage(trees)
    size = trees.agg(F.count("*").alias("trees"), F.max("_mk_n").alias("n")).first()
    block = F.col("_mk_block")
    members = blocks.withColumns({"steps": F.array().cast(STEP), "_mk_blocks": F.ceil(F.col("_mk_n") / block_size)})
    own = levels_of(-(-(size["n"] or 0) // block_size), fanout)
    for r in range(own):
        span, low = fanout**r, F.floor(block / fanout ** (r + 1)) * fanout
        node = F.floor(block / span)

        def width(of: Column, span: int = span) -> Column:
            return F.least(F.lit(span).cast("long"), F.col("_mk_blocks") - of * span)

        # seen from the first sibling, none is wider
        members = members.withColumns({
            "_mk_over": F.floor(block / fanout ** (r + 1)), "child": F.pmod(node, F.lit(fanout)), "seat": F.pmod(block, F.lit(span)),
            "width": width(node), "most": width(low),
        })
        members = _exchange(members, ["_mk_tree", "_mk_over"], r, F.col("_mk_blocks") > span)
    members = members.withColumn("subroot", F.col("node"))

    rounds = levels_of(size["trees"], fanout)
    if rounds:
        shape = _upper_shape(trees, rounds, fanout, block_size)
        # a group of very many blocks meets several copies of its numbers
        copies = shape.withColumn("_mk_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_mk_blocks") - 1) / CHUNK))))
        members = members.withColumn("_mk_chunk", F.floor(block / CHUNK)).join(copies.drop("_mk_blocks"), ["_mk_tree", "_mk_chunk"])
        for r in range(rounds):
            at = F.col("_mk_shape")[r]
            members = members.withColumns({
                "_mk_over": F.floor(F.col("_mk_tree") / fanout ** (r + 1)), "child": at["child"],
                "seat": at["shift"] + block, "width": at["width"], "most": at["most"],
            })
            members = _exchange(members, ["_mk_over"], own + r, F.lit(True))
    return members.select("_mk_tree", "_mk_block", "subroot", F.col("node").alias("root"), F.col("steps").alias("_mk_high"))


def _upper_shape(trees: DataFrame, rounds: int, fanout: int, block_size: int) -> DataFrame:
    """(_mk_tree, _mk_blocks, _mk_shape): per round above the group roots the place of a group's
    node among its siblings, the blocks below that node and below the widest sibling, and how
    many of the node's blocks come before those of the group. One row per group."""
    shape = trees.withColumn("_mk_blocks", F.ceil(F.col("_mk_n") / block_size).cast("long")).drop("_mk_n")
    nodes = shape.select(F.col("_mk_tree").alias("_mk_node"), F.col("_mk_blocks").alias("_mk_width"))
    shift, made = F.lit(0).cast("long"), []
    for r in range(rounds):
        siblings = Window.partitionBy(F.floor(F.col("_mk_node") / fanout))  # at most `fanout` rows
        nodes = stage(nodes.withColumns({
            "_mk_most": F.max("_mk_width").over(siblings),
            "_mk_before": F.sum("_mk_width").over(siblings.orderBy("_mk_node")) - F.col("_mk_width"),
        }))
        # few nodes to many groups, or many nodes to few groups each: their staged size decides
        named = nodes.select(
            F.col("_mk_node").alias(f"_mk_i{r}"), F.col("_mk_width").alias(f"_mk_w{r}"),
            F.col("_mk_most").alias(f"_mk_m{r}"), F.col("_mk_before").alias(f"_mk_b{r}"),
        )
        shape = shape.withColumn(f"_mk_i{r}", F.floor(F.col("_mk_tree") / fanout**r)).join(named, f"_mk_i{r}")
        made.append(F.struct(
            F.pmod(F.col(f"_mk_i{r}"), F.lit(fanout)).alias("child"), F.col(f"_mk_w{r}").alias("width"),
            F.col(f"_mk_m{r}").alias("most"), shift.alias("shift"),
        ))
        shift = shift + F.col(f"_mk_b{r}")
        nodes = nodes.groupBy(F.floor(F.col("_mk_node") / fanout).alias("_mk_node")).agg(F.sum("_mk_width").alias("_mk_width"))
    return shape.select("_mk_tree", "_mk_blocks", F.array(*made).alias("_mk_shape"))
