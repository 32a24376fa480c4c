"""Conversation prefix trie: conversations that start alike share nodes, found by block digests.

The turns of a conversation are cut into blocks of fixed length.  A block's key mixes a digest of its
turns with the keys of all blocks before it, so conversations are grouped by successive block
keys first: (number, key before, key after) tells one child of one block node.  Where the
conversations below a block node all go on with the same block, its turns are nodes as they are.
Only where siblings diverge are the block's turn boundaries refined: the first 1, 2, ... turns of each
distinct sibling become keys of their own and are grouped again.

Sums over subtrees are taken in two steps: inside a block each node adds to its few ancestors
there, and over the families of sibling blocks ancestors are doubled, so the rounds grow with
the logarithm of the longest conversation.

Digests have 128 bits.  All groups are aggregated before they are shuffled, so a conversation that a
third of all are copies of counts once per task.  Positions in a conversation come from one global
sort by ranges, and keys of blocks from partial sums over stretches of blocks, so one conversation
with a third of all turns is dealt out too.  The list of members that end at a node is hashed
piece by piece in order and never held: pieces are joined per range of ids before they meet.

Cases: rows without conv_id belong to no conversation and are left out.  A null turn comes first;
equal turns of a conversation follow a digest of role and text.  Null roles and texts are empty.
Repeated rows are turns of their own.  Extra columns are ignored.  An empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslane.plans.durable import durable

BLOCK = 4
#: Blocks whose keys are mixed in one window; stretches of so many are mixed after that.
STRETCH = 4096
#: Bytes of a piece of a member list.
PIECE_BYTES = 1 << 16
#: Ids of the textless root, which are also the key before every first block.
ROOT = 0
_NODE = ["depth", "i1", "i2"]
_FAMILY = ["j", "u1", "u2"]


def _two(*parts: Column, name: str) -> list[Column]:
    """A 128-bit digest as two numbers."""
    return [F.xxhash64(F.lit(31 * k), *parts).alias(f"{name}{k}") for k in (1, 2)]


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text, d1, d2, n_bytes): turns with their positions, from 0, and digests."""
    role, text = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select("conv_id", "turn", role, text)
    rows = rows.select("*", *_two(F.col("role"), F.col("text"), name="d"), F.octet_length("text").cast("long").alias("n_bytes"))
    by = ["conv_id", "turn", "d1", "d2"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("turn")
    rows = durable(rows.withColumn("at", F.monotonically_increasing_id()))
    rows = rows.withColumn("part", F.shiftright("at", 33))
    parts = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(parts, ["conv_id", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def rebuild(turns: DataFrame, base: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with the first turns of another one.

    The first ``shared`` (at most ``most``) turns come from conversation ``base``, both given as
    expressions of conv_id; the own turns after the first ``shared`` follow.  Returns all
    (conv_id, n_turns) and the turns with their new positions.
    """
    kept = [c for c in turns.columns if c not in ("conv_id", "pos")]
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    plans = sizes.select("conv_id", "n", base.alias("base"), shared.cast("long").alias("h"))
    known = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plans = durable(
        plans.join(known, "base", "left").select(
            "conv_id", "base", "h", "n", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")
        )
    )
    own = turns.join(plans, "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), *kept)
    heads = turns.filter(F.col("pos") < most).withColumnRenamed("conv_id", "base")
    heads = heads.join(plans, "base").filter("pos < h").select("conv_id", "pos", *kept)
    members = plans.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    return members, own.union(heads)


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """(conv_id, j, turns, u1, u2, e1, e2): blocks with the keys before them and of their last node."""
    turn = F.struct("pos", "d1", "d2", "n_bytes")
    blocks = turns.groupBy("conv_id", F.floor(F.col("pos") / block).alias("j")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    full = F.size("turns") == block
    content = F.transform("turns", lambda t: F.struct(t["d1"], t["d2"]))
    blocks = blocks.select(
        "conv_id", "j", F.transform("turns", lambda t: F.struct(t["d1"].alias("d1"), t["d2"].alias("d2"), t["n_bytes"].alias("n_bytes"))).alias("turns"),
        full.alias("full"), *_two(F.col("j"), content, name="c"), F.floor(F.col("j") / STRETCH).alias("stretch"),
    )
    near = Window.partitionBy("conv_id", "stretch").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = blocks.groupBy("conv_id", "stretch").agg(*(F.bit_xor(f"c{k}").alias(f"s{k}") for k in (1, 2)))
    stretches = stretches.select("conv_id", "stretch", *(F.coalesce(F.bit_xor(f"s{k}").over(far), F.lit(0)).alias(f"s{k}") for k in (1, 2)))
    blocks = blocks.withColumns({f"u{k}": F.coalesce(F.bit_xor(f"c{k}").over(near), F.lit(0)) for k in (1, 2)})
    blocks = blocks.join(stretches, ["conv_id", "stretch"]).withColumns({f"u{k}": F.col(f"u{k}").bitwiseXOR(F.col(f"s{k}")) for k in (1, 2)})
    # A block's last node has the key after the block; an unfinished block is no key of a later one.
    ends = {f"e{k}": F.when(F.col("full"), F.col(f"u{k}").bitwiseXOR(F.col(f"c{k}"))).otherwise(_inner(k, F.col("turns"))) for k in (1, 2)}
    return blocks.withColumns(ends).select("conv_id", *_FAMILY, "turns", "e1", "e2")


def _inner(k: int, turns: Column) -> Column:
    """Id of a node inside a block: the key before the block and the turns so far."""
    return F.xxhash64(F.lit(31 * k + 7), F.col("u1"), F.col("u2"), F.transform(turns, lambda t: F.struct(t["d1"], t["d2"])))


def _turn_nodes(kinds: DataFrame, block: int) -> DataFrame:
    """Each distinct block as one row per turn: node id, parent id and the ids of its ancestors in the block."""
    r = F.sequence(F.lit(1), F.size("turns"))

    def node(n: Column) -> Column:
        last = n == block
        return F.struct(*(F.when(last, F.col(f"e{k}")).otherwise(_inner(k, F.slice("turns", F.lit(1), n))).alias(f"i{k}") for k in (1, 2)))

    rows = kinds.withColumn("path", F.transform(r, node))
    rows = rows.select(*_FAMILY, "kinds", "n_convs", "conv_id", "turns", "path", F.explode(r).alias("r"))
    own, up = F.col("path")[F.col("r") - 1], F.col("path")[F.greatest(F.col("r") - 2, F.lit(0))]
    first = F.col("r") == 1
    return rows.select(
        *_FAMILY, "kinds", "n_convs", "conv_id", "r",
        (F.col("j") * block + F.col("r")).alias("depth"), own["i1"].alias("i1"), own["i2"].alias("i2"),
        *(F.when(first, F.col(f"u{k}")).otherwise(up[f"i{k}"]).alias(f"p{k}") for k in (1, 2)),
        F.col("turns")[F.col("r") - 1]["n_bytes"].alias("n_bytes"), F.slice("path", F.lit(1), F.col("r")).alias("path"),
    )


def _below(families: DataFrame) -> DataFrame:
    """Sums (leaves, saved) of each family (j, u1, u2) and all below it; ``up`` is the family above."""
    state = durable(families)
    keys = [F.col(c) for c in _FAMILY]
    while not state.filter("up is not null").isEmpty():
        given = state.filter("up is not null").groupBy(*(F.col(f"up.{c}").alias(c) for c in _FAMILY))
        given = given.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = state.filter("up is not null").select(F.struct(*keys).alias("up"), F.col("up").alias("next"))
        state = durable(
            state.join(given, _FAMILY, "left").join(above, "up", "left").select(
                *_FAMILY,
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                F.col("next").alias("up"),
            )
        )
    return state.select(*_FAMILY, "leaves", "saved")


def _ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, i1, i2, ends_sha256) of nodes at which conversations end."""
    names = [*_NODE, "first", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size, out = None, [], 0, []
        for batch in batches:
            for *now, conv in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "conv_id")), strict=True):
                if ids and (now != node or size >= PIECE_BYTES):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                    if len(out) >= 1024:
                        yield _table(out, names, kinds)
                        out = []
                node = now
                ids.append(conv)
                size += len(str(conv)) + 1
        if ids:
            out.append((*node, ids[0], ",".join(map(str, ids))))
        if out:
            yield _table(out, names, kinds)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True):
                if now != node:
                    if state is not None:
                        out.append((*node, state.hexdigest()))
                    if len(out) >= 1024:
                        yield _table(out, [*_NODE, "ends_sha256"], [*kinds[:3], pa.string()])
                        out = []
                    node, state = now, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if state is not None:
            out.append((*node, state.hexdigest()))
        if out:
            yield _table(out, [*_NODE, "ends_sha256"], [*kinds[:3], pa.string()])

    schema = "depth long, i1 long, i2 long"
    dealt = ends.select(*_NODE, "conv_id").repartitionByRange("conv_id").sortWithinPartitions(*_NODE, "conv_id")
    found = dealt.mapInArrow(pieces, f"{schema}, first long, ids string")
    return found.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(digests, f"{schema}, ends_sha256 string")


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def trie(members: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node, the root included.

    ``members`` has (conv_id, n_turns) of all conversations, turnless ones included; ``turns`` has
    (conv_id, pos, d1, d2, n_bytes).  Columns: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    members = members.select(F.col("conv_id").cast("long").alias("conv_id"), "n_turns")
    blocks = durable(_blocks(turns.select(F.col("conv_id").cast("long").alias("conv_id"), "pos", "d1", "d2", "n_bytes"), block))
    kinds = blocks.groupBy(*_FAMILY, "e1", "e2").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"))
    kinds = durable(kinds)
    siblings = kinds.groupBy(*_FAMILY).agg(F.count("*").alias("kinds"))
    rows = _turn_nodes(kinds.join(siblings, _FAMILY), block)
    alone = rows.filter("kinds = 1").drop("kinds")
    same = [c for c in alone.columns if c not in ("n_convs", "conv_id")]
    sums = {"n_convs": F.sum("n_convs").alias("n_convs"), "conv_id": F.min("conv_id").alias("conv_id")}
    # The id names the family too; grouping by the id alone deals out the family below the root.
    others = [F.first(c).alias(c) for c in same if c not in _NODE]
    refined = rows.filter("kinds > 1").groupBy(*_NODE).agg(*others, *sums.values())
    nodes = alone.unionByName(refined)
    whole = members.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    null = F.lit(None).cast("long")
    root = whole.select(
        F.lit(-1).cast("long").alias("j"), *(F.lit(ROOT).cast("long").alias(c) for c in ("u1", "u2")),
        "n_convs", "conv_id", F.lit(block).alias("r"), F.lit(0).cast("long").alias("depth"),
        *(F.lit(ROOT).cast("long").alias(c) for c in ("i1", "i2")), null.alias("p1"), null.alias("p2"), F.lit(0).cast("long").alias("n_bytes"),
        F.array(F.struct(*(F.lit(ROOT).cast("long").alias(c) for c in ("i1", "i2")))).alias("path"),
    )
    nodes = durable(nodes.unionByName(root))

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("i1"), F.col("p2").alias("i2"))
    children = children.agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("own", (F.col("n_convs") - 1) * F.col("n_bytes"))
    nodes = durable(nodes)

    ends_of_blocks = nodes.filter(F.col("r") == block)
    above = ends_of_blocks.select(F.struct(*_FAMILY).alias("up"), (F.col("j") + 1).alias("j"), F.col("i1").alias("u1"), F.col("i2").alias("u2"))
    families = nodes.groupBy(*_FAMILY).agg(F.sum("leaf").alias("leaves"), F.sum("own").alias("saved"))
    sums = _below(families.join(above, _FAMILY, "left"))
    # The family below a block's last node has the node's id as the key before it.
    under = sums.select(((F.col("j")) * block).alias("depth"), F.col("u1").alias("i1"), F.col("u2").alias("i2"), "leaves", "saved").filter("depth >= 0")
    carried = nodes.join(under, _NODE, "left").select(
        (F.col("depth") - F.size("path")).alias("before"), F.posexplode("path").alias("place", "up"),
        (F.col("leaf") + F.coalesce("leaves", F.lit(0))).alias("leaf"), (F.col("own") + F.coalesce("saved", F.lit(0))).alias("own"),
    )
    # The root is a path of its own: one entry at depth 0.
    totals = carried.groupBy((F.col("before") + F.col("place") + 1).alias("depth"), F.col("up.i1").alias("i1"), F.col("up.i2").alias("i2"))
    totals = totals.agg(F.sum("leaf").alias("n_leaves"), F.sum("own").alias("saved_tokens"))

    last = F.floor((F.col("n_turns") - 1) / block)
    ended = members.filter("n_turns > 0").withColumn("j", last).join(blocks.select("conv_id", "j", "e1", "e2"), ["conv_id", "j"])
    ended = ended.select(F.col("n_turns").cast("long").alias("depth"), F.col("e1").alias("i1"), F.col("e2").alias("i2"), "conv_id")
    at_root = [F.lit(ROOT).cast("long").alias(c) for c in _NODE]
    ends = _ends_digest(ended.union(members.filter("n_turns = 0").select(*at_root, "conv_id")))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("i1").alias("p1"), F.col("i2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(totals, _NODE)
        .join(ends, _NODE, "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )


def node_texts(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes with role and text of their last turn, null for the root."""
    last = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "role", "text")
    return nodes.join(last, ["conv_id", "depth"], "left")
