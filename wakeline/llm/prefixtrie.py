"""The prefix trie of conversations, with totals over subtrees by a depth-band rollup.

A node is a sequence of turns, known by its depth and a 126-bit sum of hashes of
(place, turn). Sums over prefixes need no step per turn: they are taken inside
runs of RUN turns and over the runs' totals, so a very long conversation is no
single task's work.

Totals over subtrees: depths are cut into bands of fixed height. Every node
hands its value only to its ancestors within its band. The nodes at the top of
the bands then form a trie of their own, lower by the band's height, and its
totals, found the same way, are handed to the band above them. So a node is
copied at most `height` times a level and there are log(depth) levels.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.operators import skew

# Depths that a node's value is handed up in one step.
HEIGHT = 8
# Turns whose hashes are summed in one window.
RUN = 64
# Up to 2^8 ids are joined into one piece of text before they are hashed in order.
PIECE_BITS = 8
LOW31, LOW32 = (1 << 31) - 1, (1 << 32) - 1


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, bytes): the turns in order, from 0, texts replaced by digests.

    Order is by turn, null first, then by digest. Rows without a conv_id belong
    to no conversation and are left out. A null role or text is empty.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"))
    placed = skew.positions(rows, ["conv_id"], ["turn", "digest"])
    return placed.select("conv_id", F.col("before").cast("bigint").alias("pos"), "digest", "bytes")


def _lanes() -> list[Column]:
    """Four hashes of 32 bits of a turn at its place; sums of 2^31 of them fit a bigint."""
    a = F.xxhash64(F.lit(1), "pos", "digest")
    b = F.xxhash64(F.lit(2), "digest", "pos")
    return [x for h in (a, b) for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(LOW32)))]


def _node(sums) -> Column:
    """A node's name from four sums."""
    a, b, c, d = sums
    pair = lambda x, y: F.shiftleft(x.bitwiseAND(F.lit(LOW31)), 32).bitwiseOR(y.bitwiseAND(F.lit(LOW32)))
    return F.struct(pair(a, b).alias("a"), pair(c, d).alias("b"))


# SQL text of the root's name.
ROOT = "named_struct('a', 0L, 'b', 0L)"


def paths(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, node, parent, bytes): every conversation's way from the root, the root included.

    `placed` has (conv_id, pos, digest, bytes); `convs` names every conversation,
    also those without turns.
    """
    rows = placed.select("conv_id", "pos", "bytes", (F.floor(F.col("pos") / RUN)).alias("run"),
                         *[x.alias(f"x{i}") for i, x in enumerate(_lanes())])
    lanes = range(4)
    within = Window.partitionBy("conv_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("conv_id", "run").agg(*[F.sum(f"x{i}").alias(f"t{i}") for i in lanes])
               .select("conv_id", "run", *[F.coalesce(F.sum(f"t{i}").over(ahead), F.lit(0)).alias(f"o{i}") for i in lanes]))
    summed = (rows.withColumns({f"s{i}": F.sum(f"x{i}").over(within) for i in lanes})
              .join(offsets, ["conv_id", "run"])
              .withColumns({f"s{i}": F.col(f"s{i}") + F.col(f"o{i}") for i in lanes}))
    below = summed.select(F.col("conv_id").alias("conv"), (F.col("pos") + 1).alias("depth"),
                          _node([F.col(f"s{i}") for i in lanes]).alias("node"),
                          _node([F.col(f"s{i}") - F.col(f"x{i}") for i in lanes]).alias("parent"), "bytes")
    top = convs.select(F.col("conv_id").alias("conv"), F.lit(0).cast("bigint").alias("depth"), F.expr(ROOT).alias("node"),
                       F.expr(f"if(false, {ROOT}, null)").alias("parent"), F.lit(0).cast("bigint").alias("bytes"))
    return below.unionByName(top)


def rollup(nodes: DataFrame, ways: DataFrame, values: list[str], height: int = HEIGHT) -> DataFrame:
    """(node, *values): each node's values summed over its subtree, itself included.

    `nodes` has (node, conv, depth, *values), where conv is a conversation through
    the node; `ways` has (conv, depth, node) of at least those conversations,
    without gaps from depth 0 on.
    """
    band = F.floor(F.col("depth") / height)
    held = ways.select("conv", band.alias("band"), F.struct("depth", "node").alias("step")).groupBy("conv", "band").agg(
        F.transform(F.sort_array(F.collect_list("step")), lambda s: s["node"]).alias("line"))  # `height` nodes at most

    def handed(rows: DataFrame, count: Column) -> DataFrame:
        """The values of rows (conv, band, ...) summed at the first `count` nodes of that band's line."""
        above = F.explode(F.slice("line", F.lit(1), count.cast("int"))).alias("node")
        return (rows.join(held, ["conv", "band"]).select(above, *values)
                .groupBy("node").agg(*[F.sum(v).alias(v) for v in values]))

    inside = skew.settle(handed(nodes.drop("node").withColumn("band", band), F.col("depth") % height + 1))
    deepest = nodes.agg(F.max("depth")).first()[0]
    if deepest is None or deepest < height:
        return inside
    on_top = F.col("depth") % height == 0
    tops = nodes.filter(on_top).select("node", "conv", band.alias("depth")).join(inside, "node")
    totals = rollup(tops, ways.filter(on_top).select("conv", band.alias("depth"), "node"), values, height)
    carried = handed(tops.select("node", "conv", "depth").filter("depth > 0").join(totals, "node")
                     .withColumn("band", F.col("depth") - 1).drop("node"), F.lit(height))
    return skew.settle(inside.unionByName(carried).groupBy("node").agg(*[F.sum(v).alias(v) for v in values]))


def _ends(ways: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end: the digest of their ids, ascending, by commas.

    Ids are joined in pieces first; the pieces of a node are hashed one after
    another as they stream by, so no node's ids are ever held together.
    """
    last = ways.groupBy("conv").agg(F.max("depth").alias("depth"))
    piece = F.shiftright("conv", PIECE_BITS)
    pieces = (ways.join(last, ["conv", "depth"]).groupBy("node", piece.alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")))
    ordered = (pieces.select("node.a", "node.b", "piece", "ids").repartition("a", "b")
               .sortWithinPartitions("a", "b", "piece"))

    def run(batches):
        at, state = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (a, b) == at:
                    state.update(b"," + ids.encode())
                    continue
                if at is not None:
                    out.append((*at, state.hexdigest()))
                at, state = (a, b), hashlib.sha256(ids.encode())
            yield _rows(out)
        if at is not None:
            yield _rows([(*at, state.hexdigest())])

    return ordered.mapInArrow(run, "a bigint, b bigint, ends_sha256 string").select(
        F.struct("a", "b").alias("node"), "ends_sha256")


def _rows(out) -> pa.RecordBatch:
    a, b, digest = zip(*out) if out else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest, pa.string())],
                                      names=["a", "b", "ends_sha256"])


def trie(placed: DataFrame, convs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one included.

    Columns: conv_id (the smallest conversation that starts with it), depth,
    parent_conv_id, n_convs, n_children, n_leaves (childless nodes in the
    subtree), saved_tokens (bytes of the last text, once for every conversation
    but one, summed over the subtree) and ends_sha256. No conversations, no rows.
    """
    ways = skew.settle(paths(placed, convs))
    nodes = skew.settle(ways.groupBy("node").agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        F.max("parent.a").alias("pa"), F.max("parent.b").alias("pb"), F.max("bytes").alias("bytes"))
        .withColumn("parent", F.when(F.col("pa").isNotNull(), F.struct(F.col("pa").alias("a"), F.col("pb").alias("b"))))
        .drop("pa", "pb"))
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    full = skew.settle(nodes.join(kids, "node", "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "n_leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}))
    owners = ways.join(nodes.select("conv").distinct(), "conv", "left_semi").select("conv", "depth", "node")
    values = ["n_leaves", "saved_tokens"]
    totals = rollup(full.select("node", "conv", "depth", *values), skew.settle(owners), values, height)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return (full.drop(*values).join(totals, "node").join(parents, "parent", "left").join(_ends(ways), "node", "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", *values,
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))


def families(placed: DataFrame, size: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from a shared start: (their turns, all of them by conv_id).

    Conversation c gets the first h turns of conversation c - c % size, then its
    own from its turn h on, where h is the unsigned crc32 of c's digits modulo
    `heads`. The remainder has the sign of c.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h")
    own = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    starts = placed.filter((F.col("conv_id") % size == 0) & (F.col("pos") < heads - 1)).select(
        F.col("conv_id").alias("start"), "pos", "digest", "bytes")
    named = own.select("conv_id", "own", h, (F.col("conv_id") - F.col("conv_id") % size).alias("start"))
    # How many turns of its start a conversation gets: h, or fewer if the start is shorter.
    lengths = named.filter("conv_id = start").select("start", F.col("own").alias("there"))
    convs = skew.settle(named.join(lengths, "start", "left").withColumn(
        "head", F.least("h", F.coalesce("there", F.lit(0)))).select("conv_id", "start", "h", "head"))
    first = convs.join(starts, "start").filter("pos < h").select("conv_id", "pos", "digest", "bytes")
    rest = (placed.withColumn("h", h).filter("pos >= h").drop("h").join(convs.select("conv_id", "h", "head"), "conv_id")
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "digest", "bytes"))
    return first.unionByName(rest), convs.select("conv_id")
