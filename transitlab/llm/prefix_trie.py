"""Prefix trie of conversations and its subtree totals by centroid decomposition.

A node stands for a distinct sequence of first turns (role, text); the root, without turns, for all conversations. The smallest
conversation through a node names it together with its depth. Totals over subtrees (childless nodes, tokens saved by
sharing) are rolled up on the forest of parent edges:

* every node knows the weight below it at once, the turns of its members from its depth on (a sum over members, no rollup);
* in each component the nodes that hold at least half of the weight form the path from the top to the centroid, the last of them;
* the totals of the component's part below the centroid (itself included) are added to every node of that path, whose weights
  lose the centroid's, and the centroid is taken out: its children's parts become components, the rest keeps its top.

Each round halves the components at least, so the rounds are logarithmic however deep the trie is (one conversation may hold a third of
all turns) or however wide a node. Components above ``TASK_NODES`` nodes are split by joins over all of their nodes; smaller
ones are handed to tasks, many at a time, which run the same rounds on arrays.

Turns are numbered without gathering a conversation: rows are range-partitioned by (conversation, turn), and counts of earlier
partitions are added. A node's key is the exclusive-or of 128-bit hashes of (position, role, text) along its sequence, so prefixes of one long
conversation are combined from partitions too. The digest of a node's members runs over sorted pieces, never a list in memory.

Defined results: rows without a conversation id belong to none. A conversation's rows are ordered by turn, null first; rows of one turn
number by a hash of role and text (repeated rows are turns of their own). Null role or text is empty. Other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

TASK_NODES = 32_768          # nodes of a component that one task decomposes in memory
PIECE = 1 << 16              # characters of a node's member list that are passed on at once
FAMILY, HEADS = 20, 4        # rebuilding: conversations of a family share up to HEADS - 1 first turns
ROOT = b"\0" * 16
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
PIDS = 33                    # bits of a row number within its partition (monotonically_increasing_id)


def numbered(rows: DataFrame) -> DataFrame:
    """conv_id, pid, rank (from 1 in the conversation), a, b (two hashes of role and text), words: a row a turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("tie"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"), F.monotonically_increasing_id().alias("copy"))
    order = ["conv_id", "turn", "tie", "copy"]
    at = F.monotonically_increasing_id()
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "a", "b", "words", at.alias("uid"), F.shiftrightunsigned(at, PIDS).alias("pid"))
    turns = common.written(turns, "trie-turns")
    # a conversation is a run of rows in one partition or in some neighbouring ones
    run = turns.groupBy("conv_id", "pid").agg(F.min("uid").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    run = common.written(run.withColumn("before", before), "trie-runs")
    return common.written(turns.join(run, ["conv_id", "pid"]).select(
        "conv_id", "pid", (F.col("uid") - F.col("first") + F.col("before") + 1).alias("rank"), "a", "b", "words"), "trie-ranked")


def shared_heads(conv_id: Column) -> tuple[Column, Column]:
    """(the conversation whose first turns are taken over, how many) by the digits of the id."""
    return conv_id - conv_id % FAMILY, F.crc32(conv_id.cast("string")) % HEADS


def rebuilt(turns: DataFrame, heads=shared_heads) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after every conversation's first h turns were replaced by those of its base.

    Turns: conv_id, pid (-1: taken over), pos, a, b, words. Conversations: conv_id, length (also 0).
    """
    base, h = heads(F.col("conv_id"))
    convs = turns.groupBy("conv_id").agg(F.max("rank").alias("own")).withColumns({"base": base, "h": h})
    convs = common.written(convs, "trie-convs")
    given = convs.select(F.col("conv_id").alias("_b"), F.col("own").alias("_own"))
    convs = convs.join(given, F.col("base") == F.col("_b"), "left").select(
        "conv_id", "base", "h", "own", F.least("h", F.coalesce("_own", F.lit(0))).alias("taken"))
    convs = common.written(convs, "trie-shared")
    # at most HEADS - 1 rows of each base, for at most FAMILY conversations
    first = turns.filter(F.col("rank") < HEADS).select(F.col("conv_id").alias("_b"), "rank", "a", "b", "words")
    over = convs.join(first, (F.col("base") == F.col("_b")) & (F.col("rank") <= F.col("h"))) \
        .select("conv_id", F.lit(-1).cast("long").alias("pid"), F.col("rank").alias("pos"), "a", "b", "words")
    kept = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter(F.col("rank") > F.col("h")) \
        .select("conv_id", "pid", (F.col("rank") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "words")
    length = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    return over.unionByName(kept), length


def _key(a: str, b: str) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos, node and parent (keys), words of the last turn: a row for each conversation and position."""
    own = turns.select("conv_id", "pid", "pos", "words", *[F.xxhash64(F.lit(k), "a", "b", "pos").alias(n) for k, n in ((3, "x"), (4, "y"))])
    own = common.written(own, "trie-hashed")
    part = own.groupBy("conv_id", "pid").agg(F.bit_xor("x").alias("px"), F.bit_xor("y").alias("py"))
    earlier = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    part = common.written(part.select("conv_id", "pid", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("px", "py")]), "trie-parts")
    here = Window.partitionBy("conv_id", "pid").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = own.join(part, ["conv_id", "pid"]).select(
        "conv_id", "pos", "words", "x", "y", *[F.bit_xor(c).over(here).bitwiseXOR(F.col(p)).alias(n) for c, p, n in (("x", "px", "nx"), ("y", "py", "ny"))])
    run = run.withColumns({"ux": F.col("nx").bitwiseXOR(F.col("x")), "uy": F.col("ny").bitwiseXOR(F.col("y"))})
    # the first turn hangs on the root
    parent = F.when(F.col("pos") == 1, F.lit(ROOT)).otherwise(_key("ux", "uy"))
    return common.written(run.select("conv_id", "pos", _key("nx", "ny").alias("node"), parent.alias("parent"), "words"), "trie-prefixes")


def trie_nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """A row a node: node, parent (null: root), depth, conv_id (smallest member), n_convs, weight (turns of its members from
    its depth on), n_children, leaf and saved (its own share of the totals)."""
    by = rows.join(convs, "conv_id").groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("pos").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("pos") + 1).alias("weight"), F.first("words").alias("words"))
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") + 1).alias("weight")) \
        .filter("n_convs > 0").select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
                                      "conv_id", "n_convs", "weight", F.lit(0).cast("long").alias("words"))
    nodes = common.written(by.unionByName(top), "trie-groups")
    children = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "_p")
    nodes = nodes.join(children, F.col("node") == F.col("_p"), "left").drop("_p").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return common.written(nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")}),
                          "trie-nodes")


TOTALS = ("leaf", "saved")
STATE = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("parent", T.BinaryType()), T.StructField("depth", T.LongType()),
                      T.StructField("conv_id", T.LongType()), T.StructField("top", T.BinaryType()), T.StructField("weight", T.LongType()),
                      *[T.StructField(c, T.LongType()) for c in TOTALS], *[T.StructField(f"sum_{c}", T.LongType()) for c in TOTALS]])
DONE = T.StructType([T.StructField("node", T.BinaryType()), *[T.StructField(f"sum_{c}", T.LongType()) for c in TOTALS]])


def decompose(up, weight, values):
    """Subtree sums on arrays. ``up`` is each node's parent in the forest (itself at a top), ``weight`` the weight below it, ``values``
    (kinds, nodes) what is summed. Every round treats all components at once."""
    import numpy as np
    up, weight, n = up.copy(), weight.copy(), len(up)
    sums = np.zeros_like(values)
    alive = np.arange(n)

    def tops(link):
        """The top of each living node, by doubling."""
        out = link.copy()
        while True:
            nxt = out[out]
            if (nxt[alive] == out[alive]).all():
                return out
            out = nxt
    while len(alive):
        top = tops(up)
        on_path = alive[2 * weight[alive] >= weight[top[alive]]]
        # the deepest node of a path has the least weight (every node weighs something)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, top[on_path], weight[on_path])
        centroid = on_path[weight[on_path] == least[top[on_path]]]
        of_top = np.full(n, -1)
        of_top[top[centroid]] = centroid
        cut = up.copy()
        cut[centroid] = centroid
        part = tops(cut)
        is_centroid = np.zeros(n, dtype=bool)
        is_centroid[centroid] = True
        below = alive[is_centroid[part[alive]]]
        total = np.zeros_like(values)
        for k in range(len(values)):
            np.add.at(total[k], part[below], values[k, below])
        mine = of_top[top[on_path]]
        sums[:, on_path] += total[:, mine]
        rest = on_path != mine
        weight[on_path[rest]] -= weight[mine[rest]]
        alive = alive[~is_centroid[alive]]
        free = alive[is_centroid[up[alive]]]
        up[free] = free
    return sums


def _in_tasks(state: DataFrame) -> DataFrame:
    """(node, sums) of components of at most ``TASK_NODES`` nodes, as many at a time as that bound allows."""
    common.ship(state.sparkSession)

    def solve(table):
        import numpy as np
        node, parent, top = (table.column(c).to_pylist() for c in ("node", "parent", "top"))
        place = {k: i for i, k in enumerate(node)}
        up = np.fromiter((place[p] if k != t else i for i, (k, p, t) in enumerate(zip(node, parent, top))), dtype=np.int64, count=len(node))
        values = np.stack([table.column(c).to_numpy().astype(np.int64) for c in TOTALS])
        sums = decompose(up, table.column("weight").to_numpy().astype(np.int64), values)
        return common.batch_of(DONE, [node, *(sums[k] + table.column(f"sum_{c}").to_numpy() for k, c in enumerate(TOTALS))])

    def run(batches: Iterator):
        import pyarrow as pa
        pending, rows = [], 0                # whole components, then the one that goes on
        for b in batches:
            if not b.num_rows:
                continue
            pending.append(b)
            rows += b.num_rows
            if rows < TASK_NODES:
                continue
            table = pa.Table.from_batches(pending)
            top = table.column("top").to_pylist()
            last = len(top)
            while last and top[last - 1] == top[-1]:
                last -= 1
            if last:
                yield solve(table.slice(0, last))
                pending = table.slice(last).to_batches()
                rows = len(top) - last
        if pending:
            yield solve(pa.Table.from_batches(pending))
    return state.repartition("top").sortWithinPartitions("top").mapInArrow(run, DONE)


def _split_round(state: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round on large components: (centroids with their sums, the nodes left with new tops)."""
    total = F.max("weight").alias("total")
    whole = common.written(state.groupBy("top").agg(total).withColumnRenamed("top", "_t"), "trie-whole")
    marked = state.join(whole, F.col("top") == F.col("_t")).withColumn("path", 2 * F.col("weight") >= F.col("total")).drop("_t", "total")
    marked = common.written(marked, "trie-marked")
    centre = marked.filter("path").groupBy("top").agg(F.min(F.struct("weight", "node", "depth")).alias("c")).select(
        F.col("top").alias("_t"), F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight"))
    centre = common.written(centre, "trie-centres")
    # a node's ancestor one below the centroid's depth is what its smallest member has there
    nodes = marked.join(centre, F.col("top") == F.col("_t")).drop("_t")
    step = rows.select(F.col("conv_id").alias("_c"), F.col("pos").alias("_d"), F.col("node").alias("_child"), F.col("parent").alias("_above"))
    nodes = nodes.join(step, (F.col("conv_id") == F.col("_c")) & (F.col("c_depth") + 1 == F.col("_d")), "left")
    under = (F.col("depth") > F.col("c_depth")) & F.coalesce(F.col("_above") == F.col("c_node"), F.lit(False))
    nodes = common.written(nodes.withColumn("below", under | (F.col("node") == F.col("c_node"))).withColumn("_child", F.when(under, F.col("_child")))
                           .drop("_c", "_d", "_above"), "trie-below")
    sums = nodes.filter("below").groupBy("top").agg(*[F.sum(c).alias(f"t_{c}") for c in TOTALS]).withColumnRenamed("top", "_t")
    nodes = nodes.join(common.written(sums, "trie-totals"), F.col("top") == F.col("_t"))
    nodes = nodes.withColumns({f"sum_{c}": F.col(f"sum_{c}") + F.when(F.col("path"), F.col(f"t_{c}")).otherwise(0) for c in TOTALS})
    is_centre = F.col("node") == F.col("c_node")
    nodes = nodes.withColumn("weight", F.col("weight") - F.when(F.col("path") & ~is_centre, F.col("c_weight")).otherwise(0)) \
        .withColumn("top", F.coalesce("_child", "top")).withColumn("done", is_centre)
    nodes = common.written(nodes.select(*STATE.names, "done"), "trie-round")
    return nodes.filter("done").select(*DONE.names), nodes.filter("NOT done").select(*STATE.names)


def rolled_up(nodes: DataFrame, rows: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """node and the sums of ``TOTALS`` over its subtree (itself included), by centroid decomposition."""
    zero = [F.lit(0).cast("long").alias(f"sum_{c}") for c in TOTALS]
    # written: a literal top would turn the first joins on it into joins without a key
    state = common.written(nodes.select("node", "parent", "depth", "conv_id", F.lit(ROOT).alias("top"), "weight", *TOTALS, *zero), "trie-state")
    done = []
    while True:
        size = common.written(state.groupBy("top").agg(F.count(F.lit(1)).alias("m")).withColumnRenamed("top", "_t"), "trie-sizes")
        if size.filter(F.col("m") > task_nodes).isEmpty():
            done.append(_in_tasks(state))
            break
        sized = common.written(state.join(size, F.col("top") == F.col("_t")).drop("_t"), "trie-sized")
        done.append(_in_tasks(sized.filter(F.col("m") <= task_nodes).drop("m")))
        centres, state = _split_round(sized.filter(F.col("m") > task_nodes).drop("m"), rows)
        done.append(centres)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return common.written(out, "trie-sums")


PIECES = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("first", T.LongType()), T.StructField("text", T.StringType())])
DIGESTS = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])


def member_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids (``conv_id``) at each ``node``, ascending and comma-joined.

    Ranges of (node, id) write the list in pieces; one pass over a node's pieces, in order, makes the digest. Neither holds a list.
    """
    common.ship(ends.sparkSession)

    def pieces(batches: Iterator):
        now, first, out, size = None, None, [], 0
        for b in batches:
            made = []
            for node, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if node != now or size > PIECE:
                    if out:
                        made.append((now, first, ",".join(out)))
                    now, first, out, size = node, conv, [], 0
                out.append(str(conv))
                size += len(out[-1]) + 1
            if made:
                yield common.batch_of(PIECES, list(map(list, zip(*made))))
        if out:
            yield common.batch_of(PIECES, [[now], [first], [",".join(out)]])

    def digests(batches: Iterator):
        now, sha = None, None
        for b in batches:
            made = []
            for node, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if node != now:
                    if now is not None:
                        made.append((now, sha.hexdigest()))
                    now, sha = node, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(text.encode())
            if made:
                yield common.batch_of(DIGESTS, list(map(list, zip(*made))))
        if now is not None:
            yield common.batch_of(DIGESTS, [[now], [sha.hexdigest()]])
    cut = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(pieces, PIECES)
    return common.written(cut, "trie-pieces").repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, DIGESTS)


def prefix_trie(conversations: DataFrame, heads=shared_heads, task_nodes: int = TASK_NODES) -> DataFrame:
    """A row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``heads`` gives, for a conversation's id, the conversation whose first turns it takes over and their number (below ``HEADS``).
    """
    turns, convs = rebuilt(numbered(conversations), heads)
    convs = common.written(convs, "trie-lengths")
    rows = prefixes(turns)
    nodes = trie_nodes(rows, convs)
    sums = rolled_up(nodes, rows, task_nodes).withColumnRenamed("node", "_s")
    last = rows.select("conv_id", "pos", "node")
    ends = convs.filter("length > 0").join(last.withColumnRenamed("conv_id", "_c"), (F.col("conv_id") == F.col("_c")) & (F.col("length") == F.col("pos"))) \
        .select("node", "conv_id").unionByName(convs.filter("length = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    digest = common.written(member_digests(ends).withColumnRenamed("node", "_e"), "trie-digests")
    above = nodes.select(F.col("node").alias("_p"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, F.col("parent") == F.col("_p"), "left").join(sums, F.col("node") == F.col("_s")).join(digest, F.col("node") == F.col("_e"), "left") \
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("sum_leaf").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"))
