"""Chat formatting of reply trees, with DataFrame and SQL functions only.

A tree is a set of messages (tree, node, parent, role, text, score). Root-to-leaf paths are enumerated by iterated
self-joins that double their reach: after round k every node knows its ancestor 2^k steps up, and the members of a
path known so far fetch the next 2^k ones, so a path of n messages takes log2(n) rounds. Branches are ranked by the sum
of their scores, and each chosen path becomes one conversation in a template that marks turns.

Template: ``<|im_start|>role`` newline, text, ``<|im_end|>`` newline, for every turn. Inside roles and texts every ``<``
followed by zero or more backslashes and ``|`` gets one backslash more, so control strings never appear there; parsing
takes it away again. In roles a backslash and a newline are escaped too. The loss mask holds the code point ranges of the
assistant texts in the formatted string.

Defined results: null text and role are empty; null tree and node ids are keys like any other; null scores are 0. Rows
with the same tree and node are kept once (the smallest parent, role, text). A parent that does not exist makes a node
a root; nodes on a cycle have no root and appear in no path. Equal branch scores are ranked by node id.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

START, END = "<|im_start|>", "<|im_end|>"       # fixed values: the template's turn marks
MAX_ROUNDS = 40                                 # paths of up to 2^40 messages


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    # between doubled backslashes (found from the left, as they were written) a backslash can only belong to a line end
    parts = F.split(unescape(c), r"\\\\")
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def conversation_tree(rows: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as trees: every row replies to the one before it.

    Repeated and null turns are rows of their own, in the order of (turn, role, text). The numbering sorts one
    conversation in one task; its formatted text has to be put together in one row anyway.
    """
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = F.row_number().over(w).cast("long")
    return rows.select(F.col("conv_id").alias("tree"), n.alias("node"), F.when(n > 1, n - 1).alias("parent"),
                       "role", "text", F.lit(0.0).alias("score"))


def _unique(tree: DataFrame) -> DataFrame:
    t = tree.select("tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    first = F.min(F.struct("parent", "role", "text", "score")).alias("_m")
    return t.groupBy("tree", "node").agg(first).select("tree", "node", "_m.*")


def paths(tree: DataFrame) -> DataFrame:
    """One row for each member of each root-to-leaf path: tree, leaf, node, up (steps from the leaf).

    The messages stay behind; only ids travel through the joins, each round written to the shared folder.
    """
    ids = tree.select("tree", "node", "parent")
    known = ids.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    linked = ids.join(known, F.col("tree").eqNullSafe(F.col("_t")) & F.col("parent").eqNullSafe(F.col("_n"))
                      & F.col("parent").isNotNull(), "left") \
        .select("tree", "node", F.col("_n").alias("up_node"), (F.col("_t").isNotNull() | F.col("_n").isNotNull()).alias("has_up"))
    linked = common.written(linked, "chat-links")
    parents = linked.filter("has_up").select(F.col("tree").alias("_t"), F.col("up_node").alias("_n")).distinct()
    leaves = linked.join(parents, F.col("tree").eqNullSafe(F.col("_t")) & F.col("node").eqNullSafe(F.col("_n")), "left_anti")
    members = common.written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")),
                             "chat-members")
    jumps = linked.filter("has_up").select("tree", "node", "up_node")
    for k in range(MAX_ROUNDS):
        far = jumps.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "up_node")
        more = members.join(far, F.col("tree").eqNullSafe(F.col("_t")) & F.col("node").eqNullSafe(F.col("_n"))) \
            .select("tree", "leaf", F.col("up_node").alias("node"), (F.col("up") + F.lit(1 << k)).alias("up"))
        more = common.written(more, "chat-more")
        if more.isEmpty():
            return members
        members = members.unionByName(more)
        step = far.withColumnRenamed("up_node", "_far")
        jumps = jumps.join(step, F.col("tree").eqNullSafe(F.col("_t")) & F.col("up_node").eqNullSafe(F.col("_n"))) \
            .select("tree", "node", F.col("_far").alias("up_node"))
        jumps = common.written(jumps, "chat-jumps")
    raise RuntimeError("a path is longer than the rounds allow")


def format_trees(tree: DataFrame, branches: int | None = 1) -> DataFrame:
    """The best ``branches`` paths of every tree (None: all) as conversations.

    Columns: tree, leaf, rank (1 is best), path_score, n_turns, formatted, loss_mask (array of start and end).
    """
    messages = common.written(_unique(tree), "chat-messages")
    member = paths(messages)
    m = messages.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "role", "text", "score")
    turn = member.join(m, F.col("tree").eqNullSafe(F.col("_t")) & F.col("node").eqNullSafe(F.col("_n"))) \
        .select("tree", "leaf", "up", "role", "text", "score")
    if branches is not None:
        total = turn.groupBy("tree", "leaf").agg(F.sum("score").alias("path_score"))
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf"))
        best = total.withColumn("rank", rank).filter(F.col("rank") <= branches) \
            .select(F.col("tree").alias("_t"), F.col("leaf").alias("_l"), "rank")
        turn = turn.join(best, F.col("tree").eqNullSafe(F.col("_t")) & F.col("leaf").eqNullSafe(F.col("_l"))).drop("_t", "_l")
    else:
        turn = turn.withColumn("rank", F.lit(None).cast("int"))
    role, text = escape_role(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    part = F.struct((-F.col("up")).alias("o"), (F.col("role") == "assistant").alias("a"), F.length(head).alias("h"),
                    F.length(text).alias("n"), F.concat(head, text, F.lit(END + "\n")).alias("s"))
    turns = turn.groupBy("tree", "leaf", "rank").agg(F.sum("score").alias("path_score"), F.array_sort(F.collect_list(part)).alias("_p"))
    tail = len(END) + 1
    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("mask"))

    def step(acc, p):
        begin = acc["at"] + p["h"]
        span = F.struct(begin.alias("start"), (begin + p["n"]).alias("end"))
        return F.struct((begin + p["n"] + F.lit(tail)).alias("at"),
                        F.when(p["a"], F.concat(acc["mask"], F.array(span))).otherwise(acc["mask"]).alias("mask"))
    return turns.select("tree", "leaf", "rank", "path_score", F.size("_p").cast("long").alias("n_turns"),
                        F.array_join(F.transform("_p", lambda p: p["s"]), "").alias("formatted"),
                        F.aggregate("_p", first, step)["mask"].alias("loss_mask"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, read back: array of (role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda x: x != "")
    body = F.transform(pieces, lambda x: F.substring(x, F.lit(len(START) + 1), F.length(x)))
    return F.transform(body, lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substring(x, F.length(F.substring_index(x, "\n", 1)) + F.lit(2), F.length(x))).alias("text")))


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, cut out of the formatted string and unescaped."""
    return F.transform(mask, lambda m: unescape(F.substring(formatted, m["start"] + F.lit(1), m["end"] - m["start"])))
