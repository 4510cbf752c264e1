"""Hard negatives of anchor vectors by exact integer scores, looked up instead of multiplied (the method of the Four Russians).

Components become whole numbers, floor(256 * x). For every anchor the sums of all subsets of eight neighbouring components are
tabulated (256 a group of eight). A candidate is kept as its bit planes, packed eight components to a byte: one byte is the
index of the subset whose components have that bit. Adding the lookups of a plane over the groups gives the plane's share of the inner
product; the planes are added from the sign down, doubling in between. The result is the exact score of every pair, no estimate.

Anchors and candidates meet in blocks: rows are dealt into chunks and anchors into groups, and one task scores one chunk against one
group, keeping the best few of each anchor. So neither a label that holds a third of all rows nor the number of anchors is ever
gathered in one task, and no pair leaves a task unless it is among the best there. The best of the chunks are ranked at the end.
First the positives (rows of the anchor's label), then the negatives whose scores lie in the range that each positive gives.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors of different
lengths are not compared (empty vectors score 0 with each other). Whole numbers beyond 2^24 either way are cut off there, so scores fit a long.
Repeated rows are rows of their own: an anchor's copies can be its positives, each copy of an anchor has results. Ties of score go to the smaller id, then
(repeated ids) to a hash of label and vector. Columns other than ``vec_id``, ``embedding``, ``label`` are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SCALE = 256
CUT_OFF = 1 << 24
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90           # a negative's score in percent of the positive's, both included
CHUNK_BYTES = 1 << 25        # packed candidates in one task
GROUP_BYTES = 1 << 23        # anchors in one task
TABLE_BYTES = 1 << 24        # subset sums held at once
SPREAD, LEAST_CHUNK = 64, 4096   # rows are dealt into so many chunks at least, unless that makes them smaller than this
SLICE = 1024                 # candidates scored at once
LOWEST = -(1 << 62)

CODED = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.LongType()), T.StructField("dim", T.IntegerType()),
                      T.StructField("numbers", T.BinaryType()), T.StructField("planes", T.IntegerType()), T.StructField("bits", T.BinaryType())])


def whole_numbers(raw):
    """floor(256 * x) of an array of doubles, cut off at ``CUT_OFF``."""
    import numpy as np
    return np.clip(np.floor(raw * SCALE), -CUT_OFF, CUT_OFF).astype(np.int64)


def bit_planes(numbers):
    """(rows, planes, groups) bytes of whole numbers in two's complement, lowest plane first; the last plane is the sign."""
    import numpy as np
    top = int(max(numbers.max(initial=0), -(numbers.min(initial=0) + 1)))
    n = top.bit_length() + 1
    wide = np.zeros((len(numbers), groups_of(numbers.shape[1]) * 8), dtype=np.int64)
    wide[:, :numbers.shape[1]] = numbers
    return np.stack([np.packbits((wide >> b & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(n)], axis=1)


def groups_of(dim: int) -> int:
    return max(1, -(-dim // 8))


def subset_sums(anchors):
    """(groups, 256, anchors) sums of the components that a byte names, for every group of eight components of each anchor."""
    import numpy as np
    wide = np.zeros((groups_of(anchors.shape[1]) * 8, len(anchors)), dtype=np.int64)
    wide[:anchors.shape[1]] = anchors.T
    out = np.zeros((len(wide) // 8, 256, len(anchors)), dtype=np.int64)
    for g in range(len(out)):
        for j in range(8):
            np.add(out[g, :1 << j], wide[8 * g + j], out=out[g, 1 << j:2 << j])
    return out


def scores(sums, bits):
    """(candidates, anchors) exact inner products from the subset sums of the anchors and the candidates' bit planes."""
    import numpy as np
    n, planes, groups = bits.shape
    total = None
    for b in range(planes - 1, -1, -1):
        share = sums[0].take(bits[:, b, 0], axis=0)
        for g in range(1, groups):
            share += sums[g].take(bits[:, b, g], axis=0)
        if total is None:
            total = np.negative(share, out=share)            # the sign plane counts negative
        else:
            total <<= 1
            total += share
    return total


def narrow(sums, planes: int):
    """The same sums in 32 bits where no score can leave them."""
    import numpy as np
    reach = np.abs(sums).max(axis=1).sum(axis=0).max(initial=0)
    return sums.astype(np.int32) if int(reach) << planes < 1 << 30 else sums


def prepare(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """The rows that take part, with whole numbers, bit planes, ``tie`` and whether they are anchors."""
    def fn(batch):
        import math

        import numpy as np
        rows: dict[int, list] = {}
        ids, labels = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for i, v in enumerate(batch.column(1).to_pylist()):
            if v is not None and ids[i] is not None and labels[i] is not None and None not in v and all(map(math.isfinite, v)):
                rows.setdefault(len(v), []).append((i, v))
        out: list[list] = [[] for _ in CODED.fields]
        for dim, found in rows.items():
            numbers = whole_numbers(np.array([v for _, v in found], dtype=np.float64).reshape(len(found), dim))
            bits = bit_planes(numbers)
            for k, (i, _) in enumerate(found):
                for c, x in zip(out, (ids[i], labels[i], dim, numbers[k].tobytes(), bits.shape[1], bits[k].tobytes())):
                    c.append(x)
        return common.batch_of(CODED, out)
    coded = common.map_batches(vectors.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("long")), fn, CODED)
    coded = coded.withColumn("tie", F.xxhash64("label", "numbers")).withColumn("anchor", F.coalesce(is_anchor, F.lit(False))) \
        .withColumn("uid", F.monotonically_increasing_id())
    return common.written(coded, "negatives-rows")


SIDES = ["uid", "vec_id", "label", "tie", "dim", "planes", "numbers", "bits", "wanted"]


def in_blocks(rows: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and anchors of equal ``keys`` dealt into chunks and groups; every chunk meets every group in one task."""
    dim = F.greatest(F.col("dim"), F.lit(1))
    chunk_rows = F.greatest(F.lit(LEAST_CHUNK // 4), F.lit(CHUNK_BYTES) / (2 * dim))
    group_rows = F.greatest(F.lit(64), F.lit(GROUP_BYTES) / (8 * dim))
    size = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    met = anchors.groupBy(*keys).agg(F.count(F.lit(1)).alias("_a"))
    size = size.join(met, keys).select(
        *keys, F.greatest(F.ceil(F.col("_n") / chunk_rows), F.least(F.lit(SPREAD), F.ceil(F.col("_n") / LEAST_CHUNK))).cast("int").alias("_chunks"),
        F.ceil(F.col("_a") / group_rows).cast("int").alias("_groups"))
    size = common.written(size, "negatives-sizes")

    def dealt(df, own, other, number, each):
        df = df.join(size, keys).withColumn(own, F.pmod(F.xxhash64("uid"), F.col(number)).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(each) - 1))).drop("_chunks", "_groups")
    none = F.lit(None)
    candidates = dealt(rows.select("uid", "vec_id", "label", "tie", "dim", "planes", none.cast("binary").alias("numbers"), "bits",
                                   none.cast("array<struct<id:bigint,score:bigint>>").alias("wanted")), "chunk", "grp", "_chunks", "_groups")
    wanted = F.col("wanted") if "wanted" in anchors.columns else F.array().cast("array<struct<id:bigint,score:bigint>>").alias("wanted")
    queries = dealt(anchors.select("uid", "vec_id", "label", "tie", "dim", "planes", "numbers", none.cast("binary").alias("bits"), wanted),
                    "grp", "chunk", "_groups", "_chunks")
    return candidates.unionByName(queries)


class Best:
    """The best ``k`` (score, then id, tie, uid) of every list, kept while candidates pass in slices."""

    def __init__(self, lists: int, k: int):
        import numpy as np
        self.k, self.cut = k, np.full(lists, LOWEST, dtype=np.int64)
        self.rows = np.empty((6, 0), dtype=np.int64)          # list, -score, id, tie, uid, place in the list

    def offer(self, score, allowed, keys, first: int) -> None:
        """``score`` and ``allowed`` are (candidates, lists from ``first`` on); ``keys`` the candidates' id, tie and uid."""
        import numpy as np
        cut = self.cut[first:first + score.shape[1]]
        good = allowed & (score >= cut)
        if score.shape[0] > self.k and np.count_nonzero(good) > 8 * self.k * score.shape[1]:
            # only what reaches the k-th best of this slice can stay (all ties of it included)
            kth = np.partition(np.where(good, score, LOWEST), -self.k, axis=0)[-self.k]
            good &= score >= kth
        i, j = np.nonzero(good)
        if not len(i):
            return
        new = np.stack([j + first, -score[i, j].astype(np.int64), *(k[i] for k in keys), np.zeros(len(i), dtype=np.int64)])
        touched = np.zeros(len(self.cut), dtype=bool)
        touched[new[0]] = True
        old = touched[self.rows[0]]
        some = np.concatenate([self.rows[:, old], new], axis=1)
        some = some[:, np.lexsort(some[4::-1])]
        begin = np.flatnonzero(np.r_[True, some[0, 1:] != some[0, :-1]])
        some[5] = np.arange(some.shape[1]) - np.repeat(begin, np.diff(np.r_[begin, some.shape[1]]))
        some = some[:, some[5] < self.k]
        full = some[5] == self.k - 1
        self.cut[some[0, full]] = -some[1, full]
        self.rows = np.concatenate([self.rows[:, ~old], some], axis=1)


def _sides(table):
    """(anchors, candidates) of one task's table: those with whole numbers, those with bits."""
    import pyarrow.compute as pc
    is_anchor = pc.is_valid(table.column("numbers"))
    return table.filter(is_anchor), table.filter(pc.invert(is_anchor))


def _number_columns(table, names):
    import numpy as np
    return [table.column(n).to_numpy().astype(np.int64) for n in names]


def _slices(candidates):
    """(rows, bits) of runs of candidates with one number of planes."""
    import numpy as np
    planes = candidates.column("planes").to_numpy()
    raw, dim = candidates.column("bits").to_pylist(), candidates.column("dim")[0].as_py()
    for n in np.unique(planes):
        at = np.flatnonzero(planes == n)
        for lo in range(0, len(at), SLICE):
            some = at[lo:lo + SLICE]
            yield some, np.frombuffer(b"".join(raw[i] for i in some), dtype=np.uint8).reshape(len(some), n, groups_of(dim))


def _scored(anchors, candidates):
    """(first anchor, anchors at once, candidate rows, their scores) over the whole block."""
    import numpy as np
    dim = anchors.column("dim")[0].as_py()
    numbers = np.frombuffer(b"".join(anchors.column("numbers").to_pylist()), dtype=np.int64).reshape(anchors.num_rows, dim)
    step = int(min(256, max(8, TABLE_BYTES // (groups_of(dim) * 256 * 8))))
    most = int(candidates.column("planes").to_numpy().max())
    for first in range(0, len(numbers), step):
        sums = narrow(subset_sums(numbers[first:first + step]), most)
        for rows, bits in _slices(candidates):
            yield first, sums.shape[2], rows, scores(sums, bits)


FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "place", "score", "id", "tie", "uid")])


def _found(best: Best, per_anchor: int, anchor_uid):
    """The kept rows with their anchor and the list's place among the anchor's lists."""
    import numpy as np
    lists, score, ids, tie, uid = best.rows[:5]
    return common.batch_of(FOUND, list(map(np.ascontiguousarray, (anchor_uid[lists // per_anchor], lists % per_anchor, -score, ids, tie, uid))))


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` of each key over all chunks, numbered from 1 (only the best of a task are shuffled)."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "tie", "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives(rows: DataFrame, k: int = POSITIVES) -> DataFrame:
    """anchor (uid), rank, id, score: the best ``k`` other rows of each anchor's label."""
    def fn(table):
        anchors, candidates = _sides(table)
        if not anchors.num_rows or not candidates.num_rows:
            return None
        own, = _number_columns(anchors, ["uid"])
        keys = _number_columns(candidates, ["vec_id", "tie", "uid"])
        best = Best(len(own), k)
        for first, n, at, score in _scored(anchors, candidates):
            some = [c[at] for c in keys]
            best.offer(score, some[2][:, None] != own[None, first:first + n], some, first)
        return _found(best, 1, own)
    keys = ["label", "dim"]
    met = in_blocks(rows, rows.filter("anchor"), keys)
    found = common.by_group(met.select("grp", "chunk", *SIDES), [*keys, "grp", "chunk"], fn, FOUND)
    return _ranked(found, ["anchor"], k)


def negatives(rows: DataFrame, best: DataFrame, k: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor (uid), place (0 for the first positive), rank, id, score: for each positive the best ``k`` rows of other labels whose
    scores are ``low`` to ``high`` percent of the positive's."""
    listed = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("w")) \
        .select(F.col("anchor").alias("uid"), F.transform("w", lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score"))).alias("wanted"))
    anchors = rows.filter("anchor").join(listed, "uid")

    def fn(table):
        import numpy as np
        anchors, candidates = _sides(table)
        if not anchors.num_rows or not candidates.num_rows:
            return None
        own, own_label = _number_columns(anchors, ["uid", "label"])
        label, *keys = _number_columns(candidates, ["label", "vec_id", "tie", "uid"])
        wanted = [[x["score"] for x in w] for w in anchors.column("wanted").to_pylist()]
        width = max(map(len, wanted))
        # whole numbers of any size; an anchor with fewer positives gets ranges that hold nothing
        least = np.array([[-(-low * s // 100) for s in w] + [1] * (width - len(w)) for w in wanted], dtype=np.int64)
        most = np.array([[high * s // 100 for s in w] + [0] * (width - len(w)) for w in wanted], dtype=np.int64)
        best = [Best(len(own), k) for _ in range(width)]
        for first, n, at, score in _scored(anchors, candidates):
            other = label[at][:, None] != own_label[None, first:first + n]
            some = [c[at] for c in keys]
            for p in range(width):
                best[p].offer(score, other & (score >= least[first:first + n, p]) & (score <= most[first:first + n, p]), some, first)
        for p, b in enumerate(best):
            b.rows[0] = b.rows[0] * width + p
        best[0].rows = np.concatenate([b.rows for b in best], axis=1)
        return _found(best[0], width, own)
    met = in_blocks(rows, anchors, ["dim"])
    found = common.by_group(met.select("grp", "chunk", *SIDES), ["dim", "grp", "chunk"], fn, FOUND)
    return _ranked(found, ["anchor", "place"], k)


def mine(vectors: DataFrame, is_anchor: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score of every anchor and positive.

    ``is_anchor`` is a condition on ``vec_id`` and ``label``.
    """
    rows = prepare(vectors, is_anchor)
    best = common.written(positives(rows, n_positives), "negatives-positives")
    found = negatives(rows, best, n_negatives, low, high)
    given = best.select("anchor", (F.col("rank") - 1).cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = rows.filter("anchor").select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(given, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
