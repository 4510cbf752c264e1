"""Random forest of regression trees from cells (M2): every tree on its own bootstrap of all rows, every feature at every split.

Rows with equal bins and target are counted together; how often a tree draws them is Poisson with that count as its mean, which is the sum of
the rows' own Poisson(1) draws. The draw comes from a hash of bins, target, tree and seed, so a forest does not depend on partitions. Per tree
the drawn rows of equal bins become one entry (weight, sum and sum of squares of the target: all that variance needs).

Nodes with more than ``LOCAL_ENTRIES`` entries are split level by level, by one aggregate over (tree, node, feature, bin). A node that has
fewer goes with its entries to one group and is grown to the end there, so no level of a deep tree costs a pass over the table.

The trees become a ``RandomForestRegressionModel`` of Spark ML (through its saved form), so scoring, saving and loading are Spark's own. That model is
one object on the driver, so a forest of more than ``DRIVER_NODES`` nodes stays a table in the same saved form (``ForestTable``): tasks walk
its trees one at a time, and neither the driver nor a task ever holds the whole forest.
"""
from __future__ import annotations

import json
import math
import sys
import time
import uuid
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.pipeline import PipelineSharedReadWrite
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.ml.util import MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import file_system, remove_folder, shared_dir
from .boosting import _MODEL_DEFAULTS, _NODE, _TREE_DEFAULTS, bin_edges

# what the tasks run travels to the workers as code, not as a module those would have to find
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 32                # of a feature, as before with Spark ML's learner
LOCAL_ENTRIES = 65_536       # entries of a node that one group holds at most
LEAST_GAIN = 1e-12           # of a node's sum of squares: below it a gain is rounding
DRIVER_NODES = 100_000       # of a forest that is Spark ML's object on the driver; a larger one stays a table
_NODE_COLS = "tree int, node long, w double, s double, q double, gain double, feature int, cut int"


def all_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """``bin_edges``, but a bin for every value, however rare, of a feature that has at most ``max_bins`` of them."""
    number = [F.col(c).cast("double") for c in features]
    about = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(number)]).first()
    few = [i for i in range(len(number)) if about[i] <= 2 * max_bins]
    row = df.agg(F.lit(0), *[F.collect_set(number[i]).alias(f"v{i}") for i in few]).first()
    exact = {i: sorted(set(row[f"v{i}"])) for i in few}
    rest = [i for i in range(len(number)) if len(exact.get(i, range(max_bins + 1))) > max_bins]
    wide = dict(zip(rest, bin_edges(df, [features[i] for i in rest], max_bins))) if rest else {}
    return [wide[i] if i in wide else exact[i][1:] for i in range(len(number))]


def to_counts(df: DataFrame, features: Sequence[str], target: str, edges: list[list[float]]) -> DataFrame:
    """``_b0``, ``_b1``... (bins), ``_y`` (target) and ``n``: how many rows have these."""
    names = [f"_b{i}" for i in range(len(features))]
    df = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)], F.col(target).cast("double").alias("_y"))
    some = [i for i, e in enumerate(edges) if e]
    if some:
        inf = float("inf")
        df = Bucketizer(splitsArray=[[-inf, *edges[i], inf] for i in some], inputCols=[f"_x{i}" for i in some],
                        outputCols=[names[i] for i in some]).transform(df)
    bins = [(F.col(n) if edges[i] else F.lit(0)).cast("int").alias(n) for i, n in enumerate(names)]
    return df.select(*bins, "_y").groupBy(*names, "_y").agg(F.count(F.lit(1)).alias("n"))


def poisson(u, mean: int):
    """The Poisson counts with this mean that uniform numbers ``u`` stand for."""
    import numpy as np
    spread = 12 * math.sqrt(mean) + 24
    low, high = max(0, math.floor(mean - spread)), math.ceil(mean + spread)
    k = np.arange(low, high + 1)
    # log of the probabilities relative to the first, then to the largest: neither overflows
    logp = np.concatenate([[0.0], np.cumsum(math.log(mean) - np.log(k[1:]))])
    p = np.exp(logp - logp.max())
    return low + np.minimum(np.searchsorted(np.cumsum(p) / p.sum(), u, side="right"), high - low)


def uniform(h, trees):
    """Numbers in [0, 1) for every row hash (int64) and tree: a 64-bit mix of both."""
    import numpy as np
    x = h.astype("uint64")[:, None] + (trees.astype("uint64") + np.uint64(1))[None, :] * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype("float64") / float(1 << 53)


def drawn(counts: DataFrame, n_features: int, n_trees: int, seed: int) -> DataFrame:
    """(tree, bins, w, s, q) of every tree's bootstrap. ``counts`` comes from ``to_counts``."""
    names = [f"_b{i}" for i in range(n_features)]
    hashed = counts.select(*names, "_y", "n", F.xxhash64(*names, "_y", F.lit(seed)).alias("h"))
    # equal bins stand together, so that a batch sums them; a hot combination of bins goes to several ranges by its targets
    dealt = hashed.repartitionByRange(*names, "_y").sortWithinPartitions(*names, "_y")
    schema = "tree int, " + ", ".join(f"{n} int" for n in names) + ", w double, s double, q double"

    def draw(batches):
        import numpy as np
        import pyarrow as pa
        trees = np.arange(n_trees)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                cols = [part.column(i).to_numpy(zero_copy_only=False) for i in range(n_features + 3)]
                bins, y, n, h = np.stack(cols[:n_features], axis=1), cols[-3], cols[-2], cols[-1]
                u, w = uniform(h, trees), np.empty((len(y), n_trees))
                for mean in np.unique(n):
                    w[n == mean] = poisson(u[n == mean], int(mean))
                starts = np.flatnonzero(np.r_[True, (bins[1:] != bins[:-1]).any(axis=1)])
                sums = [np.add.reduceat(w * v[:, None], starts, axis=0) for v in (np.ones(len(y)), y, y * y)]
                cell, tree = np.nonzero(sums[0])
                kept = bins[starts][cell]
                made = [pa.array(tree, pa.int32()), *[pa.array(kept[:, i], pa.int32()) for i in range(n_features)],
                        *[pa.array(x[cell, tree], pa.float64()) for x in sums]]
                yield pa.RecordBatch.from_arrays(made, names=["tree", *names, "w", "s", "q"])
    return dealt.mapInArrow(draw, schema).groupBy("tree", *names).agg(*[F.sum(c).alias(c) for c in "wsq"])


def best_splits(node, columns, w, s, n_nodes: int):
    """(gain, feature, cut) of every node: the largest drop of the sum of squared errors, by rows' node numbers and one column of bins a feature.

    Equal gains (but for rounding) go to the first feature and bin; without a split the gain is 0 and the feature -1.
    """
    import numpy as np
    gain, feature, cut = np.zeros(n_nodes), np.full(n_nodes, -1), np.zeros(n_nodes, dtype="int64")
    total_w, total_s = (np.bincount(node, x, n_nodes) for x in (w, s))
    whole = total_s ** 2 / np.maximum(total_w, 1e-300)
    for f, (rows, bins) in enumerate(columns):
        here, ws, ss = node[rows], w[rows], s[rows]
        order = np.lexsort((bins, here))
        k, b = here[order], bins[order]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.array([], dtype="int64")
        sums = [np.cumsum(x[order]) for x in (ws, ss)]
        # less what came before the node's first row
        before = [np.repeat(np.r_[0.0, c][first], np.diff(np.r_[first, len(k)])) for c in sums]
        left_w, left_s = (c - x for c, x in zip(sums, before))
        ends = np.flatnonzero((k[1:] == k[:-1]) & (b[1:] != b[:-1])) if len(k) else first
        if not len(ends):
            continue
        at, lw, ls = k[ends], left_w[ends], left_s[ends]
        drop = ls ** 2 / lw + (total_s[at] - ls) ** 2 / np.maximum(total_w[at] - lw, 1e-300) - whole[at]
        start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        top = np.maximum.reduceat(drop, start)
        close = np.flatnonzero(drop >= np.repeat(top - 1e-9 * np.abs(top), np.diff(np.r_[start, len(at)])))
        chosen = close[np.r_[True, at[close][1:] != at[close][:-1]]]
        nodes = at[chosen]
        better = drop[chosen] > gain[nodes] * (1 + 1e-9)
        nodes, chosen = nodes[better], chosen[better]
        gain[nodes], feature[nodes], cut[nodes] = drop[chosen], f, b[ends[chosen]]
    return gain, feature, cut


def grow(start: int, bins, w, s, q, max_node: int):
    """The subtree under node ``start`` (heap number) from its entries; columns of ``_NODE_COLS`` after ``tree``. Nodes from ``max_node`` on are leaves."""
    import numpy as np
    out, ids, node = [], np.array([start], dtype="int64"), np.zeros(len(w), dtype="int64")
    while len(ids):
        n = len(ids)
        total_w, total_s, total_q = (np.bincount(node, x, n) for x in (w, s, q))
        if ids[0] < max_node:
            every = slice(None)
            gain, feature, cut = best_splits(node, [(every, bins[:, f]) for f in range(bins.shape[1])], w, s, n)
        else:
            gain, feature, cut = np.zeros(n), np.full(n, -1), np.zeros(n, dtype="int64")
        feature = np.where(gain > LEAST_GAIN * total_q, feature, -1)
        out.append((ids, total_w, total_s, total_q, gain, feature, cut))
        split = feature >= 0
        kept = split[node]
        bins, w, s, q, node = bins[kept], w[kept], s[kept], q[kept], node[kept]
        right = bins[np.arange(len(w)), feature[node]] > cut[node]
        place = np.cumsum(split) - 1
        node = place[node] * 2 + right
        ids = np.stack([ids[split] * 2, ids[split] * 2 + 1], axis=1).ravel()
    return [np.concatenate(c) for c in zip(*out)]


def _table(tree: int, columns):
    import numpy as np
    import pyarrow as pa
    types = (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.int32())
    names = ("node", "w", "s", "q", "gain", "feature", "cut")
    return pa.table({"tree": pa.array(np.full(len(columns[0]), tree), pa.int32()), **{k: pa.array(c, t) for k, c, t in zip(names, columns, types)}})


def grow_forest(entries: DataFrame, n_features: int, max_depth: int, written, removed, local_entries: int = LOCAL_ENTRIES) -> DataFrame:
    """All nodes of all trees (``_NODE_COLS``). ``written(df, name)`` writes a table and reads it back, ``removed(name)`` deletes one."""
    names, max_node = [f"_b{i}" for i in range(n_features)], 1 << max_depth
    places = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def finish(table):
        import numpy as np
        col = {c: table.column(c).to_numpy() for c in ("tree", "node", "w", "s", "q")}
        bins = np.stack([table.column(n).to_numpy() for n in names], axis=1)
        # in one order whatever the shuffle's, so that sums round alike on every run
        order = np.lexsort(bins.T)
        return _table(col["tree"][0], grow(int(col["node"][0]), bins[order], *[col[c][order] for c in "wsq"], max_node))

    def choose(table):
        """The one node of the sums by (feature, bin), at most features x bins rows."""
        import numpy as np
        feature, bins, w, s, q = (table.column(c).to_numpy() for c in ("feature", "bin", "w", "s", "q"))
        one = [(np.flatnonzero(feature == f), bins[feature == f]) for f in range(n_features)]
        total = [np.array([x[one[0][0]].sum()]) for x in (w, s, q)]
        node = table.column("node").to_numpy()[:1]
        gain, best, cut = np.zeros(1), np.array([-1]), np.zeros(1, dtype="int64")
        if node[0] < max_node:
            # the totals of every feature are the node's: weigh each feature's rows alone
            for f, (rows, b) in enumerate(one):
                g, hit, c = best_splits(np.zeros(len(rows), dtype="int64"), [(slice(None), b)], w[rows], s[rows], 1)
                if hit[0] == 0 and g[0] > gain[0] * (1 + 1e-9) and g[0] > LEAST_GAIN * total[2][0]:
                    gain, best, cut = g, np.array([f]), c
        return _table(table.column("tree").to_numpy()[0], (node, *total, gain, best, cut))

    made, level, now = None, 0, entries.withColumn("node", F.lit(1).cast("long"))
    while True:
        sizes = now.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("_size"))
        big = written(sizes.filter(F.col("_size") > local_entries).select("tree", "node"), f"big-{level}")
        any_big = not big.isEmpty()
        small = now.join(big, ["tree", "node"], "left_anti") if any_big else now
        # a set number of partitions: the groups are few rows and much work
        done = written(small.repartition(places, "tree", "node").groupBy("tree", "node").applyInArrow(finish, _NODE_COLS), f"nodes-{level}")
        made = done if made is None else made.unionByName(done)
        if not any_big:
            return made
        large = written(now.join(big, ["tree", "node"], "left_semi"), f"large-{level}")
        if level:
            removed(f"below-{level - 1}")
        sums = large.select("tree", "node", F.posexplode(F.array(*names)).alias("feature", "bin"), "w", "s", "q") \
            .groupBy("tree", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "wsq"])
        splits = written(sums.groupBy("tree", "node").applyInArrow(choose, _NODE_COLS), f"splits-{level}")
        made = made.unionByName(splits)
        right = F.element_at(F.array(*names), F.col("feature") + 1) > F.col("cut")
        now = written(large.join(splits.filter("feature >= 0").select("tree", "node", "feature", "cut"), ["tree", "node"])
                      .select("tree", (F.col("node") * 2 + right.cast("long")).alias("node"), *names, "w", "s", "q"), f"below-{level}")
        removed(f"large-{level}")
        level += 1


def _threshold(feature: Column, cut: Column, edges: list[list[float]]) -> Column:
    """The largest number that goes left: just below the lower edge of the bin on the right."""
    under = F.array(*[F.array(*[F.lit(math.nextafter(x, -math.inf)) for x in e]).cast("array<double>") for e in edges])
    return F.element_at(F.element_at(under, feature + 1), cut + 1)


def spark_nodes(nodes: DataFrame, edges: list[list[float]]) -> DataFrame:
    """The nodes as Spark ML saves them: numbered from 0 within a tree, -1 for no child."""
    numbered = nodes.withColumn("id", F.row_number().over(Window.partitionBy("tree").orderBy("node")) - 1)
    # children of a node stand beside each other in this order
    left = numbered.select("tree", (F.col("node") / 2).cast("long").alias("node"), F.col("id").alias("_left"), (F.col("node") % 2).alias("_side")) \
        .filter("_side = 0 AND node > 0").drop("_side")
    mean, has = F.col("s") / F.col("w"), F.col("feature") >= 0
    none = F.lit(-1)
    split = F.struct(F.when(has, F.col("feature")).otherwise(none).alias("featureIndex"),
                     F.when(has, F.array(_threshold(F.col("feature"), F.col("cut"), edges))).otherwise(F.array().cast("array<double>"))
                     .alias("leftCategoriesOrThreshold"), none.alias("numCategories"))
    data = F.struct("id", mean.alias("prediction"), F.greatest(F.lit(0.0), F.col("q") / F.col("w") - mean * mean).alias("impurity"),
                    F.array("w", "s", "q").alias("impurityStats"), F.col("w").cast("long").alias("rawCount"),
                    F.when(has, F.col("gain") / F.col("w")).otherwise(F.lit(-1.0)).alias("gain"),
                    F.when(has, F.col("_left")).otherwise(none).alias("leftChild"),
                    F.when(has, F.col("_left") + 1).otherwise(none).alias("rightChild"), split.alias("split"))
    return numbered.join(left, ["tree", "node"], "left").select(F.col("tree").alias("treeID"), data.alias("nodeData"))


def walk(columns, x):
    """The prediction that a tree's ``columns`` (by node id: feature, threshold, left, right, prediction) give each row of ``x``."""
    import numpy as np
    feature, threshold, left, right, prediction = columns
    at, rows = np.zeros(len(x), dtype="int64"), np.arange(len(x))
    while True:
        here = feature[at]
        inner = here >= 0
        if not inner.any():
            return prediction[at]
        at = np.where(inner, np.where(x[rows, here] <= threshold[at], left[at], right[at]), at)


class ForestTable(Model, MLWritable):
    """A saved ``RandomForestRegressionModel`` as the table it is: what the driver holds does not grow with the trees. Scores are Spark's, bit for bit."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path.rstrip("/")
        self.meta = json.loads(spark.read.text(f"{self.path}/metadata").first()[0])
        self.settings = {**self.meta["defaultParamMap"], **self.meta["paramMap"]}
        self._resetUid(self.meta["uid"])

    @property
    def data(self) -> DataFrame:
        return self.spark.read.schema(_NODE).parquet(f"{self.path}/data")

    @property
    def getNumTrees(self) -> int:
        return self.meta["numTrees"]

    @property
    def numFeatures(self) -> int:
        return self.meta["numFeatures"]

    @property
    def totalNumNodes(self) -> int:
        return self.data.count()

    @property
    def featureImportances(self) -> DenseVector:
        """Spark's: gain times rows by feature, each tree's adding up to 1, then all."""
        n = F.col("nodeData")
        sums = self.data.filter(n["split"]["featureIndex"] >= 0).groupBy("treeID", n["split"]["featureIndex"].alias("feature")) \
            .agg(F.sum(n["gain"] * n["impurityStats"][0]).alias("gain"))
        trees: dict[int, dict[int, float]] = {}
        for tree, feature, gain in sums.collect():               # a row a tree and feature at most
            trees.setdefault(tree, {})[feature] = gain
        out = [0.0] * self.numFeatures
        for _, gains in sorted(trees.items()):
            whole = sum(gains.values())
            for feature, gain in gains.items():
                out[feature] += gain / whole if whole else 0.0
        whole = sum(out)
        return DenseVector([v / whole if whole else 0.0 for v in out])

    def spark_model(self) -> RandomForestRegressionModel:
        """Spark ML's object, which holds all trees on the driver."""
        return RandomForestRegressionModel.load(self.path)

    @property
    def toDebugString(self) -> str:
        return self.spark_model().toDebugString

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if dataset.isStreaming:                                  # a stream is read once, so the trees have to go to its rows
            return self.spark_model().transform(dataset)
        xs, n_trees = [f"_x{i}" for i in range(self.numFeatures)], self.getNumTrees
        values, n = vector_to_array(F.col(self.settings["featuresCol"])), F.col("nodeData")
        rows = dataset.withColumns({x: values[i] for i, x in enumerate(xs)})
        nodes = self.data.select(F.col("treeID").alias("tree"), F.struct(
            n["id"].alias("id"), n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"),
            n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("prediction")).alias("node"))
        # rows of equal features are asked for once, of every tree
        asked = rows.select(*xs).distinct().select(F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"), F.array(*xs).alias("x"))

        def reach(batches):
            import numpy as np
            import pyarrow as pa
            now, parts, columns = None, [], None
            for batch in batches:
                if not batch.num_rows:
                    continue
                tree, is_node = batch.column(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (is_node[1:] != is_node[:-1])])
                for a, b in zip(starts, np.r_[starts[1:], len(tree)]):
                    if tree[a] != now:
                        now, parts, columns = tree[a], [], None
                    if is_node[a]:
                        parts.append([c.to_numpy(zero_copy_only=False) for c in batch.column(1).slice(a, b - a).flatten()])
                        continue
                    if columns is None:
                        ids, *rest = (np.concatenate(c) for c in zip(*parts))
                        order, parts = np.argsort(ids), []
                        columns = [c[order] for c in rest]
                    x = batch.column(2).slice(a, b - a).flatten().to_numpy().reshape(b - a, -1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, now), pa.int32()), pa.array(walk(columns, x), pa.float64()),
                                                      *[pa.array(c) for c in x.T.copy()]], names=["tree", "p", *xs])
        # a tree's nodes stand before what is asked of it: a task holds one tree and a batch
        places = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = nodes.unionByName(asked, allowMissingColumns=True).repartition(places, "tree").sortWithinPartitions("tree", F.col("node").isNull())
        reached = dealt.mapInArrow(reach, "tree int, p double, " + ", ".join(f"{x} double" for x in xs))
        # added in the order of the trees, as Spark does
        each = F.array_sort(F.collect_list(F.struct("tree", "p")))
        scores = reached.groupBy(*xs).agg((F.aggregate(each, F.lit(0.0), lambda a, v: a + v["p"]) / n_trees).alias("_score"))
        changed = F.raise_error(F.lit("the rows to score were others when read again: write the table first")).cast("double")
        return rows.join(scores, xs, "left").select(*[F.col(f"`{c}`") for c in dataset.columns],
                                                    F.coalesce("_score", changed).alias(self.settings["predictionCol"]))

    def copied(self, path: str) -> None:
        self.data.write.parquet(f"{path}/data")
        self.spark.read.parquet(f"{self.path}/treesMetadata").coalesce(1).write.parquet(f"{path}/treesMetadata")
        self.spark.read.text(f"{self.path}/metadata").coalesce(1).write.text(f"{path}/metadata")

    def write(self) -> MLWriter:
        return _TableWriter(self)


class _TableWriter(MLWriter):
    """Writes a forest table, or a pipeline that ends in one, as Spark ML would have; the trees go from table to table."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance
        self.table = instance.stages[-1] if isinstance(instance, PipelineModel) else instance

    def save(self, path: str) -> None:
        spark, table = self.table.spark, self.table
        whole = [f"{fs.makeQualified(p).toString()}/" for fs, p in (file_system(spark, x) for x in (table.path, path))]
        if whole[0].startswith(whole[1]):                        # saved over itself: its own files would be deleted first
            kept = shared_dir(spark, "forest", f"model-{uuid.uuid4().hex}")
            table.copied(kept)
            table.path = kept
        super().save(path)

    def saveImpl(self, path: str) -> None:
        if self.instance is self.table:
            return self.table.copied(path)
        stages, spark = self.instance.stages, self.table.spark
        meta = {"class": "org.apache.spark.ml.PipelineModel", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                "uid": self.instance.uid, "paramMap": {"stageUids": [s.uid for s in stages]}, "defaultParamMap": {}}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        for i, s in enumerate(stages):
            s.write().save(PipelineSharedReadWrite.getStagePath(s.uid, i, len(stages), f"{path}/stages"))


class TablePipeline(PipelineModel):
    """A fitted pipeline that ends in a forest table."""

    def write(self) -> MLWriter:
        return _TableWriter(self)

    def copy(self, extra=None) -> PipelineModel:
        return TablePipeline([s.copy(extra or {}) for s in self.stages])


def load_pipeline(spark: SparkSession, path: str) -> PipelineModel:
    """A saved pipeline; a forest of more than ``DRIVER_NODES`` nodes at its end stays a table."""
    def meta_of(folder):
        return json.loads(spark.read.text(f"{folder}/metadata").first()[0])
    uids = meta_of(path)["paramMap"]["stageUids"]
    folders = [PipelineSharedReadWrite.getStagePath(uid, i, len(uids), f"{path}/stages") for i, uid in enumerate(uids)]
    kinds = [meta_of(f)["class"].rsplit(".", 1)[-1] for f in folders]
    if kinds == ["VectorAssembler", "RandomForestRegressionModel"]:
        n, categories = spark.read.schema(_NODE).parquet(f"{folders[1]}/data").agg(F.count(F.lit(1)), F.max("nodeData.split.numCategories")).first()
        if n > DRIVER_NODES and categories < 0:
            return TablePipeline([VectorAssembler.load(folders[0]), ForestTable(spark, folders[1])])
    return PipelineModel.load(path)


def fit_forest(train: DataFrame, features: Sequence[str], target: str, n_trees: int = 100, max_depth: int = 20, seed: int = 42,
               max_bins: int = MAX_BINS, local_entries: int = LOCAL_ENTRIES) -> PipelineModel:
    """Bins, bootstraps, trees and the model, behind an assembler of the raw features. An empty table is an error."""
    spark, features = train.sparkSession, list(features)
    root = shared_dir(spark, "forest", uuid.uuid4().hex)
    made = shared_dir(spark, "forest", f"model-{uuid.uuid4().hex}")

    def written(df, name):
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")
    edges = all_edges(train, features, max_bins)
    counts = written(to_counts(train, features, target, edges), "counts")
    n_rows, *sums = counts.agg(F.sum("n").cast("double"), F.sum(F.col("n") * F.col("_y")), F.sum(F.col("n") * F.col("_y") * F.col("_y"))).first()
    if not n_rows:
        raise ValueError("no training rows")
    entries = written(drawn(counts, len(features), n_trees, seed), "entries")
    nodes = grow_forest(entries, len(features), max_depth, written, lambda name: remove_folder(spark, f"{root}/{name}"), local_entries)
    # a tree whose bootstrap is empty (tables of very few rows) holds the mean of all rows
    lone = spark.range(n_trees).select(F.col("id").cast("int").alias("tree")).join(nodes.filter("node = 1").select("tree"), "tree", "left_anti") \
        .select("tree", F.lit(1).cast("long").alias("node"), *[F.lit(float(x)).alias(c) for c, x in zip("wsq", (n_rows, *sums))], F.lit(0.0).alias("gain"),
                F.lit(-1).alias("feature"), F.lit(0).alias("cut"))
    spark_nodes(nodes.unionByName(lone), edges).select(F.col("treeID").cast("int"), F.col("nodeData").cast(_NODE.split("nodeData ")[1]).alias("nodeData")) \
        .write.parquet(f"{made}/data")
    now = int(time.time() * 1000)

    def saved(kind, params, **more):
        return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}RegressionModel", "timestamp": now, "sparkVersion": spark.version,
                           "uid": f"{kind.lower()}_{uuid.uuid4().hex[:12]}", "paramMap": params, **more})
    metas = [(i, saved("DecisionTree", {"maxDepth": max_depth, "seed": seed}, defaultParamMap=_TREE_DEFAULTS), 1.0) for i in range(n_trees)]
    spark.createDataFrame(metas, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{made}/treesMetadata")
    defaults = {k: v for k, v in _MODEL_DEFAULTS.items() if k not in ("lossType", "maxIter", "stepSize", "validationTol")}
    meta = saved("RandomForest", {"featuresCol": "features", "labelCol": target, "predictionCol": "prediction", "maxDepth": max_depth, "numTrees": n_trees,
                                  "seed": seed, "maxBins": max_bins, "featureSubsetStrategy": "all"},
                 defaultParamMap={**defaults, "bootstrap": True, "numTrees": 20}, numFeatures=len(features), numTrees=n_trees)
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{made}/metadata")
    remove_folder(spark, root)
    assembler, table = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"), ForestTable(spark, made)
    if table.totalNumNodes > DRIVER_NODES:
        return TablePipeline([assembler, table])
    model = table.spark_model()
    remove_folder(spark, made)
    return PipelineModel(stages=[assembler, model])
