"""Second-order gradient boosting of regression trees by histograms (M3).

Feature values are put into bins between quantiles of a mergeable sketch, one aggregate for all features. Rows with equal bins are one cell from
then on (count and sum of the target: all the squared error needs), so the rows are read once and a hot combination is one row. A tree grows level
by level: one aggregate (arrays inside tasks, then a shuffle of their sums) sums gradients and hessians by (node, feature, bin), and the split with the best regularised gain is chosen from those
sums, of which there are at most 2^depth x features x bins. Leaves get the second-order optimum, shrunk by the learning rate.

The fitted trees become a ``GBTRegressionModel`` of Spark ML (through its saved form), so scoring, saving and loading are Spark's own, in the JVM.
"""
from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel, cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_folder, shared_dir

# what the tasks run travels to the workers as code, not as a module those would have to find
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The usual settings of the boosted-tree option beside rounds, rate and depth (penalty on leaf weights, least gain of a split,
# least hessian of a child, bins of a feature).
REG_LAMBDA, GAMMA, MIN_CHILD_WEIGHT, MAX_BINS = 1.0, 0.0, 1.0, 256
SKETCH_ACCURACY = 100        # relative rank error of the quantile sketch: 1 / (accuracy * bins)
MAX_PARTITIONS = 64          # partitions in which the sums of a level are combined (they are bounded by the parameters)
PAST_ALL = 1 << 30           # a bin beyond every bin: all rows go left
ROUNDS_WRITTEN = 8           # after so many rounds the predictions are written; until then tasks follow these trees


@dataclass
class Tree:
    """One tree by heap numbers (children of k: 2k and 2k + 1): splits of inner nodes, weights and covers of all."""
    feature: dict[int, int] = field(default_factory=dict)
    cut: dict[int, int] = field(default_factory=dict)          # rows whose bin is at most this go left
    gain: dict[int, float] = field(default_factory=dict)
    weight: dict[int, float] = field(default_factory=dict)     # before shrinking
    cover: dict[int, float] = field(default_factory=dict)


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """For each feature the ascending lower edges of its bins but the first: approximate quantiles, all of them for few distinct values."""
    shares = [i / max_bins for i in range(max_bins + 1)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, SKETCH_ACCURACY * max_bins).alias(f"q{i}") for i, c in enumerate(features)],
                 *[F.min(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return [sorted({v for v in (row[f"q{i}"] or []) if v > row[f"m{i}"]}) for i in range(len(features))]


def to_cells(df: DataFrame, features: Sequence[str], target: str, edges: list[list[float]]) -> DataFrame:
    """bins (one number a feature), n and total (rows and sum of the target): rows with equal bins together, combined map-side."""
    names = [f"_b{i}" for i in range(len(features))]
    df = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)], F.col(target).cast("double").alias("_y"))
    some = [i for i, e in enumerate(edges) if e]
    if some:
        inf = float("inf")
        df = Bucketizer(splitsArray=[[-inf, *edges[i], inf] for i in some], inputCols=[f"_x{i}" for i in some],
                        outputCols=[names[i] for i in some]).transform(df)
    bins = [F.col(n).cast("int") if edges[i] else F.lit(0) for i, n in enumerate(names)]
    return df.select(*[b.alias(n) for b, n in zip(bins, names)], "_y").groupBy(*names) \
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("_y").alias("total")) \
        .select(F.array(*names).alias("bins"), "n", "total")


class Paths:
    """A grown tree as arrays, which tasks follow: feature and cut by heap number, weight of the leaf above every node of the last level."""

    def __init__(self, tree: Tree, levels: int, rate: float | None = None):
        import numpy as np
        self.levels = levels
        self.feature = np.array([tree.feature.get(k, 0) for k in range(1 << levels)], dtype=np.int64)
        self.cut = np.array([tree.cut.get(k, PAST_ALL) for k in range(1 << levels)], dtype=np.int64)
        self.leaf = None if rate is None else rate * np.array(leaf_weights(tree, levels))

    def node(self, bins):
        """The heap number each row of ``bins`` reaches; below a leaf everything goes left."""
        import numpy as np
        at, rows = np.ones(len(bins), dtype=np.int64), np.arange(len(bins))
        for _ in range(self.levels):
            at = at * 2 + (bins[rows, self.feature[at]] > self.cut[at])
        return at

    def added(self, bins):
        """What the tree adds to the prediction of each row."""
        return self.leaf[self.node(bins) - (1 << self.levels)]


def _columns(batch, shift: float, done: list[Paths]):
    """(bins as a matrix, n, total, prediction) of a batch of cells: the stored prediction, ``shift`` and the trees in ``done``."""
    n, total, pred = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
    bins = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(n), -1)
    pred = pred + shift
    for tree in done:
        pred = pred + tree.added(bins)
    return bins, n, total, pred


def histograms(cells: DataFrame, tree: Tree, level: int, shift: float = 0.0, done: list[Paths] | None = None) -> tuple:
    """(node, feature, bin, gradient, hessian) arrays of one level: the one aggregate of the level. A task sums its cells into arrays of
    at most nodes x features x bins numbers, the tasks' sums are added by a shuffle."""
    paths, done = Paths(tree, level), done or []

    def add(batches):
        import numpy as np
        import pyarrow as pa
        g = h = np.zeros((1 << level, 1, 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, n, total, pred = _columns(batch, shift, done)
            size = (1 << level, bins.shape[1], max(int(bins.max()) + 1, g.shape[2]))
            if g.shape != size:
                wide = [np.zeros(size) for _ in "gh"]
                for new, old in zip(wide, (g, h)):
                    new[:, :old.shape[1], :old.shape[2]] = old
                g, h = wide
            base = (paths.node(bins) - (1 << level)) * size[1]
            grad = n * pred - total
            for f in range(size[1]):
                key = (base + f) * size[2] + bins[:, f]
                g += np.bincount(key, grad, g.size).reshape(size)
                h += np.bincount(key, n, h.size).reshape(size)
        node, feature, at = np.nonzero(h)
        yield pa.RecordBatch.from_arrays([pa.array(node + (1 << level), pa.int32()), pa.array(feature, pa.int32()), pa.array(at, pa.int32()),
                                          pa.array(g[node, feature, at]), pa.array(h[node, feature, at])], names=["node", "feature", "bin", "g", "h"])
    sums = cells.mapInArrow(add, "node int, feature int, bin int, g double, h double") \
        .groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    table = sums.toArrow()
    return tuple(table.column(c).to_numpy() for c in ("node", "feature", "bin", "g", "h"))


def with_trees(cells: DataFrame, shift: float, done: list[Paths]) -> DataFrame:
    """The cells with ``shift`` and the trees in ``done`` in their stored prediction."""
    def add(batches):
        import pyarrow as pa
        for batch in batches:
            if batch.num_rows:
                pred = _columns(batch, shift, done)[3]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(pred)], names=["bins", "n", "total", "pred"])
    return cells.mapInArrow(add, cells.schema)


def grow_level(tree: Tree, sums: tuple, reg_lambda: float, gamma: float, min_child_weight: float) -> bool:
    """Chooses the best split of every node of the level; False if none has one. Equal gains (but for rounding) go to the first feature and bin."""
    import numpy as np
    node, feature, bins, g, h = sums
    grown = False
    order = np.lexsort((bins, feature, node))
    node, feature, bins, g, h = (x[order] for x in (node, feature, bins, g, h))
    for k in np.unique(node):
        at = node == k
        if k > 1 and int(k) // 2 not in tree.feature:
            continue                                  # below a leaf
        f, b, gk, hk = feature[at], bins[at], g[at], h[at]
        first = f == f[0]
        total_g, total_h = float(gk[first].sum()), float(hk[first].sum())
        tree.weight[int(k)], tree.cover[int(k)] = -total_g / (total_h + reg_lambda), total_h
        best = None
        for one in np.unique(f):
            mine = f == one
            left_g, left_h = np.cumsum(gk[mine])[:-1], np.cumsum(hk[mine])[:-1]
            right_g, right_h = total_g - left_g, total_h - left_h
            gain = 0.5 * (left_g ** 2 / (left_h + reg_lambda) + right_g ** 2 / (right_h + reg_lambda) - total_g ** 2 / (total_h + reg_lambda)) - gamma
            gain[(left_h < min_child_weight) | (right_h < min_child_weight)] = -np.inf
            if len(gain):
                i = int(np.flatnonzero(gain >= gain.max() - 1e-9 * max(1.0, abs(gain.max())))[0]) if np.isfinite(gain.max()) else 0
                if gain[i] > 1e-9 and (best is None or gain[i] > best[0] + 1e-9 * max(1.0, best[0])):
                    best = (float(gain[i]), int(one), int(b[mine][i]), float(left_g[i]), float(left_h[i]))
        if best:
            tree.gain[int(k)], tree.feature[int(k)], tree.cut[int(k)], left_g, left_h = best
            # the children's sums are known now, so the last level needs no aggregate of its own
            for child, cg, ch in ((2 * int(k), left_g, left_h), (2 * int(k) + 1, total_g - left_g, total_h - left_h)):
                tree.weight[child], tree.cover[child] = -cg / (ch + reg_lambda), ch
            grown = True
    return grown


def leaf_weights(tree: Tree, levels: int) -> list[float]:
    """Weight of the leaf above (or at) every node of the last level."""
    out = []
    for k in range(1 << levels, 2 << levels):
        while k > 1 and k // 2 not in tree.feature:
            k //= 2
        out.append(tree.weight[k])
    return out


def fit_trees(cells: DataFrame, rounds: int, rate: float, depth: int, reg_lambda: float = REG_LAMBDA, gamma: float = GAMMA,
              min_child_weight: float = MIN_CHILD_WEIGHT) -> tuple[float, float, list[Tree]]:
    """(rows, mean of the target, trees). ``cells`` comes from ``to_cells``; without any it is an error."""
    spark = cells.sparkSession
    root = shared_dir(spark, "boosting", uuid.uuid4().hex)
    # a session of the fit's own for its many small aggregates: their groups are bounded, so few partitions do at every size
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")

    def written(df, name):
        """A table of its own every few rounds: tasks follow few trees, and a lost executor repeats few at most."""
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return own.read.schema(df.schema).parquet(f"{root}/{name}").persist(StorageLevel.MEMORY_AND_DISK)
    now, last = written(cells.withColumn("pred", F.lit(0.0)), "cells"), "cells"
    own.conf.set("spark.sql.shuffle.partitions", str(max(2, min(MAX_PARTITIONS, len(now.inputFiles()) // 4))))
    try:
        n, total = now.agg(F.sum("n"), F.sum("total")).first()
        if not n:
            raise ValueError("no training rows")
        base, trees, done = total / n, [], []
        shift = base                                   # added to the stored prediction: the mean until the first write
        for r in range(rounds):
            tree, levels = Tree(), 0
            while levels < depth:
                if not grow_level(tree, histograms(now, tree, levels, shift, done), reg_lambda, gamma, min_child_weight):
                    break
                levels += 1
            trees.append(tree)
            done.append(Paths(tree, levels, rate))
            if len(done) == ROUNDS_WRITTEN and r + 1 < rounds:
                before, now = now, written(with_trees(now, shift, done), f"round={r}")
                before.unpersist()
                remove_folder(spark, f"{root}/{last}")
                shift, done, last = 0.0, [], f"round={r}"
        return n, base, trees
    finally:
        now.unpersist()
        remove_folder(spark, root)


def _preorder(tree: Tree, edges: list[list[float]], index: int) -> list[tuple]:
    """The nodes of one tree as Spark ML saves them: numbered from the top, left before right, -1 for no child."""
    import math
    rows: list = []

    def add(k: int) -> int:
        at = len(rows)
        rows.append(None)
        stats, weight = [tree.cover[k], tree.cover[k] * tree.weight[k], 0.0], tree.weight[k]
        if k in tree.feature:
            # values below the right side's lower edge go left
            threshold = math.nextafter(edges[tree.feature[k]][tree.cut[k]], -math.inf)
            left, right = add(2 * k), add(2 * k + 1)
            rows[at] = (index, (at, weight, 0.0, stats, int(tree.cover[k]), tree.gain[k] / max(tree.cover[k], 1.0), left, right,
                                (tree.feature[k], [threshold], -1)))
        else:
            rows[at] = (index, (at, weight, 0.0, stats, int(tree.cover[k]), -1.0, -1, -1, (-1, [], -1)))
        return at
    add(1)
    return rows


# The defaults that Spark ML writes beside a saved tree and a saved boosted model.
_TREE_DEFAULTS = {"cacheNodeIds": False, "checkpointInterval": 10, "featuresCol": "features", "impurity": "variance", "labelCol": "label", "leafCol": "",
                  "maxBins": 32, "maxDepth": 5, "maxMemoryInMB": 256, "minInfoGain": 0.0, "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0,
                  "predictionCol": "prediction", "seed": 0}
_MODEL_DEFAULTS = {**_TREE_DEFAULTS, "featureSubsetStrategy": "all", "lossType": "squared", "maxIter": 20, "stepSize": 0.1, "subsamplingRate": 1.0,
                   "validationTol": 0.01}
_NODE = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,"
         "rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def as_spark_model(spark: SparkSession, base: float, trees: list[Tree], edges: list[list[float]], n_rows: float, rate: float, depth: int,
                   n_features: int, target: str) -> GBTRegressionModel:
    """The trees as a ``GBTRegressionModel``: the mean as a tree of one leaf with weight 1, the others weighted by the rate."""
    path = shared_dir(spark, "boosting", f"model-{uuid.uuid4().hex}")
    version, now = spark.version, int(time.time() * 1000)
    mean = Tree(weight={1: base}, cover={1: float(n_rows)})
    rows = [r for i, t in enumerate([mean, *trees]) for r in _preorder(t, edges, i)]
    spark.createDataFrame(rows, _NODE).coalesce(1).write.parquet(f"{path}/data")
    tree_meta = [(i, json.dumps({"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "timestamp": now, "sparkVersion": version,
                                 "uid": f"dtr_{uuid.uuid4().hex[:12]}", "paramMap": {"maxDepth": depth}, "defaultParamMap": _TREE_DEFAULTS}), 1.0 if i == 0 else rate)
                 for i in range(len(trees) + 1)]
    spark.createDataFrame(tree_meta, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    meta = {"class": "org.apache.spark.ml.regression.GBTRegressionModel", "timestamp": now, "sparkVersion": version, "uid": f"gbt_{uuid.uuid4().hex[:12]}",
            "paramMap": {"featuresCol": "features", "labelCol": target, "predictionCol": "prediction", "maxDepth": depth, "maxIter": len(trees),
                         "stepSize": rate}, "defaultParamMap": _MODEL_DEFAULTS, "numFeatures": n_features, "numTrees": len(trees) + 1}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return GBTRegressionModel.load(path)


def fit_boosted(train: DataFrame, features: Sequence[str], target: str, rounds: int = 100, rate: float = 0.1, depth: int = 6,
                reg_lambda: float = REG_LAMBDA, gamma: float = GAMMA, min_child_weight: float = MIN_CHILD_WEIGHT, max_bins: int = MAX_BINS) -> PipelineModel:
    """Bins, trees and the Spark model, behind an assembler of the raw features. An empty table is an error."""
    features = list(features)
    edges = bin_edges(train, features, max_bins)
    cells = to_cells(train, features, target, edges)
    n, base, trees = fit_trees(cells, rounds, rate, depth, reg_lambda, gamma, min_child_weight)
    model = as_spark_model(train.sparkSession, base, trees, edges, n, rate, depth, len(features), target)
    return PipelineModel(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"), model])
