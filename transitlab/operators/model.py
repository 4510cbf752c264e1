"""Delay models on ``pyspark.ml`` (M1-M9): split, fit, evaluate, explain, save, load, score."""
from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting, forest
from .ranks import repeated, running_sum

# Model settings of the two model types and the metric thresholds (minutes).
RANDOM_FOREST = dict(numTrees=100, maxDepth=20, seed=42)
BOOSTED_TREES = dict(maxIter=100, stepSize=0.1, maxDepth=6, seed=42)
WITHIN_MINUTES = (1, 2, 5)
MODEL_TYPES = ("random_forest", "boosted_trees")
# the boosted-tree option is also accepted under the name callers of the original used for it
MODEL_TYPE_ALIASES = {"xgboost": "boosted_trees"}
DEFAULT_MODEL_NAME = "delay_model"


def split_fraction(cols: Sequence[str], seed: int = 42) -> Column:
    """A stable number in [0, 1) per row from a 64-bit hash of ``cols`` and ``seed``.

    The same rows get the same split on every run and any partitioning; no shuffle is needed.
    """
    h = F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))
    return F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)


def clean_training_rows(df: DataFrame, feature_cols: Sequence[str], target_col: str = "delay_minutes"
                        ) -> DataFrame:
    """M1 first half: drop rows with a missing target or feature."""
    return df.na.drop(subset=[target_col, *feature_cols])


def prepare_data(df: DataFrame, feature_cols: Sequence[str], target_col: str = "delay_minutes",
                 test_size: float = 0.2, seed: int = 42, key_cols: Sequence[str] | None = None,
                 exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """M1: clean, then split into (train, test).

    Default (``exact=True``): exactly ``ceil(test_size * n)`` rows in test, the rows with the smallest hashes
    (see ``exact_hash_split``; five passes over one hash column). ``exact=False``: each row goes to test when
    its hash fraction is below ``test_size`` -- one pass, no shuffle, about ``test_size`` of the rows. ``key_cols`` (default: every column)
    decides which rows hash together.
    """
    clean = clean_training_rows(df, feature_cols, target_col)
    if exact:
        return exact_hash_split(clean, test_size, seed, key_cols)
    u = split_fraction(list(key_cols or clean.columns), seed)
    marked = clean.withColumn("_u", u)
    return (marked.filter(F.col("_u") >= test_size).drop("_u"),
            marked.filter(F.col("_u") < test_size).drop("_u"))


_RADIX_BITS, _ROUNDS = 16, 4


def exact_hash_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
                     key_cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Exactly ``ceil(test_size * n)`` rows to test: those with the smallest 64-bit row hash.

    The k-th smallest hash is found by a radix search: four passes, each counting rows per 16-bit digit
    under the digits fixed so far (a ``groupBy`` with at most 65,536 groups; those counts are all the
    driver sees). Rows below that hash go to test, rows above to train. Rows that share the threshold hash
    are identical rows (or, rarely, a 64-bit collision); they are reduced to (row, copies) and the
    remaining test places are handed out as copy counts, so no tied group is ever gathered in one task.
    """
    cols = list(df.columns)
    hashed = df.withColumn("_k", F.xxhash64(*[F.col(c) for c in (key_cols or cols)], F.lit(seed)))
    k, prefix, rank = _radix_rank(hashed, test_size)
    if k is None:                                   # every row is a test row
        return hashed.limit(0).drop("_k"), hashed.drop("_k")
    if k == 0:
        return hashed.drop("_k"), hashed.limit(0).drop("_k")
    # the radix search ran on the sign-flipped hash; the same threshold on the signed hash is U - 2^63
    t = prefix - (1 << 63)
    below, above = hashed.filter(F.col("_k") < t), hashed.filter(F.col("_k") > t)
    # rank = how many rows of the tie group still belong to test (1 <= rank <= size of the group)
    tied = hashed.filter(F.col("_k") == t).groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    # the distinct tied rows in the order of all columns, with a running sum of their copies over ranges: no task holds them all
    reached = running_sum(tied, cols, "_m", "_upto")
    tied = reached.withColumn("_take", F.least(F.greatest(F.lit(rank) - (F.col("_upto") - F.col("_m")), F.lit(0)), F.col("_m")))
    taken, left = (tied.select(*cols, n.alias("_copies")) for n in (F.col("_take"), F.col("_m") - F.col("_take")))
    test = below.select(*cols).unionByName(repeated(taken, "_copies").select(*cols))
    train = above.select(*cols).unionByName(repeated(left, "_copies").select(*cols))
    return train, test


def _radix_rank(hashed: DataFrame, test_size: float):
    """Number of test rows ``k``, the unsigned 64-bit value U of the k-th smallest sign-flipped hash, and the
    rank of the k-th row inside the group sharing that value. ``k`` is None when every row is a test row."""
    import math
    from pyspark import StorageLevel
    # flip the sign bit so that unsigned digit order equals the signed order of the hash
    keys = hashed.select(F.col("_k").bitwiseXOR(F.lit(-(1 << 63))).alias("_h")) \
        .persist(StorageLevel.MEMORY_AND_DISK)   # one long per row, for the count and four passes
    try:
        n = keys.count()
        k = math.ceil(test_size * n)
        if k >= n:
            return None, 0, 0
        if k <= 0:
            return 0, 0, 0
        prefix, rank = 0, k
        for r in range(_ROUNDS):
            shift = 64 - _RADIX_BITS * (r + 1)
            digit = F.shiftrightunsigned("_h", shift).bitwiseAND(F.lit((1 << _RADIX_BITS) - 1))
            part = keys if r == 0 else keys.filter(F.shiftrightunsigned("_h", shift + _RADIX_BITS) == F.lit(prefix))
            counts = sorted((row[0], row[1]) for row in part.groupBy(digit.alias("d")).count().collect())
            for d, c in counts:
                if rank <= c:
                    prefix = (prefix << _RADIX_BITS) | d
                    break
                rank -= c
        return k, prefix, rank
    finally:
        keys.unpersist()


def train_random_forest(train: DataFrame, feature_cols: Sequence[str], target_col: str = "delay_minutes",
                        n_estimators: int = 100, max_depth: int = 20, seed: int = 42) -> PipelineModel:
    """M2: random forest on bootstraps of all rows (``forest``); every feature is considered at every split."""
    from pyspark import StorageLevel
    # read for the bins and for their counts (memory and disk, so a lost executor recomputes its blocks instead of failing the fit)
    train = train.select(*feature_cols, target_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return forest.fit_forest(train, feature_cols, target_col, n_estimators, max_depth, seed)
    finally:
        train.unpersist()


def train_boosted_trees(train: DataFrame, feature_cols: Sequence[str], target_col: str = "delay_minutes",
                        n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 6,
                        seed: int = 42, **regularisation) -> PipelineModel:
    """M3: second-order boosted trees on histograms (``boosting``). All rows and features are used in every round, so the seed changes
    nothing; ``regularisation`` passes reg_lambda, gamma, min_child_weight and max_bins."""
    return boosting.fit_boosted(train, feature_cols, target_col, n_estimators, learning_rate, max_depth, **regularisation)


def regression_metrics(pred: DataFrame, label_col: str = "delay_minutes", prediction_col: str = "prediction"
                       ) -> DataFrame:
    """M4: mae, mse, rmse, r2, % within 1/2/5 minutes and the sample count, in one aggregation pass.

    r2 = 1 - SSE / SST with SST = n * var_pop(label).
    """
    y, p = F.col(label_col).cast("double"), F.col(prediction_col).cast("double")
    err = y - p
    n = F.count(F.lit(1))
    agg = pred.agg(n.alias("test_samples"), F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"),
                   F.sum(err * err).alias("_sse"), (F.var_pop(y) * n).alias("_sst"),
                   *[(F.avg((F.abs(err) <= m).cast("double")) * 100.0).alias(f"within_{m}min") for m in WITHIN_MINUTES])
    return agg.select("mae", "mse", F.sqrt("mse").alias("rmse"),
                      (F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2_score"),
                      *[f"within_{m}min" for m in WITHIN_MINUTES], "test_samples")


def evaluate(model: PipelineModel, test: DataFrame, target_col: str = "delay_minutes") -> DataFrame:
    return regression_metrics(model.transform(test), target_col, "prediction")


def feature_importance(spark: SparkSession, model: PipelineModel, feature_cols: Sequence[str]) -> DataFrame:
    """M5: (feature, importance) by importance descending. The vector has one entry per feature."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(list(feature_cols), [float(v) for v in imp]))
    return spark.createDataFrame(rows, "feature string, importance double") \
        .orderBy(F.desc("importance"), F.asc("feature"))


def save_model(spark: SparkSession, model: PipelineModel, model_dir: str, model_type: str,
               feature_cols: Sequence[str], training_stats: dict | None = None, name: str | None = None) -> str:
    """M6: write a timestamped copy and the default copy, each with a one-row metadata table."""
    trained_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    name = name or f"{model_type}_model_{trained_at:%Y%m%d_%H%M%S}"
    meta = spark.createDataFrame(
        [(model_type, trained_at, list(feature_cols), json.dumps(training_stats or {}))],
        "model_type string, trained_at timestamp, feature_names array<string>, training_stats string")
    for target in (name, DEFAULT_MODEL_NAME):
        base = f"{model_dir.rstrip('/')}/{target}"
        model.write().overwrite().save(f"{base}/model")
        meta.coalesce(1).write.mode("overwrite").json(f"{base}/metadata")
    return f"{model_dir.rstrip('/')}/{name}"


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    """M6: the fitted pipeline and its metadata row."""
    meta = spark.read.schema("model_type string, trained_at timestamp, feature_names array<string>, "
                             "training_stats string").json(f"{path.rstrip('/')}/metadata")
    return forest.load_pipeline(spark, f"{path.rstrip('/')}/model"), meta


def model_feature_names(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def predict(model: PipelineModel, df: DataFrame, feature_names: Sequence[str] | None = None) -> DataFrame:
    """M7: score a table (batch or stream). Every model input must be present; the error lists the missing.

    A single row still gives a table.
    """
    absent = sorted(set(feature_names or model_feature_names(model)).difference(df.columns))
    if absent:
        raise ValueError(f"the table lacks model inputs: {', '.join(absent)}")
    return model.transform(df).drop("features")


def model_info(meta: DataFrame | None) -> DataFrame | dict:
    """M8: the metadata row, or a status when no model is loaded."""
    if meta is None:
        return {"status": "no model"}
    return meta.select("model_type", "trained_at", "feature_names", "training_stats")


def train_and_evaluate(spark: SparkSession, df: DataFrame, feature_cols: Sequence[str],
                       target_col: str = "delay_minutes", model_type: str = "random_forest",
                       model_dir: str | None = None, **params) -> dict:
    """M9: split -> fit -> metrics -> importances -> save. Unknown model types are an error."""
    model_type = MODEL_TYPE_ALIASES.get(model_type, model_type)
    if model_type not in MODEL_TYPES:
        raise ValueError(f"model_type must be one of {MODEL_TYPES}, not {model_type!r}")
    from pyspark import StorageLevel
    # the split, the fit and the evaluation read the rows about ten times: kept in columns, so that a table of text is parsed once
    own = not (df.storageLevel.useMemory or df.storageLevel.useDisk)      # what the caller keeps stays kept
    df = df.persist(StorageLevel.MEMORY_AND_DISK) if own else df
    try:
        train, test = prepare_data(df, feature_cols, target_col)
        fit = train_random_forest if model_type == "random_forest" else train_boosted_trees
        model = fit(train, feature_cols, target_col, **params)
        metrics_row = evaluate(model, test, target_col).first().asDict()
    finally:
        if own:
            df.unpersist()
    importance = feature_importance(spark, model, feature_cols)
    path = None
    if model_dir:
        path = save_model(spark, model, model_dir, model_type, feature_cols, metrics_row)
    return {"model": model, "model_type": model_type, "metrics": metrics_row, "feature_importance": importance, "path": path}


def train_delay_model(spark: SparkSession, data_path: str, feature_cols: Sequence[str] | None = None,
                      model_type: str = "random_forest", target_col: str = "delay_minutes", fmt: str = "csv",
                      model_dir: str | None = None, **params) -> dict:
    """M9 from a written feature table: read (S17) -> split -> fit -> metrics -> importances -> save.

    Without ``feature_cols`` the features present in the table are used, in their fixed order.
    """
    from ..sources.training_csv import read_training_table
    from .features import feature_columns
    df = read_training_table(spark, data_path, target_col, fmt)
    return train_and_evaluate(spark, df, list(feature_cols or feature_columns(df, include_weather=True)), target_col, model_type,
                              model_dir, **params)
