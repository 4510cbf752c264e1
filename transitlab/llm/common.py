"""Helpers that several operators share: shipping the package, shared tables, row maps, components."""
from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application (as ``--py-files`` would)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    # only the driver reads this file; Spark's own file server hands it to the executors
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="transitlab-py-")), "transitlab_package.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared location."""
    return shared_dir(spark, "llm", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts lineage and survives lost executors."""
    return written_at(df, scratch(df.sparkSession, name))


def written_at(df: DataFrame, path: str) -> DataFrame:
    """``written`` under a path of the caller's, who removes it when nothing reads it any more."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SLICE_BYTES = 1 << 20


def slices(batch, column: str = "text", size: int = SLICE_BYTES) -> Iterator:
    """The batch in runs of rows that hold about ``size`` bytes of text, so that what Python makes of a run (lists of
    ids, words, spans) stays small; a longer text is a run of its own."""
    k = batch.schema.get_field_index(column)
    if k < 0:
        yield batch
        return
    import pyarrow.compute as pc
    first, total = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(k)).to_pylist()):
        if total and total + (n or 0) > size:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n or 0
    if first < batch.num_rows:
        yield batch.slice(first)


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``fn(record batch) -> record batch or None`` over Arrow batches (bounded by rows and bytes); no shuffle."""
    ship(df.sparkSession)

    def run(batches: Iterator):
        for b in batches:
            for part in slices(b) if b.num_rows else ():
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def by_group(df: DataFrame, keys: list[str], fn: Callable, schema) -> DataFrame:
    """``fn(arrow table of one group) -> record batch or None`` for every key; one shuffle and a sort inside tasks.

    A group is held in memory as a whole, so callers split groups into blocks of bounded size first.
    """
    ship(df.sparkSession)

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        pending, current = [], None

        def flush():
            out = fn(pa.Table.from_batches(pending)) if pending else None
            return out if out is not None and out.num_rows else None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(b.schema.get_field_index(k)) for k in keys]
            change = np.zeros(b.num_rows, dtype=bool)
            for c in cols:
                v = c.to_numpy(zero_copy_only=False)
                change[1:] |= v[1:] != v[:-1]
            cuts = [0, *change.nonzero()[0].tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                key = tuple(c[lo].as_py() for c in cols)
                if key != current:
                    if (out := flush()) is not None:
                        yield out
                    pending, current = [], key
                pending.append(b.slice(lo, hi - lo))
        if (out := flush()) is not None:
            yield out
    # the number of partitions is left to the session and to run-time coalescing
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def batch_of(schema, columns: list):
    """A record batch with the given Spark schema from Python lists (or Arrow/NumPy arrays)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(schema)
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, target)]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def texts_of(batch, name: str = "text") -> list[str]:
    """The text column as Python strings; null counts as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def blocks(df: DataFrame, group: str, count: str, member: str, size: int) -> DataFrame:
    """Deals a group of ``count`` members out as blocks: ``block`` numbers a pair of parts (one part: 0).

    Parts are chosen by the member's hash; a member of part p goes to the pairs (p, q) for every q. ``part`` is its own.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col(count) / size)).cast("int")
    df = df.withColumn("_parts", parts).withColumn("part", F.pmod(F.xxhash64(F.col(member), F.lit(3)), F.col("_parts")).cast("int"))
    q = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    low, high = F.least(F.col("part"), F.col("_q")), F.greatest(F.col("part"), F.col("_q"))
    return df.withColumn("_q", q).withColumn("block", (low * F.col("_parts") + high).cast("long")).drop("_q", "_parts")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; component = the smallest node reachable.

    ``edges`` has columns ``a`` and ``b`` of one orderable type. Alternates the two star operations of Kiveris
    et al. ("Connected components in MapReduce and beyond"): every round hangs neighbours on the smallest
    node known, written to the shared folder; it ends when a round changes nothing. The neighbour minima are
    combined map-side, so a hub ships one row per task, and written before they are joined: both sides of that join are
    plain tables then, whose skewed partitions AQE can split. Nothing is collected.
    """
    a, b = F.col("a"), F.col("b")
    cur = written(edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
                  "edges")

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    state = mark(cur)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        # larger neighbours hang on the smallest node of the neighbourhood
        both = cur.select("a", "b").unionByName(cur.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("_m")) \
            .select(F.col("a").alias("_n"), F.least("a", "_m").alias("_m"))
        low = written(low, "edges-low")
        large = both.join(low, both["a"] == low["_n"]).filter(F.col("b") > F.col("a")) \
            .select(F.col("b").alias("a"), F.col("_m").alias("b")).filter(a != b).distinct()
        # smaller neighbours and the node itself hang on the smallest of them
        large = written(large, "edges-large")
        low2 = written(large.groupBy("a").agg(F.min("b").alias("_m")).withColumnRenamed("a", "_n"), "edges-low")
        small = large.join(low2, large["a"] == low2["_n"]).select(
            F.explode(F.array(F.struct(F.col("b").alias("x")), F.struct(F.col("a").alias("x")))).alias("_x"),
            F.col("_m").alias("b")).select(F.col("_x.x").alias("a"), "b").filter(a != b).distinct()
        cur = written(small, "edges-small")
        new = mark(cur)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return cur.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node") \
        .unionByName(cur.select(b.alias("node"), b.alias("component")).distinct())
