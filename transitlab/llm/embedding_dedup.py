"""Near-duplicate embeddings: links between vectors of one label whose cosine is 0.98 or more.

Every vector is turned by one random rotation into ``bits`` dimensions and kept as the signs there (RaBitQ codes) with its
correction factor, the inner product of the unit vector and its code. For a code c with factor f and an exact unit
vector q, <c, q> / f is an unbiased estimate of the cosine, and its error stays below
``CONFIDENCE`` * sqrt((1 - f^2) / f^2 / (bits - 1)) but for a vanishing chance. Pairs whose upper bound reaches the threshold, in
both directions, are recomputed exactly in double precision; nothing else is linked, and nothing is linked on an estimate.

Candidates come from bands (``BANDS`` of ``BAND_BITS`` bits, each bit from a random plane of its own): a pair at cosine 0.98
differs in 6.4 % of its bits and misses every band with a chance of about 1e-6; unrelated vectors meet with one of 2^-16 a band.
Equal vectors form a class that stands for them. Links of a bucket join classes into components; inside a component every
pair is compared, in pairs of blocks of bounded size, so links are counted without giving out pairs.

Defined results: rows whose label is null, or whose vector is null, empty, zero or holds null or non-finite values, link
with nothing (their component is their own id). Vectors of different lengths never link. Repeated rows link with each other.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

THRESHOLD = 0.98
BITS = 256                  # code length; longer vectors use the next multiple of 64
BANDS, BAND_BITS = 32, 16
BAND_ROWS = 2048            # vectors whose band bits are made at once
CONFIDENCE = 6.0
BUCKET_BLOCK = 2048
BLOCK = 1024
SEED = 20240521

_ROTATIONS: dict[int, object] = {}
_PLANES: dict[int, object] = {}


def bits_of(dim: int) -> int:
    return max(BITS, -(-dim // 64) * 64)


def rotation(dim: int):
    """``bits`` x ``dim`` matrix with orthonormal columns: a random rotation of the zero-padded vector."""
    if dim not in _ROTATIONS:
        import numpy as np
        q, r = np.linalg.qr(np.random.RandomState(SEED + dim).standard_normal((bits_of(dim), dim)))
        _ROTATIONS[dim] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim]


def planes(dim: int):
    """The normals of the band bits: independent of each other and of the rotation."""
    if dim not in _PLANES:
        import numpy as np
        _PLANES[dim] = np.random.RandomState([SEED, dim]).standard_normal((BANDS * BAND_BITS, dim))
    return _PLANES[dim]


def band_values(units):
    """(rows, bands) numbers of ``BAND_BITS`` bits, the sides of the planes on which each unit vector lies."""
    import numpy as np
    bits = (units @ planes(units.shape[1]).T >= 0).reshape(len(units), BANDS, BAND_BITS)
    return (bits.astype(np.uint64) << np.arange(BAND_BITS, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def encode(units):
    """(signs, factors) of unit vectors: their code bits and the inner product of each with its own code."""
    import numpy as np
    y = units @ rotation(units.shape[1]).T
    return y >= 0, np.abs(y).sum(axis=1) / np.sqrt(y.shape[1])


def may_reach(units, signs, factors, threshold: float = THRESHOLD, rows=None):
    """Matrix of the pairs (``rows``, all) whose upper confidence bounds both reach the threshold."""
    import numpy as np
    rows = np.arange(len(units)) if rows is None else rows
    bits = signs.shape[1]
    y = units @ rotation(units.shape[1]).T
    code = np.where(signs, 1.0, -1.0) / np.sqrt(bits)
    error = CONFIDENCE * np.sqrt(np.maximum(0.0, 1 - factors ** 2) / factors ** 2 / (bits - 1))
    upper = (code @ y[rows].T).T / factors + error                          # codes of all, exact rows
    other = (code[rows] @ y.T) / factors[rows, None] + error[rows, None]    # codes of the rows, exact others
    return (upper >= threshold) & (other >= threshold)


def links_of(units, signs, factors, rows, threshold: float = THRESHOLD):
    """Boolean matrix (rows, all) of the exact links: candidates by their bounds, then cosines in double precision."""
    import numpy as np
    i, j = np.nonzero(may_reach(units, signs, factors, threshold, rows))
    good = np.zeros((len(rows), len(units)), dtype=bool)
    for lo in range(0, len(i), 65536):
        a, b = i[lo:lo + 65536], j[lo:lo + 65536]
        good[a, b] = np.einsum("nd,nd->n", units[rows[a]], units[b]) >= threshold
    return good


CODED = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("cls", T.BinaryType()), T.StructField("grp", T.StringType()),
                      T.StructField("dim", T.IntegerType()),
                      T.StructField("unit", T.BinaryType()), T.StructField("code", T.BinaryType()), T.StructField("factor", T.DoubleType())])


def codes(vectors: DataFrame) -> DataFrame:
    """vec_id, class (128-bit hash of group and vector; null if it links with nothing), group (label and length), unit
    vector, code and factor."""
    def fn(batch):
        import math

        import numpy as np
        import xxhash
        ids, labels = batch.column(0), batch.column(2).to_pylist()
        out = [[None] * batch.num_rows for _ in range(6)]
        by_dim: dict[int, list] = {}
        for r, (v, label) in enumerate(zip(batch.column(1).to_pylist(), labels)):
            if v and label is not None and None not in v and all(map(math.isfinite, v)) and any(v):
                by_dim.setdefault(len(v), []).append((r, v))
        for dim, found in by_dim.items():
            raw = np.array([v for _, v in found], dtype=np.float64) + 0.0       # -0.0 becomes 0.0
            scaled = raw / np.abs(raw).max(axis=1, keepdims=True)               # squares cannot overflow or vanish
            units = scaled / np.sqrt((scaled ** 2).sum(axis=1, keepdims=True))
            signs, factors = encode(units)
            packed = np.packbits(signs, axis=1)
            for k, (r, _) in enumerate(found):
                grp = f"{labels[r]!r}/{dim}"
                for c, x in zip(out, (xxhash.xxh3_128_digest(grp.encode() + raw[k].tobytes()), grp, dim, units[k].tobytes(),
                                      packed[k].tobytes(), float(factors[k]))):
                    c[r] = x
        return common.batch_of(CODED, [ids, *out])
    return common.map_batches(vectors.select(F.col("vec_id").cast("long"), "embedding", "label"), fn, CODED)


KEYS = T.StructType([T.StructField("key", T.LongType()), T.StructField("cls", T.BinaryType())])
EDGES = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
LINKS = T.StructType([T.StructField("cls", T.BinaryType()), T.StructField("links", T.LongType()), T.StructField("root", T.BinaryType())])


def _band_keys(classes: DataFrame) -> DataFrame:
    def fn(batch):
        import numpy as np
        import pyarrow as pa
        keys, owner = [], []
        group = batch.column(3).to_numpy()
        dims = np.array(batch.column(2).to_pylist())
        raw = batch.column(1).to_pylist()
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            value = np.concatenate([
                band_values(np.frombuffer(b"".join(raw[r] for r in some), dtype=np.float64).reshape(len(some), dim))
                for some in np.split(rows, range(BAND_ROWS, len(rows), BAND_ROWS))])
            value = (value + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            value = (value ^ (value >> np.uint64(31)) ^ group[rows].view(np.uint64)[:, None]) * np.uint64(0xD6E8FEB86659FD93)
            keys.append((value ^ (value >> np.uint64(32))).view(np.int64).ravel())
            owner.append(np.repeat(rows, BANDS))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), batch.column(0).take(pa.array(np.concatenate(owner)))], names=KEYS.names)
    return common.map_batches(classes.select("cls", "unit", "dim", F.xxhash64("grp")), fn, KEYS)


def _arrays(table):
    import numpy as np
    n, dim = table.num_rows, table.column("dim")[0].as_py()
    units = np.frombuffer(b"".join(table.column("unit").to_pylist()), dtype=np.float64).reshape(n, dim)
    packed = np.frombuffer(b"".join(table.column("code").to_pylist()), dtype=np.uint8).reshape(n, -1)
    return table.column("cls").to_pylist(), units, np.unpackbits(packed, axis=1).astype(bool), table.column("factor").to_numpy()


def _candidate_edges(classes: DataFrame, threshold: float) -> DataFrame:
    """A spanning forest of the exact links met in buckets (equal buckets of several bands are compared once)."""
    keys = _band_keys(classes)
    h = F.xxhash64("cls")
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 8)).alias("s")) \
        .filter("m > 1")
    buckets = common.written(buckets.groupBy("m", "x", "s").agg(F.min("key").alias("key")).select("key", "m"), "vec-buckets")
    member = common.written(keys.join(buckets, "key"), "vec-members")
    # labels and lengths are part of the group: a hash of them that met by chance must not mix them
    rows = common.blocks(member, "key", "m", "cls", BUCKET_BLOCK).select("key", "block", "cls") \
        .join(classes.select("cls", "grp", "dim", "unit", "code", "factor"), "cls")

    def fn(table):
        import numpy as np
        cls, units, signs, factors = _arrays(table)
        left, a, b = np.arange(len(cls)), [], []
        while len(left) > 1:
            queue, left = [int(left[0])], left[1:]
            while queue and len(left):
                one = queue.pop()
                hit = left[links_of(units[[one, *left]], signs[[one, *left]], factors[[one, *left]], np.array([0]), threshold)[0, 1:]]
                if len(hit):
                    a += [cls[one]] * len(hit)
                    b += [cls[i] for i in hit]
                    queue.extend(hit.tolist())
                    left = np.setdiff1d(left, hit, assume_unique=True)
        return common.batch_of(EDGES, [a, b]) if a else None
    return common.by_group(rows.select("key", "grp", "block", "cls", "dim", "unit", "code", "factor"), ["key", "grp", "block"], fn, EDGES)


def _counted(classes: DataFrame, component: DataFrame, threshold: float) -> DataFrame:
    """Per class and block of its component: vectors linked to it, and its root in the block's spanning forest."""
    size = component.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    member = component.join(size, "component").join(classes, component["node"] == classes["cls"]).drop("node")
    rows = common.blocks(common.written(member, "vec-components"), "component", "m", "cls", BLOCK) \
        .select("component", "block", "part", "cls", "dim", "n", "unit", "code", "factor")

    def fn(table):
        import numpy as np
        cls, units, signs, factors = _arrays(table)
        part, n = table.column("part").to_numpy(), table.column("n").to_numpy()
        good = links_of(units, signs, factors, np.arange(len(cls)), threshold)
        good |= good.T
        np.fill_diagonal(good, False)
        if len(set(part.tolist())) > 1:
            good &= part[:, None] != part[None, :]
        forest = common.Forest(len(cls))
        for i, j in zip(*np.nonzero(np.triu(good))):
            forest.join(int(i), int(j))
        return common.batch_of(LINKS, [cls, (good @ n).astype(int).tolist(), [cls[forest.root(i)] for i in range(len(cls))]])
    return common.by_group(rows, ["component", "block"], fn, LINKS)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable) and kept."""
    coded = common.written(codes(vectors), "vec-codes")
    classes = coded.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("min_id"),
        *[F.first(c).alias(c) for c in ("grp", "dim", "unit", "code", "factor")])
    classes = common.written(classes, "vec-classes")
    component = common.connected_components(_candidate_edges(classes, threshold))
    found = common.written(_counted(classes, component, threshold), "vec-links")
    total = found.groupBy("cls").agg(F.sum("links").alias("links")).withColumnRenamed("cls", "_c")
    final = common.connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "_n")
    full = classes.select("cls", "n", "min_id").join(total, F.col("cls") == F.col("_c"), "left") \
        .join(final, F.col("cls") == F.col("_n"), "left") \
        .select("cls", "n", "min_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "cls").alias("component"))
    full = common.written(full, "vec-full")
    least = full.groupBy("component").agg(F.min("min_id").alias("component_id")).withColumnRenamed("component", "_k")
    full = common.written(full.join(least, F.col("component") == F.col("_k")).select(F.col("cls").alias("_c"), "n", "links", "component_id"), "vec-result")
    out = coded.select("vec_id", "cls").join(full, F.col("cls") == F.col("_c"), "left")
    component_id = F.when(F.col("_c").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce(F.col("n") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
                      component_id.alias("component_id"), F.col("vec_id").eqNullSafe(component_id).alias("kept"))
