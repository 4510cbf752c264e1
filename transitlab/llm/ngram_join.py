"""Similarity join of documents on the Jaccard index of their word shingles (five words, 0.8 or more).

Documents with equal shingle sets form a class, which stands for all of them from then on. Classes that share a band of
MinHash values meet in a bucket. Candidates are pruned by the Bayesian test of BayesLSH: MinHash values are compared
``STEP`` at a time, and a pair is dropped as soon as the posterior probability that its similarity reaches the
threshold falls below ``TOLERANCE`` (uniform prior). Survivors only link classes into candidate components; inside each
component every pair goes through the test again and what survives is verified exactly on the shingle sets. Buckets
and components beyond a block's size are dealt out as pairs of blocks, so no task holds an unbounded group; pairs
stay inside tasks, which give out links per class and a spanning forest. Buckets with the same members (near
copies meet in most bands) are compared once.

Misses: a pair exactly at 0.8 shares none of ``BANDS`` bands of ``ROWS`` values with probability (1 - 0.8^4)^32 = 5e-8, and
the test drops it with probability of the order of ``TOLERANCE``.

Words are runs of letters and digits, lower case. A text of one to four words is one shingle. Defined results: null
texts and texts without words link with nothing (class_id is their own id, 0 links). Repeated rows count as
documents of their own; null doc_ids take part, and a component's id is its smallest non-null doc_id.
"""
from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP, TOLERANCE = 16, 1e-6
BUCKET_BLOCK = 4096         # classes of one bucket in a block (256 bytes each)
BLOCK = 512                 # classes of one component in a block, with their shingles
WORD = re.compile(r"[^\W_]+")
CACHE_WORDS = 250_000


class WordHashes(dict):
    """word -> 64-bit hash; starts anew when full."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = WordHashes()


def shingles(text: str, words: int = WORDS):
    """Sorted distinct 64-bit hashes of the text's word shingles (empty without words)."""
    import numpy as np
    found = WORD.findall(text.lower())
    if not found:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(_HASHES.__getitem__, found), dtype=np.uint64, count=len(found))
    k = min(words, len(w))
    h = np.zeros(len(w) - k + 1, dtype=np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i:len(w) - k + 1 + i]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return np.unique(h)


def _coefficients(n: int):
    import numpy as np
    rnd = np.random.RandomState(20240229)
    return (rnd.randint(0, 2 ** 31, n).astype(np.uint32) * np.uint32(2) + np.uint32(1), rnd.randint(0, 2 ** 31, n).astype(np.uint32))


_AB = None


def minhash(sh):
    """``HASHES`` 16-bit MinHash values of a shingle set."""
    import numpy as np
    global _AB
    if _AB is None:
        _AB = _coefficients(HASHES)
    a, b = _AB
    x = (sh >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(x), 2048):
        np.minimum(low, (x[lo:lo + 2048, None] * a + b).min(axis=0), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, fewest matches that keep a pair): below, P(similarity >= threshold | matches) < tolerance.

    With a uniform prior the posterior after m matches of k is Beta(m + 1, k - m + 1), whose upper tail at the threshold
    is the probability that a binomial of k + 1 trials gives at most m.
    """
    out = []
    for k in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(k + 1, m) * threshold ** m * (1 - threshold) ** (k + 1 - m)
        out.append((k, m))
    return out


def survivors(sigs, sizes, one: int, others, threshold: float = THRESHOLD, rules=None):
    """Those of ``others`` that may reach the threshold with ``one``: size bound first, then the incremental test."""
    import numpy as np
    n = sizes[one]
    left = others[(np.minimum(sizes[others], n) >= threshold * np.maximum(sizes[others], n))]
    matches = np.zeros(len(left), dtype=np.int32)
    done = 0
    for k, least in rules or least_matches(threshold):
        if not len(left):
            break
        matches += (sigs[left, done:k] == sigs[one, done:k]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        left, matches, done = left[keep], matches[keep], k
    return left


SIGNED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()),
                       T.StructField("cls", T.BinaryType()), T.StructField("size", T.IntegerType()), T.StructField("sig", T.BinaryType())])


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, hash of the text, class (128-bit hash of the shingle set; null without words), set size and MinHash values."""
    def fn(batch):
        import xxhash
        cls, size, sig = [], [], []
        for t in common.texts_of(batch):
            sh = shingles(t, words)
            cls.append(xxhash.xxh3_128_digest(sh.tobytes()) if len(sh) else None)
            size.append(len(sh))
            sig.append(minhash(sh).tobytes() if len(sh) else None)
        return common.batch_of(SIGNED, [batch.column(0), batch.column(1), cls, size, sig])
    return common.map_batches(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), fn, SIGNED)


KEYS = T.StructType([T.StructField("key", T.LongType()), T.StructField("cls", T.BinaryType())])
EDGES = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _band_keys(classes: DataFrame) -> DataFrame:
    def fn(batch):
        import numpy as np
        import pyarrow as pa
        cls = batch.column(0)
        sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(len(cls), BANDS, ROWS)
        key = np.ascontiguousarray(sigs).view(np.uint64).reshape(len(cls), BANDS)
        # the band is part of the key: a band's four 16-bit values, mixed with the band's own constant
        key = (key ^ (np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        rows = np.repeat(np.arange(len(cls)), BANDS)
        return pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), cls.take(pa.array(rows))], names=KEYS.names)
    return common.map_batches(classes.select("cls", "sig"), fn, KEYS)


def candidate_edges(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A spanning forest of the pairs that survive the Bayesian test in some bucket."""
    keys = _band_keys(classes)
    # a bucket is known by how many members it has and by two sums over their hashes; equal buckets are compared once
    h = F.xxhash64("cls")
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 8)).alias("s")) \
        .filter("m > 1")
    buckets = common.written(buckets.groupBy("m", "x", "s").agg(F.min("key").alias("key")).select("key", "m"), "join-buckets")
    member = common.written(keys.join(buckets, "key"), "join-members")
    rows = common.blocks(member, "key", "m", "cls", BUCKET_BLOCK).select("key", "block", "cls") \
        .join(classes.select("cls", "size", "sig"), "cls")

    def fn(table):
        import numpy as np
        cls = table.column("cls").to_pylist()
        sizes = table.column("size").to_numpy()
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint16).reshape(len(cls), HASHES)
        rules, left, a, b = least_matches(threshold), np.arange(len(cls)), [], []
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                one = queue.pop()
                hit = survivors(sigs, sizes, one, left, threshold, rules)
                if len(hit):
                    a += [cls[one]] * len(hit)
                    b += [cls[i] for i in hit]
                    queue.extend(hit.tolist())
                    left = np.setdiff1d(left, hit, assume_unique=True)
        return common.batch_of(EDGES, [a, b]) if a else None
    return common.by_group(rows.select("key", "block", "cls", "size", "sig"), ["key", "block"], fn, EDGES)


SETS = T.StructType([T.StructField("cls", T.BinaryType()), T.StructField("shingles", T.BinaryType())])
LINKS = T.StructType([T.StructField("cls", T.BinaryType()), T.StructField("links", T.LongType()), T.StructField("classes", T.LongType()),
                      T.StructField("root", T.BinaryType())])


def exact_similar(sigs, sizes, sets, part, block: int, threshold: float = THRESHOLD):
    """Symmetric boolean matrix of the pairs of this block whose exact similarity reaches the threshold."""
    import numpy as np
    n = len(sizes)
    may, rules = np.zeros((n, n), dtype=bool), least_matches(threshold)
    everyone = np.arange(n)
    for i in range(n - 1):
        may[i, survivors(sigs, sizes, i, everyone[i + 1:], threshold, rules)] = True
    if len(set(part.tolist())) > 1:
        may &= part[:, None] != part[None, :]       # pairs inside one part belong to that part's own block
    rows = np.flatnonzero(may.any(axis=0) | may.any(axis=1))
    good = np.zeros((n, n), dtype=bool)
    if not len(rows):
        return good
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    _, word, often = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    use = often[word] > 1
    owner, word = owner[use], word[use]
    order = np.argsort(word, kind="stable")
    owner, word = owner[order], word[order]
    shared = np.zeros((len(rows), len(rows)), dtype=np.float64)
    first = 0
    while first < len(word):
        # incidence of up to 2048 shingles at a time, so the matrix stays small whatever the texts' length
        last = np.searchsorted(word, word[first] + 2048)
        inc = np.zeros((len(rows), 2048), dtype=np.float32)
        inc[owner[first:last], word[first:last] - word[first]] = 1
        shared += inc @ inc.T
        first = last
    union = sizes[rows][:, None] + sizes[rows][None, :] - shared
    hit = (shared >= threshold * union - 1e-9) & may[np.ix_(rows, rows)]
    good[np.ix_(rows, rows)] = hit | hit.T
    return good


def _verified(docs: DataFrame, classes: DataFrame, component: DataFrame, words: int, threshold: float) -> DataFrame:
    """Per class and block: documents and classes linked to it (exactly), and the root of its spanning tree there."""
    size = component.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    member = component.join(size, "component").join(classes, component["node"] == classes["cls"]).drop("node")
    member = common.written(member, "join-components")
    # the texts of one document for each member class; only these documents' shingles are built again
    wanted = member.select(F.col("min_id").alias("_id"), F.col("min_hash").alias("_h"), F.col("cls").alias("_c"))
    text = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    text = text.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_h"))).select("_c", "text")

    def build(batch):
        sets = [shingles(t, words).tobytes() for t in common.texts_of(batch)]
        return common.batch_of(SETS, [batch.column(0), sets])
    sets = common.map_batches(text, build, SETS).groupBy("cls").agg(F.first("shingles").alias("shingles"))
    rows = common.blocks(member.join(sets, "cls"), "component", "m", "cls", BLOCK) \
        .select("component", "block", "part", "cls", "size", "n_docs", "sig", "shingles")

    def fn(table):
        import numpy as np
        cls = table.column("cls").to_pylist()
        sizes = table.column("size").to_numpy().astype(np.float64)
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint16).reshape(len(cls), HASHES)
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
        good = exact_similar(sigs, sizes, sets, table.column("part").to_numpy(), 0, threshold)
        forest = common.Forest(len(cls))
        for i, j in zip(*np.nonzero(np.triu(good))):
            forest.join(int(i), int(j))
        links = good @ table.column("n_docs").to_numpy()
        return common.batch_of(LINKS, [cls, links.astype(int).tolist(), good.sum(axis=1).tolist(), [cls[forest.root(i)] for i in range(len(cls))]])
    return common.by_group(rows, ["component", "block"], fn, LINKS)


def join(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD):
    """(documents, classes) as written tables.

    documents: doc_id, text_hash, cls. classes: cls, n_docs, links (documents linked to it in other classes), linked_classes,
    component (a class), keeper_id and keeper_hash (the component's smallest document).
    """
    signed = common.written(signatures(docs, words), "join-signatures")
    low = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")).alias("low")
    classes = signed.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.count(F.lit(1)).alias("n_docs"), low, F.first("size").alias("size"), F.first("sig").alias("sig")) \
        .select("cls", "n_docs", F.col("low.doc_id").alias("min_id"), F.col("low.text_hash").alias("min_hash"), "size", "sig")
    classes = common.written(classes, "join-classes")
    component = common.connected_components(candidate_edges(classes, threshold))
    found = common.written(_verified(docs, classes, component, words, threshold), "join-links")
    total = found.groupBy("cls").agg(F.sum("links").alias("links"), F.sum("classes").alias("linked_classes")).withColumnRenamed("cls", "_c")
    final = common.connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    final = final.withColumnRenamed("node", "_n")
    full = classes.drop("size", "sig").join(total, F.col("cls") == F.col("_c"), "left").join(final, F.col("cls") == F.col("_n"), "left") \
        .select("cls", "n_docs", "min_id", "min_hash", F.coalesce("links", F.lit(0)).alias("links"),
                F.coalesce("linked_classes", F.lit(0)).alias("linked_classes"), F.coalesce("component", "cls").alias("component"))
    full = common.written(full, "join-full")
    low = F.min(F.struct(F.col("min_id").isNull().alias("null"), F.col("min_id").alias("doc_id"), F.col("min_hash").alias("text_hash")))
    keeper = full.groupBy("component").agg(low.alias("k")) \
        .select(F.col("component").alias("_k"), F.col("k.doc_id").alias("keeper_id"), F.col("k.text_hash").alias("keeper_hash"))
    full = full.join(keeper, F.col("component") == F.col("_k")).drop("_k", "min_id", "min_hash")
    return signed.select("doc_id", "text_hash", "cls"), common.written(full, "join-result")


def similar_documents(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its component) and n_links (other documents it is
    linked to directly, copies included)."""
    rows, classes = join(docs, words, threshold)
    c = classes.select(F.col("cls").alias("_c"), "n_docs", "links", "keeper_id")
    return rows.join(c, F.col("cls") == F.col("_c"), "left").select(
        "doc_id", F.when(F.col("_c").isNull(), F.col("doc_id")).otherwise(F.col("keeper_id")).alias("class_id"),
        F.coalesce(F.col("n_docs") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does (the smallest doc_id; of repeated
    rows one). Rows without words stay. All columns, whatever their names."""
    rows, classes = join(docs, words, threshold)
    keep = classes.select("keeper_id", "keeper_hash").distinct()
    copies = rows.filter("cls IS NOT NULL").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    keep = keep.join(copies, F.col("keeper_id").eqNullSafe(F.col("doc_id")) & (F.col("keeper_hash") == F.col("text_hash"))) \
        .select("keeper_id", "keeper_hash", "copies")
    wordless = rows.filter("cls IS NULL").select(F.col("doc_id").alias("keeper_id"), F.col("text_hash").alias("keeper_hash"),
                                                 F.lit(1).cast("long").alias("copies")).distinct()
    keep = common.written(keep.unionByName(wordless), "join-keep")
    # the caller's columns travel in one struct, so names used here cannot meet theirs
    marked = docs.select(F.struct(*["`" + c.replace("`", "``") + "`" for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"),
                         F.xxhash64("text").alias("_hash"))
    stay = marked.join(keep.select("keeper_id", "keeper_hash", F.col("copies").alias("_copies")),
                       F.col("_id").eqNullSafe(F.col("keeper_id")) & (F.col("_hash") == F.col("keeper_hash")))
    repeated = stay.filter("_copies > 1").dropDuplicates(["_id", "_hash"])
    return stay.filter("_copies = 1").unionByName(repeated).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
