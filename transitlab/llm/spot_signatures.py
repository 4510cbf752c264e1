"""Document fingerprints from spot signatures (SpotSigs).

An anchor is a common word, or the start of the text. In a stretch of ``STRETCH`` or more content words without one (other
languages, tables, code) further anchors are the content words whose chain has the smallest hash of ``STRETCH`` neighbouring ones, so
signatures grow with the text. Characters of scripts written without blanks are words of their own. The signature of an anchor is the chain of the next ``CHAIN`` content
words (words that are no anchors); anchors near the end give shorter chains. A fingerprint is the set of signatures,
written as sorted 32-bit numbers in fixed-width base 64. Likeness is the Jaccard index of two sets; it is only counted when their
sizes allow the bound asked for (the smaller over the larger), and counting stops when the rest cannot reach it.

For a search over all documents, sets are partitioned by their size: a pair above the threshold t lies in the same
partition or in neighbouring ones when partition bounds grow by the factor 1/t. Inside, only the rarest signatures of
each set (as many as a partner above t could miss, plus one) are looked up.

Defined results: null and empty texts have the empty fingerprint; so does a text without letters or digits only if it is
empty: other wordless texts have one signature, of the whole text. Two empty fingerprints have likeness 1. The text
that follows a document is that of the next row in the order (doc_id, hash of the text, text); after the last comes the first. Rows are
kept one to one; repeated ids are rows of their own.
"""
from __future__ import annotations

import base64
import hashlib
import math
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

CHAIN = 2
STRETCH = 4
# scripts written without blanks: Thai, Lao, Myanmar, Khmer, kana, Han
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
WORD = re.compile(rf"(?:(?![{_UNSPACED}])[^\W_])+|(?:(?=[{_UNSPACED}])[^\W_])")
CACHE_WORDS = 300_000

# Frequent function words of English, German, French and Spanish.
ANCHORS = frozenset("""
a an and are as at be by for from in is it of on or that the this to was with
als auf aus das dem den der des die ein eine im ist mit nicht sich und von zu
au aux ce dans de des du elle en est et il la le les par pas pour que qui sur un une
al como con del el en es la las lo los no para por que se su un una y
""".split())


class WordNumbers(dict):
    """word -> 32-bit number, or -1 for an anchor; starts anew when full."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = n = -1 if word in ANCHORS else xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"))
        return n


_NUMBERS = WordNumbers()


def signatures(text: str, chain: int = CHAIN):
    """Sorted distinct 32-bit signatures of a text."""
    import numpy as np
    words = WORD.findall(text.lower())
    if not words:
        return np.array([int.from_bytes(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:4], "little")] if text else [],
                        dtype=np.uint32)
    n = np.fromiter(map(_NUMBERS.__getitem__, words), dtype=np.int64, count=len(words))
    anchor = n < 0
    content = n[~anchor].astype(np.uint64)
    # a chain starts at the start of the text and after each anchor: place of its first word among the content words
    first = np.unique(np.concatenate([[0], np.cumsum(~anchor)[anchor]]))
    padded = np.concatenate([content, np.zeros(chain, dtype=np.uint64)])
    first = first[first < max(1, len(content))]
    h = np.zeros(max(1, len(content)), dtype=np.uint64)     # the chain at every content word
    for k in range(chain):
        h = (h ^ padded[k:k + len(h)]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)
    h ^= h >> np.uint64(32)
    h = (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.uint32)
    if len(content) >= STRETCH:
        stretch = np.cumsum(anchor)[~anchor]                # number of the stretch each content word is in
        whole = np.flatnonzero(stretch[:len(h) - STRETCH + 1] == stretch[STRETCH - 1:])
        least = np.lib.stride_tricks.sliding_window_view(h, STRETCH)[whole].argmin(axis=1)
        first = np.concatenate([first, whole + least])
    return np.unique(h[first])


def written_form(sig) -> str:
    return base64.b64encode(sig.astype("<u4").tobytes()).decode()


def read_form(fingerprint: str):
    import numpy as np
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u4")


def jaccard(a, b, least: float = 0.0) -> float:
    """Jaccard index of two sorted sets; 0 where it cannot reach ``least`` by their sizes."""
    import numpy as np
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def edited(text: str, following: str) -> str:
    """The text with its last quarter (code points, rounded down) replaced by as many first ones of ``following``."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q] if q else text


PRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fingerprint", T.StringType())])


def fingerprints(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """doc_id and fingerprint of every whole text; no shuffle."""
    def fn(batch):
        return common.batch_of(PRINTS, [batch.column(0), [written_form(signatures(t, chain)) for t in common.texts_of(batch)]])
    return common.map_batches(docs.select("doc_id", "text"), fn, PRINTS)


COMPARED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def _compare(doc_id, text: str, following: str, sig, next_sig) -> tuple:
    changed = edited(text, following)
    other = signatures(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), written_form(sig), written_form(other),
            jaccard(sig, other), jaccard(sig, next_sig))


def _ranges(rows: DataFrame, n: int) -> DataFrame:
    """Adds ``range``: numbers that grow with (doc_id, hash), about as many rows each.

    The bounds are quantiles of doc_id (``n`` numbers on the driver). An id that holds so many rows that several bounds fall on it
    is spread over their ranges by its rows' hashes, in the order of the hashes.
    """
    common.ship(rows.sparkSession)
    bounds = rows.select("doc_id").filter("doc_id IS NOT NULL").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []

    @F.pandas_udf("int")
    def place(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        import numpy as np
        at = np.array(sorted(bounds), dtype=np.float64)
        v = ids.to_numpy(dtype=np.float64, na_value=-np.inf)
        low, high = np.searchsorted(at, v, "left"), np.searchsorted(at, v, "right")
        share = (hashes.to_numpy(dtype=np.float64) + 2.0 ** 63) / 2.0 ** 64
        return pd.Series(np.minimum(low + np.floor(share * (high - low + 1)), high).astype("int32"))
    return rows.withColumn("range", place("doc_id", "hash"))


def compare_with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The rows are dealt out by ranges of (doc_id, hash of the text) and sorted inside tasks, so a document's successor is the next
    row of its range. The last row of a range needs the first row of the next one: those first rows (one for each range)
    are found by their ids and hashes, and travel along with the range before them. Texts are shuffled once.
    ``ranges``: how many (default: the session's number of shuffle partitions).
    """
    spark = docs.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = _ranges(rows, n)
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "hash")
    first = rows.groupBy("range").agg(F.min(key).alias("k")).select("range", "k.doc_id", "k.hash")
    order = Window.orderBy("range")                                    # one small row for each range
    first = common.written(first.withColumn("before", F.lag("range").over(order)).withColumn("last", F.max("range").over(Window.partitionBy())),
                           "spot-first")
    heads = first.select(F.col("doc_id").alias("_d"), F.col("hash").alias("_h"), F.coalesce("before", "last").alias("_before"))
    # as many rows as ranges go to every executor
    heads = rows.drop("range").join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("hash") == F.col("_h"))) \
        .groupBy("_before").agg(F.min("text").alias("text"))
    heads = heads.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(None).cast("long").alias("hash"),
                         F.col("_before").alias("range"), F.lit(1).alias("next"))
    every = rows.withColumn("next", F.lit(0)).unionByName(heads)
    sort = ["range", "next", "doc_id", "hash", "text"]
    dealt = every.repartitionById(n, F.col("range")).sortWithinPartitions(*sort).select("doc_id", "text", "next")

    def run(batches):
        held = None
        for part in (p for b in batches for p in common.slices(b)):
            out = []
            for doc_id, text, following in zip(*(part.column(i).to_pylist() for i in range(3))):
                sig = signatures(text)
                if held is not None:
                    out.append(_compare(held[0], held[1], text, held[2], sig))
                held = None if following else (doc_id, text, sig)
            if out:
                yield common.batch_of(COMPARED, [list(c) for c in zip(*out)])
    return dealt.mapInArrow(run, COMPARED)


BUCKET_BLOCK = 512          # fingerprints of one bucket compared in a task
SETS = T.StructType([T.StructField("fid", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("sig", T.LongType())])
EDGES = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def near_classes(docs: DataFrame, threshold: float = 0.8, chain: int = CHAIN) -> DataFrame:
    """doc_id and class_id of every document: the smallest doc_id reachable over fingerprints alike to ``threshold`` or more.

    Equal fingerprints are compared as one. Sizes are partitioned with bounds growing by 1/threshold; a set is looked up in
    its own partition and the next one, through its rarest signatures only. Buckets are dealt out in blocks of
    bounded size, and a task gives out a spanning forest of the alike fingerprints it meets, never pairs. Documents with an
    empty fingerprint are classes of their own.
    """
    prints = common.written(fingerprints(docs, chain).withColumn("fid", F.sha2("fingerprint", 256)), "spot-prints")
    sets = common.written(prints.filter("fingerprint <> ''").select("fid", "fingerprint").distinct(), "spot-sets")

    def spread(batch):
        import numpy as np
        found = [read_form(x) for x in batch.column(1).to_pylist()]
        sizes = [len(s) for s in found]
        return common.batch_of(SETS, [np.repeat(np.array(batch.column(0).to_pylist(), dtype=object), sizes).tolist(),
                                      np.repeat(sizes, sizes).tolist(), np.concatenate(found).astype(np.int64).tolist()])
    sigs = common.map_batches(sets, spread, SETS)
    often = sigs.groupBy("sig").agg(F.count(F.lit(1)).alias("often"))
    # a partner above the threshold misses at most size - ceil(threshold * size) of the signatures
    rank = F.row_number().over(Window.partitionBy("fid").orderBy("often", "sig"))
    rare = sigs.join(often, "sig").withColumn("r", rank).filter(F.col("r") <= F.col("size") - F.ceil(F.col("size") * threshold) + 1)
    level = F.floor(F.log(F.col("size").cast("double")) / -math.log(threshold) + 1e-9).cast("int")
    keys = common.written(rare.select("fid", F.explode(F.array(level, level + 1)).alias("level"), "sig")
                          .select(F.xxhash64("sig", "level").alias("key"), "fid"), "spot-keys")
    h = F.xxhash64("fid")
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 8)).alias("s")) \
        .filter("m > 1").groupBy("m", "x", "s").agg(F.min("key").alias("key")).select("key", "m")     # equal buckets once
    member = common.blocks(keys.join(common.written(buckets, "spot-buckets"), "key"), "key", "m", "fid", BUCKET_BLOCK)
    rows = member.select("key", "block", "fid").join(sets, "fid")

    def fn(table):
        fids, found = table.column("fid").to_pylist(), [read_form(x) for x in table.column("fingerprint").to_pylist()]
        left, a, b = list(range(len(fids))), [], []
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and left:
                one = queue.pop()
                hit = [i for i in left if jaccard(found[one], found[i], threshold) >= threshold]
                if hit:
                    a += [fids[one]] * len(hit)
                    b += [fids[i] for i in hit]
                    queue += hit
                    met = set(hit)
                    left = [i for i in left if i not in met]
        return common.batch_of(EDGES, [a, b]) if a else None
    component = common.connected_components(common.by_group(rows.select("key", "block", "fid", "fingerprint"), ["key", "block"], fn, EDGES))
    named = prints.join(component, prints["fid"] == component["node"], "left").withColumn("_k", F.coalesce("component", "fid"))
    least = named.filter("fingerprint <> ''").groupBy("_k").agg(F.min("doc_id").alias("class_id"))
    return named.select("doc_id", "_k").join(least, "_k", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
