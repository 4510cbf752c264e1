"""Best-fit packing of token pieces into sequences of a fixed size, by exact complements.

Every document becomes its token ids plus an end id; only longer ones are cut, into pieces of the full size, the
first piece taking what is left over. Pieces of one length are interchangeable, so a plan over the *counts by length*
(at most ``size`` numbers, whatever the corpus) decides everything: for every length, from the longest, the gap to
the size is looked up among single lengths, sums of two and sums of three, and combinations that fill it exactly are
consumed as often as all their counts allow; what is left goes best-fit, longest first, into the smallest gap. The plan
is a table of patterns (lengths and how many sequences use them). Pieces then find their places without gathering:
each is numbered within its length (offsets per length and partition, then a count inside the partition), and the
number falls into one pattern's run of slots.

Defined results: null and empty texts are one piece that holds the end id. Repeated rows are packed one by one. An empty
table gives an empty table. Columns other than ``doc_id`` and ``text`` are ignored.
"""
from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SIZE = 1024
_ENCODERS: dict[str, object] = {}


class Encoder:
    """A rank encoder that takes the vocabulary's added tokens out of a text, as the tokenizers library does."""

    def __init__(self, ranks, added: dict[str, int]):
        import tiktoken
        self.ranks = tiktoken.Encoding("packing", pat_str=GPT2_PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.added = set(added)

    def encode(self, text: str) -> list[int]:
        return self.ranks.encode(text, allowed_special=self.added, disallowed_special=())

    def encode_ordinary(self, text: str) -> list[int]:
        """The ids with added tokens as ordinary text."""
        return self.ranks.encode_ordinary(text)


def encoder(path: str) -> Encoder:
    """Tokenizer of a byte-level BPE file: a ``.json``, or a ``.tiktoken`` rank file with the ``.json`` of the same name beside
    it, which lists the added tokens (without it there are none)."""
    if path not in _ENCODERS:
        import base64
        import json
        import os
        spec = {}
        listing = os.path.splitext(path)[0] + ".json"
        if os.path.exists(listing):
            with open(listing, encoding="utf-8") as f:
                spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if path.endswith(".json"):
            ranks = _json_ranks(spec)
        else:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = Encoder(ranks, added)
    return _ENCODERS[path]


# fixed value: the published pre-splitting pattern of this byte-level vocabulary
GPT2_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _json_ranks(spec: dict) -> dict[bytes, int]:
    """Byte strings of the vocabulary with their ids. Such a file orders ids by merge, so an id is a merge rank."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]   # bytes written as themselves
    hidden = [b for b in range(256) if b not in shown]              # the others, from code point 256 up
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("tokens", T.BinaryType()),
    T.StructField("task", T.LongType()), T.StructField("rank", T.LongType())])


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, size: int = SIZE, keep_tokens: bool = True) -> DataFrame:
    """The pieces of every document: place in the document, length, CRC-32 and (little-endian unsigned 32-bit) tokens,
    with the task that made each piece and its number among that task's pieces of the same length."""
    common.ship(docs.sparkSession)

    def run(batches):
        import numpy as np
        from pyspark import TaskContext
        enc, task, made = encoder(vocabulary), TaskContext.get().partitionId(), defaultdict(int)
        for batch in (part for b in batches for part in common.slices(b)):
            cols = [[] for _ in PIECES.fields]
            for doc, text in zip(batch.column(0).to_pylist(), common.texts_of(batch)):
                ids = enc.encode(text)
                ids.append(end_id)
                raw = np.array(ids, dtype="<u4").tobytes()
                n, at, k = len(ids), 0, 0
                while at < n:
                    step = n % size or size if not at else size
                    part = raw[4 * at:4 * (at + step)]
                    row = (doc, k, at, step, zlib.crc32(part), part if keep_tokens else None, task, made[step])
                    for c, v in zip(cols, row):
                        c.append(v)
                    made[step] += 1
                    at, k = at + step, k + 1
            if cols[0]:
                yield common.batch_of(PIECES, cols)
    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


class _Left:
    """Pieces left, by length. ``have`` has bit n set while length n is left, ``mirror`` bit size - n: the lengths
    that complete a sum are then one shift and one AND, an index of all pair sums at once."""

    def __init__(self, counts: dict[int, int], size: int):
        self.n, self.size = {k: v for k, v in counts.items() if v > 0}, size
        self.have = sum(1 << k for k in self.n)
        self.mirror = sum(1 << (size - k) for k in self.n)
        self.used: list[tuple[tuple[int, ...], int]] = []

    def take(self, *lengths: int) -> int:
        """Use a combination as often as all its counts allow."""
        need = defaultdict(int)
        for k in lengths:
            need[k] += 1
        times = min(self.n.get(k, 0) // c for k, c in need.items())
        if times:
            self.used.append((lengths, times))
            for k, c in need.items():
                self.n[k] -= c * times
                if not self.n[k]:
                    del self.n[k]
                    self.have ^= 1 << k
                    self.mirror ^= 1 << (self.size - k)
        return times

    def pairs(self, total: int) -> int:
        """Bits b >= total / 2 such that b and total - b are both left."""
        if total < 2:
            return 0
        both = self.have & (self.mirror >> (self.size - total))
        return both >> (total + 1) // 2 << (total + 1) // 2 & ((1 << total) - 1)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences) that hold all pieces counted by length."""
    left = _Left(counts, size)
    longest = sorted(left.n, reverse=True)
    for a in longest:
        if a in left.n and (a == size or size - a in left.n):
            left.take(*(k for k in (a, size - a) if k))
    for a in longest:
        while a in left.n and _fill_exactly(left, a, size - a):
            pass
    return left.used + _best_fit(left.n, size)


def _fill_exactly(left: _Left, a: int, gap: int) -> bool:
    """Use ``a`` with the longest length that fits its gap and one or two more that complete the sum.

    Other pairs and triples would spend short pieces on gaps that one long piece nearly fills; short pieces are what the
    last sequences need, so such gaps are left to the best-fit step.
    """
    b = (left.have & ((1 << (gap + 1)) - 1)).bit_length() - 1
    rest = gap - b
    if b < 1 or rest < 1:
        return False
    if rest in left.n and left.take(a, b, rest):
        return True
    found = left.pairs(rest)
    while found:
        c = found.bit_length() - 1
        if left.take(a, b, c, rest - c):
            return True
        found ^= 1 << c
    return False


def _best_fit(left: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first into the smallest gap that holds it; equal sequences are handled as one group."""
    open_: dict[int, list[list]] = defaultdict(list)      # gap -> groups of [pattern, how many]
    gaps: list[int] = []                                  # the gaps with a group, ascending

    def put(pattern, times):
        gap = size - sum(pattern)
        if not open_[gap]:
            bisect.insort(gaps, gap)
        open_[gap].append([pattern, times])

    for n in sorted(left, reverse=True):
        c = left[n]
        while c:
            k = bisect.bisect_left(gaps, n)
            if k < len(gaps):
                gap = gaps[k]
                group = open_[gap][-1]
                times = min(c, group[1])
                group[1] -= times
                if not group[1]:
                    open_[gap].pop()
                    if not open_[gap]:
                        gaps.pop(k)
                put((*group[0], n), times)
                c -= times
            else:
                fit = size // n
                whole, rest = divmod(c, fit)
                if whole:
                    put((n,) * fit, whole)
                if rest:
                    put((n,) * rest, 1)
                c = 0
    return [(tuple(p), t) for groups in open_.values() for p, t in groups]


def _slots(patterns) -> dict[int, list[tuple[int, int, int, int]]]:
    """length -> runs of slots (first slot, first sequence, pieces of this length in a sequence, pattern's offset)."""
    runs, used, seq = defaultdict(list), defaultdict(int), 0
    for lengths, times in patterns:
        at = 0
        for n in sorted(set(lengths), reverse=True):
            k = lengths.count(n)
            runs[n].append((used[n], seq, k, at))
            used[n] += k * times
            at += k * n
        seq += times
    return runs


PLACED = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()),
                       T.StructField("offset", T.LongType())])


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, size: int = SIZE, keep_tokens: bool = True) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` (their place there, gapless from 0)."""
    spark = docs.sparkSession
    cut = common.written(pieces(docs, vocabulary, end_id, size, keep_tokens), "pieces")
    # a full piece is a sequence of its own: no plan, and its tokens are not shuffled
    names = [n for n in PLACED.names if n not in ("task", "rank")]
    alone = -F.lit(1) - F.shiftleft(F.col("task"), 36) - F.col("rank")
    full = cut.filter(F.col("length") == size).select("*", alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    cut = cut.filter(F.col("length") < size)
    # at most `size` numbers for each task that wrote
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("_n"))
    total = {r["length"]: r["_n"] for r in by_task.groupBy("length").agg(F.sum("_n").alias("_n")).collect()}
    runs = spark.sparkContext.broadcast(_slots(plan(total, size)))      # bounded by the number of lengths
    # number of the first piece of each (length, task): a running sum over those counts, never over pieces
    w = Window.partitionBy("length").orderBy("task")
    first = by_task.select("length", "task", (F.sum("_n").over(w) - F.col("_n")).alias("_first"))
    numbered = cut.join(first, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("_first")) \
        .select(*cut.columns)
    placed = common.map_batches(numbered, lambda b: _placed(b, runs.value), PLACED)
    return full.select(*names).unionByName(placed.select(*names))


def _placed(batch, runs):
    import pyarrow as pa
    starts = {n: [r[0] for r in rs] for n, rs in runs.items()}
    seq, off = [], []
    for n, slot in zip(batch.column(PIECES.names.index("length")).to_pylist(),
                       batch.column(PIECES.names.index("rank")).to_pylist()):
        first, sequence, k, at = runs[n][bisect.bisect_right(starts[n], slot) - 1]
        copy, place = divmod(slot - first, k)
        seq.append(sequence + copy)
        off.append(at + place * n)
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                      names=PLACED.names)


def sequences(packed: DataFrame) -> DataFrame:
    """The filled sequences: ``sequence_id``, ``length`` and the pieces' tokens in order (needs kept tokens)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "tokens")))   # at most `size` pieces in a sequence
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_p")) \
        .select("sequence_id", "length",
                F.aggregate("_p", F.unhex(F.lit("")), lambda acc, p: F.concat(acc, p["tokens"])).alias("tokens"))
