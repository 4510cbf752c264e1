"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised by the model's own rules, split where no vocabulary entry can span (a word-start mark after
another character), and every part is merged by an agenda of its adjacent symbol pairs whose join is an entry,
best score first, leftmost on ties: short parts of a batch together, a row of symbols each, long ones with a heap. Parts recur, so each Python worker
keeps a bounded table of the ids of parts already merged. Symbols that are no entry become their UTF-8 byte entries, or the unknown id where the
vocabulary has none. Every row's ids and decoded text are compared with the sentencepiece library (``library_equal``).

Defined results: null and empty texts encode to the end id alone and decode to "". Rows are kept one to one
(repeated rows and ids included). Columns of the input other than ``doc_id`` and ``text`` are ignored.
"""
from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

MARK = "▁"              # fixed value: the library's word-start mark
CACHE_PARTS = 450_000        # parts in each of the two generations a Python worker remembers
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"  # Latin letters, of which most parts consist
SHORT = 40                   # parts up to this length are rows of symbols merged together, longer ones have a heap
STEP = 4                     # rows of symbols are made of parts whose lengths differ by less than this
NONE = (1 << 31) - 1         # place of a pair that is no entry
SIGNS = 1 << 24              # symbols from here on are characters without an entry
PAD = SIGNS + 0x110000       # no symbol: before and after those of a part
FREE = (1 << 64) - 1         # slot without a pair
SPREAD = 0x9E3779B97F4A7C15  # multiplier that spreads pairs over the slots
HIGH = 0xDC00                # from here on the code points that stand for byte entries from 128 on; no text holds them
HIGH_RUN = re.compile("[\udc80-\udcff]+")
CACHED_LENGTH = 64           # longer parts are merged but not remembered

_MODELS: dict[str, "PieceModel"] = {}


class PartTable(dict):
    """part -> ids. When full, the entries become the old generation; parts still in use come back from it."""

    def __init__(self, entries):
        super().__init__()
        self.entries, self.old = entries, {}

    def add(self, parts: set[str]) -> dict:
        """The ids of ``parts``, which this table does not hold; it remembers all but the very long from now on."""
        if len(self) + len(parts) > CACHE_PARTS and self:
            self.old = dict(self)
            self.clear()
        made = {p: ids for p in parts if (ids := self.old.get(p)) is not None} if self.old else {}
        new = [p for p in parts if p not in made]
        made.update((p, ids) for p, (ids,) in zip(new, self.entries(new)))
        self.update((p, ids) for p, ids in made.items() if len(p) <= CACHED_LENGTH)
        return made


class PieceModel:
    """Vocabulary of one model file, with the agenda encoder and the decoder."""

    def __init__(self, path: str):
        import sentencepiece
        self.lib = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.number = [str(i) for i in range(n)]
        self.end, self.unk = lib.eos_id(), lib.unk_id()
        silent = [lib.is_control(i) for i in range(n)]
        self.bytes = {i: int(p[3:5], 16) for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.byte_ids = {v: k for k, v in self.bytes.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces)
                    if not (silent[i] or i in self.bytes or lib.is_unused(i) or i == self.unk)}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.silent = {i for i in range(n) if silent[i]}
        self.part = re.compile(self._part_pattern())
        self.cache = PartTable(self.entries)
        self._pair_table()
        surface = [p.replace(MARK, " ") for p in self.pieces]
        surface[self.unk] = lib.decode([self.unk]) if self.unk >= 0 else ""
        # the model puts a blank before every text, and its decoder takes it from an entry that starts with one
        self.prefix = lib.normalize("a") == MARK + "a"
        self.opening = {i for p, i in self.ids.items() if p.startswith(MARK)}
        self.surface = ["" if i in self.silent else s for i, s in enumerate(surface)]
        # a byte below 128 is a character whatever stands beside it
        self.shown = [s if (b := self.bytes.get(i)) is None else chr(b if b < 128 else HIGH + b) for i, s in enumerate(self.surface)]

    def _part_pattern(self) -> str:
        """A part ends before a mark if no entry has one after another character; a word also ends before a sign
        (ASCII, no letter or digit) that no entry has after a letter."""
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            return r"(?s).+"
        letter = re.compile(f"[{LETTERS}]")
        after_letter = {y for p in self.ids for x, y in zip(p, p[1:]) if letter.match(x)}
        ends = "".join(re.escape(c) for c in map(chr, range(128)) if not c.isalnum() and c not in after_letter)
        word = f"{MARK}*[{LETTERS}]++(?![^{MARK}{ends}])|" if ends else ""      # a mark or the end of the text ends a part anyway
        return f"{word}{MARK}*[^{MARK}]+|{MARK}+"

    def _pair_table(self) -> None:
        """The agenda's table: for every pair of symbols whose join is an entry its place by score, and the entry, in slots found by the pair
        (the next free one where several want the same). A symbol is an entry's id, or ``SIGNS`` and the code point for a character that is none."""
        import numpy as np
        self.sign = np.arange(0x110000, dtype=np.int32) + SIGNS
        for p, i in self.ids.items():
            if len(p) == 1:
                self.sign[ord(p)] = i
        letters = set().union(*self.ids)
        for b, i in self.byte_ids.items():
            if b < 128 and chr(b) not in letters:       # never merged: its byte entry from the start
                self.sign[b] = i

        def symbol(x):
            return self.ids.get(x, ord(x) + SIGNS if len(x) == 1 else None)
        found = []
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                left, right = symbol(p[:k]), symbol(p[k:])
                if left is not None and right is not None:
                    found.append((left << 32 | right, self.score[p], i))
        bits = max(4, (4 * len(found)).bit_length())
        self.shift, self.last_slot = np.uint64(64 - bits), (1 << bits) - 1
        self.pairs = np.full(1 << bits, FREE, dtype=np.uint64)
        self.place, self.joined = np.full(1 << bits, NONE, dtype=np.int32), np.zeros(1 << bits, dtype=np.int32)
        self.own = np.empty(len(self.pieces), dtype=object)             # one number object an id, which all parts share
        self.own[:] = range(len(self.pieces))
        # equal scores share a place: the leftmost pair goes first then
        places = {s: k for k, s in enumerate(sorted({f[1] for f in found}, reverse=True))}
        for pair, score, i in found:
            slot = (pair * SPREAD & FREE) >> 64 - bits
            while self.pairs[slot] != FREE:
                slot = slot + 1 & self.last_slot
            self.pairs[slot], self.place[slot], self.joined[slot] = pair, places[score], i

    def _slots(self, left, right):
        """Slot of each pair; a free one (``place`` is ``NONE``) where the join is no entry."""
        import numpy as np
        pair = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = (pair * np.uint64(SPREAD) >> self.shift).astype(np.int64)
        held = self.pairs[slot]
        away = np.flatnonzero((held != pair) & (held != FREE))
        while len(away):
            slot[away] = slot[away] + 1 & self.last_slot
            held = self.pairs[slot[away]]
            away = away[(held != pair[away]) & (held != FREE)]
        return slot

    def merge_all(self, parts: list[str]) -> list[tuple[int, ...]]:
        """Ids of many parts at once, those of about one length together as rows of symbols. Each row has its agenda, the places of its adjacent
        pairs; every round takes the best pair, leftmost on ties, of each row, which makes all rows one symbol shorter. A row without a pair leaves."""
        import numpy as np
        out: list = [()] * len(parts)
        size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        signs = self.sign[np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4")]
        start = np.cumsum(size) - size
        steps = -(-size // STEP)
        for width in (np.unique(steps) * STEP).tolist():
            row = np.flatnonzero(steps * STEP == width)
            at = np.arange(width)
            filled = at < size[row, None]
            sym = np.full((len(row), width + 2), PAD, dtype=np.int32)
            sym[:, 1:-1][filled] = signs[(start[row, None] + at)[filled]]
            place = np.full(sym.shape, NONE, dtype=np.int32)            # of the pair that begins there
            place[:, :-1] = self.place[self._slots(sym[:, :-1].ravel(), sym[:, 1:].ravel())].reshape(len(row), -1)
            while len(row):
                best = place.argmin(axis=1)                             # the leftmost of each row
                going = place[np.arange(len(row)), best] < NONE
                if not going.all():
                    self._leave(out, row[~going], sym[~going])
                    sym, place, row, best = sym[going], place[going], row[going], best[going]
                    if not len(row):
                        break
                n, wide = sym.shape
                at = best + np.arange(n) * wide
                sym, place = sym.ravel(), place.ravel()
                sym[at] = self.joined[self._slots(sym[at], sym[at + 1])]
                stay = np.ones(n * wide, dtype=bool)
                stay[at + 1] = False
                sym, place = sym[stay], place[stay]
                at -= np.arange(n)                                      # one symbol went from each row before
                change = np.concatenate([at, at - 1])
                place[change] = self.place[self._slots(sym[change], sym[change + 1])]
                sym, place = sym.reshape(n, wide - 1), place.reshape(n, wide - 1)
        return out

    def _leave(self, out: list, row, sym) -> None:
        """Puts the ids of merged rows of symbols into their places in ``out``."""
        import numpy as np
        real = sym != PAD
        flat, end = sym[real], np.cumsum(real.sum(axis=1))
        start = np.r_[0, end[:-1]]
        foreign = flat >= SIGNS
        if foreign.any():
            some = np.logical_or.reduceat(foreign, start)
            for r, x in zip(row[some].tolist(), sym[some]):
                out[r] = tuple(chain.from_iterable((i,) if i < SIGNS else self._ids([chr(i - SIGNS)]) for i in x[x != PAD].tolist()))
            flat = np.where(foreign, 0, flat)                           # the rows left do not hold these
            row, start, end = row[~some], start[~some], end[~some]
        ids = self.own[flat].tolist()
        for r, lo, hi in zip(row.tolist(), start.tolist(), end.tolist()):
            out[r] = tuple(ids[lo:hi])

    def merge(self, part: str) -> tuple[int, ...]:
        """Ids of one part by the agenda of adjacent pairs as a heap (long parts)."""
        sym = list(part)
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        score, agenda = self.score, []

        def offer(i, j):
            joined = sym[i] + sym[j]
            s = score.get(joined)
            if s is not None:
                heapq.heappush(agenda, (-s, i, j, joined))
        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, joined = heapq.heappop(agenda)
            # stale if either side has been merged away or has grown since
            if not sym[i] or not sym[j] or right[i] != j or len(sym[i]) + len(sym[j]) != len(joined):
                continue
            sym[i], sym[j] = joined, ""
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
                offer(i, right[j])
            if left[i] >= 0:
                offer(left[i], i)
        return self._ids([x for x in sym if x])

    def _ids(self, symbols: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for x in symbols:
            got = self.ids.get(x)
            if got is not None:
                out.append(got)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in x.encode())
            else:
                out.append(self.unk)
        return tuple(out)

    def entries(self, parts: list[str]) -> list[tuple[tuple[int, ...]]]:
        """(ids,) of parts (not empty)."""
        short = [p for p in parts if len(p) <= SHORT]
        merged = zip(self.merge_all(short) if short else ())
        return list(merged) if len(short) == len(parts) else [next(merged) if len(p) <= SHORT else (self.merge(p),) for p in parts]

    def parts(self, texts: list[str]) -> list[list[tuple[int, ...]]]:
        """The ids of whole texts, part by part in order."""
        cut = [self.part.findall(self.lib.normalize(t)) if t else [] for t in texts]
        found = [list(map(self.cache.get, c)) for c in cut]
        gaps = [[k for k, ids in enumerate(f) if ids is None] for f in found]
        made = self.cache.add({c[k] for c, g in zip(cut, gaps) for k in g})
        for c, f, g in zip(cut, found, gaps):
            for k in g:
                f[k] = made[c[k]]
        return found

    def ids_of(self, entries: list[tuple[int, ...]]) -> list[int]:
        out = list(chain.from_iterable(entries))
        out.append(self.end)
        return out

    def encode(self, text: str) -> list[int]:
        return self.ids_of(self.parts([text])[0])

    def texts_of(self, entries: list[tuple[int, ...]], ids: list[int]) -> tuple[str, str]:
        """(ids as text, decoded text) of a whole text, both made from its ids, whatever its parts ``entries`` were."""
        return " ".join(map(self.number.__getitem__, ids)), self.decode(ids)

    def decode(self, ids: list[int]) -> str:
        """Surface of the entries; runs of byte entries become UTF-8; the blank that stands for the start goes."""
        text = "".join(map(self.shown.__getitem__, ids))
        if not text.isascii() and HIGH_RUN.search(text):
            # a silent id between two bytes keeps them apart
            text = HIGH_RUN.sub(lambda run: _utf8(run[0].encode("utf-8", "surrogateescape")), text) \
                if self.silent.isdisjoint(ids[:-1]) else "".join(self._surfaces(ids))
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if self.prefix and first in self.opening else text

    def _surfaces(self, ids: list[int]):
        pending = bytearray()
        for i in ids:
            b = self.bytes.get(i)
            if b is not None:
                pending.append(b)
                continue
            if pending:
                yield _utf8(bytes(pending))
                pending.clear()
            yield self.surface[i]
        if pending:
            yield _utf8(bytes(pending))


def _utf8(raw: bytes) -> str:
    """UTF-8 text; every byte outside a well-formed sequence becomes a replacement mark of its own."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for k in range(1, 5):
                try:
                    out.append(raw[i:i + k].decode())
                    i += k
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
                        T.StructField("library_equal", T.BooleanType())])


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (with the end id) and whether the library gives the same."""
    def fn(batch):
        m = model(model_path)
        texts = common.texts_of(batch)
        ids = list(map(m.ids_of, m.parts(texts)))
        same = [a == b for a, b in zip(ids, m.lib.encode(texts, num_threads=1, add_eos=True))]
        return common.batch_of(ENCODED, [batch.column(0), ids, same])
    return common.map_batches(docs.select("doc_id", "text"), fn, ENCODED)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the decoded text of ``ids``; null ids decode to ""."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def fn(batch):
        m = model(model_path)
        return common.batch_of(schema, [batch.column(0), [m.decode(i or []) for i in batch.column(1).to_pylist()]])
    return common.map_batches(encoded.select("doc_id", "ids"), fn, schema)


ROUND_TRIP = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    T.StructField("library_equal", T.BooleanType())])


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode and decode in one pass, kept as digests: ids and texts never leave the task that made them."""
    def fn(batch):
        m = model(model_path)
        texts = common.texts_of(batch)
        entries = m.parts(texts)
        ids = [m.ids_of(e) for e in entries]
        made = [m.texts_of(e, i) for e, i in zip(entries, ids)]
        theirs = m.lib.encode(texts, num_threads=1, add_eos=True)
        back = m.lib.decode(theirs, num_threads=1) if theirs else []
        return common.batch_of(ROUND_TRIP, [
            batch.column(0), list(map(len, ids)),
            [hashlib.sha256(n.encode()).hexdigest() for n, _ in made],
            [hashlib.sha256(t.encode()).hexdigest() for _, t in made],
            [i == j and t == u for i, j, (_, t), u in zip(ids, theirs, made, back)]])
    return common.map_batches(docs.select("doc_id", "text"), fn, ROUND_TRIP)
