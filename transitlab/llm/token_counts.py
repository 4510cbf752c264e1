"""Token counts of whole texts for a merge vocabulary with word ends, without making the tokens.

A text is taken apart as the vocabulary file says: the strings of its added tokens stand for themselves, the rest is composed (NFC),
lower-cased and cut into pre-tokens. The pre-tokens of a batch that a worker has not met lie in one ragged array of symbols, the bytes
of each pre-token with a word end on the last. Every round looks up the rank of each adjacent pair, finds the lowest rank of each
pre-token and merges all its places at once (of overlapping places every second one, from the left); a pre-token without a
ranked pair leaves the array, and its count is the number of symbols it still has. A merge never makes a pair of lower rank
(checked when the file is read), so this gives the same symbols as merging one place at a time. Long pre-tokens (scripts without
blanks, junk) would need a round for every rank they hold; they are merged rank by rank on linked positions instead, so each
round touches only the places of its rank.

Defined results: null and empty texts count 0 tokens. Rows are kept one to one (repeated rows and ids included); texts of
any length are counted whole. Columns of the input other than ``doc_id`` and ``text`` are ignored.
"""
from __future__ import annotations

import heapq
import json
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

LIMIT = 2048                 # tokens; a longer document is over the limit
CACHE_WORDS = 300_000        # pre-tokens in each of the two generations a Python worker remembers
CACHED_LENGTH = 64           # longer pre-tokens are counted but not remembered
SHORT = 48                   # bytes up to which a pre-token is merged in the rounds of the ragged array
NONE = 1 << 30               # rank of a pair that is no merge
# fixed values: the characters the library takes for white space, and the settings of the vocabulary file that are implemented here
SPACES = "\t-\r \x85\xa0  -     　"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

_MODELS: dict[str, "WordMerges"] = {}


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next free one above 255."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordMerges:
    """Merge ranks of one vocabulary file and the counting of pre-tokens."""

    def __init__(self, path: str):
        import numpy as np
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != NORMALIZERS or cut[0]["pattern"]["Regex"] != WORDS or model["type"] != "BPE":
            raise ValueError(f"{path}: normalisation, words or model other than the ones implemented here")
        self.library = Tokenizer.from_file(path)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = regex.compile(WORDS.replace(r"\s", SPACES))
        # the same words of lower-cased ASCII texts
        self.plain_words = re.compile(WORDS.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.ASCII)
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        # the symbol of a byte inside a word, and (256 places on) at its end
        self.first = np.array([vocab[c] for c in letters] + [vocab[c + end] for c in letters], dtype=np.int64)
        pairs = [tuple(m) for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        self.result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        key = (left << 32) | right
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order
        self._check_ranks(left, right, len(vocab))
        self.cache: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.letters = {c: b for b, c in enumerate(letters)}

    def _check_ranks(self, left, right, size: int) -> None:
        """Merging all places of a rank at once needs that no merge makes a symbol that an earlier merge uses."""
        import numpy as np
        used = np.full(size, NONE, dtype=np.int64)
        place = np.arange(len(left))
        np.minimum.at(used, left, place)
        np.minimum.at(used, right, place)
        if (used[self.result] <= place).any():
            raise ValueError("a merge uses a symbol before it is made: places of one rank cannot be merged at once")

    def rank_of(self, left, right):
        """Rank of each pair of symbols; ``NONE`` where it is no merge."""
        import numpy as np
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def symbols(self, raw: list[bytes]):
        """(symbols, lengths) of pre-tokens: one ragged array, the last byte of each as a word end."""
        import numpy as np
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        place = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int64)
        place[np.cumsum(size) - 1] += 256
        return self.first[place], size

    def _ranks(self, symbol, size):
        """Rank of the pair that starts at each place; a pre-token's last place starts none."""
        import numpy as np
        rank = np.full(len(symbol), NONE, dtype=np.int64)
        rank[:-1] = self.rank_of(symbol[:-1], symbol[1:])
        rank[np.cumsum(size) - 1] = NONE
        return rank

    def count_ragged(self, raw: list[bytes]):
        """Symbols left of each pre-token, all of them merged in the same rounds."""
        import numpy as np
        symbol, size = self.symbols(raw)
        rank = self._ranks(symbol, size)
        count, row = size.copy(), np.arange(len(raw))
        while len(row):
            start = np.cumsum(size) - size
            low = np.minimum.reduceat(rank, start)
            going = low < NONE
            if not going.all():
                count[row[~going]] = size[~going]
                keep = np.repeat(going, size)
                symbol, rank, row, size, low = symbol[keep], rank[keep], row[going], size[going], low[going]
                continue
            at = every_second(np.flatnonzero(rank == np.repeat(low, size)), None)
            symbol[at] = self.result[rank[at]]
            stay = np.ones(len(symbol), dtype=bool)
            stay[at + 1] = False
            owner = np.repeat(np.arange(len(row)), size)
            size = size - np.bincount(owner[at], minlength=len(row))
            new = (np.cumsum(stay) - 1)[at]
            symbol, rank = symbol[stay], rank[stay]
            final = np.zeros(len(symbol), dtype=bool)
            final[np.cumsum(size) - 1] = True
            for change in (new, new[new > 0] - 1):
                change = change[~final[change]]
                rank[change] = self.rank_of(symbol[change], symbol[change + 1])
            rank[final] = NONE
        return count

    def count_linked(self, raw: list[bytes]):
        """Symbols left of each pre-token, merged rank by rank: a calendar of places by rank, neighbours linked."""
        import numpy as np
        symbol, size = self.symbols(raw)
        n = len(symbol)
        rank = self._ranks(symbol, size)
        following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        stop = np.cumsum(size)
        following[stop - 1] = n                       # nothing follows the last place of a pre-token ...
        before[stop - size] = -1                      # ... and nothing comes before its first
        alive = np.ones(n, dtype=bool)
        calendar: dict[int, list] = {}
        agenda: list[int] = []

        def enter(places):
            places = places[rank[places] < NONE]
            if not len(places):
                return
            places = places[np.argsort(rank[places], kind="stable")]
            value = rank[places]
            cuts = np.flatnonzero(np.diff(value)) + 1
            for group in np.split(places, cuts):
                r = int(rank[group[0]])
                if r not in calendar:
                    calendar[r] = []
                    heapq.heappush(agenda, r)
                calendar[r].append(group)
        enter(np.arange(n))
        while agenda:
            r = heapq.heappop(agenda)
            at = np.unique(np.concatenate(calendar.pop(r)))
            at = every_second(at[alive[at] & (rank[at] == r)], following)
            if not len(at):
                continue
            gone = following[at]
            symbol[at] = self.result[r]
            alive[gone] = False
            following[at] = following[gone]
            inside = following[at] < n
            before[following[at[inside]]] = at[inside]
            rank[at[~inside]] = NONE
            earlier = before[at]
            change = np.unique(np.concatenate([at[inside], earlier[earlier >= 0]]))
            rank[change] = self.rank_of(symbol[change], symbol[following[change]])
            enter(change)
        return np.add.reduceat(alive.astype(np.int64), stop - size)

    def count(self, words: list[str]) -> list[int]:
        """Number of tokens of each pre-token (not empty)."""
        raw = [w.encode() for w in words]
        out = [0] * len(raw)
        for some, merge in (([i for i, b in enumerate(raw) if len(b) <= SHORT], self.count_ragged),
                            ([i for i, b in enumerate(raw) if len(b) > SHORT], self.count_linked)):
            if some:
                for i, c in zip(some, merge([raw[i] for i in some]).tolist()):
                    out[i] = c
        return out

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text without added tokens."""
        if text.isascii():
            return self.plain_words.findall(text.lower())
        if any(unicodedata.category(c) == "Cn" for c in set(text) if c > "ɏ"):
            # characters newer than this Python's tables: the library's own tables decide
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(self.letters[c] for c in w).decode() for w, _ in cut]
        # lower() has one rule that looks at the neighbours (a sigma at the end of a word); the library has none
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def split(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, added tokens) of a whole text."""
        if self.special is None or not self.special.search(text):
            return self.pre_tokens(text), 0
        parts = self.special.split(text)
        return [w for p in parts for w in self.pre_tokens(p)], len(parts) - 1

    def counts(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text; pre-tokens not met before are merged together."""
        cut = [self.split(t) for t in texts]
        words = set().union(*(w for w, _ in cut))
        if len(self.cache) + len(words) > CACHE_WORDS:
            self.old, self.cache = self.cache, {}       # pre-tokens still in use come back from the old generation
        found = self.cache
        fresh = []
        for w in words:
            if w not in found:
                if w in self.old:
                    found[w] = self.old[w]
                else:
                    fresh.append(w)
        long = {}
        for w, c in zip(fresh, self.count(fresh)):
            (found if len(w) <= CACHED_LENGTH else long)[w] = c
        if long:
            return [sum(found[w] if w in found else long[w] for w in ws) + added for ws, added in cut]
        return [sum(map(found.__getitem__, ws)) + added for ws, added in cut]


def every_second(at, following):
    """Of places that follow each other directly (pairs that overlap) the first, third ... of each run; ``following`` gives the
    place after each (None: the next one)."""
    import numpy as np
    if len(at) < 2:
        return at
    nxt = at + 1 if following is None else following[at]
    runs = np.concatenate([[True], at[1:] != nxt[:-1]])
    if runs.all():
        return at
    begin = np.maximum.accumulate(np.where(runs, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - begin) % 2 == 0]


def model(path: str) -> WordMerges:
    if path not in _MODELS:
        _MODELS[path] = WordMerges(path)
    return _MODELS[path]


COUNTED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and whether they are more than ``limit``; one pass, no shuffle."""
    def fn(batch):
        texts = common.texts_of(batch)
        return common.batch_of(COUNTED, [batch.column(0), [len(t.encode()) for t in texts], model(path).counts(texts)])
    return common.map_batches(docs.select(F.col("doc_id").cast("long"), "text"), fn, COUNTED) \
        .withColumn("over_limit", F.col("n_tokens") > limit)
