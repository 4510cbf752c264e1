"""Toxicity scores from a support vector machine over a gap-weighted subsequence kernel.

Units of a text are its words, and runs of three or more single characters read as one word ("i d i o t"). The kernel of
two words sums, over the three-character subsequences they share (at most ``SPAN`` characters wide), a decay for
every character skipped in either, so inserted characters lower the likeness without ending it. Case, accents, marks
inside a word and common digit-for-letter swaps are folded away first. A Nyström map onto landmark words turns the
kernel into short vectors; a linear machine on them (squared hinge) collapses into one table of weights by subsequence,
which is what documents are scored with.

Training: every distinct sentence of all labelled training documents counts once, so copies of a document add nothing, and is
clean if any clean document has it. Witnesses are words over-represented in sentences of toxic documents (G-squared above
twice the log of the number of words) that clean sentences hardly hold; a toxic document's sentence with a witness is a
toxic sentence, the words of clean sentences are clean. Spellings of a witness with one character inserted are added
with a small weight. After each fit the clean documents' most toxic-looking words are added as hard negatives
(``HARD_ROUNDS`` times). A document's score is a logistic curve of its highest word value and of how many words the
machine accepts, fitted on the same documents and weighted back to the labels' proportions; the documents are counted by these two
measures, rounded to 1 / ``GRID`` only if there are more than ``MAX_MEASURES`` different pairs.

No labelled document is left out; Spark counts over all of them. The size of the model is bounded: at most ``MAX_UNITS`` witnesses,
clean words and hard negatives each, the first by what was counted.

Defined results: null and empty texts have no units and get the lowest score the model gives. Without a toxic and a clean
training document every score is 0. A doc_id labelled both ways counts as toxic. Rows are kept one to one.
"""
from __future__ import annotations

import math
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_folder
from . import common

MAX_UNITS = 4000
LANDMARKS = 320
CLEAN_SHARE = 0.05          # clean sentences that may hold a witness, against toxic ones
HARD_ROUNDS, HARD_WEIGHT = 3, 10.0
VARIANT_WEIGHT = 0.3
SENTENCE_END = re.compile(r"[.!?\n]+")
SPAN, DECAY = 7, 0.5
WINDOW = 24                 # longer words are read through windows of this many characters
CACHE_WORDS = 250_000        # words in each of the two generations a Python worker remembers
CHUNK = 512                  # words whose subsequences are weighed at a time
ID_BITS = 24                 # size of the filter of labelled documents (2 MB of bits, whatever the number of labels)
GRID, MAX_MEASURES = 1000, 100_000       # steps in 1 of the measures that the curve is fitted to, if there are more different ones
LOWEST = -3.0               # value of a text without units
TOKEN = re.compile(r"[^\s.,;:!?\"()]+")
SYMBOLS = 64                # letters a-z are 1..26, other characters share 27..61, word ends are 62 and 63

# Characters commonly written in place of a letter.
SWAPS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _codes():
    import numpy as np
    table = np.array([27 + c % 35 for c in range(0x250)], dtype=np.int64)
    for c in range(0x250):
        base = unicodedata.normalize("NFD", SWAPS.get(chr(c), chr(c)).lower())[0]
        if "a" <= base <= "z":
            table[c] = ord(base) - 96
    return table


_TRIPLES: dict = {}


def triples(n: int):
    """Index arrays, weights and norm of the three-character subsequences of a word of ``n`` symbols."""
    if n not in _TRIPLES:
        import numpy as np
        ijk = [(i, j, k) for i in range(n) for k in range(i + 2, min(n, i + SPAN)) for j in range(i + 1, k)]
        i, j, k = (np.array(x, dtype=np.int64) for x in zip(*ijk))
        w = (DECAY ** (k - i - 2)).astype("float32")
        _TRIPLES[n] = i, j, k, w / math.sqrt(float((w * w).sum()))
    return _TRIPLES[n]


def features(words: list[str]):
    """(positions, subsequence numbers, weights) for at most ``CHUNK`` words of one length at a time; words end in marks of their own."""
    import numpy as np
    global _CODES
    if _CODES is None:
        _CODES = _codes()
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(size, kind="stable")
    raw = np.frombuffer("".join([words[a] for a in order.tolist()]).encode("utf-32-le"), dtype="<u4")
    code = np.where(raw < len(_CODES), _CODES[np.minimum(raw, len(_CODES) - 1)], 27 + raw % 35).astype(np.int32)
    at = first = 0
    for n, many in zip(*(x.tolist() for x in np.unique(size, return_counts=True))):
        i, j, k, w = triples(n + 2)
        for lo in range(0, many, CHUNK):
            where = order[first + lo:first + min(many, lo + CHUNK)]
            one = np.empty((len(where), n + 2), dtype=np.int32)
            one[:, 0], one[:, 1:-1], one[:, -1] = 62, code[at:at + n * len(where)].reshape(len(where), n), 63
            at += n * len(where)
            ids = (one * SYMBOLS ** 2).take(i, axis=1)
            ids += (one * SYMBOLS).take(j, axis=1)
            ids += one.take(k, axis=1)
            yield where, ids, w
        first += many


_CODES = None


def unit_of(token: str) -> str:
    return token if token.isalnum() else "".join(c for c in token if c.isalnum() or c in "@$")


def windows(word: str) -> list[str]:
    if len(word) <= WINDOW + WINDOW // 2:
        return [word] if word else []
    return [word[i:i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def tokens(text: str) -> list[str]:
    """Words of a text, and every run of three or more single characters as one more word."""
    found = TOKEN.findall(text.lower())
    size = list(map(len, found))
    if size.count(1) >= 3:
        single = [i for i, n in enumerate(size) if n == 1]
        run: list[int] = []
        for i in [*single, -9]:
            if run and i != run[-1] + 1:
                if len(run) >= 3:
                    found.append("".join(found[r] for r in run))
                run = []
            run.append(i)
    return found


def is_training(doc_id: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text is not divisible by 5."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 0


class Machine:
    """Weights by subsequence; a word's value is their weighted sum plus the bias. Values of words met are kept: when full, they become
    the old generation, from which words still in use come back."""

    def __init__(self, model: dict):
        self.model, self.value, self.old = model, {}, {}

    def known(self, lists: list) -> dict[str, float]:
        """The values of all words of the lists."""
        import numpy as np
        words = set().union(*lists)
        new = words.difference(self.value)
        if len(self.value) + len(new) > CACHE_WORDS:
            self.old, self.value, new = self.value, {}, words
        if self.old:
            found = new & self.old.keys()
            self.value.update(zip(found, map(self.old.__getitem__, found)))
            new = new - found
        new = list(new)
        parts, owner = [], []
        for i, t in enumerate(new):
            u = unit_of(t)
            if len(u) <= WINDOW:
                if u:
                    parts.append(u)
                    owner.append(i)
            else:
                for w in windows(u):
                    parts.append(w)
                    owner.append(i)
        best = np.full(len(new), LOWEST)
        got = np.zeros(len(parts))
        for where, ids, w in features(parts):
            got[where] = self.model["weights"].take(ids) @ w
        if parts:
            np.maximum.at(best, np.array(owner), got + self.model["bias"])
        self.value.update(zip(new, best.tolist()))
        # a table of its own: the batch's words are looked up there many times
        return dict(zip(words, map(self.value.__getitem__, words)))

    def values(self, lists: list[list[str]]) -> list[list[float]]:
        value = self.known(lists).__getitem__
        return [list(map(value, t)) for t in lists]

    def measures(self, texts: list[str]):
        """Per text: highest word value, and how many words the machine accepts."""
        lists = [tokens(t) for t in texts]
        different = list(map(set, lists))
        value = self.known(different).__getitem__
        for t, words in zip(lists, different):
            top = max(map(value, words), default=LOWEST)
            yield top, (sum(1 for x in map(value, t) if x > 0) if top > 0 else 0)

    def scores(self, texts: list[str]) -> list[float]:
        a, c, b = self.model["curve"]
        return [1 / (1 + math.exp(-max(-60.0, min(60.0, a * top + c * math.log1p(n) + b)))) for top, n in self.measures(texts)]


def fit_machine(positive: dict[str, float], negative: dict[str, float], landmarks: list[str], ridge: float = 1e-4) -> dict:
    """Machine from weighted words of toxic and of clean sentences (at most a few times ``MAX_UNITS`` words)."""
    import numpy as np
    ids, cols, vals = [], [], []
    for where, f, w in features(landmarks):
        ids.append(f.ravel())
        cols.append(np.repeat(where, f.shape[1]))
        vals.append(np.tile(w, len(where)))
    ids, cols, vals = map(np.concatenate, (ids, cols, vals))
    known, row = np.unique(ids, return_inverse=True)
    land = np.zeros((len(known) + 1, len(landmarks)), dtype="float32")      # last row: subsequences of no landmark
    np.add.at(land, (row, cols), vals)
    place = np.full(SYMBOLS ** 3, len(known), dtype=np.int32)
    place[known] = np.arange(len(known))
    eig, vec = np.linalg.eigh(land.T.astype(float) @ land)
    keep = eig > 1e-6 * eig.max()
    root = vec[:, keep] / np.sqrt(eig[keep])                                # Nyström: k(x, landmarks) @ root
    words = [*positive, *negative]
    gram = np.zeros((len(words), len(landmarks)), dtype="float32")
    for where, f, w in features(words):
        for lo in range(0, len(where), 256):
            gram[where[lo:lo + 256]] = np.einsum("ntm,t->nm", land[place[f[lo:lo + 256]]], w)
    x = np.hstack([gram @ root, np.ones((len(words), 1))])
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    c = np.array([*positive.values(), *negative.values()])
    c[:len(positive)] *= 0.5 / c[:len(positive)].sum()
    c[len(positive):] *= 0.5 / c[len(positive):].sum()
    beta, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(40):                                                     # Newton on the squared hinge
        on = y * (x @ beta) < 1
        xa = x[on] * c[on, None]
        new = np.linalg.solve(xa.T @ x[on] + np.diag(penalty), xa.T @ y[on])
        if np.abs(new - beta).max() < 1e-9:
            break
        beta = 0.5 * beta + 0.5 * new
    weights = np.zeros(SYMBOLS ** 3, dtype="float32")
    weights[known] = land[:-1] @ (root @ beta[:-1])
    return {"weights": weights, "bias": float(beta[-1]), "curve": (1.0, 0.0, 0.0)}


def fit_curve(rows: list[tuple[float, float, int, float]]) -> tuple[float, float, float]:
    """Logistic curve over (highest value, log1p of accepted words) from (highest, logarithm, label, weight) rows."""
    import numpy as np
    x = np.array([[t, n, 1.0] for t, n, _, _ in rows])
    y, w = np.array([float(r[2]) for r in rows]), np.array([r[3] for r in rows])
    w = w / w.sum()
    beta = np.zeros(3)
    ridge = np.diag([1e-4, 1e-4, 1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, x.T @ (w * (y - p)) - ridge @ beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


UNITS = T.StructType([T.StructField("unit", T.StringType()), T.StructField("pos", T.LongType()), T.StructField("neg", T.LongType())])
MEASURES = T.StructType([T.StructField("toxic", T.IntegerType()), T.StructField("top", T.DoubleType()), T.StructField("accepted", T.DoubleType()),
                         T.StructField("n", T.LongType())])
HARD = T.StructType([T.StructField("unit", T.StringType()), T.StructField("n", T.LongType())])


def _may_hold(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id may be in ``marked`` (all that are, few others): a filter of ``2^ID_BITS`` bits by a hash of the id, at
    most ``2^(ID_BITS - 6)`` rows of 64 bits however many ids there are. An exact join follows."""
    place = F.shiftright(F.xxhash64("doc_id"), 64 - ID_BITS).cast("int")
    bit = F.expr("shiftleft(1L, _at & 63)")
    bits = marked.select(place.alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return docs.withColumn("_at", place).withColumn("_word", F.shiftright("_at", 6)).join(F.broadcast(bits), "_word") \
        .filter(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits", "_at")


def training_rows(docs: DataFrame, labels: DataFrame, root: str | None = None):
    """(doc_id, text, toxic of every labelled training document as a written table under ``root``; labelled documents by class)."""
    root = root or common.scratch(docs.sparkSession, "toxic")
    marked = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IN (0, 1)") \
        .filter(is_training(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = common.written_at(marked, f"{root}/labels")
    size = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = _may_hold(docs.select("doc_id", "text").filter("text IS NOT NULL").filter(is_training(F.col("doc_id"))), marked)
    # written once: the texts are read by every round of the training. Only texts that are learned from are dealt by doc_id, and not sorted
    rows = common.written_at(texts.join(marked.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "toxic"), f"{root}/training")
    return rows, size


SENTENCES = T.StructType([T.StructField("sentence", T.StringType()), T.StructField("toxic", T.IntegerType())])


def labelled_sentences(rows: DataFrame) -> DataFrame:
    """The distinct sentences with the label of their documents (clean if any of these is clean)."""
    def fn(batch):
        found: dict[str, int] = {}
        for text, toxic in zip(common.texts_of(batch), batch.column(2).to_pylist()):
            for s in SENTENCE_END.split(text.lower()):
                s = " ".join(s.split())
                if s:
                    found[s] = min(toxic, found.get(s, 1))
        return common.batch_of(SENTENCES, [list(found), list(found.values())])
    return common.map_batches(rows, fn, SENTENCES).groupBy("sentence").agg(F.min("toxic").alias("toxic"))


def _unit_counts(sentences: DataFrame) -> DataFrame:
    """In how many toxic and clean sentences each unit is; the row without a unit counts the sentences."""
    def fn(batch):
        labels = batch.column(1).to_pylist()
        count: dict[str | None, list[int]] = {None: [sum(labels), len(labels) - sum(labels)]}
        for text, toxic in zip(batch.column(0).to_pylist(), labels):
            for u in {w for t in tokens(text) for w in windows(unit_of(t))}:
                count.setdefault(u, [0, 0])[0 if toxic else 1] += 1
        return common.batch_of(UNITS, [list(count), [c[0] for c in count.values()], [c[1] for c in count.values()]])
    return common.map_batches(sentences, fn, UNITS).groupBy("unit").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def variants(word: str) -> set[str]:
    """The word with one character inserted: a foreign one, or one of its own doubled."""
    if len(word) < 4:
        return set()
    return {word[:k] + x + word[k:] for k in range(1, len(word)) for x in ("x", word[k])}


def _hard_words(clean: DataFrame, model: dict, known: set[str]) -> list[tuple[str, int]]:
    """The most toxic-looking words (at most 5 a document) of the clean documents, by how many have them, without ``known`` ones."""
    shared = _shared(clean, model)

    def fn(batch):
        m = _machine(shared.value)
        toks = [tokens(t) for t in common.texts_of(batch)]
        count: dict[str, int] = {}
        for ts, v in zip(toks, m.values(toks)):
            least = sorted(v)[-20:][:1]           # the twentieth highest value; ties go by place
            by_word = sorted([p for p in zip(ts, v) if p[1] >= least[0]], key=lambda p: -p[1])
            best = list(dict.fromkeys(unit_of(t) for t, _ in by_word[:20]))[:5]
            for w in [w for b in best for w in windows(b)[:1]]:
                if w not in known:
                    count[w] = count.get(w, 0) + 1
        return common.batch_of(HARD, [list(count), list(count.values())])
    found = common.map_batches(clean, fn, HARD).groupBy("unit").agg(F.sum("n").alias("n"))
    return [(r["unit"], r["n"]) for r in found.orderBy(F.desc("n"), "unit").limit(MAX_UNITS).collect()]


def _measured(rows: DataFrame, model: dict, root: str) -> list:
    """How many training documents of each class have which measures (highest value, log1p of accepted words); see ``MAX_MEASURES``."""
    shared = _shared(rows, model)

    def fn(batch):
        count: dict[tuple, int] = {}
        for toxic, (top, n) in zip(batch.column(2).to_pylist(), _machine(shared.value).measures(common.texts_of(batch))):
            key = toxic, top, math.log1p(n)
            count[key] = count.get(key, 0) + 1
        return common.batch_of(MEASURES, [[k[0] for k in count], [k[1] for k in count], [k[2] for k in count], list(count.values())])
    found = common.map_batches(rows, fn, MEASURES).groupBy("toxic", "top", "accepted").agg(F.sum("n").alias("n"))
    found = common.written_at(found, f"{root}/measures")
    if found.count() > MAX_MEASURES:
        steps = [(F.round(F.col(c) * GRID) / GRID).alias(c) for c in ("top", "accepted")]
        found = found.groupBy("toxic", *steps).agg(F.sum("n").alias("n"))
    return found.orderBy("toxic", "top", "accepted").collect()          # bounded by the steps, not by the documents


def train(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Model from documents and their labels; None without both classes or without any word of evidence. Its tables go when it is made."""
    root = common.scratch(docs.sparkSession, "toxic")
    try:
        return _train(docs, labels, root)
    finally:
        remove_folder(docs.sparkSession, root)


def _train(docs: DataFrame, labels: DataFrame, root: str) -> dict | None:
    rows, size = training_rows(docs, labels, root)
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    if not n_pos or not n_neg:
        return None
    # the distinct sentences are counted behind their shuffle, not written
    units = common.written_at(_unit_counts(labelled_sentences(rows)), f"{root}/units")
    total = units.filter("unit IS NULL").first()
    s_pos, s_neg = (total["pos"], total["neg"]) if total else (0, 0)
    units = units.filter("unit IS NOT NULL")
    k, n = F.col("pos") + F.col("neg"), float(s_pos + s_neg)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    # G-squared of (word in sentence) against (toxic document)
    g2 = 2 * (part(F.col("pos"), k * s_pos / n) + part(F.col("neg"), k * s_neg / n)
              + part(s_pos - F.col("pos"), (n - k) * s_pos / n) + part(s_neg - F.col("neg"), (n - k) * s_neg / n))
    scored = units.withColumn("g2", F.when(F.col("pos") * s_neg > F.col("neg") * s_pos, g2).otherwise(0.0))
    evidence = 2 * math.log(max(2, units.count()))
    rare = F.col("neg") <= CLEAN_SHARE * F.col("pos")
    witnesses = scored.filter((F.col("g2") >= evidence) & rare).orderBy(F.desc("g2"), "unit").limit(MAX_UNITS).collect()
    clean = scored.filter(~rare).orderBy(F.desc("neg"), "unit").limit(MAX_UNITS).collect()
    if not witnesses or not clean:
        return None
    positive = {r["unit"]: 1 + math.log(r["pos"]) for r in witnesses}
    negative = {r["unit"]: 1 + math.log(r["neg"]) for r in clean}
    near = {v: VARIANT_WEIGHT for w in list(positive)[:LANDMARKS // 2] for v in variants(w) if v not in positive}
    hard: dict[str, int] = {}
    model = None
    for _ in range(1 + HARD_ROUNDS):
        if model is not None:
            for w, k in _hard_words(rows.filter("toxic = 0"), model, positive.keys() | near.keys()):
                hard[w] = hard.get(w, 0) + k
        worst = sorted(hard, key=lambda w: (-hard[w], w))
        half = LANDMARKS // 4
        landmarks = dict.fromkeys([*list(positive)[:LANDMARKS // 2], *worst[:half], *list(negative)[:half]])
        model = fit_machine(positive | near, negative | {w: HARD_WEIGHT * (1 + math.log(c)) for w, c in hard.items()}, list(landmarks))
    back = {1: size[1] / n_pos, 0: size[0] / n_neg}
    model["curve"] = fit_curve([(r["top"], r["accepted"], r["toxic"], back[r["toxic"]] * r["n"]) for r in _measured(rows, model, root)])
    return model


_MACHINES: dict = {}


def _shared(df: DataFrame, model: dict | None):
    import uuid
    return df.sparkSession.sparkContext.broadcast({"id": uuid.uuid4().hex, "model": model})


def _machine(shared: dict) -> Machine:
    # one per Python worker and model, kept over tasks
    if _MACHINES.get("id") != shared["id"]:
        _MACHINES.update(id=shared["id"], machine=Machine(shared["model"]))
    return _MACHINES["machine"]


def _scores(shared: dict, texts: list[str]) -> list[float]:
    return [0.0] * len(texts) if shared["model"] is None else _machine(shared).scores(texts)


SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()),
                       T.StructField("predicted", T.IntegerType())])


def toxicity(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5) of every whole text."""
    shared = _shared(docs, model)

    def fn(batch):
        s = _scores(shared.value, common.texts_of(batch))
        return common.batch_of(SCORED, [batch.column(0), s, [int(x >= 0.5) for x in s]])
    return common.map_batches(docs.select("doc_id", "text"), fn, SCORED)


def keep_clean(docs: DataFrame, model: dict | None, threshold: float = 0.5) -> DataFrame:
    """The rows scored below the threshold. All columns, no shuffle."""
    shared = _shared(docs, model)

    def fn(batch):
        import pyarrow as pa
        return batch.filter(pa.array([x < threshold for x in _scores(shared.value, common.texts_of(batch))]))
    return common.map_batches(docs, fn, docs.schema)
