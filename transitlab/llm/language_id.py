"""Language spans of mixed-language text.

Every word (a run of letters) gets a score under each learned language from its letter n-grams; the script of
its letters narrows the candidates to languages that use that script. Viterbi over the words with a penalty for each
switch labels spans; a document's language is the one that holds most letters.

The model is a table of n-gram counts by language, hashed into ``BUCKETS`` cells, so its size is bounded by the number of
languages. It is counted by Spark over the whole text of every row that may be learned from; a task adds its rows up first.

Defined results: a null text, or one without letters, is ``und`` with score 0 and no spans; without any learned
language everything is ``und``. Ties go to the language first in alphabetical order. Rows are kept one to one,
repeated rows and ids included; columns other than those named are ignored. Training skips rows without lang, text or id.
"""
from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

UNDETERMINED = "und"
MAX_TASK_LANGUAGES = 64    # languages whose cells a task adds up at a time (256 KB each)
MAX_TASK_WORDS = 100_000   # different words a task counts before it adds them to the cells
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
PRIME, MIX = 1_000_000_007, 0x9E3779B97F4A7C15      # constants of the hash into cells
SMOOTHING = 0.2
GRAM_WEIGHT = 0.3          # overlapping n-grams of a word are not independent evidence
WORD_LIMIT = 6.0           # the most one word can say against a language (natural log)
SWITCH_PENALTY = 12.0
CACHE_WORDS = 120_000
WORD = re.compile(r"[^\W\d_]+")       # letters, and number signs that are no decimal digits: ``only_letters`` takes those out first
NUMBER_SIGNS = frozenset(c for c in map(chr, range(128, 0x20000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())

# First and last code points of scripts (Unicode block ranges).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)], "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)], "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)], "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)], "bengali": [(0x980, 0x9FF)], "tamil": [(0xB80, 0xBFF)], "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)], "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)], "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)],
}


def only_letters(text: str) -> str:
    """The text with blanks for number signs such as \u00bd, \u00b2, \u2163 and \u2460 (Python counts them as word characters); positions stay."""
    if text.isascii():
        return text
    odd = NUMBER_SIGNS.intersection(text)
    return text.translate(dict.fromkeys(map(ord, odd), " ")) if odd else text


def script_of(word: str) -> str:
    """Script of the word's first letter whose block is listed; "other" if none is."""
    if word.isascii():
        return "latin"
    for ch in word:
        c = ord(ch)
        for name, ranges in SCRIPTS.items():
            if any(lo <= c <= hi for lo, hi in ranges):
                return name
    return "other"


def cells_of(words: list[str]):
    """(positions, cells) for the words of each length: cells of their 1- to 4-grams with word ends, and of the whole."""
    import numpy as np
    by_length: dict[int, list[int]] = {}
    lower = [w.lower() for w in words]
    for at, w in enumerate(lower):
        by_length.setdefault(len(w), []).append(at)
    for n, where in by_length.items():
        step = max(1, 200_000 // (n + 2))
        for lo in range(0, len(where), step):
            part = where[lo:lo + step]
            raw = np.frombuffer("".join(lower[a] for a in part).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            ends = np.full((len(part), 1), 1, dtype=np.uint64)
            code = np.hstack([ends, raw.reshape(len(part), n).astype(np.uint64), ends])
            gram, whole, grams = np.zeros_like(code), np.zeros(len(part), dtype=np.uint64), []
            for k in range(1, 5):
                if code.shape[1] < k:
                    break
                # one more character on every k-gram: a polynomial in the code points, salted by the length
                gram = gram[:, :code.shape[1] - k + 1] * PRIME + code[:, k - 1:]
                grams.append(gram[:, 1:-1] if k == 1 else gram + np.uint64(k * 1_000_003))
            for j in range(code.shape[1]):
                whole = whole * PRIME + code[:, j]
            cells = np.hstack([*grams, (whole + np.uint64(77))[:, None]])
            cells = (cells ^ (cells >> np.uint64(31))) * MIX
            yield np.array(part), (cells >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def is_training(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the id as text leaves a remainder other than 1 by 3."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) != 1


COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("cell", T.StringType()),
                       T.StructField("n", T.DoubleType())])


class Counted:
    """Counts of a task's rows by language: words first, then their cells and scripts; bounded by ``MAX_TASK_WORDS`` and ``MAX_TASK_LANGUAGES``."""

    def __init__(self):
        self.words, self.cells, self.scripts = defaultdict(Counter), {}, defaultdict(Counter)

    def add(self, texts: list[str], langs: list[str]):
        """Count the texts; gives back a record batch when the cells of many languages are full."""
        for text, lang in zip(texts, langs):
            self.words[lang].update(WORD.findall(only_letters(text)))
        if sum(map(len, self.words.values())) > MAX_TASK_WORDS:
            self.fold()
        if len(self.words.keys() | self.cells.keys()) > MAX_TASK_LANGUAGES:
            return self.taken()
        return None

    def fold(self) -> None:
        """The counted words into cells and scripts."""
        import numpy as np
        for lang, counted in self.words.items():
            listed = list(counted)
            total = self.cells.setdefault(lang, np.zeros(BUCKETS))
            often = np.array([counted[w] for w in listed], dtype=float)
            for where, cells in cells_of(listed):
                total += np.bincount(cells.ravel(), weights=np.repeat(often[where], cells.shape[1]), minlength=BUCKETS)
            for w, n in counted.items():
                self.scripts[lang][script_of(w)] += n * len(w)
        self.words.clear()

    def taken(self):
        """All counts so far as a record batch; counting starts again."""
        self.fold()
        langs, names, n = [], [], []
        for lang, total in self.cells.items():
            some = total.nonzero()[0].tolist()
            own = self.scripts[lang]
            langs += [lang] * (len(some) + len(own))
            names += [*map(str, some), *own]
            n += [*total[some].tolist(), *map(float, own.values())]
        self.cells.clear()
        self.scripts.clear()
        return common.batch_of(COUNTS, [langs, names, n])


def train(docs: DataFrame) -> dict:
    """Model from the ``text`` and ``lang`` of every row that may be learned from."""
    rows = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.filter(is_training(F.col("doc_id")))
    common.ship(docs.sparkSession)

    def run(batches):
        counted = Counted()
        for b in batches:
            for part in common.slices(b) if b.num_rows else ():
                full = counted.add(part.column(0).to_pylist(), part.column(1).to_pylist())
                if full is not None:
                    yield full
        last = counted.taken()
        if last.num_rows:
            yield last
    counted = rows.select("text", "lang").mapInArrow(run, COUNTS).groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    return build(((r["lang"], r["cell"], r["n"]) for r in counted.toLocalIterator()))


def build(counts) -> dict:
    """Log probabilities from (language, cell or script, count); bounded by languages x (BUCKETS + scripts)."""
    import numpy as np
    cells: dict[str, object] = {}
    scripts: dict[str, dict[str, float]] = defaultdict(dict)
    for lang, cell, n in counts:
        if lang not in cells:
            cells[lang] = np.zeros(BUCKETS)
        if cell.isdigit():
            cells[lang][int(cell)] += n
        else:
            scripts[lang][cell] = scripts[lang].get(cell, 0.0) + n
    langs = sorted(cells)
    logp = [np.log((cells[x] + SMOOTHING) / (cells[x].sum() + SMOOTHING * BUCKETS)) for x in langs]
    uses = {}
    for s in [*SCRIPTS, "other"]:
        mine = [i for i, x in enumerate(langs) if scripts[x].get(s, 0.0) >= 0.01 * sum(scripts[x].values())]
        uses[s] = mine or list(range(len(langs)))
    return {"langs": langs, "logp": np.array(logp, dtype="float32").T.copy() if langs else None, "scripts": uses}


class WordScores:
    """Scores of words met, relative to each word's best language; bounded by ``CACHE_WORDS``."""

    def __init__(self, model: dict):
        import numpy as np
        self.model, self.place = model, {}
        self.rows = np.zeros((1024, max(1, len(model["langs"]))))

    def of(self, texts: list[list[str]]) -> list:
        """One score matrix (words x languages) per text."""
        import numpy as np
        new = list(set().union(*texts) - self.place.keys())
        if len(self.place) + len(new) > CACHE_WORDS:
            self.place.clear()
            new = list(set().union(*texts))
        first = len(self.place)
        while first + len(new) > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        m = self.model
        for where, cells in cells_of(new):
            self.rows[first + where] = m["logp"][cells].sum(axis=1) * GRAM_WEIGHT
        got = self.rows[first:first + len(new)]
        odd = [(i, script_of(w)) for i, w in enumerate(new) if not w.isascii()]
        if len(m["scripts"]["latin"]) < got.shape[1]:
            odd = [(i, script_of(w)) for i, w in enumerate(new)]
        for i, script in odd:
            mine = m["scripts"][script]
            if len(mine) < got.shape[1]:
                kept = got[i, mine]
                got[i] = kept.max() - 2 * WORD_LIMIT
                got[i, mine] = kept
        got -= got.max(axis=1, keepdims=True)
        np.maximum(got, -WORD_LIMIT, out=got)
        self.place.update(zip(new, range(first, first + len(new))))
        return [self.rows[list(map(self.place.__getitem__, t))] for t in texts]


def viterbi(rows: list[list[float]], penalty: float = SWITCH_PENALTY) -> list[int]:
    """Best language of each word when every change of language costs ``penalty``."""
    n = len(rows[0])
    v, steps = list(rows[0]), []
    for r in rows[1:]:
        best = max(v)
        k, floor, moved, new = v.index(best), best - penalty, 0, []
        for i in range(n):
            if v[i] >= floor:
                new.append(v[i] + r[i])
            else:
                new.append(floor + r[i])
                moved |= 1 << i
        steps.append((k, moved))
        v = new
    at = v.index(max(v))
    path = [at]
    for k, moved in reversed(steps):
        if moved >> at & 1:
            at = k
        path.append(at)
    return path[::-1]


def one_language(scores, penalty: float = SWITCH_PENALTY) -> int | None:
    """The language of the best path if it surely has no switch, else None.

    Every stretch that leaves the best single language gains at most its largest sum of differences; a path with
    j stretches pays for j - 1 switches at least, so gains of half a penalty or less never pay.
    """
    import numpy as np
    best = int(scores.sum(axis=0).argmax())
    gain = scores - scores[:, best:best + 1]
    run = np.vstack([np.zeros((1, gain.shape[1])), gain.cumsum(axis=0)])
    most = (run - np.minimum.accumulate(run, axis=0)).max()
    return best if most <= penalty / 2 else None


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("lang", T.StringType())])


def label_all(texts: list[str], table: WordScores, penalty: float = SWITCH_PENALTY) -> list:
    """(language, score, spans) of each text; spans are (start, end, language) in code points."""
    if not table.model["langs"]:
        return [(UNDETERMINED, 0.0, [])] * len(texts)
    texts = [only_letters(t) for t in texts]
    words = [WORD.findall(t) for t in texts]
    return [_label(t, w, s, table.model["langs"], penalty) if w else (UNDETERMINED, 0.0, [])
            for t, w, s in zip(texts, words, table.of(words))]


def _label(text: str, words: list[str], scores, langs: list[str], penalty: float):
    import numpy as np
    sure = one_language(scores, penalty)
    lengths = np.fromiter(map(len, words), float, len(words))
    if sure is not None:
        path = None
        spans = [(text.find(words[0]), text.rfind(words[-1]) + len(words[-1]), langs[sure])]
        letters = np.zeros(len(langs))
        letters[sure] = lengths.sum()
    else:
        path = viterbi(scores.tolist(), penalty)
        letters = np.bincount(path, weights=lengths, minlength=len(langs))
        spans = []
        for m, k in zip(WORD.finditer(text), path):
            if spans and spans[-1][2] == langs[k]:
                spans[-1] = (spans[-1][0], m.end(), langs[k])
            else:
                spans.append((m.start(), m.end(), langs[k]))
    win = int(letters.argmax())
    mine = scores if path is None else scores[np.array(path) == win]
    rest = np.delete(mine.sum(axis=0), win)
    # how far the words labelled with the winner speak for it against the next language
    margin = float(mine[:, win].sum() - rest.max()) if len(rest) else 50.0
    sure_share = 1 / (1 + math.exp(-min(50.0, max(-50.0, margin))))
    return langs[win], float(letters[win] / letters.sum()) * sure_share, spans


OUT = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
       T.StructField("spans", T.ArrayType(SPAN))]


def _table(shared) -> WordScores:
    # one table per Python worker and model, kept over tasks
    if _TABLES.get("id") != shared["id"]:
        _TABLES.update(id=shared["id"], table=WordScores(shared["model"]))
    return _TABLES["table"]


_TABLES: dict = {}


def _shared(docs: DataFrame, model: dict):
    import uuid
    return docs.sparkSession.sparkContext.broadcast({"id": uuid.uuid4().hex, "model": model})


def language_spans(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and spans of every whole text."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *OUT])
    shared = _shared(docs, model)

    def fn(batch):
        table = _table(shared.value)
        got = label_all(common.texts_of(batch), table)
        spans = [[{"start": a, "end": b, "lang": x} for a, b, x in g[2]] for g in got]
        return common.batch_of(schema, [batch.column(0), [g[0] for g in got], [g[1] for g in got], spans])
    return common.map_batches(docs.select("doc_id", "text"), fn, schema)


def keep_identified(docs: DataFrame, model: dict, min_score: float = 0.3) -> DataFrame:
    """The rows whose language is known: not ``und`` and scored ``min_score`` or more. All columns, no shuffle."""
    shared = _shared(docs, model)

    def fn(batch):
        import pyarrow as pa
        table = _table(shared.value)
        got = label_all(common.texts_of(batch), table)
        return batch.filter(pa.array([g[0] != UNDETERMINED and g[1] >= min_score for g in got]))
    return common.map_batches(docs, fn, docs.schema)
