"""Personal data in texts: fixed patterns, and candidates scored by boosted trees. DataFrame and SQL functions only.

Base spans are the leftmost non-overlapping matches of four patterns (e-mail, IP address, card and phone number) that pass
their checks; they are always kept. High-recall generators propose further spans, which may overlap: loose addresses and
numbers, values after ``=`` or ``:``, long mixed tokens. Each becomes a vector of format features (lengths, shares of
digits and letters, separators, checksum) and context features (words and signs beside it). Gradient-boosted trees are
fitted to weak labels, since the tables carry none: a candidate is positive if a base span covers most of it, if a
keyword of ``SECRET_WORDS`` with ``=`` or ``:`` stands before it, or if it has a published key format. Keywords, formats and
base matches are no features themselves, so the trees have to find their traces in format and context. For each generator the lowest threshold whose
precision on a held-out third is at least ``PRECISION`` is taken (none, if no threshold reaches it). The fitted trees become one
SQL expression, so documents are scored in the pass that reads them, without a shuffle.

The possessive quantifiers and lookbehinds below match what the plain patterns match, without their backtracking.

Training reads every document: trees and thresholds are fitted to the candidates of all whole texts.

Defined results: null and empty texts have no spans. Rows are kept one to one. Positions are code points, ends exclusive.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BASE_KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
LEAST_SUPPORT = 8           # held-out candidates a threshold needs above it
TREES, DEPTH = 12, 4

# The base patterns, each found leftmost without overlap.
_LOCAL = "A-Za-z0-9._%+-"
BASE_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# a cheap test that the pattern can match at all
BASE_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# Generators: the proposed span is group 1, which ends the match.
GENERATORS = {
    "address": r"(?<![^\s,;<>()\[\]])([^\s@,;<>()\[\]]++ ?(?:@|\(at\)|\[at\]) ?[^\s@,;<>()\[\]]{2,}+)",
    "number": r"(?<![0-9A-Za-z.])([+(]?[0-9](?:[ ().:-]{0,2}[0-9]){6,}+)",
    "value": r"[=:] ?[\"']?([^\s\"'=:]{6,}+)",
    "token": r"(?<![A-Za-z0-9_+/-])((?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{12,}+)",
}
GENERATOR_NEEDS = {"address": r"@|\(at\)|\[at\]", "number": "[0-9]", "value": "[=:]", "token": "[0-9]"}
# Words that announce a secret.
SECRET_WORDS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "ssn", "iban", "passport")
# Published formats of keys.
SECRET_FORMATS = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abpr]-[0-9A-Za-z-]{10,})$"
CONTACT_WORDS = ("mail", "phone", "tel", "call", "fax", "contact", "card", "visa", "account", "ip", "host", "server", "address")

_EMPTY = "cast(array() as array<struct<start:int,end:int,value:string,before:string,after:string>>)"


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern with their places: array of (start, end, value, before, after).

    The pieces between the matches and the matches themselves alternate, so lengths add up to positions. With
    ``group`` the value is that group, which has to end the match.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.arrays_zip(whole.alias("m"), F.slice(pieces, F.lit(1), F.size(whole)).alias("b"),
                         F.slice(pieces, F.lit(2), F.size(whole)).alias("a"))

    def step(acc, x):
        end = acc["at"] + F.length(x["b"]) + F.length(x["m"])
        value = F.regexp_extract(x["m"], pattern, group) if group else x["m"]
        before = F.substring(F.concat(x["b"], F.left(x["m"], F.length(x["m"]) - F.length(value))), -24, 24)
        one = F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"),
                       before.alias("before"), F.left(x["a"], F.lit(2)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.expr(_EMPTY).alias("out")), step)["out"]


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def step(acc, i):
        d = F.substring(digits, F.length(digits) - i + F.lit(1), F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), step) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        return F.length(digits).between(16, 19) & luhn(digits)
    return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)


def _with_base(docs: DataFrame) -> DataFrame:
    """doc columns plus ``_t`` (the text, never null) and ``_base``: array of (kind, start, end)."""
    df = docs.withColumn("_t", F.coalesce("text", F.lit("")))
    df = df.withColumn("_digit", F.col("_t").rlike("[0-9]"))
    cols = {}
    for kind in BASE_KINDS:
        may = F.col("_digit") if kind != "email" else F.lit(True)
        if BASE_NEEDS[kind]:
            may = may & F.contains(F.col("_t"), F.lit(BASE_NEEDS[kind]))
        cols[f"_b_{kind}"] = F.when(may, found(F.col("_t"), BASE_PATTERNS[kind])).otherwise(F.expr(_EMPTY))
    df = df.withColumns(cols)

    def spans(kind):
        good = F.filter(f"_b_{kind}", lambda m: _passes(kind, m["value"]))
        return F.transform(good, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    return df.withColumn("_base", F.concat(*map(spans, BASE_KINDS))).drop("_digit", *cols)


def _share(value: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{chars}]", "")) / F.greatest(F.length(value), F.lit(1))


def features(kind: str, c: Column) -> list[Column]:
    """Format and context of one candidate, as numbers."""
    v, before = c["value"], F.lower(c["before"])
    digits = F.regexp_replace(v, "[^0-9]", "")
    n = F.length(digits)
    words = F.substring(F.regexp_replace(before, r"[\s\"'=:]+$", ""), -12, 12)
    flags = [
        v.contains("@"), v.rlike(r"@[^@\s]+\.[A-Za-z0-9-]+"), v.startswith("+"), v.contains("("), v.contains(" "),
        v.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), v.rlike("^[0-9a-f]+$"), v.rlike("[A-Z]"), v.rlike("[a-z]"),
        v.rlike(r"^[^\p{L}]*$"), F.when((n >= 13) & (n <= 19), luhn(digits)).otherwise(F.lit(False)),
        before.rlike(r"[=:] ?[\"']?$"), before.rlike(r"\"$"), before.rlike(r"[a-z_]$"), before.rlike(r"[0-9.]$"),
        words.rlike("(" + "|".join(CONTACT_WORDS) + ")"), c["after"].rlike("^[\\s.,;!?\"]|^$"), c["after"].rlike("^[a-z0-9]"),
    ]
    counts = [
        F.length(v), n, _share(v, "0-9"), _share(v, "A-Za-z"), F.size(F.array_distinct(F.split(F.left(v, F.lit(64)), ""))),
        F.size(F.split(v, "[ ().-]+")), F.length(F.regexp_replace(v, "[^.]", "")), F.length(before),
    ]
    return [x.cast("double") for x in (F.lit(list(GENERATORS).index(kind)), *flags, *counts)]


def _with_candidates(df: DataFrame) -> DataFrame:
    """Adds ``_cand``: array of (kind, start, end, value, before, x) of all generators, x being the features."""
    cols = {f"_c_{k}": F.when(F.col("_t").rlike(GENERATOR_NEEDS[k]), found(F.col("_t"), p, 1)).otherwise(F.expr(_EMPTY))
            for k, p in GENERATORS.items()}
    df = df.withColumns(cols)

    def each(kind):
        return F.transform(f"_c_{kind}", lambda c: F.struct(
            F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"),
            c["before"].alias("before"), F.array(*features(kind, c)).alias("x")))
    return df.withColumn("_cand", F.concat(*map(each, GENERATORS))).drop(*cols)


def _weak_label(c: Column, base: Column) -> Column:
    covered = F.exists(base, lambda b: (F.least(b["end"], c["end"]) - F.greatest(b["start"], c["start"])) * 5 >= (c["end"] - c["start"]) * 4)
    word = F.lower(c["before"]).rlike("(" + "|".join(SECRET_WORDS) + r")\s?[=:] ?[\"']?$")
    return (covered | word | c["value"].rlike(SECRET_FORMATS)).cast("double")


def train(docs: DataFrame) -> dict | None:
    """Trees and thresholds from the candidates of all documents; None if they are all of one class."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    texts = docs.select("doc_id", "text").filter(F.col("text").rlike("|".join(GENERATOR_NEEDS.values())))
    learned = F.transform("_cand", lambda c: F.struct(c["kind"].alias("kind"), c["x"].alias("x"), _weak_label(c, F.col("_base")).alias("label")))
    # written a document a row and taken apart when read: an explode over the generators would run them again for its size check
    rows = common.written(_with_candidates(_with_base(texts)).select(
        (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0).alias("held"), learned.alias("found")), "pii-candidates") \
        .select("held", F.explode("found").alias("c")).select("held", "c.kind", "c.x", "c.label")
    seen = {(r["held"], r["label"]) for r in rows.select("held", "label").distinct().collect()}
    if not {(False, 0.0), (False, 1.0)} <= seen:
        return None
    vectors = rows.withColumn("features", array_to_vector("x"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11, checkpointInterval=-1, maxMemoryInMB=64) \
        .fit(vectors.filter("NOT held"))
    trees = {"trees": [_parse_tree(t.toDebugString) for t in model.trees], "weights": list(model.treeWeights)}
    # held-out candidates by generator and score, in steps of a hundredth: at most 101 rows a generator
    steps = rows.filter("held").groupBy("kind", F.floor(score(trees, F.col("x")) * 100).alias("s")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).collect()
    return trees | {"thresholds": {k: _threshold([r for r in steps if r["kind"] == k]) for k in GENERATORS}}


def _threshold(steps) -> float:
    """The lowest score from which up the precision stays at ``PRECISION`` or more; above 1 if there is none."""
    best, n, good = 1.01, 0, 0.0
    for r in sorted(steps, key=lambda r: -r["s"]):
        n, good = n + r["n"], good + r["good"]
        if n >= LEAST_SUPPORT and good >= PRECISION * n and r["s"] >= 50:
            best = r["s"] / 100
    return best


def _parse_tree(text: str):
    """Nested (feature, threshold, left, right) or leaf value, from the model's printed form."""
    lines = [x.strip() for x in text.splitlines()[1:] if x.strip()]

    def node(at):
        if lines[at].startswith("Predict:"):
            return float(lines[at].split(":")[1]), at + 1
        name, bound = lines[at][len("If (feature "):-1].split(" <= ")
        left, at = node(at + 1)
        right, at = node(at + 1)
        return (int(name), float(bound), left, right), at
    return node(0)[0]


def score(model: dict, x: Column) -> Column:
    """The boosted trees as one expression over a feature array: a probability."""
    def value(t):
        if isinstance(t, float):
            return F.lit(t)
        return F.when(x[t[0]] <= t[1], value(t[2])).otherwise(value(t[3]))
    total = sum((value(t) * w for t, w in zip(model["trees"], model["weights"])), F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(total * -2.0))


def find_spans(docs: DataFrame, model: dict | None) -> DataFrame:
    """All columns of ``docs`` plus ``_t``, ``_base`` and ``_spans``: arrays of (kind, start, end).

    ``_spans`` holds the base spans and the accepted candidates that no base span contains, by kind and start.
    """
    df = _with_base(docs)
    if model is None:
        return df.withColumn("_spans", F.col("_base"))
    df = _with_candidates(df)
    bound = F.create_map(*[F.lit(y) for k, t in model["thresholds"].items() for y in (k, t)])

    def accepted(c):
        inside = F.exists(F.col("_base"), lambda b: (b["start"] <= c["start"]) & (c["end"] <= b["end"]))
        return ~inside & (score(model, c["x"]) >= bound[c["kind"]])
    more = F.transform(F.filter("_cand", accepted), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return df.withColumn("_spans", F.concat("_base", F.array_sort(F.array_distinct(more)))).drop("_cand")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: dict | None) -> DataFrame:
    """The documents with every span replaced by its kind in brackets (overlapping spans by the first one's).

    Columns as before, whatever their names; ``n_chars``, where present, is the new length. Null texts stay null.
    """
    # the caller's columns travel in one struct, so names used here cannot meet theirs
    df = find_spans(docs.select(F.struct(*map(_quoted, docs.columns)).alias("_row"), "text"), model)
    order = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("e"), s["kind"].alias("kind"))))

    def step(acc, s):
        end = -s["e"]
        put = F.concat(acc["out"], F.substring(F.col("_t"), acc["at"] + F.lit(1), s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] >= acc["at"], F.struct(end.alias("at"), put.alias("out"))) \
            .otherwise(F.struct(F.greatest(acc["at"], end).alias("at"), acc["out"].alias("out")))
    made = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(F.col("_t"), acc["at"] + F.lit(1), F.length("_t"))))
    new = df.withColumn("_new", F.when(F.size("_spans") > 0, made).otherwise(F.col("text")))
    cols = {"text": F.col("_new"), "n_chars": F.when(F.size("_spans") > 0, F.length("_new").cast("long")).otherwise(F.col("_row.n_chars"))
            if "n_chars" in docs.columns else None}
    return new.select(*[cols[c].cast(docs.schema[c].dataType).alias(c) if cols.get(c) is not None else F.col("_row").getField(c).alias(c)
                        for c in docs.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
