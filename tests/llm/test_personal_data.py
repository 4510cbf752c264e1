import random
import re

from pyspark.sql import functions as F

from transitlab.llm import personal_data as pd

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - (9 if n > 4 else 0)
        total += n
    return total % 10 == 0


def good(kind, m):
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        d = re.sub(r"[^0-9]", "", m)
        return 16 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 8 <= len(re.sub(r"[^0-9]", "", m)) <= 15
    return True


def brute(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if good(k, m.group())]


def samples():
    rnd = random.Random(2)
    bits = ["a@b.c", "_d@e.f", "1.2.3.4", ".5", "256.1.1.1", "4111 1111 1111 1111", "4111111111111111", "-", "+1 (555) 123-4567", "+", "@",
            ".", " ", "x", "🎉", "é", "0", "007", "99", "x@y.", "..", "+12345678", "()", "\n", "%", "a.b+c@d-e.co.uk", "00000000000000000"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    return texts + [None, "", "a" * 50_000, "1" * 30_000, "a@b.c " * 300, "1 " * 5000, "+1 " + "9" * 5000]


def test_base_spans_equal_plain_patterns(spark):
    texts = samples()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: [tuple(x) for x in r["_spans"]] for r in pd.find_spans(df, None).select("doc_id", "_spans").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == brute(t), t


def test_base_spans_of_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in pd.find_spans(docs, None).select("text", "_base").collect():
        assert [tuple(x) for x in r["_base"]] == brute(r["text"])


def test_trees_add_secrets_and_keep_base_spans(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        secret = "".join(rnd.choice("0123456789abcdef") for _ in range(18))
        word = rnd.choice(["password=", 'token = "', "width=", "see ", "mail ", "at "])
        what = {"mail ": f"u{i}@mail.example.com", "at ": f"{rnd.randint(1, 250)}.2.3.4"}.get(word, secret if word[0] in "pt" else "plainword")
        rows.append((i, f"Some text {word}{what}{chr(34) if word.endswith(chr(34)) else ''} and more words 12 here."))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pd.train(df)
    assert model is not None and set(model["thresholds"]) == set(pd.GENERATORS)
    found = pd.find_spans(df, model).collect()
    secrets = [r for r in found if "password=" in r["text"] or "token =" in r["text"]]
    caught = sum(any(s["kind"] in ("value", "token") for s in r["_spans"]) for r in secrets)
    assert caught >= 0.95 * len(secrets)
    for r in found:
        assert [tuple(x) for x in r["_spans"]][:len(r["_base"])] == brute(r["text"])
        if "width=" in r["text"] or "see " in r["text"]:
            assert len(r["_spans"]) == len(r["_base"])


def test_trees_in_sql_equal_the_fitted_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rnd = random.Random(1)
    rows = [([rnd.random(), rnd.random()],) for _ in range(400)]
    df = spark.createDataFrame(rows, "x array<double>").withColumn("label", ((F.col("x")[0] > 0.4) != (F.col("x")[1] > 0.7)).cast("double"))
    fitted = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(df.withColumn("features", array_to_vector("x")))
    mine = {"trees": [pd._parse_tree(t.toDebugString) for t in fitted.trees], "weights": list(fitted.treeWeights)}
    both = fitted.transform(df.withColumn("features", array_to_vector("x"))) \
        .select(vector_to_array("probability")[1].alias("p"), pd.score(mine, F.col("x")).alias("q")).collect()
    assert all(abs(r["p"] - r["q"]) < 1e-9 for r in both)


def test_redaction(spark):
    rows = [(1, "Mail a@b.co now, +1 (555) 123-4567 or 4111 1111 1111 1111.", "en", 5), (2, None, None, None), (3, "clean", "de", 5), (3, "clean", "de", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    out = pd.redact(df, None)
    assert out.columns == df.columns
    got = sorted(map(tuple, out.collect()))
    assert got[0] == (1, "Mail [EMAIL] now, [PHONE] or [CARD].", "en", len("Mail [EMAIL] now, [PHONE] or [CARD]."))
    assert got[1:] == [(2, None, None, None), (3, "clean", "de", 5), (3, "clean", "de", 5)]
    assert pd.redact(df.limit(0), None).count() == 0
    assert pd.train(df.limit(0)) is None
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_long_secrets_and_addresses_go_whole(spark):
    """Whatever the trees say: every candidate is accepted here."""
    model = {"trees": [1.0], "weights": [1.0], "thresholds": {k: 0.5 for k in pd.GENERATORS}}
    rows = []
    for n in (12, 128, 200, 5000, 100_000):
        secret = ("aB3$" * n)[:n]
        rows += [("password = " + secret + " end", "password = [VALUE] end"), (f'token: "{secret}"', 'token: "[VALUE]"'),
                 ("x" * n + " (at) y.org, end", "[ADDRESS], end"), ("me(at)" + "z" * n + ", end", "[ADDRESS], end")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = dict(pd.redact(df, model).select("doc_id", "text").collect())
    for i, (_, new) in enumerate(rows):
        assert got[i] == new, (i, got[i][:200])


def test_training_reads_the_candidates_of_every_document(spark, monkeypatch):
    """More documents than the 20,000 that were once sampled; the last generator's sign alone is enough to be read."""
    kept = []
    plain = pd.common.written
    monkeypatch.setattr(pd.common, "written", lambda df, name: kept.append(plain(df, name)) or kept[-1])
    text = F.when(F.col("id") % 3 == 0, F.concat(F.lit("password=ab1"), F.sha2(F.col("id").cast("string"), 256))) \
        .when(F.col("id") % 3 == 1, F.lit("width=plainword")).otherwise(F.lit("me(at)home, or not"))
    model = pd.train(spark.range(24_000).select(F.col("id").alias("doc_id"), text.alias("text")))
    assert model is not None and set(model["thresholds"]) == set(pd.GENERATORS)
    rows = kept[0].select(F.explode("found.kind").alias("kind")).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in rows}["value"] == 16_000 and {r["kind"]: r["count"] for r in rows}["address"] == 8_000
