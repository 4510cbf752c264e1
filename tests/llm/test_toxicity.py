import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from transitlab.llm import toxicity as tx

CLEAN = "river stone water light green house window garden table summer winter letter paper music bread".split()
RUDE = "blorgface skumbert vilenose".split()


def documents(spark, n=300):
    rnd = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(CLEAN) + rnd.choice(["", "s", "ing", "er"]) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            words.insert(rnd.randrange(40), rnd.choice(RUDE))
        docs.append((i, ". ".join(" ".join(words[k:k + 8]) for k in range(0, len(words), 8)) + ".", "en"))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = documents(spark)
    return docs, labels, tx.train(docs, labels)


def kernel(a, b):
    """The gap-weighted kernel by enumeration."""
    def phi(w):
        w, out = "^" + w + "$", {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + tx.SPAN)):
                    out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0.0) + tx.DECAY ** (k - i - 2)
        return out
    def norm(w):
        n = len(w) + 2
        return math.sqrt(sum(tx.DECAY ** (2 * (k - i - 2)) for i in range(n) for k in range(i + 2, min(n, i + tx.SPAN)) for _ in range(i + 1, k)))
    x, y = phi(a), phi(b)
    return sum(v * y.get(u, 0.0) for u, v in x.items()) / norm(a) / norm(b)


def test_features_give_the_subsequence_kernel():
    words = ["idiot", "idxiot", "riot", "a", "stone", "idiotidiot"]
    dense = np.zeros((len(words), tx.SYMBOLS ** 3))
    for where, ids, w in tx.features(words):
        for r, i in zip(where, ids):
            np.add.at(dense[r], i, w)
    for a in range(len(words)):
        for b in range(len(words)):
            assert abs(dense[a] @ dense[b] - kernel(words[a], words[b])) < 1e-5


def test_spaced_and_marked_words_are_read_as_one():
    assert "idiot" in tx.tokens("you i d i o t there") and "idiot" in tx.tokens("I.D.I.O.T!")
    assert tx.unit_of("id-io_t") == "idiot" and tx.tokens("a b") == ["a", "b"] and tx.tokens("") == []


def test_held_out_documents(fitted):
    docs, labels, model = fitted
    got = {r["doc_id"]: r for r in tx.toxicity(docs, model).collect()}
    held = labels.filter(~tx.is_training(F.col("doc_id"))).collect()
    assert len(held) > 30 and all(got[r["doc_id"]]["predicted"] == r["toxic"] for r in held)


def test_gapped_and_inserted_characters_are_caught(spark, fitted):
    _, _, model = fitted
    texts = ["river stone blorgface water", "river s k u m b e r t stone", "water vilexnose light", "BLORG-FACE!", "river stone water light", "", None,
             "x" * 100_000, "stone " * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["predicted"] for r in tx.toxicity(df, model).orderBy("doc_id").collect()]
    assert got[:7] == [1, 1, 1, 1, 0, 0, 0] and got[8] == 0


def test_edges(spark, fitted):
    docs, labels, model = fitted
    assert tx.train(docs, labels.limit(0)) is None and tx.train(docs.limit(0), labels) is None
    assert {r["score"] for r in tx.toxicity(docs, None).collect()} == {0.0}
    assert tx.toxicity(docs.limit(0), model).count() == 0
    extra = docs.withColumn("score", F.lit(1)).withColumn("toxic", F.lit(0))
    kept = tx.keep_clean(extra.unionByName(extra), model)
    assert kept.columns == extra.columns
    toxic = {r["doc_id"] for r in labels.filter("toxic = 1").collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert not toxic & set(ids) and len(ids) == 2 * (300 - len(toxic))


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    # 2,600 documents of a class, more than a sample of 1,500 held
    docs, labels = documents(spark, 80)
    copies = spark.range(65).select((F.col("id") * 1000).alias("_k"))
    docs, labels = (df.crossJoin(copies).withColumn("doc_id", F.col("doc_id") + F.col("_k")).drop("_k") for df in (docs, labels))
    rows, size = tx.training_rows(docs, labels)
    want = {r["toxic"]: r["n"] for r in labels.filter(tx.is_training(F.col("doc_id"))).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert size == want and want[0] > 3000
    assert {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()} == want
    fitted, curve = [], tx.fit_curve
    monkeypatch.setattr(tx, "fit_curve", lambda given: fitted.extend(given) or curve(given))
    model = tx.train(docs, labels)
    # every document has its weight in the curve
    assert sum(r[3] for r in fitted if r[2] == 0) == want[0] and sum(r[3] for r in fitted if r[2] == 1) == want[1]
    assert model["curve"][0] > 0


def test_only_documents_that_are_learned_from_are_shuffled(spark):
    # the ids' filter lets every labelled document pass, few others, whatever plan the size of the labels would choose
    docs = spark.range(4000).select("id", F.lit("some words").alias("text")).withColumnRenamed("id", "doc_id")
    docs = docs.unionByName(docs.limit(50)).unionByName(spark.createDataFrame([(None, "no id")], "doc_id long, text string"))
    marked = spark.range(0, 4000, 100).withColumnRenamed("id", "doc_id")
    kept = [r["doc_id"] for r in tx._may_hold(docs, marked).collect()]
    want = [r["doc_id"] for r in docs.join(marked, "doc_id").collect()]
    assert set(want) <= set(kept) and len(want) <= len(kept) < 100 and tx._may_hold(docs, marked).columns == docs.columns


def test_training_leaves_no_tables(spark, monkeypatch):
    made, written = [], tx.common.written_at
    monkeypatch.setattr(tx.common, "written_at", lambda df, path: made.append(path) or written(df, path))
    assert tx.train(*documents(spark, 120)) is not None
    assert made and not any(tx.common.os.path.exists(p.removeprefix("file://")) for p in made)


def test_words_come_back_from_the_old_generation(monkeypatch):
    rng = np.random.RandomState(3)
    model = {"weights": rng.normal(size=tx.SYMBOLS ** 3).astype("float32"), "bias": 0.0, "curve": (1.0, 0.0, 0.0)}
    lists = [[f"word{i % 70}x{i % 3}" for i in range(k, k + 20)] for k in range(0, 200, 10)]
    want = tx.Machine(model).values(lists)
    monkeypatch.setattr(tx, "CACHE_WORDS", 45)
    small = tx.Machine(model)
    got = [v for k in range(0, len(lists), 2) for v in small.values(lists[k:k + 2])]
    assert np.allclose(np.array(got), np.array(want), atol=1e-6) and len(small.value) <= 45 and len(small.old) <= 45
