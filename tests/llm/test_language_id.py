import itertools
import random

from pyspark.sql import functions as F

from transitlab.llm import language_id as lid

WORDS = {"en": "the house and river with stone from water green light".split(),
         "de": "das haus und fluss mit stein aus wasser gruen licht über".split(),
         "ru": "дом река камень вода свет и из зелёный".split()}


def sentence(rnd, lang, n):
    return " ".join(rnd.choice(WORDS[lang]) for _ in range(n))


def trained(spark):
    rnd = random.Random(1)
    rows = [(i, sentence(rnd, lang, 30), lang) for i, lang in enumerate(list(WORDS) * 40)]
    rows += [(900, None, "en"), (901, "x", None), (None, "zzz", "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df, lid.train(df)


def brute_path(rows, penalty):
    best = max(itertools.product(range(len(rows[0])), repeat=len(rows)),
               key=lambda p: sum(r[k] for r, k in zip(rows, p)) - penalty * sum(a != b for a, b in zip(p, p[1:])))
    return sum(r[k] for r, k in zip(rows, best)) - penalty * sum(a != b for a, b in zip(best, best[1:]))


def test_viterbi_equals_brute_force_and_the_shortcut_is_safe():
    import numpy as np
    rnd = random.Random(2)
    for _ in range(300):
        rows = [[-rnd.random() * 6 for _ in range(3)] for _ in range(rnd.randint(1, 6))]
        penalty = rnd.choice([0.5, 2.0, 6.0])
        path = lid.viterbi(rows, penalty)
        value = sum(r[k] for r, k in zip(rows, path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
        best = brute_path(rows, penalty)
        assert abs(value - best) < 1e-9
        one = lid.one_language(np.array(rows), penalty)
        if one is not None:
            assert abs(sum(r[one] for r in rows) - best) < 1e-9


def test_held_out_accuracy_and_edges(spark):
    df, model = trained(spark)
    assert model["langs"] == ["de", "en", "ru"]
    got = {r["doc_id"]: r for r in lid.language_spans(df, model).collect()}
    held = df.filter(~lid.is_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).collect()
    assert len(held) > 20 and all(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert (got[900]["lang_pred"], got[900]["score"], got[900]["spans"]) == ("und", 0.0, [])
    odd = spark.createDataFrame([(1, ""), (2, "12 34 !!"), (3, None), (3, None), (4, "дом " * 20_000), (5, "x" * 100_000)],
                                "doc_id long, text string")
    out = {(r["doc_id"], r["lang_pred"]) for r in lid.language_spans(odd, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "ru")} <= out and len(out) == 5
    assert lid.language_spans(odd.limit(0), model).count() == 0
    nothing = lid.train(df.limit(0))
    assert {r["lang_pred"] for r in lid.language_spans(df, nothing).collect()} == {"und"}


def test_mixed_text_is_labelled_by_span(spark):
    _, model = trained(spark)
    rnd = random.Random(3)
    text = f"1. {sentence(rnd, 'en', 40)}. {sentence(rnd, 'ru', 30)}! {sentence(rnd, 'de', 30)}"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = lid.language_spans(df, model).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "ru", "de"]
    assert text[spans[1]["start"]:spans[1]["end"]].strip("!. ") in text and spans[-1]["end"] == len(text)


def test_keep_identified_keeps_columns_and_clean_rows(spark):
    df, model = trained(spark)
    docs = df.withColumn("score", F.lit("mine"))
    kept = lid.keep_identified(docs, model)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert 900 not in ids and set(range(120)) <= ids


def test_number_signs_are_no_letters():
    model = lid.build([("de", "5", 3.0), ("de", "latin", 3.0)])
    table = lid.WordScores(model)
    signs = "\u00bd \u00b2 \u2163 \u2460 12 \u0663"
    assert [g[:2] for g in lid.label_all([signs, "", "3\u00b2"], table)] == [("und", 0.0)] * 3
    label, score, spans = lid.label_all(["a\u00b2b \u2163 c"], table)[0]
    assert label == "de" and score > 0 and spans == [(0, 7, "de")]
    assert lid.only_letters("x\u00b2\u4e00y") == "x \u4e00y"
    assert all(c.isalpha() for w in lid.WORD.findall(lid.only_letters("".join(map(chr, range(0x3000))))) for c in w)


def test_every_training_document_is_counted(spark):
    # 3,000 documents of one language, more than a sample of 2,000 held: a word that each has once is counted for each that may be learned from
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("river").alias("text"), F.lit("en").alias("lang"))
    seen = []

    def counts(rows):
        seen.extend(rows)
        return {}
    build, lid.build = lid.build, counts
    try:
        lid.train(docs)
    finally:
        lid.build = build
    n = docs.filter(lid.is_training(F.col("doc_id"))).count()
    assert n < 3000 and [r for r in seen if r[1] == "latin"] == [("en", "latin", 5.0 * n)]


def test_many_languages_and_words_are_counted_in_parts(monkeypatch):
    texts, langs = ["river stone дом"] * 12 + ["stone"], [f"l{i % 6}" for i in range(12)] + ["l0"]
    whole = lid.Counted()
    assert whole.add(texts, langs) is None
    want = whole.taken().to_pylist()
    monkeypatch.setattr(lid, "MAX_TASK_LANGUAGES", 2)
    monkeypatch.setattr(lid, "MAX_TASK_WORDS", 4)
    parts, got = lid.Counted(), {}
    batches = [b for b in [parts.add([t], [x]) for t, x in zip(texts, langs)] + [parts.taken()] if b is not None]
    assert len(batches) > 1
    for r in [r for b in batches for r in b.to_pylist()]:
        got[r["lang"], r["cell"]] = got.get((r["lang"], r["cell"]), 0) + r["n"]
    assert got == {(r["lang"], r["cell"]): r["n"] for r in want}
