"""Token counts against the tokenizers library."""
import random

import numpy as np
import pytest

from transitlab.llm import registry, token_counts

SF = "/root/testdata/sf0.001"
PATH = registry.vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def merges():
    return token_counts.WordMerges(PATH)


def library(merges, texts):
    return [len(e.ids) for e in merges.library.encode_batch(texts, add_special_tokens=False)]


def odd_texts():
    rnd = random.Random(5)
    some = "aaabbthe inereion'sd  12ñéÜßΣσς中文字符한국어\t\n.,!?<|endoftext|>🙂‍👩́Ɤ͸ꟜÅﬁİ"
    return ["".join(rnd.choice(some) for _ in range(rnd.randrange(0, 300))) for _ in range(400)]


def test_counts_equal_the_library(merges):
    texts = odd_texts() + ["a" * n for n in range(1, 200)] + [
        "", " ", "<|endoftext|>", "a<|endoftext|>b<|startoftext|>", "<|ENDOFTEXT|>", "don't we'll I'D", "ΑΣ ΣΑΣ", "中文" * 400, "!" * 900]
    assert merges.counts(texts) == library(merges, texts)


def test_both_ways_of_merging_agree(merges):
    rnd = random.Random(7)
    raw = ["".join(rnd.choice("etaoinsh") for _ in range(rnd.randrange(1, 60))).encode() for _ in range(2000)] + [b"a" * n for n in range(1, 40)]
    assert np.array_equal(merges.count_ragged(raw), merges.count_linked(raw))


def test_a_very_long_pre_token(merges):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    assert merges.counts([text, "x " * 100_000]) == library(merges, [text, "x " * 100_000])


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 50)
    own = token_counts.WordMerges(PATH)
    texts = odd_texts()
    got = [c for i in range(0, len(texts), 20) for c in own.counts(texts[i:i + 20])]
    assert got == library(own, texts)


def test_late_merges_are_refused(merges):
    own = token_counts.WordMerges.__new__(token_counts.WordMerges)
    own.result = np.array([5, 6])                 # rank 0 uses symbol 6, which rank 1 makes
    with pytest.raises(ValueError):
        own._check_ranks(np.array([6, 1]), np.array([2, 3]), 8)


def test_nulls_repeats_extra_columns_and_empty_tables(spark):
    schema = "doc_id long, text string, n_tokens string, over_limit int"
    rows = [(1, "a b c", "x", 3), (1, "a b c", "x", 3), (None, None, None, None), (2, "", None, 1), (3, "hello " * 1500, None, 0)]
    got = token_counts.count_tokens(spark.createDataFrame(rows, schema), PATH, limit=1000)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, 5, 3, False), (1, 5, 3, False), (None, 0, 0, False), (2, 0, 0, False), (3, 9000, 1500, True)], key=repr)
    assert token_counts.count_tokens(spark.createDataFrame([], schema), PATH).count() == 0


def test_query_equals_the_library(spark, merges):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in registry.op13_token_counts(spark, SF).collect()}
    want = dict(zip(docs, library(merges, list(docs.values()))))
    assert {k: r.n_tokens for k, r in got.items()} == want
    assert all(got[k].n_bytes == len(t.encode()) and got[k].over_limit == (want[k] > 2048) for k, t in docs.items())
