import random
import zlib
from collections import Counter

import numpy as np
import pytest

from transitlab.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def volume_bound(counts, size):
    """A lower bound of the number of sequences (the larger pieces exclude each other)."""
    best = 0
    for k in range(size // 2 + 1):
        alone = sum(c for n, c in counts.items() if n > size - k)
        large = [(n, c) for n, c in counts.items() if size // 2 < n <= size - k]
        free = sum(c for _, c in large) * size - sum(n * c for n, c in large)
        small = sum(n * c for n, c in counts.items() if k <= n <= size // 2)
        best = max(best, alone + sum(c for _, c in large) + max(0, -(-(small - free) // size)))
    return best


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_every_piece_once_and_is_near_the_bound(seed):
    rnd = random.Random(seed)
    size = rnd.choice([16, 100, 1024])
    counts = {n: rnd.randint(0, 30) for n in range(1, size + 1)}
    used = Counter()
    for lengths, times in (patterns := packing.plan(counts, size)):
        assert sum(lengths) <= size and times > 0
        for n in lengths:
            used[n] += times
    assert used == Counter({n: c for n, c in counts.items() if c})
    assert sum(t for _, t in patterns) <= volume_bound(counts, size) * 1.02 + 2


def test_exact_single_pair_and_triple_complements():
    for counts in ({7: 3, 3: 3}, {7: 2, 2: 2, 1: 2}, {5: 1, 3: 1, 1: 2}):
        assert all(sum(p) == 10 for p, _ in packing.plan(counts, 10))


def test_ids_equal_the_tokenizers_library():
    from tokenizers import Tokenizer
    theirs = Tokenizer.from_file(JSON)
    theirs.encode_special_tokens = True
    rnd = random.Random(1)
    texts = ["", "Hello  world's\n\n x", "<|endoftext|>", "日本🎉 ñandú 12345 \t\t"] + \
        ["".join(rnd.choice("ab c  \n\té日.!1'sñ") for _ in range(rnd.randint(0, 80))) for _ in range(500)]
    for path in (RANKS, JSON):
        enc = packing.encoder(path)
        assert [enc.encode_ordinary(t) for t in texts] == [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_are_taken_out_of_texts_as_the_library_does(spark):
    from tokenizers import Tokenizer
    theirs = Tokenizer.from_file(JSON)
    rnd = random.Random(4)
    bits = ["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "  ", "hello", "é", "日", "<|im_end|>", "'s", "1"]
    texts = ["hello <|endoftext|> world", "<|endoftext|>"] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    expected = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    for path in (RANKS, JSON):
        assert [packing.encoder(path).encode(t) for t in texts] == expected
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), RANKS).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(expected[r["doc_id"]] + [2], dtype="<u4").tobytes())


def test_pack_places_every_token_once(spark):
    texts = [" ".join(["word"] * n) for n in (1, 5, 9, 30, 100, 64, 63, 62, 0)] + ["only"] * 20 + [None]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, "word", "again")],
                                 "doc_id long, text string, sequence_id string").repartition(3)
    rows = packing.pack(docs, RANKS, size=64).collect()
    enc = packing.encoder(RANKS)
    whole = Counter()
    for r in rows:
        ids = enc.encode_ordinary(texts[r["doc_id"]] or "") + [2]
        part = np.array(ids[r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes()
        assert bytes(r["tokens"]) == part and r["ids_crc32"] == zlib.crc32(part)
        assert r["piece"] == 0 or r["length"] == 64
        whole[r["doc_id"]] += r["length"]
    assert whole[0] == 2 * 2 and all(whole[i] == len(enc.encode_ordinary(t or "")) + 1 for i, t in enumerate(texts) if i)
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["tokens"])))
    for parts in by_seq.values():
        at = 0
        for off, n, _ in sorted(parts):
            assert off == at
            at += n
        assert at <= 64
    filled = {r["sequence_id"]: r for r in packing.sequences(packing.pack(docs, RANKS, size=64)).collect()}
    assert len(filled) == len(by_seq) and all(len(r["tokens"]) == 4 * r["length"] for r in filled.values())
    assert packing.pack(docs.limit(0), RANKS).count() == 0
