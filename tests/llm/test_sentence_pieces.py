import hashlib
import random

import pyarrow as pa
import pytest

from transitlab.llm import registry
from transitlab.llm import sentence_pieces as sp

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "   ", "  a  b\t\n c ", "日本語 テスト 🎉 x\u0000y", "▁▁ a▁b", "<s> </s> <0x41> <unk>", "a" * 500, "x\n.\nyz!!",
       "Word, word; word.", "    def f(x):\n        return x  ", "\xa0x　y", "ﬁé́", "12.5% (of) 'it's'", "x²." * 30]


def test_encode_and_decode_equal_the_library():
    m = sp.model(PATH)
    rnd = random.Random(3)
    texts = ODD + ["".join(rnd.choice("ab c▁  \n\té日🎉.!1́'") for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    for t in texts:
        ids = m.encode(t)
        assert ids == m.lib.encode(t, add_eos=True)
        assert m.decode(ids) == m.lib.decode(ids)


def test_heap_and_ragged_agenda_agree(monkeypatch):
    m = sp.model(PATH)
    rnd = random.Random(5)
    parts = ["".join(rnd.choice("thernsoe▁日🎉é") for _ in range(rnd.randint(1, 40))) for _ in range(500)]
    short = [e[0] for e in m.entries(parts)]
    assert short == [m.merge(p) for p in parts]
    monkeypatch.setattr(sp, "SHORT", 0)
    assert [e[0] for e in m.entries(parts)] == short


def test_decode_of_any_ids_equals_the_library():
    m = sp.model(PATH)
    rnd = random.Random(4)
    for _ in range(3000):
        ids = [rnd.randint(0, 400) for _ in range(rnd.randint(0, 7))]
        assert m.decode(ids) == m.lib.decode(ids)


def test_part_table_keeps_results_when_it_rolls_over(monkeypatch):
    monkeypatch.setattr(sp, "CACHE_PARTS", 3)
    m = sp.PieceModel(PATH)
    words = "one two three four five six one two nine one".split()
    for w in words * 3:
        assert m.encode(w) == m.lib.encode(w, add_eos=True)
    assert len(m.cache) <= 3 and len(m.cache.old) <= 3


def test_round_trip_rows(spark):
    docs = spark.createDataFrame(
        [(1, "Hello world.", "x"), (1, "Hello world.", "y"), (2, None, None), (None, "", "z"), (3, "é" * 20_000, "q")],
        "doc_id long, text string, ids string")
    rows = sp.round_trip(docs, PATH).collect()
    assert len(rows) == 5 and all(r["library_equal"] for r in rows)
    empty = [r for r in rows if r["doc_id"] in (2, None)]
    assert all(r["n_tokens"] == 1 and r["decoded_sha256"] == hashlib.sha256(b"").hexdigest() for r in empty)
    enc = sp.encode(docs, PATH)
    back = {(r["doc_id"], r["text"]) for r in sp.decode(enc, PATH).collect()}
    assert back == {(1, "Hello world."), (2, ""), (None, ""), (3, "é" * 20_000)}
    assert sp.round_trip(docs.limit(0), PATH).count() == 0


def test_digests_of_parts_equal_those_of_whole_texts():
    m = sp.PieceModel(PATH)
    texts = ["Some words, some more words.\n\nAnd 12% 日本 of them!", "", " ", "  a", "\ue000x \U0001f642\u0378", "x" * 300, "\u2581a b"]
    entries = m.parts(texts)
    for text, e in zip(texts, entries):
        ids = m.ids_of(e)
        numbers, back = m.texts_of(e, ids)
        assert ids == m.lib.encode(text, add_eos=True)
        assert numbers == " ".join(map(str, ids)) and back == m.decode(ids) == m.lib.decode(ids)


def test_the_table_holds_ids_alone_whose_numbers_are_shared():
    """Every part that a worker remembers costs one tuple; its numbers are the same objects in all parts."""
    m = sp.PieceModel(PATH)
    first, second = m.parts(["some thousand words"])[0], m.parts(["words, some thousand"])[0]
    assert all(isinstance(i, int) for ids in first + second for i in ids)
    numbers = {i: i for ids in m.cache.values() for i in ids}
    assert len(m.cache) > 3 and all(numbers[i] is i for ids in m.cache.values() for i in ids)


def test_parts_already_known_are_looked_up_once(monkeypatch):
    m = sp.PieceModel(PATH)
    m.parts(["one two three"])
    asked = []
    monkeypatch.setattr(m.cache, "entries", lambda parts: asked.append(sorted(parts)) or m.entries(parts))
    texts = ["one two three", "three four one", "", "four"]
    assert list(map(m.ids_of, m.parts(texts))) == m.lib.encode(texts, add_eos=True)
    assert asked == [["▁four"]]


def test_every_pair_of_the_vocabulary_has_its_slot():
    import numpy as np
    m = sp.model(PATH)
    pairs = {}
    for p, i in m.ids.items():
        for k in range(1, len(p)):
            a, b = (m.ids.get(x, ord(x) + sp.SIGNS if len(x) == 1 else None) for x in (p[:k], p[k:]))
            if a is not None and b is not None:
                pairs[a, b] = i
    left, right = np.array(list(pairs), dtype=np.int32).T
    at = m._slots(left, right)
    assert m.joined[at].tolist() == list(pairs.values()) and (m.place[at] < sp.NONE).all()
    none = m._slots(right, left)
    assert [k < sp.NONE for k in m.place[none].tolist()] == [(b, a) in pairs for a, b in pairs]
    assert (m.place[m._slots(left, np.full(len(left), sp.PAD))] == sp.NONE).all()


def test_bytes_decode_alone_in_runs_and_beside_silent_ids():
    m = sp.model(PATH)
    b = m.byte_ids
    for ids in ([b[0xC3], b[0xA9]], [b[0xC3], m.end, b[0xA9]], [b[0xC3], b[10], b[0xA9]], [b[10], b[0xE6], b[0x97], b[0xA5], b[0xFF], m.end],
                [m.end, b[0xC3], b[0xA9]], [b[0xC3], m.unk, b[0xA9], m.end]):
        assert m.decode(ids) == m.lib.decode(ids)


def test_lengths_of_all_rows_agree_with_the_heap():
    m = sp.model(PATH)
    rnd = random.Random(6)
    parts = ["▁" + "".join(rnd.choice("aehnrst\n日é🎉.\x00\u0378") for _ in range(n)) for n in range(0, 70) for _ in range(6)]
    assert [e[0] for e in m.entries(parts)] == [m.merge(p) for p in parts]
    assert m.entries([]) == []


def test_a_wrong_part_is_told(spark, monkeypatch):
    right = sp.PieceModel.merge_all
    monkeypatch.setattr(sp.PieceModel, "merge_all",
                        lambda self, parts: [(5,) if p == "▁wrong" else ids for p, ids in zip(parts, right(self, parts))])
    m = sp.PieceModel(PATH)
    entries = m.parts(["all right", "all wrong"])
    assert [m.ids_of(e) == m.lib.encode(t, add_eos=True) for e, t in zip(entries, ["all right", "all wrong"])] == [True, False]


def test_whole_table_equals_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert sp.round_trip(docs, PATH).filter("NOT library_equal").count() == 0


@pytest.mark.parametrize("wrong", ["ids", "decoded text"])
def test_registered_query_compares_whole_rows_with_the_library(spark, tmp_path, monkeypatch, wrong):
    """Every part is merged rightly, but the row's joined ids or its decoded text are not the library's."""
    spark.createDataFrame([(1, "Some words, some more words.")], "doc_id long, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    m = sp.PieceModel(PATH)
    if wrong == "ids":
        monkeypatch.setattr(m, "ids_of", lambda e: sp.PieceModel.ids_of(m, e)[1:])
    else:
        monkeypatch.setattr(m, "texts_of", lambda e, ids: (sp.PieceModel.texts_of(m, e, ids)[0], "other"))
    batches = []
    monkeypatch.setattr(sp.common, "map_batches", lambda df, fn, schema: batches.append(fn) or df)
    monkeypatch.setitem(sp._MODELS, PATH, m)
    registry.op2_sentencepiece(spark, str(tmp_path))
    row = batches[0](pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["Some words, some more words."]}))
    assert row.column("library_equal").to_pylist() == [False]
