import hashlib
import random

from pyspark.sql import functions as F

from transitlab.llm import spot_signatures as ss

SCHEMA = "doc_id long, text string, fingerprint string"


def brute(rows, hashes):
    """The whole comparison on one machine."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1] or ""], r[1] or ""))
    out = []
    for k, (i, t, _) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        q = len(t) // 4
        new = t[:len(t) - q] + nxt[:q]
        a, b, c = (set(ss.signatures(x).tolist()) for x in (t, new, nxt))
        def like(x, y):
            return len(x & y) / len(x | y) if x | y else 1.0
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), ss.written_form(ss.signatures(t)), like(a, b), like(a, c)))
    return sorted(out, key=repr)


def corpus():
    rnd = random.Random(8)
    words = [f"word{i}" for i in range(300)] + ["the", "of", "and", "is", "der", "la"] * 20
    rows = [(i * 3, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 120))), "x") for i in range(80)]
    return rows + [(1000, None, "x"), (1001, "", "x"), (1002, "...", "x"), (1003, "🎉é日本 of the", "x"), (1004, "the of", "x"), (None, "no id", "x"),
                   (2000, "long words of it " * 20_000, "x"), (2001, "abc", "x")]


def test_equals_one_pass_over_the_sorted_rows(spark):
    rows = corpus()
    rows += [(30, f"copy {k} of the one id", "x") for k in range(60)] + [(30, "the very same row", "x")] * 5
    texts = spark.createDataFrame([(t or "",) for t in {r[1] for r in rows}], "t string")
    hashes = dict(texts.select("t", F.xxhash64("t")).collect())       # rows with one id are ordered by it
    for parts, ranges in ((1, 1), (5, None), (3, 40)):
        got = ss.compare_with_next(spark.createDataFrame(rows, SCHEMA).repartition(parts), ranges).collect()
        mine = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["near_edited"], r["near_next"]) for r in got), key=repr)
        assert mine == brute(rows, hashes)
    one = ss.compare_with_next(spark.createDataFrame([(1, "only the one", "x")], SCHEMA)).first()
    assert one["near_next"] == 1.0
    assert ss.compare_with_next(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_texts_have_equal_fingerprints_and_edits_stay_near(spark):
    rnd = random.Random(1)
    text = " ".join(rnd.choice(["the", "of", "and"] + [f"w{i}" for i in range(50)]) for _ in range(400))
    other = " ".join(rnd.choice(["the", "of", "and"] + [f"v{i}" for i in range(50)]) for _ in range(400))
    rows = [(1, text, "x"), (2, other, "x"), (3, text, "x")]
    got = {r["doc_id"]: r for r in ss.compare_with_next(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1]["fingerprint"] == got[3]["fingerprint"] and got[1]["near_edited"] > 0.5 > got[1]["near_next"]


def test_near_classes_equal_brute_force(spark):
    rnd = random.Random(9)
    rows, i = [], 0
    for _ in range(20):
        base = [rnd.choice(["the", "of", "is"] + [f"w{k}" for k in range(200)]) for _ in range(rnd.choice([8, 300, 900]))]
        for _ in range(6):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 4]) if len(w) > 8 else 0):
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(200)}"
            rows.append((i, " ".join(w), "x"))
            i += 1
    rows += [(900, "", "x"), (901, None, "x"), (902, rows[0][1], "x")]
    sets = [set(ss.signatures(t or "").tolist()) for _, t, _ in rows]
    expected = {}
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo and sets[k]:
            at = todo.pop()
            for j in range(len(rows)):
                if j not in seen and sets[j] and len(sets[at] & sets[j]) >= 0.8 * len(sets[at] | sets[j]):
                    seen.add(j)
                    todo.append(j)
        expected[i] = min(rows[j][0] for j in seen)
    got = dict(ss.near_classes(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == expected and len(set(expected.values())) < 0.8 * len(rows)


def test_signatures_grow_with_texts_without_common_words():
    rnd = random.Random(6)
    russian = " ".join(rnd.choice("дом река поле небо город книга слово ветер утро снег".split()) + str(rnd.randrange(50)) for _ in range(400))
    chinese = "".join(chr(0x4E00 + rnd.randrange(2000)) for _ in range(400))
    numbers = "\n".join(f"{rnd.randrange(1000)};{rnd.randrange(1000)}" for _ in range(200))
    for text in (russian, chinese, numbers):
        whole, new = ss.signatures(text), ss.signatures(ss.edited(text, "совсем другой текст 完全不同 " * 100))
        assert len(whole) > 60 and len(whole) > 1.5 * len(ss.signatures(text[:len(text) // 2]))
        assert 0.4 < ss.jaccard(whole, new) < 0.95
        assert ss.jaccard(whole, ss.signatures(text[:len(text) // 8] + numbers[::-1])) < 0.5
