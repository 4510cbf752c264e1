import math
import random
from collections import Counter

import numpy as np

from transitlab.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<double>, label int, cls string"


def valid(v, label):
    return bool(v) and label is not None and None not in v and all(map(math.isfinite, v)) and any(v)


def brute(rows):
    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))
    n = len(rows)
    ok = [valid(r[1], r[2]) for r in rows]
    links = [[j for j in range(n) if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
              and cos(rows[i][1], rows[j][1]) >= 0.98] for i in range(n)]
    out = Counter()
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min(rows[j][0] for j in seen)
        out[rows[i][0], len(links[i]), least, rows[i][0] == least] += 1
    return out


def vectors():
    rnd = np.random.RandomState(3)
    rows, i = [], 0
    for label in (1, 2, None):
        for dim in (16, 64, 300):
            for _ in range(6):
                base = rnd.standard_normal(dim)
                for k in range(rnd.choice([1, 3, 9])):
                    v = base + rnd.standard_normal(dim) * rnd.choice([0.0, 0.02, 0.1, 0.19, 0.4])
                    rows.append((i, [float(x) for x in v * rnd.choice([1.0, 7.5])], label, "x"))
                    i += 1
    zero = [0.0] * 16
    rows += [(900, None, 1, "x"), (901, [], 1, "x"), (902, zero, 1, "x"), (903, zero, 1, "x"), (904, [float("nan")] * 16, 1, "x"),
             (905, [1.0, None] * 8, 1, "x"), (906, [float("inf")] * 16, 1, "x"), (907, [-0.0] * 15 + [1.0], 2, "x"),
             (908, [0.0] * 15 + [2.0], 2, "x"), (0, rows[0][1], rows[0][2], "x"), (909, [1e-200] * 16, 1, "x"), (910, [1e200] * 16, 1, "x")]
    return rows


def test_equals_brute_force_over_all_pairs(spark):
    rows = vectors()
    # huge and tiny components overflow in the plain formula: compared apart
    plain = [r for r in rows if r[0] not in (909, 910)]
    got = Counter(tuple(r) for r in ed.near_duplicates(spark.createDataFrame(plain, SCHEMA).repartition(4)).collect())
    assert got == brute(plain)
    scaled = {r["vec_id"]: r["n_links"] for r in ed.near_duplicates(spark.createDataFrame(rows[-2:], SCHEMA)).collect()}
    assert scaled == {909: 1, 910: 1}
    assert ed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_is_unbiased_and_bounded():
    rnd = np.random.RandomState(1)
    x = rnd.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    signs, factors = ed.encode(x)
    q = rnd.standard_normal(64)
    y = ed.rotation(64) @ (q / np.linalg.norm(q))
    estimate = (np.where(signs, 1.0, -1.0) / math.sqrt(signs.shape[1])) @ y / factors
    error = estimate - x @ (q / np.linalg.norm(q))
    bound = ed.CONFIDENCE * np.sqrt((1 - factors ** 2) / factors ** 2 / (signs.shape[1] - 1))
    assert (np.abs(error) < bound).all() and abs(error.mean()) < 0.02


def test_bounds_keep_every_link_and_prune_the_rest():
    rnd = np.random.RandomState(2)
    base = rnd.standard_normal((60, 64))
    x = np.vstack([base, base + rnd.standard_normal((60, 64)) * 0.15])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    signs, factors = ed.encode(x)
    may, exact = ed.may_reach(x, signs, factors), x @ x.T >= 0.98
    assert (may | ~exact).all() and may.mean() < 0.05
    assert (ed.links_of(x, signs, factors, np.arange(len(x))) == exact).all()


def test_blocks_give_the_same_links(spark, monkeypatch):
    rnd = random.Random(4)
    base = [rnd.gauss(0, 1) for _ in range(32)]
    rows = [(i, [b + rnd.gauss(0, 0.08) for b in base], 1, "x") for i in range(60)]
    monkeypatch.setattr(ed, "BLOCK", 16)
    monkeypatch.setattr(ed, "BUCKET_BLOCK", 16)
    got = Counter(tuple(r) for r in ed.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)


def test_bands_of_pairs_at_the_threshold_miss_about_as_seldom_as_independent_bits():
    rnd = np.random.RandomState(12)
    missed = 0
    for _ in range(20):
        a, r = rnd.standard_normal((2, 10_000, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        r -= (r * a).sum(axis=1, keepdims=True) * a
        b = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * r / np.linalg.norm(r, axis=1, keepdims=True)
        missed += int((ed.band_values(a) != ed.band_values(b)).all(axis=1).sum())
    assert missed <= 3      # of 200,000; 19 when the bands shared the bits of one 256-bit code
