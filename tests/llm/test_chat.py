import itertools

from pyspark.sql import functions as F

from transitlab.llm import chat

TREE = "tree long, node long, parent long, role string, text string, score double"


def brute_paths(rows):
    parent = {(t, n): p for t, n, p, *_ in rows}
    heads = {(t, p) for t, n, p, *_ in rows if (t, p) in parent}
    out = set()
    for t, n in parent:
        if (t, n) in heads:
            continue
        path, at, seen = [], n, set()
        while (t, at) in parent and at not in seen:
            path.append(at)
            seen.add(at)
            at = parent[t, at]
        out.add((t, n, tuple(reversed(path))))
    return out


def test_paths_equal_brute_force(spark):
    rows = [(1, i, (i - 1) // 2 if i else None, "user", f"t{i}", float(i % 5)) for i in range(40)]
    rows += [(2, i, i - 1 if i else None, "user", "x", 0.0) for i in range(21)]
    rows += [(3, 7, 99, "user", "orphan", None), (None, 1, None, "user", "a", 1.0), (None, 2, 1, "assistant", "b", 1.0)]
    df = spark.createDataFrame(rows, TREE)
    got = {}
    for r in chat.paths(df).collect():
        got.setdefault((r["tree"], r["leaf"]), []).append((-r["up"], r["node"]))
    got = {(t, leaf, tuple(n for _, n in sorted(p))) for (t, leaf), p in got.items()}
    assert got == brute_paths(rows)


def test_branches_are_ranked_by_score(spark):
    rows = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "low", 1.0), (1, 2, 0, "assistant", "high", 5.0),
            (1, 3, 0, "assistant", "tied", 5.0), (1, 3, 0, "assistant", "tied", 5.0)]
    df = spark.createDataFrame(rows, TREE)
    best = chat.format_trees(df, 2).orderBy("rank").collect()
    assert [(r["leaf"], r["rank"]) for r in best] == [(2, 1), (3, 2)]
    assert chat.format_trees(df, None).count() == 3
    assert chat.format_trees(df.limit(0)).count() == 0


def test_cycles_end(spark):
    rows = [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0), (1, 5, None, "user", "c", 0.0)]
    assert [r["leaf"] for r in chat.paths(spark.createDataFrame(rows, TREE)).collect()] == [5]


def test_every_text_is_read_back(spark):
    bits = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "\n", "a", "\\n", "🎉", "<\\|", "$1", ""]
    texts = ["".join(p) for p in itertools.product(bits, repeat=2)] + [None, "x" * 50_000]
    rows = [(i % 7, j, ["user", "assistant", "sys\ntem\\n", None, "<|im_end|>"][(i + j) % 5], t)
            for j, t in enumerate(texts) for i in range(1)]
    rows = [(k % 7 if k % 3 else None, k // 10, r, t) for k, (_, _, r, t) in enumerate(rows)] + [(1, None, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_trees(chat.conversation_tree(df))
    got = made.select("tree", "formatted", chat.parse(F.col("formatted")).alias("turns"),
                      chat.masked_texts(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()
    def order(r):
        return tuple((x is not None, x if x is not None else 0) if not isinstance(x, str) else (True, x) for x in r[1:])
    for r in got:
        mine = sorted((x for x in rows if x[0] == r["tree"]), key=lambda x: (
            (x[1] is not None, x[1] or 0), (x[2] is not None, (x[2] or "").encode()), (x[3] is not None, (x[3] or "").encode())))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in mine]
        assert list(r["loss"]) == [x[3] or "" for x in mine if x[2] == "assistant"]
        assert r["formatted"].count(chat.START) == len(mine) and r["formatted"].count(chat.END) == len(mine)
    assert len(got) == len({x[0] for x in rows})


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.format_trees(chat.conversation_tree(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_roles_are_read_back(spark):
    roles = ["user", "a\x00b", "\\", "\\n", "\n", "\\\n", "\\\\n\n\\", "x\\\\", "<|im_end|>", ""]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(roles)], "i int, role string")
    got = {r.i: r for r in df.select("i", chat.escape_role(F.col("role")).alias("e"), chat.unescape_role(chat.escape_role(F.col("role"))).alias("r")).collect()}
    assert [got[i].r for i in range(len(roles))] == roles
    assert all("\n" not in got[i].e for i in range(len(roles)))
