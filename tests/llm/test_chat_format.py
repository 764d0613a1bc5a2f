"""Operator 3: trees with branches, exact round trips, edge cases."""

import random

from arrears.llm import chat_format as cf

SCHEMA = "conv_id long, node long, parent long, role string, text string, score double"


def brute(messages, top_k):
    """Chosen paths of each tree by walking up from every leaf."""
    by = {(m[0], m[1]): m for m in messages}
    up = lambda m: by.get((m[0], m[2])) if m[2] is not None and m[2] < m[1] else None
    inner = {(m[0], m[2]) for m in messages if up(m)}
    trees = {}
    for m in messages:
        if (m[0], m[1]) in inner:
            continue
        path = [m]
        while up(path[-1]):
            path.append(up(path[-1]))
        path.reverse()
        mean = sum(x[5] or 0.0 for x in path) / len(path)
        trees.setdefault((m[0], path[0][1]), []).append((-mean, -len(path), m[1], path))
    return {(c, r, rank): p[3] for (c, r), ps in trees.items() for rank, p in enumerate(sorted(ps, key=lambda p: p[:3])[:top_k], 1)}


def test_branches_ranked_and_formatted(spark):
    rng = random.Random(3)
    messages = []
    for conv in (1, 2, None):
        for node in range(1, 60):
            parent = None if node == 1 else rng.choice([rng.randint(1, node - 1), node - 1, node - 1, 900 if node % 17 == 0 else node - 1])
            messages.append((conv, node, parent, rng.choice(["user", "assistant"]), f"say <|{node} & </s>", rng.choice([None, 0.25, 0.5, 1.0])))
    messages.append((1, 500, 700, "user", "looks up to a later one", 1.0))
    messages.append((1, 700, None, "user", "later", 1.0))
    got = cf.format_threads(spark.createDataFrame(messages, SCHEMA).repartition(4), top_k=2)
    rows = got.select("*", cf.read_turns(got["formatted"]).alias("turns"), cf.read_loss(got["formatted"], got["loss"]).alias("learned")).collect()
    want = brute(messages, 2)
    assert {(r.conv_id, r.root, r["rank"]) for r in rows} == set(want)
    for r in rows:
        path = want[(r.conv_id, r.root, r["rank"])]
        assert r.leaf == path[-1][1]
        assert [(t.role, t.text) for t in r.turns] == [(m[3], m[4]) for m in path]
        assert r.learned == "".join(m[4] for m in path if m[3] == "assistant")
        spans = [r.formatted[s.start:s.start + s.length] for s in r.loss]
        assert len(spans) == sum(m[3] == "assistant" for m in path)


def test_escapes_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "&lt;| &amp;lt; &#91;INST]", "<<SYS>> <</SYS>> <s><|end|><|start|>user<|text|>", "<", "<<|", "&", "",
             None, "é ü 漢字 \U0001F600 <|", "[INST", "[[INST]]", "<|end|", "a\nb\r\n", "$1 \\1 \\"]
    roles = ["assistant", "user", "<|text|>", None, "ass<istant", "assistant\n"]
    rows = [(c, t, roles[(c + t) % len(roles)], texts[(c * 5 + t) % len(texts)]) for c in range(len(texts)) for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = cf.format_threads(cf.linear_thread(df))
    read = out.select("conv_id", cf.read_turns(out["formatted"]).alias("turns"), cf.read_loss(out["formatted"], out["loss"]).alias("l"),
                      cf.escape(out["formatted"]).alias("x")).collect()
    for r in read:
        mine = sorted((t, role or "", text or "") for c, t, role, text in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [m[1:] for m in mine]
        assert r.l == "".join(m[2] for m in mine if m[1] == "assistant")


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a", "x"), (1, 0, "user", "a", "x"), (1, None, None, None, None), (None, 1, "assistant", "z" * 300_000, "x"),
            (2, 5, "assistant", "only", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, k string")
    got = {r.conv_id: r for r in cf.digests(cf.format_threads(cf.linear_thread(df))).collect()}
    assert {c: r.n_turns for c, r in got.items()} == {1: 3, None: 1, 2: 1}
    assert got[None].loss_chars == 300_000 and got[1].loss_chars == 0
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cf.digests(cf.format_threads(cf.linear_thread(empty))).count() == 0


def test_long_thread(spark):
    df = spark.range(1500).selectExpr("7 as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    r = cf.digests(cf.format_threads(cf.linear_thread(df))).first()
    assert r.n_turns == 1500 and r.loss_chars == sum(len(f"t{i}") for i in range(1, 1500, 2))
