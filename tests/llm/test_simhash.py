"""Operator 7: fingerprints and components against brute force."""

import random
import re

import numpy as np
import xxhash

from arrears.llm import simhash_vpt as vpt
from tests.llm.rows import no_documents, odd_documents


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(points, r=2):
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if ((int(a) ^ int(points[j])) & (1 << 64) - 1).bit_count() <= r:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(points))]


def clustered(rng, n):
    """Points in chains and balls of a few bits, among far points."""
    out = {0, 3}
    while len(out) < n:
        p = rng.getrandbits(64)
        out.add(p)
        for _ in range(rng.choice([0, 0, 3, 40])):
            p ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                p ^= 1 << rng.randrange(64)
            out.add(p)
    return np.array(sorted(out), dtype=np.uint64)


def partition(points, links):
    root = {int(p): int(p) for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(int(a)), find(int(b))
        root[max(x, y)] = min(x, y)
    return [find(int(p)) for p in points]


def same_groups(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_shards_lose_no_link():
    for seed in range(4):
        points = clustered(random.Random(seed), 900)
        want = brute_roots(points)
        u, v = vpt.shard_links(points)
        assert same_groups(want, partition(points, zip(u, v)))
        nodes = vpt.fit_tree(points[::3], 5)
        shard, sent = vpt.route(nodes, points)
        assert len(np.unique(shard)) > 4 and len(sent) < 6 * len(points)
        pairs = [p for s in np.unique(shard) for p in zip(*vpt.shard_links(sent[shard == s]))]
        assert same_groups(want, partition(points, pairs))


def test_dense_ball_by_lookup(monkeypatch):
    rng = random.Random(2)
    ball = np.unique(np.array([sum(1 << b for b in rng.sample(range(60), rng.randint(0, 5))) for _ in range(700)], np.uint64))
    want = brute_roots(ball)
    monkeypatch.setattr(vpt, "BRUTE", 10)
    ball = np.unique(np.concatenate((ball, ball ^ np.uint64(1 << 63))))      # both signs of the stored number
    want = brute_roots(ball)
    a, b = vpt._leaf_links(ball, 2)
    assert same_groups(want, partition(ball, zip(ball[a], ball[b])))


def test_odd_rows_against_brute_force(spark):
    docs = odd_documents(spark)
    rows = docs.collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    roots = brute_roots(prints)
    want = sorted((str(r.doc_id), f"{p:016x}", str(min((rows[k].doc_id for k in range(len(rows)) if roots[k] == root and rows[k].doc_id is not None), default=None)))
                  for r, p, root in zip(rows, prints, roots))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in vpt.near_duplicates(docs).collect())
    assert got == want
    kept = vpt.keep_one(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert len(left) == len(set(roots))
    ids = {str(r.doc_id) for r in left}
    assert ids == {w[2] for w in want}


def test_components_of_chains(spark, monkeypatch):
    """Long chains over many shards come out as one component each."""
    rng, points = random.Random(4), []
    for _ in range(5):
        p = rng.getrandbits(64)
        for _ in range(300):
            points.append(p)
            p ^= 1 << rng.randrange(64)
    points = np.unique(np.array(points, np.uint64).view(np.int64))
    monkeypatch.setattr(vpt, "SHARD_POINTS", 64)
    df = spark.createDataFrame([(int(p),) for p in points], "fp long").repartition(5)
    got = {r.fp: r.root for r in vpt.components(vpt.links(df)).collect()}
    assert same_groups(brute_roots(points), [got.get(int(p), int(p)) for p in points])


def test_empty(spark):
    assert vpt.near_duplicates(no_documents(spark)).count() == 0
    assert vpt.keep_one(no_documents(spark)).count() == 0
