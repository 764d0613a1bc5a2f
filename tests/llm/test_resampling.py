"""Importance resampling (operator 12): CRCs against zlib, a plain model, awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np

from arrears.llm import resampling
from tests.llm.rows import no_documents, odd_documents

TARGET = ["The tion of er and ing, that ou.", None, "", "re st ON an Ünï 42 x", "the and the and the and"]


def plain_features(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute(rows, target, buckets=10_000, min_words=20, percent=25, seed=7):
    """Sorted (doc_id, n_features, weight, score, rank) in plain loops."""
    def of(f):
        return zlib.crc32(f.encode()) % buckets
    s, t = collections.Counter(), collections.Counter()
    for _, text in rows:
        s.update(map(of, plain_features(text)[1]))
    for text in target:
        t.update(map(of, plain_features(text)[1]))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        words, f = plain_features(text)
        gains = [math.floor(1000 * math.log((t[of(x)] + 1) * (S + buckets) / ((s[of(x)] + 1) * (T + buckets)))) for x in f]
        weight = sum(gains) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1], r[5]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def found(spark, docs, target=TARGET, **options):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    rows = resampling.resample(docs, table, **options).select("doc_id", "n_features", "weight", "score", "rank").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_crc_matrices_are_zlib():
    rng = random.Random(3)
    for n in (0, 1, 2, 7, 64):
        rows = [bytes(rng.randrange(256) for _ in range(n)) for _ in range(50)]
        matrix = np.frombuffer(b"".join(rows), np.uint8).reshape(50, n)
        assert resampling.crc_rows(matrix).tolist() == [zlib.crc32(r) for r in rows]


def test_buckets_of_slices_of_all_lengths(monkeypatch):
    monkeypatch.setattr(resampling, "CHUNK", 64)         # several matrices for one length
    monkeypatch.setattr(resampling, "LONG", 200)
    data = bytes(random.Random(4).randrange(256) for _ in range(3000))
    start = np.array([random.Random(k).randrange(2000) for k in range(300)])
    end = start + np.array([random.Random(-k).choice([0, 1, 5, 5, 5, 13, 199, 200, 201, 900]) for k in range(300)])
    got = resampling.buckets_of(np.frombuffer(data, np.uint8), start, end, 10_000)
    assert got.tolist() == [zlib.crc32(data[a:b]) % 10_000 for a, b in zip(start, end)]


def test_features_across_slices(monkeypatch):
    text = " ".join(random.Random(5).choice(["ab", "Cd", "eé", "7", "x-y", "Ω"]) for _ in range(400))
    texts = [None, text, "", "one", text[:50], "---", text]
    for size in (3, 10, 61, 1 << 20):
        monkeypatch.setattr(resampling, "CHUNK", size)
        got, words = collections.Counter(), collections.Counter()
        for doc, bucket, of in resampling.features(texts, 10_000):
            got.update(zip(doc.tolist(), bucket.tolist()))
            words.update(of.tolist())
        want = collections.Counter((k, zlib.crc32(f.encode()) % 10_000) for k, t in enumerate(texts) for f in plain_features(t)[1])
        assert got == want, size
        assert words == {k: len(plain_features(t)[0]) for k, t in enumerate(texts) if plain_features(t)[0]}


def test_equal_to_brute_force_on_awkward_rows(spark):
    docs = odd_documents(spark, n=30, long_words=4_000)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = found(spark, docs)
    assert got == brute(rows, TARGET) and any(r[4] for r in got)
    assert found(spark, docs, buckets=37, min_words=1, percent=60, seed=9) == brute(rows, TARGET, 37, 1, 60, 9)


def test_hot_repeated_rows_are_ranked_once_each(spark):
    text = "word " * 30
    docs = spark.createDataFrame([(1, text)] * 500 + [(None, text)] * 40 + [(2, "a b")], "doc_id long, text string")
    got = found(spark, docs)
    assert got == brute([(1, text)] * 500 + [(None, text)] * 40 + [(2, "a b")], TARGET)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 136))


def test_target_words_raise_the_weight(spark):
    docs = spark.createDataFrame([(1, "alpha beta " * 20), (2, "gamma delta " * 20)], "doc_id long, text string")
    weight = {r[0]: r[2] for r in found(spark, docs, ["alpha beta alpha beta"])}
    assert weight[1] > weight[2]


def test_empty_tables(spark):
    assert found(spark, no_documents(spark)) == []
    docs = spark.createDataFrame([(1, "alpha beta " * 20)], "doc_id long, text string")
    assert found(spark, docs, []) == brute([(1, "alpha beta " * 20)], [])
