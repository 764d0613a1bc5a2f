"""Operator 4: held-out accuracy, noisy-or, located sentences, edge cases."""

import math
import random
import zlib

import pytest

from arrears.llm import toxicity
from tests.llm.rows import no_documents, odd_documents, sentence

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def planted(spark):
    rng, rows, labels = random.Random(1), [], []
    bad = ["scoundrel", "grimeish", "grimeous", "grimed", "rotter", "vermin"]
    for i in range(1200):
        sentences = [sentence(rng, 10) for _ in range(rng.randint(1, 12))]
        toxic = rng.random() < 0.15
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] = sentences[k][:-1] + " " + rng.choice(bad) + "."
        rows.append((i, "\n".join(sentences), "en", f"s{i % 3}"))
        labels.append((i, 1, int(toxic != (rng.random() < 0.02))))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"),
            spark.createDataFrame(labels, LABELS), {r[0]: any(b in r[1] for b in bad) for r in rows}, bad)


def test_held_out_accuracy_and_sentences(planted):
    docs, labels, truth, bad = planted
    rows = toxicity.judge(docs, labels).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == 1200
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        for s in r.offending:
            assert any(b in text[r.doc_id][s.start:s.end] for b in bad)
    held = [r for r in rows if r.held_out]
    wrong = sum(r.predicted != truth[r.doc_id] for r in held)
    assert wrong <= 0.02 * len(held)
    assert sum(bool(r.offending) for r in held if truth[r.doc_id]) >= 0.9 * sum(truth[r.doc_id] for r in held)


def test_held_out_labels_are_not_used(planted, spark):
    docs, labels, _, _ = planted
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic"))
                               .otherwise(toxicity.F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, turned)


def test_noisy_or():
    model = ({"bad": 3.0, "wor-": 1.0, "worse": 1.0}, -2.0, 0.1)
    lex = toxicity.Lexicon({e: e for e in model[0]})
    assert lex.sentences("All fine. Bad, worse! No.\nbad") == [(9, 20, ["bad", "worse"]), (26, 29, ["bad"])]
    stem = toxicity.Lexicon({"grim-": 0, "grime-": 1})
    assert stem.sentences("x. grimes") == [(2, 9, [0, 1])]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (1, 1, None), (None, 1, 1), (999, 1, 1), (2, 1, 0), (3, 0, 0), (200, 1, 1)], LABELS)
    rows = toxicity.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    scored, name = toxicity.score_documents(docs, ({"the": 5.0}, -1.0, 0.05))
    assert name == "_toxicity" and scored.columns[:-1] == docs.columns
    by = {r.doc_id: r[name].score for r in scored.collect() if r.doc_id is not None}
    assert by[200] == by[201] == by[202] == pytest.approx(0.05)


def test_no_labels_and_empty(spark):
    none = spark.createDataFrame([], LABELS)
    docs = odd_documents(spark, n=3, long_words=50)
    assert {r.score for r in toxicity.judge(docs, none).collect()} == {0.0}
    assert toxicity.judge(no_documents(spark), none).count() == 0


def test_scores_from_the_definition(spark):
    """Every score is 1 - (1 - leak) * product of (1 - sentence score), recomputed letter by letter."""
    weights, bias, leak = {"bad": 3.0, "wors-": 1.5, "worse": -0.5, "grim-": 2.0}, -2.0, 0.1
    rng = random.Random(5)
    pool = ["bad", "BAD", "worse", "worst", "grim", "grimy", "good", "fine", "7", "bád", "worse-bad", "Émile"]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", " ", ". ", "!", "\n", "? "]) for _ in range(rng.randint(0, 40)))
             for _ in range(300)] + [None, "", "...", "bad" * 10, "bad. " * 5000, "fine " * 200_000 + "grimy"]

    def by_hand(text):
        miss, sentence = 1 - leak, ""
        for c in (text or "") + "\n":
            if c not in ".!?\n":
                sentence += c
                continue
            found = set()
            for word in "".join(x if x.isalpha() else " " for x in sentence.lower()).split():
                found |= {e for e in weights if (word == e if e[-1] != "-" else word.startswith(e[:-1]))}
            if found:
                miss *= 1 - 1 / (1 + math.exp(-(bias + sum(weights[e] for e in found))))
            sentence = ""
        return 1 - miss

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scored, name = toxicity.score_documents(docs, (weights, bias, leak))
    got = {r.doc_id: r[name].score for r in scored.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(by_hand(text), abs=1e-12), text


def test_fit_descends_the_loss_of_the_noisy_or():
    """The same descent with slopes taken numerically from the loss as it is defined."""
    bags = [(True, [[0], [1]]), (True, [[0, 1]]), (False, [[1]]), (True, [[0], [0], [1]]), (False, [[1], [1]]), (False, [[0]])]
    silent = (10, 2)

    def loss(x):
        leak = 1 / (1 + math.exp(-x[3]))
        total = -silent[1] * math.log(leak) - (silent[0] - silent[1]) * math.log(1 - leak)
        for label, bag in bags:
            none = 1 - leak
            for sentence in bag:
                none *= 1 - 1 / (1 + math.exp(-(x[2] + sum(x[w] for w in sentence))))
            total -= math.log(1 - none) if label else math.log(none)
        return total + toxicity.RIDGE / 2 * (x[0] ** 2 + x[1] ** 2)

    x, m1, m2 = [0.5, 0.5, -2.0, math.log(2.5 / 9)], [0.0] * 4, [0.0] * 4
    for step in range(1, toxicity.STEPS + 1):
        slope = []
        for k in range(4):
            up, down = list(x), list(x)
            up[k] += 1e-5
            down[k] -= 1e-5
            slope.append((loss(up) - loss(down)) / 2e-5 / (len(bags) + silent[0]) ** 0.5)
        for k, g in enumerate(slope):
            m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g, 0.999 * m2[k] + 0.001 * g * g
            x[k] -= toxicity.RATE * (m1[k] / (1 - 0.9 ** step)) / ((m2[k] / (1 - 0.999 ** step)) ** 0.5 + 1e-8)
    weights, bias, leak = toxicity.fit(bags, 2, silent)
    assert [*weights, bias, leak] == pytest.approx([x[0], x[1], x[2], 1 / (1 + math.exp(-x[3]))], abs=1e-3)


def test_a_repeated_id_is_trained_on_once(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c"), (3, None)] + [(4, "x")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in (1, 2, 3, 4, 4)], LABELS)
    rows = toxicity.sample(docs, labels, id_col="doc_id", text_col="text", label_id_col="doc_id", label_col="toxic", most=100).collect()
    kept = [i for i in (1, 2, 3, 4) if zlib.crc32(str(i).encode()) % 4 != 2]
    text = {1: "a", 2: "c", 3: None, 4: "x"}
    assert sorted(map(tuple, rows)) == [(i, text[i], bool(i % 2)) for i in kept]
