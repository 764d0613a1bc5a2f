"""Toxicity by multiple-instance learning (operator 4).

A document is a bag of sentences. A sentence's score is a logistic function of
the lexicon words in it; the document's score is the noisy-or of its sentences
and a leak, the rate of the label where no sentence speaks for it:

    1 - (1 - leak) * product over sentences of (1 - sentence score)

Only document labels are needed for training. The lexicon holds words and word
beginnings of STEMS letters (for languages that inflect): those found in at
least MIN_DOCS documents, of which a share of MIN_SHARE and MIN_Z standard
errors more than usual have the label. They come from one counting job over the
training sample. The weights are fitted by gradient descent to the sample's
bags, which hold no text, just the lexicon entries of each sentence; an entry
that only goes along with others is explained away by the noisy-or.

Bounds (parameters of `train` and `judge`): at most SAMPLE labelled documents are used
for training, those with the smallest hash of the id, each once; the lexicon has at
most LEXICON entries, those that stand out most, which is the bound of the broadcast.
Every document is scored, over its whole text, however long; a text is held in memory
by the task that scores it.

Defined results
- NULL, empty or wordless text: the leak.
- A NULL label, a label without a document, a document without a label: not
  trained on. Conflicting labels of a document: the largest counts.
- No labelled document at all: leak 0, so every score is 0.
- No documents: no rows. An id that repeats in `documents` is trained on once, with
  its smallest text.
- Repeated rows are each scored; extra columns pass through `score_documents`.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import fresh, materialise

SAMPLE = 20_000
LEXICON = 2_000
MIN_Z = 5.0
MIN_DOCS = 4
MIN_SHARE = 0.7
STEMS = (4, 5, 6)
OFFENDING = 0.5
THRESHOLD = 0.3
STEPS, RATE, RIDGE = 400, 0.05, 0.02
RESULT = "struct<score:double,sentences:array<struct<start:long,end:long,score:double>>>"

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, *, id_col, text_col, label_id_col, label_col, most: int) -> DataFrame:
    """(doc_id, text, toxic): the training sample, one row for each of at most `most` ids."""
    labelled = (labels.filter(F.col(label_col).isNotNull() & F.col(label_id_col).isNotNull())
                .groupBy(F.col(label_id_col).alias("at")).agg((F.max(label_col) > 0).alias("toxic"))
                .filter(~held_out(F.col("at"))))
    chosen = labelled.orderBy(F.xxhash64("at"), "at").limit(most)
    chosen = materialise(chosen, "toxic-sample")
    found = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("at"))   # at most `most` rows broadcast
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")


def entries(word: str) -> list[str]:
    """What a word counts as: itself and its beginnings (marked with a hyphen)."""
    return [word, *(word[:k] + "-" for k in STEMS if len(word) >= k)]


def lexicon(rows: DataFrame, base: float, most: int = LEXICON) -> list[str]:
    def count(batches):
        docs, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"].fillna(""), batch["toxic"]):
                seen = {e for w in set(WORD.findall(text.lower())) for e in entries(w)}
                docs.update(seen)
                if label:
                    toxic.update(seen)
        yield pd.DataFrame({"entry": pd.Series(list(docs), dtype=object), "docs": list(docs.values()),
                            "toxic": [toxic[e] for e in docs]})

    counts = (rows.mapInPandas(count, "entry string, docs long, toxic long")
              .groupBy("entry").agg(F.sum("docs").alias("n"), F.sum("toxic").alias("a")))
    z = (F.col("a") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)))
    best = (counts.filter((F.col("n") >= MIN_DOCS) & (F.col("a") >= F.col("n") * MIN_SHARE))
            .withColumn("z", z).filter(F.col("z") >= MIN_Z))
    return [r["entry"] for r in best.orderBy(F.desc("z"), "entry").limit(most).collect()]


class Lexicon:
    """Finds the entries of a model in texts."""

    def __init__(self, known):
        self.words = {e: v for e, v in known.items() if not e.endswith("-")}
        self.stems = [(k, {e[:-1]: v for e, v in known.items() if e.endswith("-") and len(e) == k + 1}) for k in STEMS]

    def of(self, words) -> set:
        """The values of all entries that the words count as."""
        found = {self.words[w] for w in words if w in self.words}
        for k, stems in self.stems:
            if stems:
                found |= {stems[w[:k]] for w in words if w[:k] in stems}
        return found

    def sentences(self, text: str) -> list[tuple[int, int, list]]:
        """(start, end, values) of the sentences that have any entry."""
        out = []
        if not self.of(set(WORD.findall(text.lower()))):
            return out
        for s in SENTENCE.finditer(text):
            values = self.of(WORD.findall(s.group().lower()))
            if values:
                out.append((s.start(), s.end(), sorted(values)))
        return out


def fit(bags: list[tuple[bool, list[list[int]]]], n_words: int, silent: tuple[int, int]) -> tuple[np.ndarray, float, float]:
    """Weights, bias and leak from bags (label, word numbers of each sentence).

    silent: the number of documents without a lexicon word, and how many of them have the label.
    """
    label = np.array([y for y, _ in bags], float)
    of_doc = np.repeat(np.arange(len(bags)), [len(b) for _, b in bags])
    sentences = [s for _, b in bags for s in b]
    of_sentence = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences])
    word = np.array([w for s in sentences for w in s], np.int64)
    x = np.concatenate((np.full(n_words, 0.5), [-2.0, np.log((silent[1] + 0.5) / (silent[0] - silent[1] + 1.0))]))
    m1, m2, n = np.zeros_like(x), np.zeros_like(x), len(bags) + silent[0]
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x[-2] + np.bincount(of_sentence, x[word], len(sentences)), -30, 30)))
        leak = 1 / (1 + np.exp(-x[-1]))
        keep = np.bincount(of_doc, np.log1p(-p * (1 - 1e-9)), len(bags)) + np.log1p(-leak)   # log P(no label)
        none = np.exp(keep)
        # slope of the loss -(y log(1 - none) + (1 - y) keep) by keep
        pull = label * none / np.maximum(1 - none, 1e-9) - (1 - label)
        g_sentence = pull[of_doc] * -p
        grad = np.zeros_like(x)
        grad[:n_words] = np.bincount(word, g_sentence[of_sentence], n_words)
        grad[-2] = g_sentence.sum()
        grad[-1] = (pull * -leak).sum() + (silent[0] * leak - silent[1])
        grad[:n_words] += RIDGE * x[:n_words]
        grad /= max(n, 1) ** 0.5
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad ** 2
        x -= RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return x[:n_words], float(x[-2]), float(1 / (1 + np.exp(-x[-1])))


def train(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", label_id_col="doc_id",
          label_col="toxic", most: int = SAMPLE, most_entries: int = LEXICON) -> tuple[dict[str, float], float, float]:
    """Weights of the entries, bias and leak."""
    rows = materialise(sample(docs, labels, id_col=id_col, text_col=text_col, label_id_col=label_id_col,
                              label_col=label_col, most=most), "toxic-rows")
    total, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))).first()
    if not total:
        return {}, 0.0, 0.0
    base = (toxic + 0.5) / (total + 1)
    words = lexicon(rows, base, most_entries)
    number = rows.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})

    def bag(batches):
        entries_of = Lexicon(number.value)
        for batch in batches:
            found = [[s[2] for s in entries_of.sentences(t)] for t in batch["text"].fillna("")]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "bag": found})

    bags = (rows.mapInPandas(bag, "doc_id long, toxic boolean, bag array<array<int>>").filter(F.size("bag") > 0)
            .orderBy("doc_id", "toxic", "bag").collect())          # at most `most` rows, and numbers only
    speaking = sum(r["toxic"] for r in bags)
    weights, bias, leak = fit([(r["toxic"], r["bag"]) for r in bags], len(words), (total - len(bags), toxic - speaking))
    return dict(zip(words, weights.tolist())), bias, leak


def score_documents(docs: DataFrame, model: tuple[dict[str, float], float, float], *, text_col="text") -> tuple[DataFrame, str]:
    """`docs` with a struct of the score and the offending sentences (code point spans); and its name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def toxicity(texts: pd.Series) -> pd.DataFrame:
        weights, bias, leak = shared.value
        known, rows = Lexicon({e: e for e in weights}), []
        for t in texts.fillna(""):
            miss, spans = 1 - leak, []
            for start, end, found in known.sentences(t):
                p = 1 / (1 + np.exp(-(bias + sum(weights[e] for e in found))))
                miss *= 1 - p
                if p >= OFFENDING:
                    spans.append({"start": start, "end": end, "score": float(p)})
            rows.append((float(1 - miss), spans))
        return pd.DataFrame(rows, columns=["score", "sentences"])

    name = fresh(docs, "toxicity")
    return docs.withColumn(name, toxicity(docs[text_col])), name


def judge(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, offending sentences."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    scored, name = score_documents(narrow, model)
    value = F.col(name)["score"]
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"),
                         (value >= THRESHOLD).cast("int").alias("predicted"), F.col(name)["sentences"].alias("offending"))
