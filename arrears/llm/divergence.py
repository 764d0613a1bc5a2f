"""Source divergence audit: how the sources of a language differ in their words (operator 13).

Every document is a sparse vector of term counts over its language's vocabulary:
the terms of at least `min_df` documents, without a largest size. The vectors
are summed by (language, source), as a summarizer does, with the number of
vectors in which a term is not zero. A count becomes a smoothed share p in
billionths, p = 1 + floor(10^9 (count + 1) / (N + V)), for each group and, over
all its sources, for the language. Two shares differ by f(p, q) = floor((p - q)^2 / q).

- pair: a group against each other source of its language, f summed over the vocabulary.
- term: the terms more frequent in the group than in its language, by f.

The vocabulary stays a table: a vectorizer that gathers it on the driver and
sends it to every task has no bound there. Each task sums the vectors of its own
documents before anything is shuffled, so a source or term with a third of all rows arrives
as one row per task and flush.

Pairs are evaluated sparsely. With p0 the share of a term that a group does not have,
  sum f(p, q) = V f(p0, q0) + sum [f(p, q0) - f(p0, q0)]          terms of the group
                            + sum [f(p0, q) - f(p0, q0)]          terms of the other
                            + sum [f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)]   shared terms.
The single sums are taken over the distinct counts of a group, and the last one is gathered
in each task for blocks of at most PAIRS products, of which only the sums leave
the task. The result has a row for every two sources of a language, so the groups are few beside
the documents.

Defined results
- NULL text, language or source: the empty string, which is a language or source like any other.
- Empty text, or one without a term: its group occurs, with counts of 0.
- Repeated rows: each is a document. Ids are not read, so NULL or equal ids change nothing.
- No kept term in a language: its pairs have value 0, and it has no term rows.
- Ties: the same value is ordered by the item's UTF-8 bytes.
- Very long texts are cut into vectors SLICE bytes at a time, at the end of a term, and added up.
- Empty table: no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.llm.common import materialise

MIN_DF = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
SLICE = 1 << 20            # bytes of a text taken at once
ENTRIES = 300_000          # sums held by a task before it passes them on
PAIRS = 1 << 20            # products evaluated at once

# In UTF-8 every byte of a character beyond ASCII is 0x80 or more.
TERM = re.compile(rb"[a-z\x80-\xff]+")
GAP = re.compile(rb"[^a-z\x80-\xff]")


def count_vector(text: str | None) -> Counter:
    """The counts of the terms of a text, as bytes; A-Z is lower-cased, nothing else is."""
    data = (text or "").encode().lower()
    counts: Counter = Counter()
    at = 0
    while at < len(data):
        gap = GAP.search(data, at + SLICE)
        end = gap.start() if gap else len(data)
        counts.update(TERM.findall(data, at, end))
        at = end
    return counts


def group_sums(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d) of docs (lang, source, text): summed vectors, and vectors that hold the term."""
    def add_up(batches):
        sums: dict = {}
        held = 0

        def flush():
            langs, sources, terms, n, d = [], [], [], [], []
            for (lang, source), (total, within) in sums.items():
                langs += [lang] * len(total)
                sources += [source] * len(total)
                terms += total.keys()
                n += total.values()
                d += map(within.__getitem__, total)
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array(n, pa.int64()), pa.array(d, pa.int64())], ["lang", "source", "term", "n", "d"])

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                vector = count_vector(text)
                total, within = sums.setdefault((lang, source), (Counter(), Counter()))
                held -= len(total)
                total.update(vector)
                within.update(vector.keys())
                held += len(total)
                if held > ENTRIES:
                    yield flush()
                    sums, held = {}, 0
        if sums:
            yield flush()

    parts = docs.mapInArrow(add_up, "lang string, source string, term string, n long, d long")
    return (parts.repartition("lang", "term").groupBy("lang", "term", "source")
            .agg(F.sum("n").alias("n"), F.sum("d").alias("d")))


def vocabulary(sums: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """(term_id, lang, term, total, by_source) of the kept terms; by_source holds (source, n) with n > 0."""
    kept = (sums.groupBy("lang", "term")
            .agg(F.sum("d").alias("df"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("by_source"))
            .filter(F.col("df") >= min_df))
    return materialise(kept.select(F.monotonically_increasing_id().alias("term_id"), "lang", "term", "total", "by_source"),
                       "divergence-terms")


def share(n: Column, size: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (size + terms)), exact beyond 64 bits; 1 where there is nothing to divide by."""
    part = F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(SCALE), (size + terms).cast("decimal(20,0)"))
    return F.when(size + terms > 0, part).otherwise(0) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared(entries: DataFrame) -> DataFrame:
    """(a, b, value) summed over the terms that both groups hold; entries: term_id, g, p, p0."""
    def evaluate(block):
        term, g, p, p0 = block
        first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
        size = np.diff(np.append(first, len(term)))
        begin, with_ = np.repeat(first, size), np.repeat(size, size)
        upto = np.concatenate(([0], np.cumsum(with_)))
        at = 0
        while at < len(term):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, side="right")) - 1)
            left = np.repeat(np.arange(at, end), with_[at:end])
            right = np.arange(upto[at], upto[end]) - upto[left] + begin[left]
            apart = left != right
            left, right = left[apart], right[apart]
            value = (_gap(p[left], p[right]) - _gap(p[left], p0[right]) - _gap(p0[left], p[right]) + _gap(p0[left], p0[right]))
            there, code = np.unique(g[at:end], return_inverse=True)
            others, other = np.unique(g, return_inverse=True)
            pair, which = np.unique(code[left - at] * len(others) + other[right], return_inverse=True)
            total = np.zeros(len(pair), np.int64)
            np.add.at(total, which, value)
            yield pd.DataFrame({"a": there[pair // len(others)], "b": others[pair % len(others)], "value": total})
            at = end

    def run(batches):
        rest = np.zeros((4, 0), np.int64)
        for batch in batches:
            rows = np.concatenate((rest, batch[["term_id", "g", "p", "p0"]].to_numpy(np.int64).T), axis=1)
            if not rows.shape[1]:
                continue
            cut = int(np.searchsorted(rows[0], rows[0, -1]))       # the last term may go on
            rest = rows[:, cut:]
            if cut:
                yield from evaluate(rows[:, :cut])
        if rest.shape[1]:
            yield from evaluate(rest)

    ordered = entries.repartition("term_id").sortWithinPartitions("term_id")
    return (ordered.mapInPandas(run, "a long, b long, value long").groupBy("a", "b").agg(F.sum("value").alias("value")))


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a language, in both directions."""
    other = groups.select(F.col("lang").alias("other_lang"), F.col("source").alias("item"), F.col("g").alias("b"), F.col("p0").alias("q0"))

    def beside(left: DataFrame) -> DataFrame:
        return left.join(other, (F.col("lang") == F.col("other_lang")) & (F.col("g") != F.col("b")))

    p, p0, q0, times = F.col("p"), F.col("p0"), F.col("q0"), F.col("times")
    single = beside(entries.groupBy("lang", "g", "p", "p0").agg(F.count(F.lit(1)).alias("times"))).groupBy("g", "b").agg(
        F.sum(times * (gap(p, q0) - gap(p0, q0))).alias("own"), F.sum(times * (gap(q0, p) - gap(q0, p0))).alias("back"))
    single = materialise(single, "divergence-single")
    added = (single.select(F.col("g").alias("a"), "b", F.col("own").alias("value"))
             .unionByName(single.select(F.col("b").alias("a"), F.col("g").alias("b"), F.col("back").alias("value")))
             .unionByName(_shared(entries.select("term_id", "g", "p", "p0")))
             .groupBy("a", F.col("b").alias("with")).agg(F.sum("value").alias("added")))
    every = beside(groups.select("lang", "source", "g", "p0", "terms"))
    return every.join(added, (F.col("g") == F.col("a")) & (F.col("b") == F.col("with")), "left").select(
        "lang", "source", "item", F.when(F.col("terms") == 0, 0).otherwise(
            F.col("terms") * gap(p0, q0) + F.coalesce("added", F.lit(0))).alias("value"))


def audit(docs: DataFrame, *, text_col="text", lang_col="lang", source_col="source", min_df: int = MIN_DF,
          top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: see the module's text."""
    def named(col: str) -> Column:
        return F.coalesce(docs[col].cast("string"), F.lit(""))

    rows = docs.select(named(lang_col).alias("lang"), named(source_col).alias("source"), named(text_col).alias("text"))
    terms = vocabulary(group_sums(rows), min_df)
    counts = terms.select("term_id", "lang", "term", "total", F.inline("by_source"))
    size = counts.groupBy(F.col("lang").alias("l"), F.col("source").alias("s")).agg(F.sum("n").alias("size"))
    of_lang = terms.groupBy(F.col("lang").alias("l")).agg(F.sum("total").alias("lang_size"), F.count(F.lit(1)).alias("terms"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("size", "lang_size", "terms")}
    groups = rows.select("lang", "source").distinct()
    groups = groups.join(size, (groups["lang"] == size["l"]) & (groups["source"] == size["s"]), "left").drop("l", "s")
    groups = groups.join(of_lang, groups["lang"] == of_lang["l"], "left").select("lang", "source", *zero.values())
    groups = materialise(groups.select(F.monotonically_increasing_id().alias("g"), "*",
                                       share(F.lit(0), F.col("size"), F.col("terms")).alias("p0")), "divergence-groups")
    of = groups.withColumnsRenamed({"lang": "l", "source": "s"})
    entries = counts.join(of, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s"))).select(
        "term_id", "lang", "source", "term", "g", "p0", share(F.col("n"), F.col("size"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("lang_size"), F.col("terms")).alias("q"))

    def ranked(values: DataFrame, part: str) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        return values.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))

    over = entries.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    return ranked(_pairs(entries, groups), "pair").unionByName(ranked(over, "term").filter(F.col("rank") <= top_terms))
