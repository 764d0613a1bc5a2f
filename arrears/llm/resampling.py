"""Importance resampling towards a target distribution (operator 12).

Features are the words of a text and the pairs of successive words, joined by a
space; a feature's bucket is its CRC-32 modulo BUCKETS. A bucket's gain is the
logarithm of its smoothed share in the target over that in the corpus, in
thousandths. A document's weight is the mean gain of its features, and a Gumbel
number made from its id is added, so the highest scores are a sample drawn
without replacement in proportion to exp(weight).

CRCs are taken of many features at once. A task joins the words of its texts by
single spaces, so that every feature is a slice of one buffer. Words are numbered by a
dictionary and pairs by their two numbers; the distinct features are grouped by
length into matrices of bytes, a feature a row, and the CRCs of all rows
advance a column at a time. The buckets are scattered back to all places of a feature.

The corpus is read twice, for the bucket counts and for the weights; no text is
shuffled. The counts and the gains are BUCKETS numbers, whatever the corpus, which is the bound of
what is broadcast. Ranks come from a histogram of the scores, which are whole
thousandths, and an order by id within one score: the Gumbel numbers spread
copies of a text over the scores. Equal rows are ranked as one row with a count.

Defined results
- NULL, empty or wordless text: no features, weight 0, and not among the documents to draw from.
- NULL id: noise of the empty string, ordered before other ids. Equal ids: equal
  noise; equal scores of one id are ordered by weight, features and words.
- Repeated rows: each is a document. Empty corpus: no rows. Empty target: t and T are 0.
- Very long texts are taken in slices of CHUNK bytes, cut between words, with the pair across the cut.
- Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.llm.common import materialise

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
CHUNK = 1 << 21            # bytes of text taken at once
LONG = 1 << 10             # bytes; longer features are too few for a matrix, zlib takes them one by one

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")      # in UTF-8 all bytes of a character beyond ASCII
BLANK = re.compile(rb"[^0-9a-z\x80-\xff]")


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


CRC_TABLE = _crc_table()


def crc_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a matrix of bytes, all rows a column at a time."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in matrix.T:
        crc = CRC_TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return ~crc


def buckets_of(buffer: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each slice of the buffer, by matrices of equal length."""
    size = end - start
    order = np.argsort(size, kind="stable")
    out = np.empty(len(start), np.int64)
    for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        n = int(size[rows[0]]) if len(rows) else 0
        if n > LONG:
            out[rows] = [zlib.crc32(buffer[start[r]:end[r]]) % buckets for r in rows]
            continue
        most = max(1, CHUNK // max(n, 1))
        for at in range(0, len(rows), most):           # no matrix is larger than the texts of a chunk
            part = rows[at:at + most]
            out[part] = crc_rows(buffer[start[part][:, None] + np.arange(n)]) % np.uint32(buckets)
    return out


def _pieces(texts: list[str | None]):
    """(row, words of a slice of its text, whether the slice goes on from the one before), in order."""
    for row, text in enumerate(texts):
        data = (text or "").encode().lower()
        at = 0
        while at < len(data):
            blank = BLANK.search(data, at + CHUNK)
            end = blank.start() if blank else len(data)
            yield row, WORD.findall(data, at, end), at > 0
            at = end


def _chunks(texts: list[str | None]):
    """(words, their rows, where a pair with the next word begins) for about CHUNK bytes of text at a time.

    The last word of a slice is repeated before the next slice, to make the pair across the cut; its
    row there is -1.
    """
    words, rows, held, last = [], [], 0, {}
    for row, found, goes_on in _pieces(texts):
        if not found:
            continue
        before = last.get(row) if goes_on else None
        if before is not None and not words:
            words.append(before)
            rows.append(-1 - row)
        words += found
        rows += [row] * len(found)
        held += sum(map(len, found)) + len(found)
        last = {row: found[-1]}
        if held >= CHUNK:
            yield words, np.array(rows)
            words, rows, held = [], [], 0
    if words:
        yield words, np.array(rows)


def features(texts: list[str | None], buckets: int):
    """(row, bucket) of every feature of the texts, and (row, words), as arrays, some texts at a time."""
    for words, rows in _chunks(texts):
        counted = rows >= 0
        doc = np.where(counted, rows, -1 - rows)
        number = {w: k for k, w in enumerate(dict.fromkeys(words))}
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        size = np.fromiter(map(len, number), np.int64, len(number))[ids]
        end = np.cumsum(size + 1) - 1
        start = end - size
        buffer = np.frombuffer(b" ".join(words), np.uint8)
        left = np.flatnonzero(doc[1:] == doc[:-1])
        first = np.empty(len(number), np.int64)
        first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
        _, at, pair = np.unique(ids[left] * len(number) + ids[left + 1], return_index=True, return_inverse=True)
        bucket = buckets_of(buffer, np.concatenate((start[first], start[left[at]])),
                            np.concatenate((end[first], end[left[at] + 1])), buckets)
        yield (np.concatenate((doc[counted], doc[left])), np.concatenate((bucket[ids[counted]], bucket[len(first) + pair])),
               doc[counted])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the features of the one column of `texts`."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in features(batch.iloc[:, 0].tolist(), buckets):
                total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    return texts.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from the counts of both."""
    def named(counts: DataFrame, one: str, all_: str) -> DataFrame:
        every = counts.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
        n = F.coalesce("n", F.lit(0))
        return every.select("bucket", n.alias(one), F.sum(n).over(W.partitionBy()).alias(all_))    # BUCKETS rows

    t, T, s, S = (F.col(c).cast("double") for c in ("t", "all_t", "s", "all_s"))
    ratio = (t + 1) * (S + buckets) / ((s + 1) * (T + buckets))
    return named(corpus, "s", "all_s").join(named(target, "t", "all_t"), "bucket").select(
        "bucket", F.floor(F.log(ratio) * 1000).alias("gain"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel number in thousandths, from the first 32 bits of the id's SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)


def weights(docs: DataFrame, gain: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of docs (doc_id, text)."""
    table = np.zeros(buckets, np.int64)
    rows = gain.toPandas()                             # BUCKETS rows
    table[rows["bucket"].to_numpy()] = rows["gain"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        words, n, total = (np.zeros(len(texts), np.int64) for _ in range(3))
        for doc, bucket, of in features(texts.tolist(), len(shared.value)):
            words += np.bincount(of, minlength=len(texts))
            n += np.bincount(doc, minlength=len(texts))
            np.add.at(total, doc, shared.value[bucket])
        return pd.DataFrame({"n_words": words, "n_features": n, "weight": np.where(n > 0, total // np.maximum(n, 1), 0)})

    return docs.select("doc_id", weigh("text").alias("w")).select("doc_id", "w.*")


def ranked(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """`scored` with the rank of each drawn document (NULL: not drawn)."""
    able = F.col("n_words") >= min_words
    order = ["doc_id", "weight", "n_features", "n_words"]
    rows = scored.filter(able).groupBy("score", *order).agg(F.count(F.lit(1)).alias("copies"))
    # one row per score, in thousandths
    upto = F.sum("n").over(W.orderBy(F.desc("score")))
    above = (scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("score").alias("at"), (upto - F.col("n")).alias("above"),
                     F.call_function("div", F.sum("n").over(W.partitionBy()) * percent, F.lit(100)).alias("drawn")))
    within = F.sum("copies").over(W.partitionBy("score").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = (rows.withColumn("last", within).join(above, F.col("score") == F.col("at"))
              .select("score", *order, F.explode(F.sequence(F.col("above") + F.col("last") - F.col("copies") + 1,
                                                            F.col("above") + F.col("last"))).alias("place"), "drawn"))
    placed = placed.withColumn("rank", F.when(F.col("place") <= F.col("drawn"), F.col("place"))).drop("place", "drawn")
    return placed.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")).select(placed.columns))


def resample(docs: DataFrame, target: DataFrame, *, id_col="doc_id", text_col="text", target_text_col="text",
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (1 for the highest, NULL: not drawn)."""
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    gain = gains(bucket_counts(narrow.select("text"), buckets), bucket_counts(target.select(target[target_text_col]), buckets), buckets)
    scored = weights(narrow, gain, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return ranked(materialise(scored, "resampling-scores"), min_words, percent)
