"""Quality classifier: interpolated modified Kneser-Ney model of trusted text (operator 2).

The model is a word bigram model. Words are what ASCII white space separates, by
a 64-bit hash; every document has a start and an end. Below the unigrams stands
a spelling model, a Kneser-Ney character trigram model over 64 symbols (letters
by case, blanks, full stop, comma, digit, other ASCII, six classes of non-ASCII
letters), so that unseen words have a probability too. The spelling model has a
fixed size; the word counts grow with the trusted text.

1. Counts: one in HELD_OUT of the trusted documents, by the hash of the text, is
   left out. Each task counts the word pairs of the others; the sums are sharded.
2. Model: continuation counts, discounts D1, D2, D3+ from the counts of counts,
   context totals and back-off weights are joined order by order. An interpolated
   model is a sum of numbers in its back-off form: one for each word, and one more
   for each pair that was seen. So it is one table (key, value).
3. Scores: each task sends the words and pairs of its documents, packed in blocks
   by shard of the key, each of the documents of STACK characters; a shard is joined
   with the model's part and sends a block of sums back for each, and these are
   added to one row for a document. The HOT most frequent keys are broadcast and
   looked up before, so no shard gets an entry of every document. Equal texts have
   one score, by a 64-bit hash. Log perplexity is per spelled symbol (a word's
   characters and a blank).
   Pairs (by context) and words are dealt over up to MOST_ROUNDS rounds, one after
   the other, in the counts, the model and the scores. Each round reads all texts for
   its keys, so a shuffle holds one round's keys only.
4. Thresholds: for every language, the QUANTILE of the held-out documents' log
   perplexity, from an exact histogram on a grid of 1/1000. A document of n
   characters has the evidence n / (n + PRIOR_CHARS): its distance to the median
   is shrunk by that, in the histogram as in the verdict. Of fewer than
   1 / (1 - QUANTILE) documents the quantile is taken from the tail, see `_limit`.
5. Repetition: the word pairs that occurred before in the same BLOCK pairs of the
   document, divided by pairs + PRIOR_PAIRS. Its threshold is the QUANTILE of all
   trusted documents of the language (it needs no counts).

Defined results
- NULL, empty or blank text: no perplexity (NULL); such a document is kept here.
- NULL language: a language of its own. A language with fewer than `min_trusted`
  held-out (for repetition: trusted) documents takes the threshold of all of them.
- No trusted document at all: every document is kept, its perplexity is 64. None
  held out: no threshold of perplexity.
- A label row repeated, NULL or without a document: it changes nothing.
- Repeated documents: each row is scored; trusted copies each count.
- Very long texts are scored whole; one of more than CHUNK characters is a chunk of its own, held by one task.
- Empty documents table: no rows.
- Extra columns pass through `keep_good`, whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.common import discard, materialise, shuffles_dropped

SYMBOLS = 64
ORDER = 3
GRAMS = SYMBOLS ** ORDER
GRID = 1000
QUANTILE = 0.995
HELD_OUT = 5
PRIOR_CHARS = 300
BLOCK = 50                 # word pairs
PRIOR_PAIRS = 10
MIN_TRUSTED = 20
CHUNK = 1 << 20            # characters scored at once
ROWS = 1 << 9              # texts held as strings at once
SHARD_CHARS = 1 << 22      # characters of the documents for each shard of keys
STACK = 1 << 23            # characters of the documents of a block
ROUND_CHARS = 1 << 26      # characters of the documents for each round
MOST_ROUNDS = 4            # a power of two
HOT = 1 << 16
MOST_BROADCAST = 1 << 20   # ids of trusted documents, 16 bytes each
BASE = 0x9E3779B97F4A7C15  # odd: the multiplier of the word hash
FIRST, LAST = np.array([0x5EED0001C0FFEE11, 0x5EED0002C0FFEE22], np.uint64)    # before and after a text's words

_OTHER_ASCII = 57


def _alphabet() -> np.ndarray:
    """The symbol of each ASCII character: a-z 0-25, A-Z 26-51, then space, line break, '.', ',', digit, other."""
    symbol = np.full(128, _OTHER_ASCII, np.uint8)
    symbol[97:123] = np.arange(26)
    symbol[65:91] = np.arange(26, 52)
    symbol[[32, 9]] = 52
    symbol[[10, 13]] = 53
    symbol[46], symbol[44] = 54, 55
    symbol[48:58] = 56
    return symbol


ALPHABET = _alphabet()
START = "\n" * (ORDER - 1)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram codes of texts, each after two line breaks; where each text begins; its length."""
    size = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer((START + START.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = np.where(points < 128, ALPHABET[np.minimum(points, 127)], _OTHER_ASCII + 1 + points % 6).astype(np.int32)
    codes = (symbol[:-2] * SYMBOLS + symbol[1:-1]) * SYMBOLS + symbol[2:]
    begin = np.cumsum(size + len(START)) - size - len(START)
    return codes, begin, size


def chunks(texts: list[str], most: int = CHUNK):
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t)
        if n >= most:
            yield part
            part, n = [], 0
    if part:
        yield part


def sliced(batches):
    """The columns of Arrow batches as lists, ROWS rows at a time, so that few texts are held as strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield [c.to_pylist() for c in batch.slice(at, ROWS).columns]
        pa.default_memory_pool().release_unused()


def arrow(rows: pd.DataFrame) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(rows, preserve_index=False)


def _inside(codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which trigrams end inside a text (the others end in the breaks between texts)."""
    change = np.zeros(len(codes) + len(START) + 1, np.int8)
    change[begin] += 1                       # empty texts begin and end at once
    np.add.at(change, begin + size, -1)
    return np.cumsum(change, dtype=np.int8)[:len(codes)] > 0


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over all rows of the one column of `texts`."""
    def count(batches):
        total = np.zeros(GRAMS, np.int64)
        for (texts,) in sliced(batches):
            for part in chunks([t for t in texts if t]):
                codes, begin, size = trigrams(part)
                total += np.bincount(codes[_inside(codes, begin, size)], minlength=GRAMS)
        seen = np.flatnonzero(total)
        yield arrow(pd.DataFrame({"gram": seen, "n": total[seen]}))

    return texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> Column:
    """Discount of a count as an expression over n, from the counts of counts."""
    of = {int(r["n"]): int(r["k"]) for r in
          counts.filter("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}
    n1, n2, n3, n4 = (of.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    d = [min(max(x, 0.1), k - 0.05) for x, k in zip(d, (1, 2, 3))]
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def _order(counts: DataFrame, lower: DataFrame | None, order: int) -> DataFrame:
    """(gram, p) for each of the SYMBOLS^order n-grams, from its counts and the order below."""
    spark = counts.sparkSession
    kept = counts.withColumn("ctx", F.floor(F.col("gram") / SYMBOLS)).withColumn("d", _discounts(counts))
    ctx = kept.groupBy("ctx").agg(F.sum("n").alias("total"), F.sum("d").alias("mass"))
    grid = (spark.range(SYMBOLS ** order).withColumnRenamed("id", "g")
            .select("g", F.floor(F.col("g") / SYMBOLS).alias("c"), (F.col("g") % SYMBOLS ** max(order - 1, 0)).alias("low")))
    joined = (grid.join(kept.select("gram", "n", "d"), F.col("g") == F.col("gram"), "left")
              .join(ctx, F.col("c") == F.col("ctx"), "left"))
    if lower is None:
        below = F.lit(1.0 / SYMBOLS)
    else:
        joined = joined.join(lower.select(F.col("gram").alias("lg"), F.col("p").alias("lp")), F.col("low") == F.col("lg"))
        below = F.col("lp")
    own = F.coalesce((F.col("n") - F.col("d")) / F.col("total"), F.lit(0.0))
    back = F.coalesce(F.col("mass") / F.col("total"), F.lit(1.0))     # an unseen context backs off wholly
    return materialise(joined.select(F.col("g").alias("gram"), (own + back * below).alias("p")), f"kn-p{order}")


def train(texts: DataFrame) -> DataFrame:
    """(gram, p) for every trigram: p(third symbol | first two), modified Kneser-Ney."""
    three = materialise(gram_counts(texts), "kn-counts")
    two = materialise(three.groupBy((F.col("gram") % SYMBOLS ** 2).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "kn-counts")
    one = materialise(two.groupBy((F.col("gram") % SYMBOLS).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "kn-counts")
    return _order(three, _order(two, _order(one, None, 1), 2), 3)


def _losses(model: DataFrame):
    """Broadcast -log p of each trigram."""
    rows = model.select("gram", "p").toPandas()           # 64^3 rows, whatever the corpus
    table = np.zeros(GRAMS, np.float32)
    table[rows["gram"].to_numpy()] = -np.log(rows["p"].to_numpy())
    return model.sparkSession.sparkContext.broadcast(table)


def scorer(model: DataFrame):
    """A column function: text to log perplexity in nats a character (NULL: no characters)."""
    shared = _losses(model)

    @F.pandas_udf(T.DoubleType())
    def log_perplexity(texts: pd.Series) -> pd.Series:
        out = []
        for part in chunks(texts.fillna("").tolist()):
            codes, begin, size = trigrams(part)
            loss = np.where(_inside(codes, begin, size), shared.value[codes], np.float32(0))
            loss = np.concatenate((loss, np.zeros(len(START) + 1, np.float32)))
            total = np.add.reduceat(loss, begin, dtype=np.float64)
            out.append(np.where(size > 0, total / np.maximum(size, 1), np.nan))
        got = pd.Series(np.concatenate(out) if out else [], dtype="float64")
        return got.astype(object).where(got.notna(), None)

    return log_perplexity


def word_rows(texts: list[str], table: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, spelling loss, text and length of each word. `table`: -log p of the character trigrams (None: no losses)."""
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size + 1) - size + 1
    points = np.frombuffer(("  " + "\n".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = ~((points == 32) | ((points >= 9) & (points <= 13)))
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
    spelling = np.zeros(0) if table is None else _spelling(points, inside, start, end, table)
    # sum of character * BASE^(place in the word), from running sums
    power = np.full(len(points) + 1, BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    inverse = np.full(len(points) + 1, pow(BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    h = (total[end] - total[start]) * inverse[start]
    for shift in (29, 32):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(BASE) + (end - start).astype(np.uint64)
    return h ^ (h >> np.uint64(31)), spelling, np.searchsorted(begin, start, side="right") - 1, end - start


def _spelling(points: np.ndarray, inside: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    symbol = np.where(points < 128, ALPHABET[np.minimum(points, 127)], _OTHER_ASCII + 1 + points % 6).astype(np.int32)
    symbol[~inside] = 52
    # spelled after two blanks, and to the blank behind it
    before = np.where(inside[1:-1], symbol[:-2], 52)
    loss = table[(before * SYMBOLS + symbol[1:-1]) * SYMBOLS + symbol[2:]]
    loss = np.concatenate((np.zeros(2, np.float32), loss))
    spelled = inside.copy()
    spelled[end] = True
    return np.add.reduceat(np.where(spelled, loss, np.float32(0)), start, dtype=np.float64)


def word_pairs(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, word and text of each pair: all words, then the ends of the texts."""
    first = np.concatenate(([True], doc[1:] != doc[:-1]))[:len(doc)]
    last = np.concatenate((doc[1:] != doc[:-1], [True]))[-len(doc):] if len(doc) else first
    before = np.where(first, FIRST, np.concatenate((words[:1], words[:-1])))
    return (np.concatenate((before, words[last])), np.concatenate((words, np.full(last.sum(), LAST))),
            np.concatenate((doc, doc[last])))


def pair_key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return ((h << np.uint64(21)) | (h >> np.uint64(43))) ^ w


def repetition(words: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """Of each text: pairs seen before in their block, by pairs and PRIOR_PAIRS."""
    within = np.flatnonzero(doc[1:] == doc[:-1])
    of = doc[1:][within]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    block = (of.astype(np.uint64) << np.uint64(32)) + (place // BLOCK).astype(np.uint64)
    keys = pair_key(words[:-1][within], words[1:][within]) ^ ((block + np.uint64(1)) * np.uint64(BASE))
    _, at = np.unique(keys, return_index=True)
    pairs = np.bincount(of, minlength=texts)
    return (pairs - np.bincount(of[at], minlength=texts)) / (pairs + PRIOR_PAIRS)


def round_count(chars: int) -> int:
    """Rounds for documents of so many characters: a power of two."""
    return min(MOST_ROUNDS, 1 << max(0, -(-chars // ROUND_CHARS) - 1).bit_length())


def _round(words: np.ndarray, rounds: int) -> np.ndarray:
    """The round of a word, or of a context with its pairs."""
    return (words >> np.uint64(60)) & np.uint64(rounds - 1)


def word_model(texts: DataFrame, shared, rounds: int = 1) -> tuple[DataFrame, float]:
    """(key, value, n, round, rounds) of words and seen pairs, and -log of the unigrams' back-off weight.

    The loss of a text is, over its pairs, the spelling loss and that weight, and
    the values of the pair and of its words; keys that are not here have value 0.
    """
    def parts(batches, table):
        for (texts,) in sliced(batches):
            for part in chunks([t for t in texts if t]):
                yield word_rows(part, table)

    def count(k):
        def run(batches):
            for words, _, doc, _ in parts(batches, None):
                h, w, _ = word_pairs(words, doc)
                if rounds > 1:
                    mine = _round(h, rounds) == k
                    h, w = h[mine], w[mine]
                _, at, n = np.unique(pair_key(h, w), return_index=True, return_counts=True)
                yield arrow(pd.DataFrame({"h": h[at].view(np.int64), "w": w[at].view(np.int64), "n": n}))
        return run

    def spell(batches):
        told = np.array([LAST])               # the words this task has spelled
        yield arrow(pd.DataFrame({"w": told.view(np.int64), "spelling": np.log(SYMBOLS)}))
        for words, spelling, _, _ in parts(batches, shared.value):
            w, at = np.unique(words, return_index=True)
            new = ~np.isin(w, told)
            told = np.concatenate((told, w[new]))
            yield arrow(pd.DataFrame({"w": w[new].view(np.int64), "spelling": spelling[at][new]}))

    pairs = [materialise(texts.mapInArrow(count(k), "h long, w long, n long").groupBy("h", "w").agg(F.sum("n").alias("n")), "kn-pairs")
             for k in range(rounds)]
    all_pairs = reduce(DataFrame.union, pairs)
    spelled = texts.mapInArrow(spell, "w long, spelling double").groupBy("w").agg(F.min("spelling").alias("spelling"))
    ones = materialise(all_pairs.groupBy("w").agg(F.count(F.lit(1)).alias("n")).join(spelled, "w"), "kn-words")
    discounted = ones.withColumn("d", _discounts(ones))
    all_ = discounted.agg(F.sum("n").alias("total"), F.sum("d").alias("mass")).first()
    back = all_["mass"] / all_["total"] if all_["total"] else 1.0
    one = materialise(discounted.select("w", "n", "spelling", (
        (F.col("n") - F.col("d")) / F.lit(float(all_["total"] or 1)) + back * F.exp(-F.col("spelling"))).alias("p")), "kn-words")
    discard(ones)
    d = _discounts(all_pairs)
    ctx, model = [], []
    for k in range(rounds):                   # a context has all its pairs in one round
        kept = pairs[k].withColumn("d", d)
        ctx.append(materialise(kept.groupBy("h").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("back")), "kn-contexts"))
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("back") * F.col("p")
        # the words and contexts are the hashed side: the pairs are not sorted
        two = kept.join(ctx[k].hint("shuffle_hash"), "h").join(one.select("w", "p").hint("shuffle_hash"), "w").select(
            F.shiftleft("h", 21).bitwiseOR(F.shiftrightunsigned("h", 43)).bitwiseXOR(F.col("w")).alias("key"),
            (-F.log(p) + F.log("back") + F.log("p")).cast("float").alias("value"), "n", F.lit(k).alias("round"), F.lit(rounds).alias("rounds"))
        model.append(materialise(two, "kn-model"))
        discard(pairs[k])
    all_ctx = reduce(DataFrame.union, ctx)
    words = one.join(all_ctx, one["w"] == all_ctx["h"], "full").select(
        F.coalesce("w", "h").alias("key"),
        (F.coalesce(-F.log("p") - F.col("spelling") + float(np.log(back)), F.lit(0.0))
         + F.coalesce(-F.log("back"), F.lit(0.0))).cast("float").alias("value"), F.coalesce("total", "n").alias("n"),
        F.shiftrightunsigned(F.coalesce("w", "h"), 60).bitwiseAND(F.lit(rounds - 1)).cast("int").alias("round"), F.lit(rounds).alias("rounds"))
    model.append(materialise(words, "kn-model"))
    discard(one, *ctx)
    whole = reduce(DataFrame.union, model)
    whole._arrears_parts = model
    return whole, float(-np.log(back))


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of equal weight stand together, so that those that are 0 compress."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes()


def _numbers(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys >> 8) % shards


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the wanted keys (0: not there), and which are there. `keys` are in order."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[at] == wanted
    return np.where(there, values[at], 0.0), there


def text_scores(texts: DataFrame, model: DataFrame, weight: float, shared) -> DataFrame:
    """(digest, loss, words, letters, repetition) of each distinct text with words; `texts` has text and digest."""
    spark = texts.sparkSession
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    rounds = model.agg(F.max("rounds")).first()[0] or 1
    shards = 1 + chars // (SHARD_CHARS * rounds)
    top = model.orderBy(F.desc("n"), "key").limit(HOT).select("key", "value").toPandas().sort_values("key")
    hot = spark.sparkContext.broadcast((top["key"].to_numpy(np.int64), top["value"].to_numpy(np.float64)))

    def parts(batches, table):
        for texts_here, digests_here in sliced(batches):
            rows = [(t, d) for t, d in zip(texts_here, digests_here) if t]
            at = 0
            for part in chunks([t for t, _ in rows]):
                yield sum(map(len, part)), np.array([d for _, d in rows[at:at + len(part)]], np.int64), *word_rows(part, table)
                at += len(part)

    def entries(k, digests, words, spelling, doc, size):
        """What a round has of a part: its documents (digest, loss without shards, words, letters, repetition), keys and their documents."""
        n = np.bincount(doc, minlength=len(digests))
        h, w, at = word_pairs(words, doc)
        start = np.flatnonzero(n) if _round(FIRST, rounds) == k else np.zeros(0, np.int64)
        pair, word = (slice(None),) * 2 if rounds == 1 else (_round(x, rounds) == k for x in (h, w))
        keys = np.concatenate((w[word], pair_key(h[pair], w[pair]), np.full(len(start), FIRST))).view(np.int64)
        at = np.concatenate((at[word], at[pair], start))
        value, there = _lookup(*hot.value, keys)
        loss = np.bincount(at, value, minlength=len(digests))
        repeated = np.zeros(len(digests))
        if k == 0:                # what needs no key
            loss += np.bincount(doc, spelling, minlength=len(digests)) + np.log(SYMBOLS) + (n + 1) * weight
            repeated = repetition(words, doc, len(digests))
        letters = np.bincount(doc, size, minlength=len(digests)).astype(np.int64)
        return np.stack((digests, loss.view(np.int64), n, letters, repeated.view(np.int64))), keys[~there], at[~there].astype(np.uint32)

    def blocks_of(block, heads, keys, of):
        """A block for each shard, and one with what is known of the documents already."""
        first = np.cumsum([0] + [h.shape[1] for h in heads[:-1]])
        keys, of = np.concatenate(keys), np.concatenate([o + np.uint32(f) for o, f in zip(of, first)])
        shard, stored = _shard(keys, shards), keys.view(np.uint64) >> np.uint64(16)
        order = np.lexsort((stored, shard))
        shard, stored, of = shard[order], stored[order], of[order]
        cut = np.searchsorted(shard, np.arange(shards + 1))
        sent = np.flatnonzero(np.diff(cut)).tolist()
        out = [(block % shards, block, len(sent), np.concatenate(heads, axis=1).tobytes(), None, None)]
        for i in sent:
            here = slice(cut[i], cut[i + 1])
            out.append((i, block, None, None, _planes(np.diff(stored[here], prepend=np.uint64(0))), _planes(of[here])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*out), [pa.int64()] * 3 + [pa.binary()] * 3)], ["shard", "block", "sent", "head", "keys", "rows"])

    def pack(k):
        def run(batches):
            from pyspark import TaskContext
            block, stack, held = TaskContext.get().partitionId() << 32, [], 0
            for size, *part in parts(batches, None if k else shared.value):
                stack.append(entries(k, *part))
                held += size
                if held >= STACK:
                    yield blocks_of(block, *zip(*stack))
                    block, stack, held = block + 1, [], 0
            if stack:
                yield blocks_of(block, *zip(*stack))
        return run

    def join(texts_here, model_here):
        keys = model_here["key"].to_numpy(np.int64).view(np.uint64) >> np.uint64(16)
        order = np.argsort(keys)
        keys, values = keys[order], model_here["value"].to_numpy(np.float64)[order]
        out = []
        for shard, block, sent, head, packed, rows in zip(*(texts_here[c] for c in ("shard", "block", "sent", "head", "keys", "rows"))):
            if head is not None:
                out.append((shard, block, sent, head, None))
                continue
            value, _ = _lookup(keys, values, np.cumsum(_numbers(packed, np.uint64), dtype=np.uint64))
            sums = np.bincount(_numbers(rows, np.uint32), value)
            some = np.flatnonzero(sums)
            out.append((shard, block, None, _planes(some.astype(np.uint32)), sums[some].tobytes()))
        return pd.DataFrame(out, columns=["shard", "block", "sent", "head", "sums"]).astype({"sent": "Int64"})

    def merge(blocks):
        """One row for each document of a block."""
        blocks = blocks.sort_values("shard", kind="stable")
        whole = blocks["sums"].isna()
        if whole.sum() != 1 or blocks["sent"][whole].iloc[0] != len(blocks) - 1:
            raise RuntimeError("the texts of a block changed while they were scored")
        digests, loss, n, letters, repeated = np.frombuffer(blocks["head"][whole].iloc[0], np.int64).reshape(5, -1)
        loss = loss.view(np.float64).copy()
        for rows, sums in zip(blocks["head"][~whole], blocks["sums"][~whole]):
            if sums:
                loss[_numbers(rows, np.uint32)] += np.frombuffer(sums)
        return pd.DataFrame({"digest": digests, "loss": loss, "words": n, "letters": letters, "repetition": repeated.view(np.float64)})[n > 0]

    done = []
    for k in range(rounds):
        packed = texts.select("text", "digest").mapInArrow(pack(k), "shard long, block long, sent long, head binary, keys binary, rows binary")
        values = model.filter(F.col("round") == k).select(F.pmod(F.shiftright("key", 8), F.lit(shards)).alias("shard"), "key", "value")
        sums = packed.groupBy("shard").cogroup(values.groupBy("shard")).applyInPandas(
            join, "shard long, block long, sent long, head binary, sums binary")
        scored = sums.groupBy("block").applyInPandas(merge, "digest long, loss double, words long, letters long, repetition double")
        scored = scored.withColumn("round", F.lit(k))
        done.append(materialise(scored, "kn-sums") if rounds > 1 else scored)
    # equal texts come together, with the same sums in each round
    loss = [F.max(F.when(F.col("round") == k, F.col("loss"))) for k in range(rounds)]
    return reduce(DataFrame.union, done).groupBy("digest").agg(
        reduce(Column.__add__, loss).alias("loss"), *[F.max(c).alias(c) for c in ("words", "letters", "repetition")])


def _limit(histogram: DataFrame, by: list[str], q: float) -> DataFrame:
    """The quantile from (bin, n) by group, read off running sums: the upper end of its bin.

    Fewer than 1 / (1 - q) rows do not reach so far: there it is the largest value, or the
    quantile of the exponential tail that the excesses over q75 have, if that is more.
    """
    upto = F.sum("n").over(W.partitionBy(*by).orderBy("bin"))
    whole = F.sum("n").over(W.partitionBy(*by))
    placed = histogram.withColumn("upto", upto).withColumn("whole", whole)
    high = F.min(F.when(F.col("upto") >= F.col("whole") * 0.75, F.col("bin"))).over(W.partitionBy(*by))
    placed = placed.withColumn("q75", high)
    over = F.greatest(F.col("bin") - F.col("q75"), F.lit(0)) * F.col("n")
    beyond = F.sum(F.when(F.col("bin") > F.col("q75"), F.col("n")))
    tail = F.first("q75") + F.coalesce(F.sum(over) / beyond, F.lit(0.0)) * float(np.log(0.25 / (1 - q)))
    plain = F.min(F.when(F.col("upto") >= F.col("whole") * q, F.col("bin")))
    docs = F.max("whole")
    return placed.groupBy(*by).agg(
        ((F.when((docs * (1 - q) < 1) & F.lit(q > 0.75), F.greatest(plain, tail)).otherwise(plain) + 1) / GRID).alias("limit"),
        docs.alias("docs"))


def _quantile(values: DataFrame, name: str, q: float, min_trusted: int) -> tuple[DataFrame, float | None]:
    """From (lang, value): (at, `name`) of each language with enough rows, and the quantile of all."""
    bins = materialise(values.filter("value is not null").groupBy("lang", F.floor(F.col("value") * GRID).alias("bin"))
                       .agg(F.count(F.lit(1)).alias("n")), "kn-bins")
    every = _limit(bins.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("all", F.lit(1)), ["all"], q).first()
    by = materialise(_limit(bins, ["lang"], q).filter(F.col("docs") >= min_trusted)
                     .select(F.col("lang").alias("at"), F.col("limit").alias(name)), "kn-thresholds")
    return by, every and every["limit"]


def _with(df: DataFrame, limits: tuple[DataFrame, float | None], name: str) -> DataFrame:
    by, overall = limits
    return df.join(by, df["lang"].eqNullSafe(by["at"]), "left").drop("at").withColumn(
        name, F.coalesce(F.col(name), F.lit(overall).cast("double")))


def trusted_rows(docs: DataFrame, labels: DataFrame, id_col: str, label_id_col: str, quality_col: str) -> DataFrame:
    """The rows labelled as good quality.

    Up to MOST_BROADCAST ids are broadcast, so that no text moves; beyond, the labels are the
    hashed side of a shuffle, so the texts are not sorted.
    """
    good = labels.filter((F.col(quality_col) == 1) & F.col(label_id_col).isNotNull()).select(F.col(label_id_col).alias("kn_label"))
    few = good.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    good = F.broadcast(good) if few else good.hint("shuffle_hash")
    return docs.join(good, docs[id_col] == good["kn_label"], "left_semi")


def digest_of(text: Column) -> Column:
    return F.xxhash64(text)


def held_out(digest: Column) -> Column:
    return F.pmod(digest, F.lit(HELD_OUT)) == 0


def _shrunk() -> Column:
    return F.col("median") + (F.col("score") - F.col("median")) * F.col("chars") / (F.col("chars") + PRIOR_CHARS)


def verdicts(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", lang_col="lang",
             label_id_col="doc_id", quality_col="quality", min_trusted: int = MIN_TRUSTED) -> DataFrame:
    """doc_id, lang, digest, score, threshold (log), repetition, kept of each row."""
    with shuffles_dropped(docs.sparkSession):
        narrow = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), docs[text_col].alias("text"),
                             digest_of(docs[text_col]).alias("digest"))
        trusted = trusted_rows(narrow.select("doc_id", "text", "digest"), labels, "doc_id", label_id_col, quality_col)
        counted = trusted.filter(~held_out(F.col("digest"))).select("text")
        shared = _losses(train(counted))
        chars = narrow.agg(F.sum(F.length("text"))).first()[0] or 0
        model, weight = word_model(counted, shared, round_count(chars))
        scores = text_scores(narrow.select("text", "digest"), model, weight, shared)
        rows = narrow.select("doc_id", "lang", "digest", F.length("text").alias("chars"))
        scored = materialise(rows.join(scores, "digest", "left").withColumn(
            "score", F.col("loss") / (F.col("letters") + F.col("words") + 1)).drop("loss"), "kn-scores")
        good = trusted_rows(scored, labels, "doc_id", label_id_col, quality_col)
        left = good.filter(held_out(F.col("digest")))
        median = _quantile(left.select("lang", F.col("score").alias("value")), "median", 0.5, min_trusted)
        discard(*model._arrears_parts)
        limit = _quantile(_with(left, median, "median").select("lang", _shrunk().alias("value")), "threshold", QUANTILE, min_trusted)
        repeated = _quantile(good.select("lang", F.col("repetition").alias("value")), "repeated", QUANTILE, min_trusted)
    judged = _with(_with(_with(scored, median, "median"), limit, "threshold"), repeated, "repeated")
    return judged.withColumn("kept", F.coalesce(_shrunk() <= F.col("threshold"), F.lit(True))
                             & F.coalesce(F.col("repetition") <= F.col("repeated"), F.lit(True)))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, lang, perplexity, threshold (as perplexity), kept."""
    return verdicts(docs, labels, **options).select(
        "doc_id", "lang", F.exp("score").alias("perplexity"), F.exp("threshold").alias("threshold"), "kept")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    lang, text = options.get("lang_col", "lang"), options.get("text_col", "text")
    bad = verdicts(docs, labels, **options).filter("not kept").select(F.col("lang").alias("kn_lang"), F.col("digest").alias("kn_digest")).distinct()
    bad = materialise(bad, "kn-rejected").hint("shuffle_hash")        # the texts are not sorted
    return docs.join(bad, docs[lang].eqNullSafe(bad["kn_lang"]) & (digest_of(docs[text]) == bad["kn_digest"]), "left_anti")
