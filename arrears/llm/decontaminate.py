"""Benchmark decontamination with suffix arrays (operator 10).

The documents are the training text. Each task takes its documents in shards of
about SHARD_BYTES, turns words into numbers, and builds the suffix array of the
shard. Words that no benchmark item has can be in no match, so the array holds
just the runs of benchmark words that are long enough for a window; the runs
are kept apart by a number that no item uses. Every suffix of every item is then
searched in the array by binary search. The places where its first `window`
words stand are matches; matches at successive suffixes join to the longest
verbatim match.

The benchmark is taken in blocks of at most BLOCK_WORDS words; each block is
broadcast, which is the bound on what a task holds, however large the benchmark
is. All blocks are searched in the same pass over the documents, so no text is
shuffled and no result is merged later.

Words are compared by a 64-bit hash.

Defined results
- NULL or wordless text: no words, no hits. NULL or wordless item: no window.
- NULL item id: listed as the empty string.
- Items with equal ids, repeated rows, equal windows of different items: every
  id is listed once; each document row is judged on its own.
- Empty benchmark: nothing is hit. Empty documents table: no rows.
- Extra columns pass through, whatever their names.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import fresh

WINDOW = 10
BLOCK_WORDS = 1 << 20
SHARD_BYTES = 4 << 20
BASE = 0x9E3779B97F4A7C15          # odd: the multiplier of the word hash
RESULT = ("struct<n_words:long,n_hit:long,items:array<string>,"
          "matches:array<struct<item_id:string,word:long,length:long>>>")

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64) + np.uint64(1)
_IS_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the first byte of each word (ASCII letters, digits, all beyond ASCII; A-Z as a-z)."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], _IS_WORD[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    # sum of byte * BASE^(place in the word), from running sums over the whole shard
    power = np.full(len(raw) + 1, BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LOWER[raw] * power[:-1], out=total[1:])
    whole = total[end] - total[start]
    inverse = np.full(len(raw) + 1, pow(BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    h = whole * inverse[start]
    return (h ^ (h >> np.uint64(29))) * np.uint64(BASE) + (end - start).astype(np.uint64), start


def make_block(items: list[tuple[str, np.ndarray]], window: int) -> SimpleNamespace:
    """A block of the benchmark: its vocabulary and the windows to search, by their length.

    Plain data, since executors that read the broadcast need not have this module.
    """
    vocabulary = np.unique(np.concatenate([w for _, w in items]))
    by_length: dict[int, list] = {}
    for k, (_, hashes) in enumerate(items):
        w = (np.searchsorted(vocabulary, hashes) + 1).astype(np.int32)
        n = min(window, len(w))
        view = np.lib.stride_tricks.sliding_window_view(w, n)
        by_length.setdefault(n, []).append((view, np.full(len(view), k), np.arange(len(view))))
    searches = {}
    for n, parts in by_length.items():
        patterns, which = np.unique(np.concatenate([p[0] for p in parts]), axis=0, return_inverse=True)
        order = np.argsort(which, kind="stable")
        first = np.searchsorted(which[order], np.arange(len(patterns) + 1))
        searches[n] = (patterns, first, np.concatenate([p[1] for p in parts])[order],
                       np.concatenate([p[2] for p in parts])[order])
    return SimpleNamespace(vocabulary=vocabulary, ids=[i for i, _ in items], longest=max(len(w) for _, w in items),
                           searches=searches, shortest=min(searches))


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW,
           block_words: int = BLOCK_WORDS):
    """The benchmark's items with words, a block at a time."""
    items, n = [], 0
    for row in benchmark.select(benchmark[id_col].cast("string").alias("i"), benchmark[text_col].alias("t")).toLocalIterator():
        hashes, _ = hash_words((row.t or "").encode())
        if not len(hashes):
            continue
        if items and n + len(hashes) > block_words:
            yield make_block(items, window)
            items, n = [], 0
        items.append((row.i or "", hashes))
        n += len(hashes)
    if items:
        yield make_block(items, window)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first `depth` words or more, by prefix doubling."""
    rank = text.astype(np.int64)
    k = 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[:len(rank) - k] = rank[k:] + 1
        pair = rank * (int(rank.max(initial=0)) + 2 + int(after.max(initial=0))) + after if k < len(rank) else rank
        order = np.argsort(pair, kind="stable")
        step = np.concatenate(([0], np.cumsum(pair[order][1:] != pair[order][:-1])))
        rank = np.empty(len(rank), np.int64)
        rank[order] = step
        k *= 2
        if k >= depth or k >= len(rank) or step[-1] == len(rank) - 1:
            return order


def search(text: np.ndarray, order: np.ndarray, patterns: np.ndarray, upper: bool) -> np.ndarray:
    """For each pattern the number of suffixes before it (upper: not after it), by binary search."""
    m, n = len(order), patterns.shape[1]
    padded = np.concatenate([text, np.zeros(n, text.dtype)])
    lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), m, np.int64)
    span = np.arange(n)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        here = padded[order[np.minimum(mid, m - 1)][:, None] + span]
        differ = here != patterns
        first = differ.argmax(axis=1)
        rows = np.arange(len(patterns))
        same = ~differ[rows, first]
        before = np.where(same, upper, here[rows, first] < patterns[rows, first])
        lo = np.where(open_ & before, mid + 1, lo)
        hi = np.where(open_ & ~before, mid, hi)
    return lo


def scan_shard(texts: list[str], found: list[SimpleNamespace]) -> list[tuple]:
    """(n_words, n_hit, items, matches) of each text."""
    raw = [t.encode() for t in texts]
    begin = np.cumsum([0] + [len(r) + 1 for r in raw])
    hashes, at = hash_words(b"\n".join(raw))
    bounds = np.searchsorted(at, begin)          # first word of each text, and the end
    n_words = np.diff(bounds)
    hit = np.zeros(len(hashes), bool)
    places: list[dict] = [{} for _ in texts]
    fresh_doc = np.zeros(len(hashes) + 1, bool)
    fresh_doc[bounds] = True
    for block in found:
        number = np.minimum(np.searchsorted(block.vocabulary, hashes), len(block.vocabulary) - 1)
        known = block.vocabulary[number] == hashes
        # runs of known words inside one text
        starts = np.flatnonzero(known & (fresh_doc[:-1] | ~np.concatenate(([False], known[:-1]))))
        ends = np.flatnonzero(known & (fresh_doc[1:] | ~np.concatenate((known[1:], [False])))) + 1
        long_ = ends - starts >= block.shortest
        starts, ends = starts[long_], ends[long_]
        if not len(starts):
            continue
        size = ends - starts + 1
        offset = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(offset - starts, size)     # word of the shard
        apart = place == np.repeat(ends, size)
        text = np.where(apart, 0, number[np.minimum(place, len(number) - 1)] + 1).astype(np.int32)
        order = suffix_array(text, block.longest)
        for n, (patterns, first, items, starts_in) in block.searches.items():
            low, high = search(text, order, patterns, False), search(text, order, patterns, True)
            for k in np.flatnonzero(high > low):
                where = place[order[low[k]:high[k]]]
                hit[(where[:, None] + np.arange(n)).ravel()] = True
                docs = np.searchsorted(bounds, where, side="right") - 1
                for i, s in zip(items[first[k]:first[k + 1]].tolist(), starts_in[first[k]:first[k + 1]].tolist()):
                    for d, w in zip(docs.tolist(), where.tolist()):
                        places[d].setdefault((block.ids[i], n), set()).add((w - s, s))
    hits = np.concatenate(([0], np.cumsum(hit)))
    n_hit = hits[bounds[1:]] - hits[bounds[:-1]]
    out = []
    for d, seen in enumerate(places):
        best: dict[str, tuple] = {}
        for (item, n), marks in seen.items():
            length, last = 0, None
            for diagonal, s in sorted(marks):    # successive suffixes on a diagonal are one match
                length = length + 1 if last == (diagonal, s - 1) else n
                last = (diagonal, s)
                if length > best.get(item, (0,))[0]:
                    best[item] = (length, int(diagonal + s + n - length - bounds[d]))
        ids = sorted(best)
        out.append((int(n_words[d]), int(n_hit[d]), ids,
                    [{"item_id": i, "word": best[i][1], "length": best[i][0]} for i in ids]))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, *, text_col="text", item_id_col="item_id",
         item_text_col="text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, str]:
    """`docs` with a struct: n_words, n_hit, items (sorted ids), matches (longest of each item); and its name."""
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(b) for b in blocks(benchmark, item_id_col, item_text_col, window, block_words)]

    @F.pandas_udf(RESULT)
    def contamination(texts: pd.Series) -> pd.DataFrame:
        found, shard, size, rows = [b.value for b in shared], [], 0, []
        for t in texts.fillna("").tolist():
            shard.append(t)
            size += len(t)
            if size >= SHARD_BYTES:
                rows += scan_shard(shard, found)
                shard, size = [], 0
        rows += scan_shard(shard, found) if shard else []
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "matches"])

    name = fresh(docs, "contamination")
    return docs.withColumn(name, contamination(docs[text_col])), name


def remove(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    scanned, name = scan(docs, benchmark, **options)
    return scanned.filter(F.col(f"{name}.n_hit") == 0).drop(name)


def report(docs: DataFrame, benchmark: DataFrame, *, id_col="doc_id", **options) -> DataFrame:
    """One row per document with its counts, items, their digest and the longest matches."""
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[options.get("text_col", "text")].alias("text"))
    scanned, name = scan(narrow, benchmark, **{**options, "text_col": "text"})
    c = F.col(name)
    return scanned.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                          F.size(c["items"]).cast("long").alias("n_items"),
                          F.sha2(F.concat_ws(",", c["items"]).cast("binary"), 256).alias("items_sha256"),
                          (c["n_hit"] > 0).alias("contaminated"), c["matches"].alias("matches"))
