"""SimHash near-duplicates through vantage-point trees (operator 7).

1. Fingerprint: 64-bit SimHash over word shingles, one Arrow-batched pass.
2. Equal fingerprints fall together first (map-side aggregated), so a group of
   copies of any size is one point from here on.
3. A vantage-point tree, fitted to a bounded sample of points, cuts the space
   into shards. A node holds a vantage point v and a radius m: points with
   d(v, x) <= m go inside, the others outside. By the triangle inequality a
   point inside can only link to points with d(v, x) <= m + r, so the outside
   points of that rim are sent inside as well. Thus every pair within r bits
   meets in at least one shard, and no pair can be lost.
4. Each shard goes on splitting the same way in its task, down to small leaves
   in which all pairs are compared. A leaf that no vantage point splits is a
   ball of a few bits, which holds few different fingerprints; beyond
   BRUTE points its links are found by looking up all fingerprints
   within r bits of each point, so the work stays linear in the points.
5. A shard gives one edge per linked point (a forest), not all pairs. Alternating
   large-star and small-star rounds join the forests to components.

Defined results
- NULL, empty or blank text: fingerprint 0, linked like any other.
- NULL id: never a component's id unless all of its ids are NULL.
- Repeated rows and ties: one fingerprint, one component; each row is returned.
- Empty table: no rows.
- Extra columns: ignored by `near_duplicates`, kept by `keep_one`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.common import fresh, materialise

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SHARD_POINTS = 4096        # aimed number of points of a shard
MAX_DEPTH = 12             # levels of the tree above the shards
SAMPLE_PER_SHARD = 16      # points of the fitting sample: at most 16 * 2^12
LEAF = 48
BRUTE = 8192
TRIES = 6                  # vantage points tried for each node


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the shingles as a signed 64-bit integer."""
    ws = (text or "").encode("utf-8").lower().split()   # bytes: ASCII case and white space only
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        size = np.fromiter(map(len, ws), np.int64, len(ws))
        end = np.cumsum(size + 1) - 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in
                  zip((end - size)[:len(ws) - shingle + 1].tolist(), end[shingle - 1:].tolist())]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[lo:lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view("<i8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf(T.LongType())
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return fp


def unsigned(fps) -> np.ndarray:
    """Fingerprints as uint64: numpy counts the bits of a signed number's absolute value."""
    return np.asarray(fps, dtype="int64").view(np.uint64)


def _distance(points: np.ndarray, v) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(v))


def _split(points: np.ndarray, r: int, rng) -> tuple | None:
    """The vantage point and radius with the least points in both parts; None if nothing is gained."""
    best = None
    for v in points[rng.integers(0, len(points), TRIES)]:
        d = _distance(points, v)
        for m in (int(np.median(d)), int(np.median(d)) - r):
            inside, outside = int((d <= m + r).sum()), int((d > m).sum())
            if m >= 0 and max(inside, outside) <= 0.9 * len(points) and (best is None or inside + outside < best[0]):
                best = (inside + outside, v, m)
    return best and best[1:]


def fit_tree(sample: np.ndarray, depth: int, r: int = MAX_BITS, seed: int = 0) -> list:
    """Nodes (vantage, radius, inside, outside); a child below zero is shard -child - 1."""
    nodes, shards, rng = [], 0, np.random.default_rng(seed)

    def grow(points: np.ndarray, level: int) -> int:
        nonlocal shards
        cut = _split(points, r, rng) if level < depth and len(points) >= 8 else None
        if cut is None:
            shards += 1
            return -shards
        v, m = cut
        at, d = len(nodes), _distance(points, v)
        nodes.append(None)
        nodes[at] = (int(v), m, grow(points[d <= m], level + 1), grow(points[d > m], level + 1))
        return at

    grow(sample, 0)
    return nodes


def route(nodes: list, points: np.ndarray, r: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(shard, point) rows: the shard of each point and the shards whose rim holds it."""
    if not nodes:
        return np.zeros(len(points), np.int64), points
    found, todo = [], [(0, points)]
    while todo:
        at, here = todo.pop()
        if not len(here):
            continue
        if at < 0:
            found.append((np.full(len(here), -at - 1, np.int64), here))
            continue
        v, m, inside, outside = nodes[at]
        d = _distance(here, v)
        todo += [(inside, here[d <= m + r]), (outside, here[d > m])]
    if not found:
        return np.zeros(0, np.int64), points
    return np.concatenate([s for s, _ in found]), np.concatenate([p for _, p in found])


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each index over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        root = new
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _leaf_links(points: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within r bits among different, sorted points, as a forest."""
    n, a, b = len(points), [], []
    if n <= BRUTE:
        step = max(1, (1 << 20) // max(n, 1))
        for lo in range(0, n, step):
            i, j = np.nonzero(np.bitwise_count(points[lo:lo + step, None] ^ points[None, :]) <= r)
            i = i + lo
            a.append(i[i < j])
            b.append(j[i < j])
    else:
        one = np.uint64(1) << np.arange(64, dtype=np.uint64)
        flips, reach = {0}, np.zeros(1, np.uint64)
        for _ in range(r):
            reach = np.unique(reach[:, None] ^ one[None, :])
            flips.update(reach.tolist())
        for flip in flips - {0}:
            near = points ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(points, near), n - 1)
            i = np.nonzero((points[at] == near) & (at > np.arange(n)))[0]
            a.append(i)
            b.append(at[i])
    a, b = np.concatenate(a), np.concatenate(b)
    root = _forest(n, a, b)
    linked = np.nonzero(root != np.arange(n))[0]
    return linked, root[linked]


def shard_links(points: np.ndarray, r: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(point, root) for every point of a shard that links to a smaller one."""
    points = np.unique(points)
    rng, a, b = np.random.default_rng(1), [], []
    todo = [np.arange(len(points))]
    while todo:
        here = todo.pop()
        cut = _split(points[here], r, rng) if len(here) > LEAF else None
        if cut is None:
            i, j = _leaf_links(points[here], r)
            a.append(here[i])
            b.append(here[j])
            continue
        d = _distance(points[here], cut[0])
        todo += [here[d <= cut[1] + r], here[d > cut[1]]]
    root = _forest(len(points), np.concatenate(a), np.concatenate(b))
    linked = np.nonzero(root != np.arange(len(points)))[0]
    return points[linked], points[root[linked]]


def links(points: DataFrame, r: int = MAX_BITS) -> DataFrame:
    """From different fingerprints (fp): edges (u, v), u > v, that connect what links."""
    n = points.count()
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(n, 1) / SHARD_POINTS)))))
    size = SAMPLE_PER_SHARD << depth
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(size).toPandas()["fp"]
    tree = fit_tree(unsigned(sample), depth, r)
    nodes = points.sparkSession.sparkContext.broadcast(tree)

    def send(batches):
        for batch in batches:
            shard, fp = route(nodes.value, unsigned(batch["fp"]), r)
            yield pd.DataFrame({"shard": shard, "fp": fp.view(np.int64)})

    def join(batch: pd.DataFrame) -> pd.DataFrame:
        u, v = shard_links(unsigned(batch["fp"]), r)
        u, v = u.view(np.int64), v.view(np.int64)
        return pd.DataFrame({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    # Shards are small in bytes and large in work: as many tasks as shards, however few bytes they have.
    sent = points.mapInPandas(send, "shard long, fp long").repartition(len(tree) + 1, "shard")
    return sent.groupBy("shard").applyInPandas(join, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for every point of an edge, by alternating large-star and small-star rounds."""
    def mark(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialise(edges, "vpt-edges")
    now = mark(edges)
    while now[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "vpt-edges")
        before, now = now, mark(edges)
        if before == now:
            break
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))


def _members(narrow: DataFrame, r: int) -> DataFrame:
    """(at, component) for every fingerprint of `narrow` (fp, rank), rank being what the smallest wins by."""
    reps = materialise(narrow.groupBy("fp").agg(F.min("rank").alias("rank")), "vpt-points")
    comps = components(links(reps.select("fp"), r))
    rooted = (reps.join(comps, "fp", "left")
              .select("fp", "rank", F.coalesce("root", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("rank").alias("component"))
    return rooted.join(lowest, "root").select(F.col("fp").alias("at"), "component")


def near_duplicates(docs: DataFrame, *, id_col="doc_id", text_col="text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    narrow = materialise(docs.select(docs[id_col].alias("doc_id"),
                                     fingerprint_udf(shingle)(docs[text_col]).alias("fp")), "vpt-docs")
    members = _members(narrow.select("fp", F.col("doc_id").alias("rank")), max_bits)
    return narrow.join(members, narrow["fp"] == members["at"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, *, id_col="doc_id", text_col="text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The document with the smallest id of each component, with its own columns.

    Ties in the id go by a digest of id and text; exactly repeated rows leave one.
    The texts move once: by that digest, which has no hot value but for repeated rows.
    """
    digest = F.md5(F.concat(F.coalesce(docs[id_col].cast("string"), F.lit("-")), F.lit("\x1f"),
                            F.coalesce(docs[text_col], F.lit(""))).cast("binary"))
    key, at = fresh(docs, "vpt_key"), fresh(docs, "vpt_at")
    keyed = docs.withColumn(key, digest)
    narrow = materialise(docs.select(
        fingerprint_udf(shingle)(docs[text_col]).alias("fp"),
        F.struct(docs[id_col].isNull().alias("no_id"), docs[id_col].alias("id"), digest.alias("digest")).alias("rank")),
        "vpt-docs")
    winners = _members(narrow, max_bits).select(F.col("component.digest").alias(at)).distinct()
    return (keyed.join(winners, keyed[key] == winners[at], "left_semi")
            .dropDuplicates([key]).drop(key))
