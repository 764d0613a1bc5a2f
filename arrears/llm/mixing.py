"""Mixing sources to target weights (operator 1).

Every source gets a share of all words by weight. A target stops at
`max_epochs` times the words its source has; the excess goes to the other
sources by weight until no target is above its stop.

A document has a hash-random key. Within a source the documents are ordered by
key in ranges of equal width (the keys are uniform, so the ranges hold about
equally many documents, about the square root of the source's rows). Word
counts are summed per range, a running sum over the ranges finds the one in
which the budget ends, and only that range is ordered document by document. So
no task sees more than about the square root of a source, hot or not.

A target of T words over a source of S words takes floor(T) div S whole epochs,
then the documents before the cut once more, then the leading words of the
document at the cut: the budget is met to the word.

Defined results
- NULL text: size 0. NULL source: a source of its own, ranked last.
- NULL id: ordered before every other id; its key is that of the empty string.
- Repeated rows: equal (id, size) rows of a source share a key; when the cut
  falls among them each takes the same whole number of words (the budget is
  missed by fewer words than there are such rows).
- Empty table, or no words at all: all targets and takes are 0.
- Other columns of the input, whatever their names, pass through `mix_documents`;
  the new columns get a leading underscore where a name is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.llm.common import fresh, materialise, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
KEY_DIGITS = 15            # hex digits of the MD5 that make the 60-bit key
KEY_SPACE = 16 ** KEY_DIGITS
NO_ID = -(1 << 63)


def hash_key(doc_id: Column, seed: str = SEED) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, source_rows, target.

    With the sources ordered by stop / weight, the level (words per unit of
    weight) is the largest of (words left after the stops so far) / (weight
    left); a source takes its weight times the level, or its stop. These
    windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("stop", F.col("source_size") * max_epochs)
    filled = W.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("stop").over(filled.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(filled.rowsBetween(W.currentRow, W.unboundedFollowing))
    everything = F.sum("source_size").over(W.partitionBy())
    per = per.withColumn("level", (everything - before).cast("double") / weight_left.cast("double"))
    level = F.max("level").over(W.partitionBy())
    return per.select("source", "source_size", "source_rows",
                      F.least(F.col("stop").cast("double"), F.col("weight") * level).alias("target"))


def _plan(sizes: DataFrame, weights, max_epochs) -> DataFrame:
    """One row per source with its target and the place of its cut."""
    targets = source_targets(sizes, weights, max_epochs)
    budget, size = F.floor("target"), F.col("source_size")
    targets = materialise(targets.select(
        "source", "source_size", "target",
        F.when(size > 0, F.floor(budget / size)).otherwise(0).cast("long").alias("epochs"),
        F.when(size > 0, budget % size).otherwise(0).cast("long").alias("rest"),
        F.ceil(F.lit(float(KEY_SPACE)) / F.ceil(F.sqrt("source_rows"))).cast("long").alias("width")), "mix-targets")
    cutting = targets.filter("source_size > 0").withColumnRenamed("source", "at")
    ranged = (sizes.join(cutting.select("at", "width", "rest"), F.col("source").eqNullSafe(F.col("at")))
              .withColumn("bucket", F.floor(F.col("key") / F.col("width"))))
    per_bucket = ranged.groupBy("at", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = F.sum("words").over(W.partitionBy("at").orderBy("bucket"))
    bucket_cut = (per_bucket.withColumn("upto", running)
                  .filter("upto - words <= rest and rest < upto")
                  .select(F.col("at").alias("cut_at"), F.col("bucket").alias("cut_bucket"),
                          (F.col("rest") - (F.col("upto") - F.col("words"))).alias("left")))
    bucket_cut = materialise(bucket_cut, "mix-buckets")
    inside = (ranged.join(bucket_cut, F.col("at").eqNullSafe(F.col("cut_at")) & (F.col("bucket") == F.col("cut_bucket")))
              .groupBy("at", "key", "id", "size").agg(F.count(F.lit(1)).alias("copies"), F.first("left").alias("left")))
    words = F.col("size") * F.col("copies")
    upto = F.sum(words).over(W.partitionBy("at").orderBy("key", "id", "size"))
    cuts = (inside.withColumn("upto", upto)
            .filter((F.col("upto") - words <= F.col("left")) & (F.col("left") < F.col("upto")))
            .select(F.col("at").alias("cut_source"), F.col("key").alias("cut_key"), F.col("id").alias("cut_id"),
                    F.col("size").alias("cut_size"),
                    F.floor((F.col("left") - (F.col("upto") - words)) / F.col("copies")).alias("part")))
    plan = (targets.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
            .select(F.col("source").alias("at"), "source_size", "target", "epochs",
                    "cut_key", "cut_id", "cut_size", "part"))
    return materialise(plan, "mix-plan")


def _taken(plan: dict[str, Column], key: Column, ident: Column, size: Column) -> Column:
    """Words of whole epochs and of the last, incomplete one."""
    before = (key < plan["cut_key"]) | ((key == plan["cut_key"]) & (
        (ident < plan["cut_id"]) | ((ident == plan["cut_id"]) & (size < plan["cut_size"]))))
    at = (key == plan["cut_key"]) & (ident == plan["cut_id"]) & (size == plan["cut_size"])
    return (plan["epochs"] * size + F.when(before, size).when(at, plan["part"]).otherwise(0)).cast("long")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return materialise(docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("id"),
        docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"),
        hash_key(docs[id_col], seed).alias("key")), "mix-sizes")


def mixture(docs: DataFrame, *, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
            id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, epochs."""
    sizes = _sizes(docs, id_col, text_col, source_col, seed)
    plan = _plan(sizes, weights, max_epochs)
    taken = _taken({c: plan[c] for c in plan.columns}, F.col("key"), F.col("id"), F.col("size"))
    return (sizes.join(plan, F.col("source").eqNullSafe(F.col("at")))
            .select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "epochs"))


def mix_documents(docs: DataFrame, *, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
                  id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The documents in the mix, with size, source_size, target and taken.

    `taken` div `size` is how often the whole text is repeated and `taken` mod
    `size` how many leading words follow. The texts do not move: the plan has
    one row per source and Spark broadcasts it while it is small.
    """
    plan = _plan(_sizes(docs, id_col, text_col, source_col, seed), weights, max_epochs)
    size, key = fresh(docs, "mix_size"), fresh(docs, "mix_key")
    sized = docs.withColumns({size: word_count(docs[text_col]), key: hash_key(docs[id_col], seed)})
    inner = {c: fresh(sized, f"mix_{c}") for c in plan.columns}
    plan = plan.withColumnsRenamed(inner)
    of = {c: plan[n] for c, n in inner.items()}
    taken = _taken(of, sized[key], F.coalesce(sized[id_col].cast("long"), F.lit(NO_ID)), sized[size])
    out = {n: fresh(docs, n) for n in ("size", "source_size", "target", "taken")}
    mixed = sized.join(plan, sized[source_col].eqNullSafe(of["at"])).select(
        *[sized[c] for c in docs.columns], sized[size].alias(out["size"]),
        of["source_size"].alias(out["source_size"]), of["target"].alias(out["target"]), taken.alias(out["taken"]))
    return mixed.filter(F.col(out["taken"]) > 0)
