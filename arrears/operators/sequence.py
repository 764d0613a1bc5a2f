"""Sequence numbers within a key, without one task per key.

``row_number() over (partition by key order by date, ...)`` puts every row of a
key in one task; a key holding a third of the rows stalls the job. Here the
number is computed in two levels that are exact together:

1. rows are numbered inside (key, date) -- parallel over the days of a key;
2. rows are counted per (key, date) (partial aggregation) and a window per
   key over its distinct dates -- bounded by the calendar, not by the rows --
   gives each day the count of the key's earlier rows.

The result is offset + number-within-day. The rows come out hash-partitioned
by (key, date), which later per-day steps (the clamped running balance)
reuse without another shuffle.

A single day of a key is still one task there. ``row_number_in_ranges`` has no such
bound: rows are dealt out in ranges of (key, order) of about equal size and
numbered inside (key, range); only the first and the last key of a range can go on
in another one, and only for these are counts carried from range to range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def row_number_within(df: DataFrame, key: str, day: str, order: list,
                      name: str = "row_number") -> DataFrame:
    """Add ``name`` = 1-based position of each row within ``key`` ordered by
    (``day``, *``order``); NULL days sort first, like an ascending window.

    ``day`` is an existing column that coarsens the ordering (e.g. the date of
    a timestamp ordered next), so that putting it first keeps the order.
    """
    in_day = Window.partitionBy(key, day).orderBy(*order)
    numbered = df.withColumn("_r", F.row_number().over(in_day))
    per_day = numbered.groupBy(key, day).agg(F.count(F.lit(1)).alias("_c"))
    before = (Window.partitionBy(key).orderBy(F.col(day).asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_day.select(key, day, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    # A plain equi-join keeps the (key, day) partitioning of the numbered rows
    # (a null-safe one would re-shuffle them on rewritten keys). Rows with a
    # NULL day sort first, so their offset is 0: the left join leaves it NULL.
    return (numbered.join(offsets, [key, day], "left")
            .select(*df.columns,
                    (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_r")).cast("bigint").alias(name)))


def row_number_in_ranges(df: DataFrame, key: str, order: list[str], name: str = "row_number") -> DataFrame:
    """Add ``name`` = 1-based position of each row within ``key`` ordered by the columns ``order``, NULLs first.

    A key, or one day of it, with a large share of all rows is spread over many tasks. Rows
    that are equal in key and order share a range; such rows may take their numbers in any order.
    A NULL key is a key like any other.
    """
    placed = materialise(df.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id()), "sequence")
    edges = placed.groupBy("_range").agg(F.min(F.struct(key)).alias("_first"), F.max(F.struct(key)).alias("_last"))
    at_edge = (placed.select(F.struct(key).alias("_key"), "_range").join(F.broadcast(edges), "_range")  # a row per range
               .where((F.col("_key") == F.col("_first")) | (F.col("_key") == F.col("_last"))))
    counts = at_edge.groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("_c"))       # two rows per range at most
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (counts.select("_key", F.col("_range").alias("_at"), F.sum("_c").over(before).alias("_off"))
               .where("_off > 0"))
    inside = Window.partitionBy(key, "_range").orderBy(*order)
    numbered = placed.withColumn("_r", F.row_number().over(inside)).withColumn("_own", F.struct(key))
    return (numbered.join(F.broadcast(carried), (F.col("_own") == F.col("_key")) & (F.col("_range") == F.col("_at")), "left")
            .select(*df.columns, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_r")).cast("bigint").alias(name)))
