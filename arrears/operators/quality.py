"""Integrity checks of the four tables.

Each check is one aggregate per table -- no per-column jobs, no collect --
and returns a small report DataFrame. Keys are reduced with partial
aggregation before any shuffle, so a hot key (one customer with a third of
all loans, one loan with a third of all payments) collapses map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from ..sources.schemas import FOREIGN_KEYS, TABLES


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """NULL count per (table, column) for every NOT NULL column."""
    out = []
    for name, df in tables.items():
        cols = TABLES[name].columns
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        out.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(c).cast("bigint").alias("null_count")) for c in cols])).alias("r"))
            .select("r.*"))
    return _union(out)


def pk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, distinct keys and duplicated keys per table's primary key."""
    out = []
    for name, df in tables.items():
        pk = TABLES[name].primary_key
        per_key = df.groupBy(pk).agg(F.count(F.lit(1)).alias("_n"))
        out.append(per_key.agg(
            F.sum("_n").alias("n_rows"),
            F.count_if(F.col(pk).isNotNull()).alias("n_keys"),
            F.count_if((F.col("_n") > 1) & F.col(pk).isNotNull()).alias("n_duplicate_keys"),
        ).select(F.lit(name).alias("table_name"),
                 F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
                 F.col("n_keys").cast("bigint").alias("n_keys"),
                 F.col("n_duplicate_keys").cast("bigint").alias("n_duplicate_keys")))
    return _union(out)


def fk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Child rows (and distinct keys) whose parent does not exist.

    Children are reduced to one row per key before the anti join; NULL keys
    are reported by ``null_violations``, not here.
    """
    out = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        keys = (tables[child].where(F.col(col).isNotNull()).groupBy(col)
                .agg(F.count(F.lit(1)).alias("_n")))
        parents = tables[parent].select(F.col(pcol).alias(col))
        orphans = keys.join(parents, col, "left_anti")
        out.append(orphans.agg(F.sum("_n").alias("r"), F.count(F.lit(1)).alias("k")).select(
            F.lit(child).alias("child_table"), F.lit(col).alias("child_column"),
            F.lit(parent).alias("parent_table"),
            F.coalesce(F.col("r"), F.lit(0)).cast("bigint").alias("orphan_rows"),
            F.col("k").cast("bigint").alias("orphan_keys")))
    return _union(out)


def apply_defaults(name: str, df: DataFrame) -> DataFrame:
    """Column defaults for missing values (status 'active', amounts 0, ...)."""
    spec = TABLES[name]
    return df.select(*[
        F.coalesce(F.col(c), F.lit(spec.defaults[c]).cast(spec.schema[c].dataType)).alias(c)
        if c in spec.defaults else F.col(c) for c in spec.columns])


def defaults_applied(tables: dict[str, DataFrame]) -> DataFrame:
    """S11 report: how many values each default fills, per (table, column)."""
    out = []
    for name, df in tables.items():
        d = TABLES[name].defaults
        if not d:
            continue
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in d])
        out.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                     F.lit(str(v)).alias("default_value"),
                     F.col(c).cast("bigint").alias("n_defaulted")) for c, v in d.items()]))
            .alias("r")).select("r.*"))
    return _union(out)


def dense_ids(df: DataFrame, name: str = "surrogate_id") -> DataFrame:
    """Dense 1..n ids without a global sort or single-partition window.

    ``monotonically_increasing_id`` encodes (partition, position). The tagged rows
    are written once, so that counting and numbering see the same tags; the
    counts per partition (one row each, broadcast) give every partition its offset.
    """
    tagged = materialise(df.withColumn("_mid", F.monotonically_increasing_id()), "ids")
    part = F.shiftright(F.col("_mid"), 33)
    counts = tagged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_p", F.coalesce(F.sum("_c").over(
        Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_o"))
    pos = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (tagged.withColumn("_p", part).join(F.broadcast(offs), "_p")
            .withColumn(name, (F.col("_o") + pos + 1).cast("bigint"))
            .drop("_mid", "_p", "_o"))
