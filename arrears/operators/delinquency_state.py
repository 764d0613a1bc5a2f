"""The delinquency view kept up to date by increments of payments.

Every statistic of ``payment_stats`` is a sum or a maximum, so the statistics of old
and new payments merge without the old payments. The state holds them per loan,
in buckets of loan_id. An increment is reduced to one row per loan, only the
buckets it touches are read, merged and written, and a manifest names the folder of every bucket:

    <target>/versions/<v>/state/bucket=<b>/   the buckets that version wrote
    <target>/versions/<v>/_manifest/          bucket, folder: the state after that version
    <target>/_published                       one row per version, with the increment's id

A version becomes visible by its row in ``_published``. So a lost job leaves the
state before it, a reader keeps the version it opened, and an increment whose id
is already published is not merged again.

A bucket is merged in one task and is one file: choose ``n_buckets`` for the state's
final size (``io.bucket_count``), not for the first increment. A loan with a third of all
payments is one row by then.

Defined results
- Payments come in, they do not change or go: a correction of merged payments needs ``create`` anew.
- NULL loan_id: kept in the state as a row of its own, and joined to no loan.
- An empty increment publishes its id and writes no bucket.
- One writer at a time; readers any number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import publish, published_path, published_versions
from .delinquency import payment_stats, with_stats

STATE = T.StructType([T.StructField(c, t) for c, t in (
    ("loan_id", T.LongType()), ("n_pay", T.LongType()), ("n_late", T.LongType()), ("sum_late", T.LongType()),
    ("n_late_vals", T.LongType()), ("max_late", T.IntegerType()), ("recent_key", T.LongType()))])
MERGE = {"n_pay": F.sum, "n_late": F.sum, "sum_late": F.sum, "n_late_vals": F.sum, "max_late": F.max, "recent_key": F.max}
MANIFEST = "bucket int, folder string"
_CREATED = "state created"


def _bucket(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("loan_id"), F.lit(n_buckets)).cast("int").alias("bucket")


def create(spark: SparkSession, target: str, n_buckets: int) -> None:
    """An empty state of ``n_buckets`` buckets, as a new version."""
    if n_buckets < 1:
        raise ValueError("a state has at least one bucket")

    def write(path: str) -> None:
        rows = [(b, None) for b in range(n_buckets)]          # a manifest row per bucket
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{path}/_manifest")

    publish(spark, target, write, note=_CREATED)


def _manifest(spark: SparkSession, target: str) -> dict[int, str | None]:
    """Folder of each bucket (None: no loan yet) in the current version."""
    rows = spark.read.schema(MANIFEST).parquet(f"{published_path(spark, target)}/_manifest").collect()
    return {r["bucket"]: r["folder"] for r in rows}


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(*folders)


def merged_increments(spark: SparkSession, target: str) -> list[str]:
    """Ids of the increments in the state, since it was created last, oldest first."""
    ids: list[str] = []
    for row in reversed(published_versions(spark, target).select("note").collect()):      # a row per increment
        ids = [] if row["note"] == _CREATED else ids + [row["note"]]
    return ids


def merge(spark: SparkSession, target: str, payments: DataFrame, increment: str) -> list[int]:
    """Merge new payments under the id ``increment``; the buckets that were written.

    An id that was merged before changes nothing and returns no bucket.
    """
    if increment == _CREATED:
        raise ValueError(f"{increment!r} is no id of an increment")
    if increment in merged_increments(spark, target):
        return []
    manifest = _manifest(spark, target)
    touched: list[int] = []

    def write(path: str) -> None:
        delta_path = f"{path}/_delta"
        new = payment_stats(payments).select(*[F.col(f.name).cast(f.dataType) for f in STATE.fields])
        new.select("*", _bucket(len(manifest))).write.parquet(delta_path)
        delta = spark.read.parquet(delta_path)
        touched.extend(sorted(r["bucket"] for r in delta.select("bucket").distinct().collect()))    # at most n_buckets
        if touched:
            old = _read(spark, [manifest[b] for b in touched if manifest[b]]).select("*", _bucket(len(manifest)))
            rows = old.unionByName(delta).repartition("bucket").groupBy("bucket", "loan_id")
            (rows.agg(*[f(c).alias(c) for c, f in MERGE.items()])
             .write.partitionBy("bucket").parquet(f"{path}/state"))
        now = manifest | {b: f"{path}/state/bucket={b}" for b in touched}
        spark.createDataFrame(sorted(now.items()), MANIFEST).coalesce(1).write.parquet(f"{path}/_manifest")

    publish(spark, target, write, note=increment)
    return touched


def read_state(spark: SparkSession, target: str) -> DataFrame:
    """The statistics per loan of the current version, as ``payment_stats`` of all payments gives them."""
    return _read(spark, [f for f in _manifest(spark, target).values() if f])


def view(spark: SparkSession, target: str, loans: DataFrame) -> DataFrame:
    """The delinquency view of ``loans`` from the state, without reading a payment."""
    return with_stats(loans, read_state(spark, target))
