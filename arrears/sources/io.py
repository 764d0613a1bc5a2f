"""Reading, writing and refreshing the four tables.

Parquet is the default format (column pruning and predicate pushdown reach
the scan). CSV is read with the declared schema, never inferred, and FAILFAST;
``load_csv`` sets bad lines aside instead, up to a stated share of all lines.
JDBC is offered for databases: reads are split on a numeric column into
parallel range queries; writes are batched.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from .adapters import Book
from .schemas import TABLES


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan one domain table with its declared schema; S6 column order."""
    spec = TABLES[name]
    reader = spark.read.schema(spec.schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return reader.format(fmt).load(path).select(*spec.columns)


def write_table(df: DataFrame, path: str, name: str, fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """S3: write one table (header for CSV), columns in declared order."""
    w = df.select(*TABLES[name].columns).write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """S3 for derived tables (features, training set): header, columns as they are."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


BAD_LINE = "_bad_line"


def load_csv(spark: SparkSession, path: str, schema, target: str, max_bad: float = 0.0) -> dict[str, int]:
    """Load CSV lines into a new version at ``target``; lines that do not fit ``schema`` go to quarantine.

    A line is bad when a value does not parse or its number of values is wrong. All lines
    are read and written once, good and bad apart, and counted on the way. More than
    ``max_bad`` of all lines bad: ``RefreshError``, and the version before stays current.
    Returns ``lines`` and ``bad``. An empty value is NULL, as in ``read_csv``; NOT NULL is for the checks of the load.
    """
    seen = Observation(f"csv-{uuid.uuid4().hex}")
    fields = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    lines = (spark.read.schema(fields).option("header", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", BAD_LINE).csv(path))
    bad = F.col(BAD_LINE).isNotNull()
    lines = (lines.select("*", F.col("_metadata.file_path").alias("_file"), bad.alias("_bad"))
             .observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("bad")))
    counts: dict[str, int] = {}

    def write(to: str) -> None:
        lines.write.partitionBy("_bad").parquet(to)
        counts.update(seen.get)

    def check(to: str) -> None:
        if counts["bad"] > max_bad * counts["lines"]:
            raise RefreshError(f"{counts['bad']} of {counts['lines']} lines of {path} are bad, not published: see {to}")

    publish(spark, target, write, check, lambda: json.dumps(counts))
    return counts


def _loaded(spark: SparkSession, target: str, schema) -> DataFrame:
    fields = StructType([*(StructField(f.name, f.dataType) for f in schema.fields), StructField(BAD_LINE, StringType()),
                         StructField("_file", StringType()), StructField("_bad", BooleanType())])
    return spark.read.schema(fields).parquet(published_path(spark, target))


def read_loaded(spark: SparkSession, target: str, schema) -> DataFrame:
    """The good rows of the latest ``load_csv`` at ``target``."""
    return _loaded(spark, target, schema).where("not _bad").select(*schema.names)


def read_quarantine(spark: SparkSession, target: str, schema) -> DataFrame:
    """The lines that the latest ``load_csv`` at ``target`` set aside: ``line``, as it was, and its ``file``."""
    return _loaded(spark, target, schema).where("_bad").select(F.col(BAD_LINE).alias("line"), F.col("_file").alias("file"))


def read_book(spark: SparkSession, base: str, fmt: str = "parquet") -> Book:
    b = base.rstrip("/")
    return Book(*(read_table(spark, f"{b}/{n}", n, fmt) for n in TABLES))


def write_book(book: Book, base: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    b = base.rstrip("/")
    for name, df in book.items():  # parent-first order
        write_table(df, f"{b}/{name}", name, fmt, mode)


def write_book_observed(book: Book, base: str) -> dict[str, dict[str, int]]:
    """``write_book`` that counts rows and NULLs while it writes.

    Per table: ``row_count`` and the NULL count of each column, of exactly the rows
    written; the copy is not read again for them.
    """
    b, counts = base.rstrip("/"), {}
    for name, df in book.items():
        seen = Observation(f"load-{name}-{uuid.uuid4().hex}")
        columns = TABLES[name].columns
        observed = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("row_count"), *[
            F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        write_table(observed, f"{b}/{name}", name)
        counts[name] = dict(seen.get)
    return counts


# Bucketing keys: every table keyed or joined by loan is bucketed by loan_id, so
# aggregates and joins on loan_id between them need no shuffle at all.
BUCKET_KEYS = {"customers": "customer_id", "loans": "loan_id",
               "payment_history": "loan_id", "collection_actions": "loan_id"}


def bucket_count(input_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Buckets of about ``target_bytes`` each; 8 at least, so that small data is spread too."""
    return max(8, -(-input_bytes // target_bytes))


def planned_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of ``df``, from its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def drop_tables(spark: SparkSession, names) -> None:
    """Forget external tables; their files stay, and so do DataFrames read from them."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bucketed_book(spark: SparkSession, book: Book, base: str, num_buckets: int,
                        prefix: str = "", names=tuple(TABLES)) -> dict[str, DataFrame]:
    """Publish the book as bucketed, sorted parquet tables at ``base``.

    Written once, every later per-loan aggregate and loan join reads the
    tables already hash-partitioned (and sorted) by loan_id: the delinquency
    view runs without an exchange. ``num_buckets`` (see ``bucket_count``) should
    give buckets of a few hundred MB; all loan-keyed tables must share it. The tables are
    external (their files live under ``base``, a shared folder). ``names`` picks
    tables. A bucket holds all rows of its loans: a loan with a very large share
    of the rows is better left in the plain layout, whose joins AQE can split.
    """
    b = base.rstrip("/")
    for name in names:
        df = book.table(name)
        key = BUCKET_KEYS[name]
        # Shuffle once into the bucket layout so each task writes one bucket
        # file; without it every task writes a file per bucket (tasks x buckets).
        (df.select(*TABLES[name].columns).repartition(num_buckets, key).write.mode("overwrite")
         .bucketBy(num_buckets, key).sortBy(key)
         .option("path", f"{b}/{name}")
         .saveAsTable(f"{prefix}{name}"))
    return {n: spark.table(f"{prefix}{n}") for n in names}


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, properties: dict | None = None) -> DataFrame:
    """S1 connector: a query result split into ``num_partitions`` range scans.

    The ``query`` option cannot be partitioned, so the query is wrapped as a
    derived table and split on ``partition_column``.
    """
    return spark.read.jdbc(url, f"({query}) q", column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions,
                           properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str, name: str, properties: dict | None = None,
               batchsize: int = 1000, truncate: bool = True) -> None:
    """S4/S5 connector: full refresh of a database table, batched inserts.

    ``truncate`` keeps the table definition (keys, defaults) on overwrite.
    """
    (df.select(*TABLES[name].columns).write.mode("overwrite")
     .option("truncate", truncate).option("batchsize", batchsize)
     .jdbc(url, table, properties=properties or {}))


def table_counts(book: Book) -> DataFrame:
    """Row count per table (four global counts in one union)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in book.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def register_views(spark: SparkSession, book: Book, prefix: str = "") -> None:
    """Name the tables for SQL (create or replace)."""
    for name, df in book.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


class RefreshError(RuntimeError):
    pass


def publish(spark: SparkSession, target: str, write, check=None, note=None) -> str:
    """Write a new version below ``target`` with write(path), and make it the current one.

    ``check(path)`` may raise before the version becomes visible. Publishing is
    one appended row, so readers see the old version or the new one, whole; ``note``,
    a string or a function that gives one after the write, becomes visible with it.
    """
    version = f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    path = f"{target.rstrip('/')}/versions/{version}"
    write(path)
    if check:
        check(path)
    (spark.createDataFrame([(version, path, note() if callable(note) else note)], "version string, path string, note string")
     .withColumn("published_at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(f"{target.rstrip('/')}/_published"))
    return path


def published_path(spark: SparkSession, target: str) -> str:
    """The folder of the latest version at ``target``."""
    latest = published_versions(spark, target).select("path").first()
    if latest is None:
        raise RefreshError(f"nothing published at {target}")
    return latest["path"]


def full_refresh(spark: SparkSession, book: Book, target: str) -> Book:
    """Idempotent full reload of the four tables, published atomically.

    Missing values get their column defaults first. Every table is written
    (parent first) to a new version, and rows and NULLs are counted on the way; the
    written copy's primary and foreign keys are checked; only then is the version
    published, with its row counts in the note. A failed
    check or a crash leaves the previous version current, and nothing is copied a
    second time. Running twice publishes two versions with the same content.
    """
    from ..operators import quality as q

    filled = Book(*(q.apply_defaults(name, df) for name, df in book.items()))

    counts: dict[str, dict[str, int]] = {}

    def check(path: str) -> None:
        tables = dict(read_book(spark, path).items())
        pks = q.pk_violations(tables).where("n_duplicate_keys > 0")
        fks = q.fk_violations(tables).where("orphan_rows > 0")
        problems = (pks.select(F.concat_ws(":", "table_name", F.lit("pk")).alias("p"))
                    .unionByName(fks.select(F.concat_ws(":", "child_table", "child_column",
                                                        F.lit("fk")).alias("p"))))
        nulls = [f"{t}:{c}:null" for t, n in counts.items() for c in TABLES[t].columns if n[c]]
        bad = sorted(nulls + [r["p"] for r in problems.collect()])  # at most one row per column, table and foreign key
        if bad:
            raise RefreshError(f"{path} failed checks, not published: {bad}")

    def write(path: str) -> None:
        counts.update(write_book_observed(filled, path))

    return read_book(spark, publish(spark, target, write, check, lambda: json.dumps({t: n["row_count"] for t, n in counts.items()})))


def read_published(spark: SparkSession, target: str) -> Book:
    """The latest published version of the book at ``target``."""
    return read_book(spark, published_path(spark, target))


def _rows_if_any(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


_RETIRED = StructType([StructField("path", StringType())])
_LEASES = StructType([StructField("path", StringType()), StructField("until", TimestampType())])


def published_versions(spark: SparkSession, target: str) -> DataFrame:
    """All published versions at ``target`` that are still there, newest first (version, path, note, published_at)."""
    gone = _rows_if_any(spark, f"{target.rstrip('/')}/_retired", _RETIRED)
    return (spark.read.parquet(f"{target.rstrip('/')}/_published").join(gone, "path", "left_anti")
            .select("version", "path", "note", "published_at")
            .orderBy(F.desc("published_at"), F.desc("version")))


def lease(spark: SparkSession, target: str, hours: float) -> str:
    """The folder of the latest version, kept by ``retire`` for ``hours`` however many versions follow."""
    path = published_path(spark, target)
    (spark.createDataFrame([(path,)], "path string")
     .withColumn("until", F.current_timestamp() + F.make_dt_interval(mins=F.lit(round(hours * 60))))
     .coalesce(1).write.mode("append").parquet(f"{target.rstrip('/')}/_leases"))
    return path


def retire(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete versions beyond the newest ``keep`` (one at least) that nobody holds a lease on.

    A version is marked as retired before its files go, so a job lost between the two
    leaves files that no reader finds; running again deletes them. Returns the folders deleted.
    """
    if keep < 1:
        raise ValueError("the current version stays: keep must be 1 or more")
    base = target.rstrip("/")
    held = _rows_if_any(spark, f"{base}/_leases", _LEASES).where(F.col("until") > F.current_timestamp())
    kept = published_versions(spark, target).limit(keep)
    old = published_versions(spark, target).select("path").join(kept, "path", "left_anti").join(held, "path", "left_anti")
    paths = [r["path"] for r in old.collect()]            # one row per version
    if paths:
        (spark.createDataFrame([(p,) for p in paths], _RETIRED).coalesce(1)
         .write.mode("append").parquet(f"{base}/_retired"))
    out = []
    for row in _rows_if_any(spark, f"{base}/_retired", _RETIRED).distinct().collect():
        place = spark._jvm.org.apache.hadoop.fs.Path(row["path"])
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True):
            out.append(row["path"])
    return sorted(out)
