"""Session construction and scratch-space helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are public Spark SQL configuration keys.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "arrears", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster use the cluster's own."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if master.startswith("local[") or master == "local":
        # Keep the session catalog's warehouse out of the working tree.
        conf.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="arrears-wh-"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Suggested settings for a large cluster, sized from the input volume.

    The initial shuffle partition count gives ~target-sized partitions for a
    shuffle as large as the input; AQE then coalesces small ones and splits
    skewed ones at run time. Pass these to the cluster's session builder (the
    shared ``spark.checkpoint.dir`` comes from the cluster itself).
    """
    initial = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.sources.bucketing.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``. A local master has one
    machine only, so there a folder of our own will do; on any other master an
    unset folder is an error, since executors do not share local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="arrears-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/arrears-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    It is computed once, the lineage is cut in files that every executor sees,
    and the size is known to the planner.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._arrears_scratch = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, once all that was made of them is written too."""
    for df in written:
        path, context = df._arrears_scratch, df.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, Spark deletes the shuffle files of each query as it ends, not when the driver next collects garbage.

    For scratch tables written one after the other, each from a DataFrame that is run once.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


__all__ = ["build_session", "cluster_conf", "ensure_checkpoint_dir", "scratch_path", "materialise", "discard",
           "shuffles_dropped", "SCALE_CONF"]
