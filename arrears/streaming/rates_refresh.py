"""Refreshable action success-rate table (R10) as a Structured Streaming job.

New collection-action files land in a folder; the job keeps counts per action
type as streaming state (a handful of keys whatever the volume) and, after every
micro-batch, publishes a version of the rate table for the recommendation job.
Run it continuously, or as a scheduled job with ``trigger(availableNow=True)``:
each run consumes only the files that arrived since the last one, tracked by the
checkpoint in the shared checkpoint folder.

A file may be delivered twice, and a row may come again in another file: an action
counts once, by its id, if it comes again within REDELIVERY of its first arrival.
The watermark runs on the time of arrival, not on the action's date, so a row with an old
date is never late and always counts; the ids seen are forgotten after REDELIVERY, which is the
bound of the state (use the RocksDB state store for large volumes of actions). The first
delivery of an id wins. A row without an id is a row of its own.

A version is a folder of its own; a row appended to ``_published`` makes it the
current one. So a reader never meets a half-written table, and a crash leaves the
version before in place. A replayed batch publishes the same rates once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import ratio, ratio_units
from ..sources.io import publish, published_path
from ..sources.schemas import COLLECTION_ACTIONS, SUCCESS_OUTCOMES


REDELIVERY = "30 days"


def once(actions: DataFrame, within: str = REDELIVERY) -> DataFrame:
    """A stream of actions without those that came before, within that time of arrival."""
    key = F.coalesce(F.col("action_id").cast("string"), F.uuid())
    seen = (actions.withColumns({"_arrived": F.current_timestamp(), "_key": key})
            .withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_key"]))
    return seen.drop("_arrived", "_key")


def rate_counts_stream(spark: SparkSession, landing_dir: str,
                       max_files_per_trigger: int | None = None, redelivery: str | None = REDELIVERY) -> DataFrame:
    reader = spark.readStream.schema(COLLECTION_ACTIONS.schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    actions = reader.load(landing_dir)
    if redelivery:
        actions = once(actions, redelivery)
    return (actions.groupBy("action_type")
            .agg(F.count(F.lit(1)).alias("total_actions"),
                 F.count_if(F.col("outcome").isin(*SUCCESS_OUTCOMES)).alias("successes")))


def _rate_table(counts: DataFrame) -> DataFrame:
    return counts.select(
        "action_type",
        F.col("total_actions").cast("bigint").alias("total_actions"),
        ratio(F.col("successes"), F.col("total_actions"), 3).alias("success_rate"),
        ratio_units(F.col("successes"), F.col("total_actions"), 3).alias("rate_permille"))


def start_refresh(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str,
                  available_now: bool = True, processing_time: str | None = None,
                  max_files_per_trigger: int | None = None, redelivery: str | None = REDELIVERY) -> StreamingQuery:
    """Start the refresh; with ``available_now`` it stops after the backlog.

    ``max_files_per_trigger`` bounds each micro-batch, so a large backlog is
    worked off in several batches instead of one. ``redelivery`` None counts every row
    that comes; it is part of the query, so a checkpoint is resumed with the same choice."""

    def publish_rates(batch: DataFrame, epoch_id: int) -> None:
        publish(spark, table_path, lambda path: _rate_table(batch).coalesce(1).write.parquet(path))

    w = (rate_counts_stream(spark, landing_dir, max_files_per_trigger, redelivery).writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint).foreachBatch(publish_rates))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_rates(spark: SparkSession, table_path: str) -> DataFrame:
    """The rates published last."""
    return spark.read.parquet(published_path(spark, table_path))
