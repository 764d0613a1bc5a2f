"""Repeated, late and id-less rows in the rate stream."""

import random

from pyspark.sql import functions as F

from arrears.operators import portfolio
from arrears.session import scratch_path
from arrears.streaming import rates_refresh as rr
from tests import fixtures as fx
from tests.fixtures import d

TYPES, OUTCOMES = ["phone_call", "legal_notice", "payment_plan"], ["paid_in_full", "no_response", "partial_payment"]


def _rows(ids, year):
    rng = random.Random(year)
    return [(i, i % 7, d(f"{year}-0{1 + i % 9}-11"), rng.choice(TYPES), rng.choice(OUTCOMES)) for i in ids]


def _paths(spark):
    return [scratch_path(spark, f"t-again-{k}") for k in ("land", "rates", "ckpt")]


def _rates(df):
    return sorted((r.action_type, r.total_actions, r.success_rate) for r in df.collect())


def _land(spark, landing, rows):
    fx.actions(spark, rows).coalesce(1).write.mode("append").parquet(landing)


def test_repeated_and_late_rows_give_the_batch_rates(spark):
    landing, table, ckpt = _paths(spark)
    recent, old = _rows(range(60), 2025), _rows(range(100, 140), 1999)
    _land(spark, landing, recent)
    _land(spark, landing, recent)                       # the file again
    _land(spark, landing, recent[:10] + recent[:10])    # rows twice in one file
    rr.start_refresh(spark, landing, table, ckpt, max_files_per_trigger=1).awaitTermination()
    whole = fx.actions(spark, recent)
    assert _rates(rr.read_rates(spark, table)) == _rates(portfolio.action_success_rates(whole))
    _land(spark, landing, old + recent)                 # dates long past, and all once more, in a later run
    _land(spark, landing, old)
    rr.start_refresh(spark, landing, table, ckpt).awaitTermination()
    whole = fx.actions(spark, recent + old)
    assert _rates(rr.read_rates(spark, table)) == _rates(portfolio.action_success_rates(whole))


def test_the_first_delivery_of_an_id_wins(spark):
    landing, table, ckpt = _paths(spark)
    _land(spark, landing, [(1, 1, d("2024-01-01"), "phone_call", "paid_in_full")])
    rr.start_refresh(spark, landing, table, ckpt).awaitTermination()
    _land(spark, landing, [(1, 1, d("2024-01-01"), "phone_call", "no_response")])
    rr.start_refresh(spark, landing, table, ckpt).awaitTermination()
    assert [(r.total_actions, r.success_rate) for r in rr.read_rates(spark, table).collect()] == [(1, 1.0)]


def test_rows_without_an_id_each_count(spark):
    landing, table, ckpt = _paths(spark)
    rows = fx.actions(spark, _rows([1, 2, 3], 2024)).withColumn("action_id", F.lit(None).cast("long"))
    rows.coalesce(1).write.parquet(landing)
    rr.start_refresh(spark, landing, table, ckpt).awaitTermination()
    assert sum(r.total_actions for r in rr.read_rates(spark, table).collect()) == 3


def test_every_row_counts_where_asked(spark):
    landing, table, ckpt = _paths(spark)
    _land(spark, landing, _rows([1, 1, 2], 2024))
    rr.start_refresh(spark, landing, table, ckpt, redelivery=None).awaitTermination()
    assert sum(r.total_actions for r in rr.read_rates(spark, table).collect()) == 3
