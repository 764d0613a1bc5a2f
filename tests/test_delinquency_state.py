"""The delinquency state: increments against the full view, buckets, repeats, lost jobs."""

import pytest
from pyspark.sql import functions as F

from arrears.operators import delinquency as dq
from arrears.operators import delinquency_state as ds
from arrears.session import scratch_path
from arrears.sources import io as sio
from arrears.sources.adapters import book_from_testdata
from tests import fixtures as fx
from tests.conftest import SMALL
from tests.fixtures import d


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _files(spark, target):
    return ds._manifest(spark, target)


@pytest.fixture
def target(spark):
    path = scratch_path(spark, "t-state")
    ds.create(spark, path, 8)
    return path


def test_three_increments_equal_the_full_view(spark, target):
    book = book_from_testdata(spark, SMALL)
    day = F.dayofmonth("due_date") <= 10
    parts = [book.payments.where(day), book.payments.where(~day & (F.col("loan_id") % 5 == 0)),
             book.payments.where(~day & (F.col("loan_id") % 5 != 0))]
    for k, part in enumerate(parts):
        assert ds.merge(spark, target, part, f"p{k}")
    assert _rows(ds.view(spark, target, book.loans)) == _rows(dq.loan_delinquency(book.loans, book.payments))
    assert _rows(ds.read_state(spark, target)) == _rows(dq.payment_stats(book.payments))
    assert ds.merged_increments(spark, target) == ["p0", "p1", "p2"]


def test_only_touched_buckets_are_written(spark, target):
    pays = [(i, i, d("2024-01-01"), 1, i % 3) for i in range(200)]
    assert ds.merge(spark, target, fx.payments(spark, pays), "all") == list(range(8))
    before, old = _files(spark, target), ds.read_state(spark, target)
    old_rows = _rows(old)
    touched = ds.merge(spark, target, fx.payments(spark, [(900, 7, d("2024-02-01"), 1, 9), (901, 7, d("2023-02-01"), 1, -2)]), "one")
    after = _files(spark, target)
    assert len(touched) == 1 and [b for b in before if before[b] != after[b]] == touched
    assert _rows(old) == old_rows                        # a reader of the version before is undisturbed
    row = ds.read_state(spark, target).where("loan_id = 7").first()
    assert (row.n_pay, row.n_late, row.sum_late, row.max_late, dq_days(row, spark)) == (3, 2, 8, 9, 9)


def dq_days(row, spark):
    return spark.range(1).select(dq.days_late_of(F.lit(row.recent_key)).alias("x")).first().x


def test_an_increment_counts_once(spark, target):
    pays = fx.payments(spark, [(1, 1, d("2024-01-01"), 1, 4)])
    assert len(ds.merge(spark, target, pays, "a")) == 1
    assert ds.merge(spark, target, pays, "a") == []
    assert ds.read_state(spark, target).first().n_pay == 1
    assert sio.published_versions(spark, target).count() == 2


def test_a_lost_merge_leaves_the_state(spark, target):
    ds.merge(spark, target, fx.payments(spark, [(1, 1, d("2024-01-01"), 1, 4)]), "a")
    bad = fx.payments(spark, [(2, 1, d("2024-02-01"), 1, 4)]).withColumn("days_late", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        ds.merge(spark, target, bad, "b")
    assert ds.merged_increments(spark, target) == ["a"] and ds.read_state(spark, target).first().n_pay == 1
    ds.merge(spark, target, fx.payments(spark, [(2, 1, d("2024-02-01"), 1, 4)]), "b")
    assert ds.read_state(spark, target).first().n_pay == 2


def test_empty_states_and_increments(spark, target):
    loans = fx.loans(spark, [(1, 1, 100, 12, d("2024-01-01"), "active")])
    assert _rows(ds.view(spark, target, loans)) == _rows(dq.loan_delinquency(loans, fx.payments(spark, [])))
    assert ds.merge(spark, target, fx.payments(spark, []), "none") == []
    assert ds.merged_increments(spark, target) == ["none"]
    nulls = fx.payments(spark, [(1, 1, d("2024-01-01"), 1, 4)]).withColumn("days_late", F.lit(None).cast("int"))
    unknown = nulls.withColumn("loan_id", F.lit(None).cast("long"))
    for name, part in (("nulls", nulls), ("unknown", unknown), ("unknown again", unknown)):
        ds.merge(spark, target, part, name)
    assert _rows(ds.view(spark, target, loans)) == _rows(dq.loan_delinquency(loans, nulls))
    assert ds.read_state(spark, target).where("loan_id is null").first().n_pay == 2
    ds.create(spark, target, 3)                          # anew
    assert ds.merged_increments(spark, target) == [] and ds.read_state(spark, target).count() == 0


def test_a_hot_loan_is_one_row(spark, target):
    pays = spark.range(30_000).select(
        F.col("id").alias("payment_id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("long").alias("loan_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("due_date"),
        (F.col("id") % 40).cast("int").alias("days_late"))
    for k in range(2):
        ds.merge(spark, target, pays.where(F.col("payment_id") % 2 == k), str(k))
    assert _rows(ds.read_state(spark, target)) == _rows(dq.payment_stats(pays))
