"""Exact rounding helpers, including negative values and zero denominators."""

from decimal import Decimal

from pyspark.sql import functions as F

from arrears.functions.numeric import from_cents, ratio, ratio_units, round_half_up_div
from arrears.operators import delinquency as dq
from arrears.operators import lifecycle as lc
from tests import fixtures as fx
from tests.fixtures import d


def test_half_away_from_zero_both_signs(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (5, -2), (-1, 8), (7, 0), (0, 5)], "n long, m long")
    got = [tuple(r) for r in df.select(round_half_up_div(F.col("n"), F.col("m")),
                                       ratio_units(F.col("n"), F.col("m"), 2),
                                       ratio(F.col("n"), F.col("m"), 2)).collect()]
    assert got == [(3, 250, 2.5), (-3, -250, -2.5), (-3, -250, -2.5), (0, -13, -0.13),
                   (None, None, None), (0, 0, 0.0)]


def test_cents_round_trip(spark):
    df = spark.createDataFrame([(123456,), (-5,), (0,)], "c long")
    assert [r[0] for r in df.select(from_cents(F.col("c"))).collect()] == \
        [Decimal("1234.56"), Decimal("-0.05"), Decimal("0.00")]


def test_recency_key_negative_and_old_dates(spark):
    pay = fx.payments(spark, [(1, 1, d("1960-05-01"), 100, -3), (2, 1, d("1960-05-01"), 100, -7),
                              (3, 2, d("2100-01-01"), 100, 2147483647)])
    got = {r.loan_id: (r.latest_due_date, r.most_recent_days_late)
           for r in dq.latest_payment(pay).collect()}
    assert got == {1: (d("1960-05-01"), -3), 2: (d("2100-01-01"), 2147483647)}


def test_zero_term_instalment_is_null(spark):
    lo = fx.loans(spark, [(1, 1, 1200, 0, d("2020-01-01"), "active")])
    assert lc.instalment_amount(lo).first().monthly_payment is None
    assert lc.payment_schedule(lo, fx.AS_OF).count() == 0


def test_cluster_conf_sizes_partitions():
    from arrears.session import cluster_conf
    c = cluster_conf(100 * 2**40)  # 100 TiB of input
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(1)["spark.sql.shuffle.partitions"]) == 200


def test_constant_divisor_path_matches_column_path(spark):
    vals = [(x,) for x in range(-2600, 2601, 7)] + [(-1500,), (1500,), (-500,), (500,), (0,)]
    df = spark.createDataFrame(vals, "n long")
    for d in (1000, 3, -1000, 7):
        got = df.select(round_half_up_div(F.col("n"), d).alias("a"),
                        round_half_up_div(F.col("n"), F.lit(d).cast("bigint")).alias("b")).collect()
        assert all(r.a == r.b for r in got), d
    assert df.select(round_half_up_div(F.col("n"), 0)).distinct().collect()[0][0] is None
