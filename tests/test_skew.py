"""A key holding a third of all rows: results stay exact and the plans split it."""

import datetime as dt
import random

from pyspark.sql import functions as F

from arrears.operators import delinquency as dq
from arrears.operators import lifecycle as lc
from arrears.operators import portfolio as pf
from tests import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _loop(deltas):
    c, out = 0, []
    for x in deltas:
        c = max(0, c + x)
        out.append(c)
    return out


def test_hot_loan_running_balance(spark):
    rnd = random.Random(5)
    rows = []
    # loan 1 holds a third of all events, spread over many days
    for e in range(3000):
        rows.append((1, dt.date(2020, 1, 1) + dt.timedelta(days=e // 3), 0, e, rnd.randint(-20, 20)))
    for loan in range(2, 200):
        for e in range(30):
            rows.append((loan, dt.date(2020, 1, 1) + dt.timedelta(days=e), 0, loan * 1000 + e,
                         rnd.randint(-20, 20)))
    df = spark.createDataFrame(rows, "loan_id long, event_date date, kind int, event_id long, delta long")
    out = lc.clamped_balance(df)
    got = {r.event_id: r.balance for r in out.where("loan_id = 1").collect()}
    hot = sorted((r for r in rows if r[0] == 1), key=lambda r: (r[1], r[2], r[3]))
    assert got == {r[3]: c for r, c in zip(hot, _loop([r[4] for r in hot]))}
    plan = _plan(out)
    # rows are windowed per (loan, range), however many events a loan has
    windows = [w for w in plan.split("windowspecdefinition(")[1:]]
    assert windows and all(w.startswith("_no_loan#") for w in windows)
    assert sum("_range#" in w.split(" ASC")[0] for w in windows) >= 2


def test_hot_customer_and_hot_loan_aggregate_before_shuffle(spark):
    cust = fx.customers(spark, [(i, 50000, "Full-time", 300 + i) for i in range(1, 11)])
    lo = fx.loans(spark, [(i, 1 if i <= 500 else 1 + i % 10, 1000, 12, fx.d("2024-01-01"),
                           "defaulted" if i % 3 == 0 else "active") for i in range(1, 1501)])
    bands = {r.credit_score_band: (r.total_loans, r.defaulted_loans)
             for r in pf.default_rate_by_credit_band(lo, cust).collect()}
    assert bands == {"300-579 (Subprime)": (1500, 500)}
    plan = _plan(pf.default_rate_by_credit_band(lo, cust))
    assert "partial_count" in plan  # map-side combine before the customer shuffle

    pay = fx.payments(spark, [(p, 1, fx.d("2024-01-01") + dt.timedelta(days=p % 400), 100, p % 7)
                              for p in range(3000)])
    v = dq.loan_delinquency(lo.where(F.col("loan_id") <= 3), pay).where("loan_id = 1").first()
    assert v.total_payments_made == 3000
    assert "partial_max" in _plan(dq.loan_delinquency(lo, pay))


def test_row_number_within_matches_window(spark):
    from pyspark.sql import Window

    from arrears.operators.sequence import row_number_within
    rnd = random.Random(9)
    rows = [(1 if i < 900 else rnd.randint(2, 40),
             None if rnd.random() < 0.05 else dt.date(2021, 1, 1) + dt.timedelta(days=rnd.randint(0, 30)),
             rnd.randint(0, 5), i) for i in range(2700)]
    df = spark.createDataFrame(rows, "k long, d date, a int, i long")
    got = {r.i: r.rn for r in row_number_within(df, "k", "d", ["a", "i"], "rn").collect()}
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_first(), "a", "i")
    want = {r.i: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def test_stratified_split_equals_global_ordering(spark):
    """The bucketed split equals ranking each class by hash globally."""

    from pyspark.sql import Window

    from arrears.operators import features as ft
    rnd = random.Random(2)
    df = spark.createDataFrame([(i, int(rnd.random() < 0.3)) for i in range(5000)],
                               "loan_id long, is_default int")
    for fraction, per in ((0.2, 5), (0.5, 2), (0.01, 100)):
        split = ft.stratified_split(df, test_fraction=fraction)
        got = {r.loan_id: r.split for r in split.collect()}
        assert "Window" not in split._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
        assert len(got) == 5000  # complete, and each id once (disjoint)
        w = Window.partitionBy("is_default").orderBy(ft.split_hash("loan_id", 42), "loan_id")
        ref = df.withColumn("rn", F.row_number().over(w)).withColumn(
            "n", F.count("*").over(Window.partitionBy("is_default")))
        want = {r.loan_id: ("test" if r.rn <= -(-r.n // per) else "train")  # ceil(n / per)
                for r in ref.collect()}
        assert got == want


def test_split_keeps_rows_without_a_label(spark):
    from arrears.operators import features as ft
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(100)], "loan_id long, is_default int")
    got = ft.stratified_split(df).collect()
    assert len(got) == 100
    assert {(y, sum(r.split == "test" for r in got if r.is_default == y)) for y in (None, 0, 1)} == {(None, 4), (0, 8), (1, 8)}
    assert ft.stratified_split(df, test_fraction=0.0).where("split = 'test'").count() == 0
    assert ft.stratified_split(df.limit(0)).count() == 0


def test_unknown_status_is_no_default(spark):
    from arrears.operators import features as ft
    df = spark.createDataFrame([(1, None, 30.0), (2, "defaulted", 1.0)], "loan_id long, status string, loan_age_months double")
    assert {r.loan_id: r.is_default for r in ft.training_population(df).collect()} == {1: 0, 2: 1}


def _walk(events):
    """The balance by a plain loop over each loan's events; NULLs first."""
    state, out = {}, {}
    low = lambda x: (x is not None, x if x is not None else 0)
    for e in sorted(events, key=lambda e: (low(e[0]), (e[1] is not None, e[1] or dt.date.min), e[2], low(e[3]))):
        state[e[0]] = max(0, state.get(e[0], 0) + e[4])
        out[e[3]] = state[e[0]]
    return out


def test_clamped_balance_of_hot_day_and_missing_keys(spark):
    """A third of all events on one day of one loan; events without a loan or a date stay."""
    from arrears.operators import lifecycle as lc
    rnd = random.Random(12)
    day = lambda: dt.date(2021, 1, 1) + dt.timedelta(days=rnd.randint(0, 200))
    rows = [(1, dt.date(2021, 3, 1), rnd.randint(0, 1), i, rnd.randint(-40, 40)) for i in range(2000)]
    rows += [(1, day(), 0, 10_000 + i, rnd.randint(-40, 40)) for i in range(1000)]
    rows += [(rnd.choice([None, *range(2, 300)]), rnd.choice([None, day(), day(), day()]), rnd.randint(0, 1), 20_000 + i,
              rnd.randint(-40, 40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "loan_id long, event_date date, kind int, event_id long, delta long").repartition(6)
    for coalesce in ("true", "false"):     # few events fit into one range unless told otherwise
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        try:
            got = lc.clamped_balance(df).collect()
            ends = lc.end_of_day_balance(df).collect()
            hot = lc._placed(df).where("loan_id = 1 and event_date = date'2021-03-01'").select("_range").distinct().count()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert len(got) == len(rows)
        assert {r.event_id: r.balance for r in got} == _walk(rows)
        last = {}
        for e in sorted(rows, key=lambda e: (e[2], e[3])):
            last[e[0], e[1]] = e[3]
        walked = _walk(rows)
        assert {(r.loan_id, r.event_date): r.balance for r in ends} == {k: walked[i] for k, i in last.items()}
        assert len(ends) == len(last)
    assert hot > 1
    assert lc.clamped_balance(df.limit(0)).count() == 0


def test_level_two_is_small(spark):
    """Only loans cut by a range boundary take part in level 2."""
    from arrears.operators import lifecycle as lc
    df = spark.range(20_000).selectExpr("id % 1000 as loan_id", "date_add(date'2020-01-01', cast(id div 1000 as int)) as event_date",
                                        "0 as kind", "id as event_id", "cast(1 as bigint) as delta")
    placed = lc._placed(df)
    spans = placed.select("loan_id", "_range").distinct().groupBy("loan_id").count().where("count > 1").count()
    assert spans <= placed.select("_range").distinct().count()
    assert lc.clamped_balance(df).where("balance <> event_id div 1000 + 1").count() == 0
