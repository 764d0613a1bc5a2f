import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from arrears.operators import evaluate as ev
from arrears.operators import lifecycle as lc
from arrears.operators import recommend as rc
from tests import fixtures as fx
from tests.fixtures import d


def _scored(spark, rows):
    """rows: (loan_id, p, principal, term, age)."""
    return spark.createDataFrame(
        [(i, float(p), Decimal(str(pr)), t, float(a)) for i, p, pr, t, a in rows],
        "loan_id long, probability_of_default double, principal decimal(12,2), "
        "term_months int, loan_age_months double")


def test_risk_tiers(spark):
    df = _scored(spark, [(1, 0.1999, 1, 12, 0), (2, 0.20, 1, 12, 0), (3, 0.4999, 1, 12, 0),
                         (4, 0.50, 1, 12, 0)])
    got = [r.risk_tier for r in rc.risk_tiers(df).orderBy("loan_id").collect()]
    assert got == ["Low", "Medium", "Medium", "High"]


def test_balance(spark):
    df = _scored(spark, [(1, 0.5, 12000, 12, 3.0), (2, 0.5, 12000, 12, 12.0),
                         (3, 0.5, 12000, 12, 15.0), (4, 0.5, 12000, 0, 1.0)])
    got = [r.estimated_outstanding_balance for r in
           rc.outstanding_balance(df).orderBy("loan_id").collect()]
    assert got == [Decimal("9000.00"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00")]


@pytest.mark.parametrize("principal,action,ev_value", [
    (223.33, "reminder_email", "37.53"),   # VaR 134.00: tie with phone, insertion order wins
    (225.00, "phone_call", "37.92"),       # VaR 135.00
    (1095.00, "phone_call", "242.54"),     # VaR 657.00
    (1098.33, "payment_plan", "243.37"),   # VaR 659.00
])
def test_cut_points(spark, principal, action, ev_value):
    df = _scored(spark, [(1, 1.0, principal, 12, 0.0)])
    r = rc.best_action_flat(rc.recommend_actions(df)).first()
    assert (r.recommended_action, r.recommended_expected_value) == (action, Decimal(ev_value))


def test_zero_value_at_risk_still_recommends(spark):
    df = _scored(spark, [(1, 0.0, 5000, 12, 1.0)])
    rec = rc.recommend_actions(df).first()
    assert rec.estimated_value_at_risk == Decimal("0.00")
    assert rec.recommended_action.action_type == "reminder_email"
    assert rec.recommended_action.expected_value == Decimal("-2.00")
    assert [o.action_type for o in rec.all_options] == \
        ["reminder_email", "phone_call", "payment_plan", "legal_notice"]
    assert rec.assumptions_note == rc.ASSUMPTIONS_NOTE


def test_legal_notice_never_best(spark):
    rows = [(i, random.Random(i).random(), random.Random(-i).randint(100, 90000), 12, 0.0)
            for i in range(300)]
    best = rc.best_action_flat(rc.recommend_actions(_scored(spark, rows)))
    assert best.where(F.col("recommended_action") == "legal_notice").count() == 0


@pytest.mark.parametrize("p,balance,var,action,value", [
    (0.02436, 45000, "657.72", "phone_call", "242.83"),   # 658.80 and payment_plan if p were cut to 0.0244
    (0.00003, 45000, "0.81", "reminder_email", "-1.76"),  # 0.00 if p were cut to 0.0000
])
def test_probability_is_not_rounded_before_use(spark, p, balance, var, action, value):
    r = rc.best_actions(_scored(spark, [(1, p, balance, 12, 0.0)])).first()
    assert r.estimated_value_at_risk == Decimal(var)
    assert (r.recommended_action, r.recommended_expected_value) == (action, Decimal(value))
    assert r.probability_of_default == round(p, 4)


def test_rates_of_unknown_types_are_refused(spark):
    for rows in ([("phone_call", 900), ("unknown", 1)], [("phone_call", 900), ("phone_call", 1)] * 3, [(None, 5)]):
        with pytest.raises(ValueError):
            rc.refreshed_actions(spark.createDataFrame(rows, "action_type string, rate_permille long"))


def test_flat_records(spark):
    rec = rc.recommend_actions(_scored(spark, [(1, 0.4, 9000, 12, 1.0), (2, 0.0, 10, 12, 0.0)]))
    flat = rc.flat_records(rec).collect()
    assert len(flat) == 8
    for r in rec.collect():
        mine = sorted((f.option_rank, f.action_type, f.expected_value) for f in flat if f.loan_id == r.loan_id)
        assert mine == [(i, o.action_type, o.expected_value) for i, o in enumerate(r.all_options, 1)]
        assert {f.recommended_action for f in flat if f.loan_id == r.loan_id} == {r.recommended_action.action_type}


def test_refreshed_rates_fallback(spark):
    rates = spark.createDataFrame([("phone_call", 900)], "action_type string, rate_permille long")
    specs = {a.action_type: a.rate_permille for a in rc.refreshed_actions(rates)}
    assert specs == {"reminder_email": 295, "phone_call": 900, "payment_plan": 430,
                     "legal_notice": 239}


def test_schedule_rows(spark):
    asof = fx.AS_OF
    lo = fx.loans(spark, [(1, 1, 1200, 12, asof - dt.timedelta(days=29), "active"),
                          (2, 1, 1200, 12, asof - dt.timedelta(days=30), "active"),
                          (3, 1, 1200, 12, asof - dt.timedelta(days=95), "active")])
    n = {r.loan_id: r.c for r in lc.payment_schedule(lo, asof).groupBy("loan_id")
         .agg(F.count("*").alias("c")).collect()}
    assert n == {2: 1, 3: 3}
    amt = lc.instalment_amount(lo).first().monthly_payment
    assert amt == Decimal("110.00")  # 1200 * 1.1 / 12


def _loop_balance(deltas):
    c, out = 0, []
    for x in deltas:
        c = max(0, c + x)
        out.append(c)
    return out


def test_running_balance_fixture(spark):
    pay = fx.payments(spark, [
        (1, 1, d("2024-01-01"), 0, 30), (2, 1, d("2024-02-01"), 100, 0),
        (3, 1, d("2024-03-01"), 100, 0), (4, 1, d("2024-04-01"), 100, 0),
        (5, 1, d("2024-05-01"), 100, 0), (6, 1, d("2024-06-01"), 0, 30)])
    got = [r.delinquency_balance for r in
           lc.running_delinquency(pay).orderBy("payment_id").collect()]
    assert got == [30, 20, 10, 0, 0, 30]


def test_clamped_balance_matches_loop(spark):
    rnd = random.Random(7)
    rows, expect = [], {}
    for loan in range(1, 9):
        events = []
        for e in range(rnd.randint(1, 40)):
            day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 15))  # many same-day ties
            events.append((loan, day, rnd.randint(0, 1), loan * 1000 + e, rnd.randint(-50, 40)))
        events.sort(key=lambda t: (t[1], t[2], t[3]))
        for ev_, c in zip(events, _loop_balance([x[4] for x in events])):
            expect[ev_[3]] = c
        rows += events
    df = spark.createDataFrame(rows, "loan_id long, event_date date, kind int, event_id long, "
                                     "delta long")
    got = {r.event_id: r.balance for r in lc.clamped_balance(df).collect()}
    assert got == expect
    eod = {(r.loan_id, r.event_date): r.balance for r in lc.end_of_day_balance(df).collect()}
    last = {}
    for loan, day, _, eid, _ in rows:
        last[(loan, day)] = expect[eid]  # rows are sorted per loan, so the last one wins
    assert eod == last


def test_escalation_and_status(spark):
    pay = fx.payments(spark, [
        (1, 1, d("2024-01-01"), 100, 25),   # 20 -> reminder
        (2, 1, d("2024-02-01"), 100, 20),   # 35 -> phone
        (3, 1, d("2024-03-01"), 100, 0),    # 25
        (4, 1, d("2024-04-01"), 100, 0),    # 15
        (5, 1, d("2024-05-01"), 0, 30),     # 45
        (6, 1, d("2024-06-01"), 100, 25),   # 65 -> plan
    ])
    got = {(r.action_type, r.escalation_date) for r in lc.escalation_points(pay).collect()}
    assert got == {("reminder_email", d("2024-01-01")), ("phone_call", d("2024-02-01")),
                   ("payment_plan", d("2024-06-01"))}

    lo = fx.loans(spark, [(1, 1, 1000, 120, d("2020-01-01"), "active"),
                          (2, 1, 1000, 12, d("2020-01-01"), "active"),
                          (3, 1, 1000, 60, d("2024-01-01"), "active")])
    # loan 1 peaks at 109 (not defaulted); loan 2 reaches 110 before an action lowers it.
    p2 = fx.payments(spark, [(11, 1, d("2024-01-01"), 100, 114), (21, 2, d("2024-01-01"), 100, 115)])
    a2 = fx.actions(spark, [(1, 2, d("2024-01-02"), "phone_call", "paid_in_full")])
    st = {r.loan_id: r.derived_status for r in
          lc.derived_status(lo, p2, a2, fx.AS_OF).collect()}
    assert st == {1: "active", 2: "defaulted", 3: "active"}
    a3 = fx.actions(spark, [(1, 2, d("2024-01-01"), "phone_call", "paid_in_full")])
    st = {r.loan_id: r.derived_status for r in
          lc.derived_status(lo, p2, a3, fx.AS_OF).collect()}
    assert st[2] == "paid_off"  # same-day action lands before the end-of-day check


def test_metrics_no_positive_prediction(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "is_default int, prediction int")
    m = ev.binary_metrics(df).first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)
    cm = {r.actual: (r.pred_0, r.pred_1) for r in ev.confusion_matrix(df).collect()}
    assert cm == {0: (1, 0), 1: (2, 0)}


def test_auc_small(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "is_default int, score double")
    assert ev.roc_auc(df).first().auc == 0.75
    ties = spark.createDataFrame([(0, 0.5), (1, 0.5)], "is_default int, score double")
    assert ev.roc_auc(ties).first().auc == 0.5


def test_auc_matches_bruteforce(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 3)) for _ in range(400)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "is_default int, score double")
    assert abs(ev.roc_auc(df).first().auc - brute) < 1e-12
    packed = df.withColumn("score", F.col("score") * 1e-9 + 0.25)  # all scores in a tiny interval
    assert abs(ev.roc_auc(packed).first().auc - brute) < 1e-12
    shifted = df.withColumn("score", F.col("score") * 3 - 1)  # scores outside [0, 1]
    assert abs(ev.roc_auc(shifted).first().auc - brute) < 1e-12


def test_auc_beyond_long_products(spark):
    """Five billion rows in each class: 2 P N is beyond 64 bits."""
    n = 5_000_000_000
    ranked = spark.createDataFrame([(0.1, 0, n, 0, 0), (0.2, n, 0, 0, n)], "_s double, _pos long, _neg long, _off long, _in long")
    assert ev._auc(ranked).first().auc == 1.0


def test_auc_refuses_missing_scores(spark):
    for bad in (None, float("nan")):
        df = spark.createDataFrame([(0, 0.1), (1, bad)], "is_default int, score double")
        with pytest.raises(Exception, match="NULL or NaN"):
            ev.roc_auc(df).collect()
