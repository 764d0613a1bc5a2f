from decimal import Decimal

from pyspark.sql import functions as F

from arrears.functions.numeric import ratio
from arrears.operators import delinquency as dq
from arrears.operators import features as ft
from arrears.operators import portfolio as pf
from tests import fixtures as fx
from tests.fixtures import d


def _book(spark):
    cust = fx.customers(spark, [(1, 50000, "Full-time", 700), (2, 90000, "Unemployed", 579)])
    lo = fx.loans(spark, [
        (10, 1, 12000, 12, d("2024-01-01"), "active"),      # no payments
        (11, 1, 5000, 24, d("2023-01-01"), "defaulted"),    # latest payment rule
        (12, 2, 3000, 36, d("2023-06-01"), "paid_off"),     # same-date tie
    ])
    pay = fx.payments(spark, [
        (1101, 11, d("2024-01-01"), 100, 9),
        (1102, 11, d("2024-02-01"), 100, 3),
        (1201, 12, d("2024-03-01"), 100, 3),
        (1202, 12, d("2024-03-01"), 100, 7),
        (1203, 12, d("2024-01-01"), 0, 30),
    ])
    return cust, lo, pay


def test_delinquency_edge_rows(spark):
    cust, lo, pay = _book(spark)
    rows = {r.loan_id: r for r in dq.loan_delinquency(lo, pay).collect()}
    none = rows[10]
    assert (none.total_payments_made, none.late_payment_count, none.pct_payments_late) == (0, 0, 0.0)
    assert none.avg_days_late is None and none.max_days_late_ever is None
    assert none.most_recent_days_late is None
    r = rows[11]
    assert (r.most_recent_days_late, r.max_days_late_ever, r.avg_days_late, r.pct_payments_late) == \
        (3, 9, 6.0, 1.0)
    assert rows[12].most_recent_days_late == 7  # tie on the latest date: larger days_late


def test_features_fill_only_view_nulls(spark):
    cust, lo, pay = _book(spark)
    f = {r.loan_id: r for r in ft.loan_features(dq.loan_delinquency(lo, pay), cust,
                                                fx.AS_OF).collect()}
    r = f[10]
    assert (r.late_payment_count, r.pct_payments_late, r.avg_days_late,
            r.max_days_late_ever, r.most_recent_days_late) == (0, 0.0, 0.0, 0, 0)
    assert r.total_payments_made == 0


def test_half_up_ratio(spark):
    df = spark.createDataFrame([(201, 400), (1, 8), (5, 16), (0, 3), (2, 3)], "k long, n long")
    got = [r[0] for r in df.select(ratio(F.col("k"), F.col("n"), 3)).collect()]
    assert got == [0.503, 0.125, 0.313, 0.0, 0.667]


def test_credit_band_edges(spark):
    cust = fx.customers(spark, [(i, 50000, "Full-time", s) for i, s in
                                enumerate([579, 580, 669, 670, 739, 740])])
    lo = fx.loans(spark, [(i, i, 1000, 12, d("2024-01-01"), "defaulted" if i % 2 else "active")
                          for i in range(6)])
    out = [(r.credit_score_band, r.total_loans) for r in
           pf.default_rate_by_credit_band(lo, cust).collect()]
    assert out == [("300-579 (Subprime)", 1), ("580-669 (Fair)", 2), ("670-739 (Good)", 2),
                   ("740-850 (Prime)", 1)]


def test_success_rates_and_summary(spark):
    acts = fx.actions(spark, [
        (1, 1, d("2024-01-01"), "phone_call", "paid_in_full"),
        (2, 1, d("2024-01-02"), "phone_call", "no_response"),
        (3, 1, d("2024-01-03"), "phone_call", "partial_payment"),
        (4, 1, d("2024-01-04"), "legal_notice", "promised_to_pay"),
    ])
    rates = [(r.action_type, r.total_actions, r.success_rate) for r in
             pf.action_success_rates(acts).collect()]
    assert rates == [("phone_call", 3, 0.667), ("legal_notice", 1, 0.0)]
    cust, lo, pay = _book(spark)
    s = pf.portfolio_summary(cust, lo, pay, acts).first()
    assert (s.n_customers, s.n_loans, s.n_payments, s.n_actions, s.n_defaulted) == (2, 3, 5, 4, 1)
    assert s.default_rate == 0.333


def test_population_maturity(spark):
    import datetime as dt
    cust = fx.customers(spark, [(1, 50000, "Full-time", 700)])
    asof = fx.AS_OF
    lo = fx.loans(spark, [
        (1, 1, 1000, 36, asof - dt.timedelta(days=538), "active"),
        (2, 1, 1000, 36, asof - dt.timedelta(days=539), "active"),
        (3, 1, 1000, 36, asof - dt.timedelta(days=540), "active"),
        (4, 1, 1000, 36, asof - dt.timedelta(days=30), "defaulted"),
    ])
    pay = fx.payments(spark, [])
    f = ft.loan_features(dq.loan_delinquency(lo, pay), cust, asof)
    ages = {r.loan_id: r.loan_age_months for r in f.collect()}
    assert ages[1] == 17.9 and ages[2] == 18.0 and ages[3] == 18.0
    tr = {r.loan_id: r.is_default for r in ft.training_population(f).collect()}
    assert tr == {2: 0, 3: 0, 4: 1}
    assert [r.loan_id for r in ft.excluded_population(f).collect()] == [1]
    s = ft.population_summary(f).first()
    assert (s.n_all, s.n_training, s.n_defaulted, s.n_excluded) == (4, 3, 1, 1)


def test_latest_payment(spark):
    _, _, pay = _book(spark)
    got = {r.loan_id: (r.latest_due_date, r.most_recent_days_late)
           for r in dq.latest_payment(pay).collect()}
    assert got == {11: (d("2024-02-01"), 3), 12: (d("2024-03-01"), 7)}


def test_decimal_types_kept(spark):
    cust, lo, pay = _book(spark)
    v = dq.loan_delinquency(lo, pay)
    assert v.schema["principal"].dataType.simpleString() == "decimal(12,2)"
    assert {r.principal for r in v.collect()} == {Decimal("12000.00"), Decimal("5000.00"),
                                                  Decimal("3000.00")}
