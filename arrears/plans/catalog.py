"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each Spark callable takes (spark, sf_dir), builds the four domain tables from
the driver's test tables, runs the library operator over the whole tables and
returns a DataFrame. The oracle SQL states the same result independently.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import functools
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import delinquency as dq
from ..operators import delinquency_state as ds
from ..operators import evaluate as ev
from ..operators import features as ft
from ..operators import forest as fo
from ..operators import lifecycle as lc
from ..operators import model as ml
from ..operators import portfolio as pf
from ..operators import quality as qa
from ..operators import recommend as rc
from ..operators.sequence import row_number_in_ranges
from ..session import materialise, scratch_path, shuffles_dropped
from ..sources import io as sio
from ..sources.adapters import Book, book_from_testdata
from ..sources.schemas import FOREIGN_KEYS, TABLES
from ..streaming import rates_refresh as rr
from . import oracle as O

# Reporting date of all test queries (the test data ends in 2001).
AS_OF = _dt.date(2001, 12, 31)
AS_OF_SQL = "DATE '2001-12-31'"


def _book(spark: SparkSession, sf_dir: str):
    """The test tables mapped to the four domain tables."""
    return book_from_testdata(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- portfolio

@register("action_success_rates", O.with_book(f"""
SELECT action_type, CAST(COUNT(*) AS BIGINT) AS total_actions,
  {O.half_up("COUNT(*) FILTER (WHERE outcome IN ('paid_in_full', 'partial_payment'))", "COUNT(*)", 3)} AS success_rate
FROM collection_actions GROUP BY action_type ORDER BY success_rate DESC, action_type
""", "collection_actions"))
def q_action_success_rates(spark, sf_dir):
    return pf.action_success_rates(_book(spark, sf_dir).actions)


@register("default_rate_by_credit_band", O.with_book(f"""
SELECT band AS credit_score_band, n AS total_loans, bad AS defaulted_loans, {O.half_up("bad", "n", 3)} AS default_rate
FROM (SELECT low, band, CAST(sum(per_customer.n) AS BIGINT) AS n, CAST(sum(per_customer.bad) AS BIGINT) AS bad
      FROM bands, customers,
           (SELECT customer_id AS borrower, COUNT(*) AS n, COUNT(*) FILTER (WHERE status = 'defaulted') AS bad
            FROM loans GROUP BY customer_id) per_customer
      WHERE borrower = customer_id AND credit_score >= low AND credit_score < high
      GROUP BY low, band) t
ORDER BY low
""", "customers", "loans", extra="""bands(low, high, band) AS (VALUES
  (-2147483648, 580, '300-579 (Subprime)'), (580, 670, '580-669 (Fair)'),
  (670, 740, '670-739 (Good)'), (740, 2147483647, '740-850 (Prime)'))"""))
def q_default_rate_by_credit_band(spark, sf_dir):
    b = _book(spark, sf_dir)
    return pf.default_rate_by_credit_band(b.loans, b.customers)


@register("status_mix", O.with_book("""
SELECT status, CAST(COUNT(*) AS BIGINT) AS loan_count FROM loans
GROUP BY status ORDER BY loan_count DESC, status
""", "loans"))
def q_status_mix(spark, sf_dir):
    return pf.status_mix(_book(spark, sf_dir).loans)


@register("success_flag_mean", O.with_book(f"""
SELECT action_type,
  {O.half_up("SUM(CASE WHEN outcome IN ('paid_in_full', 'partial_payment') THEN 1 ELSE 0 END)", "COUNT(*)", 3)} AS success_mean
FROM collection_actions GROUP BY action_type
""", "collection_actions"))
def q_success_flag_mean(spark, sf_dir):
    return pf.success_flag_mean(_book(spark, sf_dir).actions)


@register("portfolio_summary", O.with_book(f"""
SELECT CAST((SELECT COUNT(*) FROM customers) AS BIGINT) AS n_customers,
  CAST((SELECT COUNT(*) FROM loans) AS BIGINT) AS n_loans,
  CAST((SELECT COUNT(*) FROM payment_history) AS BIGINT) AS n_payments,
  CAST((SELECT COUNT(*) FROM collection_actions) AS BIGINT) AS n_actions,
  CAST((SELECT COUNT(*) FROM loans WHERE status = 'defaulted') AS BIGINT) AS n_defaulted,
  {O.half_up("(SELECT COUNT(*) FROM loans WHERE status = 'defaulted')", "(SELECT COUNT(*) FROM loans)", 3)} AS default_rate
""", "customers", "loans", "payment_history", "collection_actions"))
def q_portfolio_summary(spark, sf_dir):
    b = _book(spark, sf_dir)
    return pf.portfolio_summary(b.customers, b.loans, b.payments, b.actions)


# ---------------------------------------------------------------- delinquency

# From the definition: payments summed per loan, the latest one by arg_max, then put beside the loans.
DELINQUENCY_SQL_BODY = f"""
SELECT loan_id, customer_id, status, principal, interest_rate, term_months, origination_date,
  CAST(coalesce(n, 0) AS BIGINT) AS total_payments_made,
  CAST(coalesce(late, 0) AS BIGINT) AS late_payment_count,
  {O.half_up("coalesce(late, 0)", "greatest(coalesce(n, 0), 1)", 3)} AS pct_payments_late,
  CASE WHEN timed > 0 THEN {O.half_up("days", "timed", 1)} END AS avg_days_late,
  worst AS max_days_late_ever, latest AS most_recent_days_late
FROM loans LEFT JOIN (
  SELECT loan_id, count(payment_id) AS n, count(payment_id) FILTER (days_late > 0) AS late,
    sum(days_late) AS days, count(days_late) AS timed, max(days_late) AS worst,
    arg_max(days_late, (due_date, days_late)) AS latest
  FROM payment_history GROUP BY loan_id) paid USING (loan_id)
"""


@register("loan_delinquency", O.with_book(DELINQUENCY_SQL_BODY, "loans", "payment_history"))
def q_loan_delinquency(spark, sf_dir):
    b = _book(spark, sf_dir)
    return dq.loan_delinquency(b.loans, b.payments)


@register("latest_payment", O.with_book("""
SELECT loan_id, due_date AS latest_due_date, days_late AS most_recent_days_late FROM (
  SELECT loan_id, due_date, days_late,
    row_number() OVER (PARTITION BY loan_id ORDER BY due_date DESC, days_late DESC) AS rn
  FROM payment_history) t
WHERE rn = 1
""", "payment_history"))
def q_latest_payment(spark, sf_dir):
    return dq.latest_payment(_book(spark, sf_dir).payments)


# ---------------------------------------------------------------- features


# A stand-in for a model's probability, for queries that SQL has to check: any double in [0, 1)
# that spreads well will do. It has full precision, no rounding.
TEST_SCORE_SQL = "CAST((credit_score * 37 + age * 11 + customer_id % 997) % 1009 AS DOUBLE) / 1009.0::DOUBLE"


def _test_score():
    return ((F.col("credit_score") * 37 + F.col("age") * 11 + F.col("customer_id") % 997) % 1009).cast("double") / F.lit(1009.0)


FEATURES_CTES = f"""v AS ({DELINQUENCY_SQL_BODY}),
features AS (
  SELECT v.loan_id, v.customer_id, v.status, v.principal, v.interest_rate, v.term_months, v.origination_date,
    v.total_payments_made,
    COALESCE(v.late_payment_count, 0) AS late_payment_count,
    COALESCE(v.pct_payments_late, 0) AS pct_payments_late,
    COALESCE(v.avg_days_late, 0) AS avg_days_late,
    COALESCE(v.max_days_late_ever, 0) AS max_days_late_ever,
    COALESCE(v.most_recent_days_late, 0) AS most_recent_days_late,
    c.income, c.employment_status, c.age, c.credit_score,
    round(CAST({AS_OF_SQL} - v.origination_date AS DOUBLE) / 30.0, 1) AS loan_age_months
  FROM v JOIN customers c ON v.customer_id = c.customer_id),
training AS (
  SELECT *, CAST(status = 'defaulted' AS INTEGER) AS is_default FROM features
  WHERE status IN ('defaulted', 'paid_off') OR loan_age_months >= 18),
split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY is_default
      ORDER BY md5('42:' || CAST(loan_id AS VARCHAR)), loan_id)
    <= ceil(0.2 * count(*) OVER (PARTITION BY is_default)) THEN 'test' ELSE 'train' END AS split
  FROM training),
scored AS (
  SELECT *, {TEST_SCORE_SQL} AS probability_of_default FROM features)"""

def _features(spark, sf_dir):
    b = _book(spark, sf_dir)
    return ft.loan_features(dq.loan_delinquency(b.loans, b.payments), b.customers, AS_OF)


def _split(spark, sf_dir, features=None):
    """Split of the training population.

    The cut of each class is found from ids, statuses and dates alone: the
    optimizer drops the payment join from those branches.
    """
    f = features if features is not None else _features(spark, sf_dir)
    return ft.stratified_split(ft.training_population(f))


def _with_score(f):
    return f.withColumn("probability_of_default", _test_score())


def _scored(spark, sf_dir):
    """Loans with the test score as P(default).

    The recommendation needs principal, term, age and p only, so it starts
    from loans and borrowers; payment statistics are never planned.
    """
    b = _book(spark, sf_dir)
    return _with_score(ft.scoring_base(b.loans, b.customers, AS_OF))


def _feature_sql(body: str) -> str:
    return O.with_book(body, "customers", "loans", "payment_history", extra=FEATURES_CTES)


@register("loan_features", _feature_sql("SELECT * FROM features"))
def q_loan_features(spark, sf_dir):
    return _features(spark, sf_dir)


@register("training_population", _feature_sql("SELECT * FROM training"))
def q_training_population(spark, sf_dir):
    return ft.training_population(_features(spark, sf_dir))


@register("excluded_population", _feature_sql("""
SELECT * FROM features WHERE NOT (status IN ('defaulted', 'paid_off') OR loan_age_months >= 18)"""))
def q_excluded_population(spark, sf_dir):
    return ft.excluded_population(_features(spark, sf_dir))


@register("population_summary", _feature_sql(f"""
SELECT CAST((SELECT COUNT(*) FROM features) AS BIGINT) AS n_all,
  CAST((SELECT COUNT(*) FROM training) AS BIGINT) AS n_training,
  CAST((SELECT SUM(is_default) FROM training) AS BIGINT) AS n_defaulted,
  {O.half_up("(SELECT SUM(is_default) FROM training)", "(SELECT COUNT(*) FROM training)", 3)} AS training_default_rate,
  CAST((SELECT COUNT(*) FROM features) - (SELECT COUNT(*) FROM training) AS BIGINT) AS n_excluded"""))
def q_population_summary(spark, sf_dir):
    return ft.population_summary(_features(spark, sf_dir))


@register("one_hot_employment", _feature_sql("""
SELECT loan_id,
  CAST(employment_status = 'Part-time' AS INTEGER) AS "employment_status_Part-time",
  CAST(employment_status = 'Retired' AS INTEGER) AS "employment_status_Retired",
  CAST(employment_status = 'Self-employed' AS INTEGER) AS "employment_status_Self-employed",
  CAST(employment_status = 'Unemployed' AS INTEGER) AS "employment_status_Unemployed"
FROM features"""))
def q_one_hot_employment(spark, sf_dir):
    f = ft.one_hot_employment(_features(spark, sf_dir))
    return f.select("loan_id", *[F.col(f"`{c}`") for c in ft.DUMMY_COLUMNS])


@register("stratified_split", _feature_sql("SELECT loan_id, is_default, split FROM split"))
def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("loan_id", "is_default", "split")


@register("class_weights", _feature_sql("""
SELECT is_default, CAST(COUNT(*) AS BIGINT) AS n_class,
  CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / CAST(2 * COUNT(*) AS DOUBLE) AS class_weight
FROM split WHERE split = 'train' GROUP BY is_default"""))
def q_class_weights(spark, sf_dir):
    return ft.class_weights(_split(spark, sf_dir))


# ---------------------------------------------------------------- evaluation
# The test score plays the model: prediction = score >= 0.5,
# evaluated on the held-out test split.

EVAL_CTE = """, evald AS (
  SELECT s.loan_id, s.is_default, r.probability_of_default AS score,
    CAST(r.probability_of_default >= 0.5 AS INTEGER) AS prediction
  FROM split s JOIN scored r ON s.loan_id = r.loan_id WHERE s.split = 'test'),
cc AS (
  SELECT COUNT(*) FILTER (WHERE is_default = 1 AND prediction = 1) AS tp,
    COUNT(*) FILTER (WHERE is_default = 0 AND prediction = 1) AS fp,
    COUNT(*) FILTER (WHERE is_default = 0 AND prediction = 0) AS tn,
    COUNT(*) FILTER (WHERE is_default = 1 AND prediction = 0) AS fn
  FROM evald)"""


def _eval_sql(body: str) -> str:
    return O.with_book(body, "customers", "loans", "payment_history",
                       extra=FEATURES_CTES + EVAL_CTE)


def _sdiv(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0 END"


def _evald(spark, sf_dir):
    """Held-out rows with the test score carried through the split (no join back)."""
    f = _with_score(_features(spark, sf_dir))
    return (_split(spark, sf_dir, f).where(F.col("split") == "test")
            .select("loan_id", "is_default", F.col("probability_of_default").alias("score"))
            .withColumn("prediction", (F.col("score") >= 0.5).cast("int")))


@register("binary_metrics", _eval_sql(f"""
SELECT {_sdiv("tp + tn", "tp + fp + tn + fn")} AS accuracy, {_sdiv("tp", "tp + fp")} AS precision,
  {_sdiv("tp", "tp + fn")} AS recall, {_sdiv("2 * tp", "2 * tp + fp + fn")} AS f1 FROM cc"""))
def q_binary_metrics(spark, sf_dir):
    return ev.binary_metrics(_evald(spark, sf_dir))


@register("confusion_matrix", _eval_sql("""
SELECT 0 AS actual, CAST(tn AS BIGINT) AS pred_0, CAST(fp AS BIGINT) AS pred_1 FROM cc
UNION ALL SELECT 1, CAST(fn AS BIGINT), CAST(tp AS BIGINT) FROM cc"""))
def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_evald(spark, sf_dir))


@register("class_report", _eval_sql(f""", pc AS (
  SELECT {_sdiv("tn", "tn + fn")} AS p0, {_sdiv("tn", "tn + fp")} AS r0, {_sdiv("2 * tn", "2 * tn + fn + fp")} AS f0,
    CAST(tn + fp AS BIGINT) AS s0,
    {_sdiv("tp", "tp + fp")} AS p1, {_sdiv("tp", "tp + fn")} AS r1, {_sdiv("2 * tp", "2 * tp + fp + fn")} AS f1,
    CAST(tp + fn AS BIGINT) AS s1, {_sdiv("tp + tn", "tp + fp + tn + fn")} AS acc FROM cc)
SELECT 'No Default' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM pc
UNION ALL SELECT 'Default', p1, r1, f1, s1 FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, acc, s0 + s1 FROM pc
UNION ALL SELECT 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, s0 + s1 FROM pc
UNION ALL SELECT 'weighted avg',
  CASE WHEN s0 + s1 <> 0 THEN (p0 * CAST(s0 AS DOUBLE) + p1 * CAST(s1 AS DOUBLE)) / CAST(s0 + s1 AS DOUBLE) ELSE 0.0 END,
  CASE WHEN s0 + s1 <> 0 THEN (r0 * CAST(s0 AS DOUBLE) + r1 * CAST(s1 AS DOUBLE)) / CAST(s0 + s1 AS DOUBLE) ELSE 0.0 END,
  CASE WHEN s0 + s1 <> 0 THEN (f0 * CAST(s0 AS DOUBLE) + f1 * CAST(s1 AS DOUBLE)) / CAST(s0 + s1 AS DOUBLE) ELSE 0.0 END,
  s0 + s1 FROM pc"""))
def q_class_report(spark, sf_dir):
    return ev.class_report(_evald(spark, sf_dir))


@register("roc_auc", _eval_sql(""", ss AS (
  SELECT score, SUM(is_default) AS pos, COUNT(*) - SUM(is_default) AS neg FROM evald GROUP BY score),
c AS (SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ss)
SELECT CASE WHEN SUM(pos) * SUM(neg) <> 0 THEN
  CAST(SUM(pos * (2 * below + neg)) AS DOUBLE) / CAST(2 * SUM(pos) * SUM(neg) AS DOUBLE) END AS auc FROM c"""))
def q_roc_auc(spark, sf_dir):
    return ev.roc_auc(_evald(spark, sf_dir), score="score")


# ---------------------------------------------------------------- recommendation

def _money(expr_cents: str, precision: int = 14) -> str:
    return f"CAST(CAST({expr_cents} AS DECIMAL(20,0)) * 0.01 AS DECIMAL({precision},2))"


ACTS_DEFAULT = """acts(ord, action_type, rate_pm, cost_c) AS (VALUES
  (1, 'reminder_email', 295, 200), (2, 'phone_call', 392, 1500),
  (3, 'payment_plan', 430, 4000), (4, 'legal_notice', 239, 15000))"""

ACTS_REFRESHED = """acts0(ord, action_type, rate_pm, cost_c) AS (VALUES
  (1, 'reminder_email', 295, 200), (2, 'phone_call', 392, 1500),
  (3, 'payment_plan', 430, 4000), (4, 'legal_notice', 239, 15000)),
fresh AS (
  SELECT action_type, (2000 * COUNT(*) FILTER (WHERE outcome IN ('paid_in_full', 'partial_payment'))
    + COUNT(*)) // (2 * COUNT(*)) AS rate_pm
  FROM collection_actions GROUP BY action_type),
acts AS (
  SELECT d.ord, d.action_type, COALESCE(f.rate_pm, d.rate_pm) AS rate_pm, d.cost_c
  FROM acts0 d LEFT JOIN fresh f ON d.action_type = f.action_type)"""


def _reco_ctes(acts: str) -> str:
    return FEATURES_CTES + f""",
money AS (
  SELECT loan_id, probability_of_default AS p, loan_age_months,
    CASE WHEN term_months > 0 THEN
      (2 * CAST(principal * 100 AS BIGINT)
         * greatest(10 * term_months - CAST(round(loan_age_months * 10) AS BIGINT), 0)
       + 10 * term_months) // (20 * term_months)
    ELSE 0 END AS bal_c
  FROM scored),
money2 AS (
  SELECT *, CAST(floor(p * CAST(bal_c AS DOUBLE) * 0.6::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS var_c FROM money),
{acts},
opts AS (
  SELECT m.*, a.ord, a.action_type, a.rate_pm, a.cost_c, a.rate_pm * m.var_c - 1000 * a.cost_c AS x
  FROM money2 m CROSS JOIN acts a),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY loan_id ORDER BY ev_c DESC, ord) AS INTEGER) AS option_rank
  FROM (SELECT *, sign(x) * ((2 * abs(x) + 1000) // 2000) AS ev_c FROM opts) t)"""


BEST_BODY = f"""
SELECT loan_id,
  CASE WHEN p >= 0.5 THEN 'High' WHEN p >= 0.2 THEN 'Medium' ELSE 'Low' END AS risk_tier,
  round(p, 4) AS probability_of_default,
  {_money("bal_c")} AS estimated_outstanding_balance,
  {_money("var_c")} AS estimated_value_at_risk,
  action_type AS recommended_action,
  CAST(rate_pm AS DOUBLE) / 1000.0 AS recommended_success_rate,
  {_money("cost_c", 10)} AS recommended_cost,
  {_money("ev_c")} AS recommended_expected_value
FROM ranked WHERE option_rank = 1"""


def _reco_sql(body: str, acts: str = ACTS_DEFAULT) -> str:
    return O.with_book(body, "customers", "loans", "payment_history", "collection_actions",
                       extra=_reco_ctes(acts))


@register("risk_tiers", _reco_sql("""
SELECT loan_id, round(p, 4) AS probability_of_default,
  CASE WHEN p >= 0.5 THEN 'High' WHEN p >= 0.2 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM money"""))
def q_risk_tiers(spark, sf_dir):
    return rc.risk_tiers(_scored(spark, sf_dir))


@register("outstanding_balance", _reco_sql(f"""
SELECT loan_id, loan_age_months, {_money("bal_c")} AS estimated_outstanding_balance FROM money"""))
def q_outstanding_balance(spark, sf_dir):
    loans = _book(spark, sf_dir).loans
    return rc.outstanding_balance(loans.withColumn("loan_age_months", ft.loan_age_months(F.col("origination_date"), AS_OF)))


@register("value_at_risk", _reco_sql(f"""
SELECT loan_id, round(p, 4) AS probability_of_default, {_money("var_c")} AS estimated_value_at_risk
FROM money2"""))
def q_value_at_risk(spark, sf_dir):
    return rc.value_at_risk(_scored(spark, sf_dir))


@register("action_options", _reco_sql(f"""
SELECT loan_id, option_rank, action_type, CAST(rate_pm AS DOUBLE) / 1000.0 AS success_rate,
  {_money("cost_c", 10)} AS cost, {_money("ev_c")} AS expected_value FROM ranked"""))
def q_action_options(spark, sf_dir):
    return rc.action_options(_scored(spark, sf_dir))


@register("best_action", _reco_sql(BEST_BODY))
def q_best_action(spark, sf_dir):
    return rc.best_actions(_scored(spark, sf_dir))


@register("best_action_refreshed", _reco_sql(BEST_BODY, ACTS_REFRESHED))
def q_best_action_refreshed(spark, sf_dir):
    b = _book(spark, sf_dir)
    actions = rc.refreshed_actions(pf.success_rate_permille(b.actions))
    return rc.best_actions(_scored(spark, sf_dir), actions=actions)


# ---------------------------------------------------------------- lifecycle

ELAPSED_SQL = f"least(term_months, greatest(0, CAST(({AS_OF_SQL} - origination_date) // 30 AS INTEGER)))"
INSTALMENT_CENTS_SQL = ("CASE WHEN term_months > 0 THEN (2 * CAST(principal * 100 AS BIGINT) "
                        "* (10000 + CAST(interest_rate * 10000 AS BIGINT)) + 10000 * term_months) "
                        "// (20000 * term_months) END")

PAY_EVENTS_SQL = """pay_ev AS (
  SELECT loan_id, due_date AS event_date, 0 AS kind, payment_id AS event_id,
    CAST(CASE WHEN amount_paid = 0 THEN 30 WHEN days_late > 0 THEN days_late - 5 ELSE -10 END AS BIGINT) AS delta
  FROM payment_history),
act_ev AS (
  SELECT loan_id, action_date AS event_date, 1 AS kind, action_id AS event_id,
    CAST(CASE outcome WHEN 'paid_in_full' THEN -45 WHEN 'partial_payment' THEN -15 ELSE 0 END AS BIGINT) AS delta
  FROM collection_actions)"""


@register("instalment_amount", O.with_book(f"""
SELECT loan_id, {_money(INSTALMENT_CENTS_SQL)} AS monthly_payment FROM loans""", "loans"))
def q_instalment_amount(spark, sf_dir):
    return lc.instalment_amount(_book(spark, sf_dir).loans)


@register("instalments_elapsed", O.with_book(f"""
SELECT loan_id, {ELAPSED_SQL} AS instalments_elapsed FROM loans""", "loans"))
def q_instalments_elapsed(spark, sf_dir):
    return lc.instalments_elapsed(_book(spark, sf_dir).loans, AS_OF)


@register("payment_schedule", O.with_book(f"""
SELECT loan_id, CAST(g AS INTEGER) AS instalment_no,
  CAST(origination_date + CAST(30 * g AS INTEGER) AS DATE) AS due_date,
  {_money("due_c")} AS amount_due
FROM (SELECT loan_id, origination_date, {INSTALMENT_CENTS_SQL} AS due_c,
        unnest(generate_series(1, {ELAPSED_SQL})) AS g
      FROM loans WHERE {ELAPSED_SQL} >= 1) t""", "loans"))
def q_payment_schedule(spark, sf_dir):
    return lc.payment_schedule(_book(spark, sf_dir).loans, AS_OF)


PAY_WALK = PAY_EVENTS_SQL + ",\n" + O.walk_ctes("pay_ev", "p")
ALL_WALK = (PAY_EVENTS_SQL + ",\nall_ev AS (SELECT * FROM pay_ev UNION ALL SELECT * FROM act_ev),\n"
            + O.walk_ctes("all_ev", "a"))


@register("running_delinquency", O.with_book("""
SELECT event_id AS payment_id, loan_id, event_date AS due_date, delta, delinquency_balance
FROM walked_p""", "payment_history", "collection_actions", extra=PAY_WALK, recursive=True))
def q_running_delinquency(spark, sf_dir):
    return lc.running_delinquency(_book(spark, sf_dir).payments)


@register("delinquency_with_actions", O.with_book("""
SELECT loan_id, event_date, kind, event_id, delta, delinquency_balance FROM walked_a""",
                                                  "payment_history", "collection_actions",
                                                  extra=ALL_WALK, recursive=True))
def q_delinquency_with_actions(spark, sf_dir):
    b = _book(spark, sf_dir)
    return lc.delinquency_with_actions(b.payments, b.actions)


@register("escalation_points", O.with_book("""
SELECT loan_id, 'reminder_email' AS action_type, 15 AS threshold, MIN(event_date) AS escalation_date
  FROM walked_p WHERE delinquency_balance >= 15 GROUP BY loan_id
UNION ALL SELECT loan_id, 'phone_call', 30, MIN(event_date) FROM walked_p WHERE delinquency_balance >= 30 GROUP BY loan_id
UNION ALL SELECT loan_id, 'payment_plan', 60, MIN(event_date) FROM walked_p WHERE delinquency_balance >= 60 GROUP BY loan_id
UNION ALL SELECT loan_id, 'legal_notice', 90, MIN(event_date) FROM walked_p WHERE delinquency_balance >= 90 GROUP BY loan_id""",
                                           "payment_history", "collection_actions",
                                           extra=PAY_WALK, recursive=True))
def q_escalation_points(spark, sf_dir):
    return lc.escalation_points(_book(spark, sf_dir).payments)


@register("derived_status", O.with_book(f"""
, eod AS (SELECT loan_id, delinquency_balance, row_number() OVER (PARTITION BY loan_id, event_date
          ORDER BY step DESC) AS rn FROM walked_a),
peak AS (SELECT loan_id, MAX(delinquency_balance) AS pk FROM eod WHERE rn = 1 GROUP BY loan_id)
SELECT l.loan_id, CASE WHEN COALESCE(pk, 0) >= 110 THEN 'defaulted'
  WHEN {ELAPSED_SQL} >= term_months THEN 'paid_off' ELSE 'active' END AS derived_status
FROM loans l LEFT JOIN peak ON l.loan_id = peak.loan_id""",
                                        "loans", "payment_history", "collection_actions",
                                        extra=ALL_WALK, recursive=True))
def q_derived_status(spark, sf_dir):
    b = _book(spark, sf_dir)
    return lc.derived_status(b.loans, b.payments, b.actions, AS_OF)


@register("risk_score", O.with_book(f"""
SELECT customer_id, {TEST_SCORE_SQL} AS risk_score FROM customers""", "customers"))
def q_risk_score(spark, sf_dir):
    """The test score itself, by customer: a stand-in, no operator of the library."""
    return _book(spark, sf_dir).customers.select("customer_id", _test_score().alias("risk_score"))


@register("risk_price", O.with_book(f"""
SELECT customer_id, 0.05::DOUBLE + {TEST_SCORE_SQL} / 8.0::DOUBLE AS risk_price FROM customers""", "customers"))
def q_risk_price(spark, sf_dir):
    """A rate that rises with the test score: a stand-in, no operator of the library."""
    return _book(spark, sf_dir).customers.select("customer_id", (F.lit(0.05) + _test_score() / F.lit(8.0)).alias("risk_price"))


# ---------------------------------------------------------------- quality and load


_ALL = ("customers", "loans", "payment_history", "collection_actions")


def _tables(spark, sf_dir):
    return dict(_book(spark, sf_dir).items())


@register("null_violations", O.with_book("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
    f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM {t}"
    for t in TABLES for c in TABLES[t].columns), *_ALL))
def q_null_violations(spark, sf_dir):
    return qa.null_violations(_tables(spark, sf_dir))


@register("pk_violations", O.with_book("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows, "
    f"CAST(COUNT(DISTINCT {s.primary_key}) AS BIGINT) AS n_keys, "
    f"CAST((SELECT COUNT(*) FROM (SELECT {s.primary_key} FROM {t} WHERE {s.primary_key} IS NOT NULL "
    f"GROUP BY {s.primary_key} HAVING COUNT(*) > 1) d) AS BIGINT) AS n_duplicate_keys FROM {t}"
    for t, s in TABLES.items()), *_ALL))
def q_pk_violations(spark, sf_dir):
    return qa.pk_violations(_tables(spark, sf_dir))


@register("fk_violations", O.with_book("\nUNION ALL\n".join(
    f"SELECT '{c}' AS child_table, '{cc}' AS child_column, '{p}' AS parent_table, "
    f"CAST(COUNT(*) AS BIGINT) AS orphan_rows, CAST(COUNT(DISTINCT ch.{cc}) AS BIGINT) AS orphan_keys "
    f"FROM {c} ch WHERE ch.{cc} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} pa WHERE pa.{pc} = ch.{cc})"
    for c, cc, p, pc in FOREIGN_KEYS), *_ALL))
def q_fk_violations(spark, sf_dir):
    return qa.fk_violations(_tables(spark, sf_dir))


@register("defaults_applied", O.with_book("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{v}' AS default_value, "
    f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_defaulted FROM {t}"
    for t, s in TABLES.items() for c, v in s.defaults.items()), *_ALL))
def q_defaults_applied(spark, sf_dir):
    return qa.defaults_applied(_tables(spark, sf_dir))


TABLE_COUNTS_SQL = O.with_book("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {t}" for t in TABLES),
    *_ALL)


@register("table_counts", TABLE_COUNTS_SQL)
def q_table_counts(spark, sf_dir):
    return sio.table_counts(_book(spark, sf_dir))


@register("csv_round_trip", O.with_book("SELECT * FROM loans", "loans"))
def q_csv_round_trip(spark, sf_dir):
    """Write the loans as CSV with a header, read back with the schema."""
    path = scratch_path(spark, "csv-loans")
    sio.write_table(_book(spark, sf_dir).loans, path, "loans", fmt="csv")
    return sio.read_table(spark, path, "loans", fmt="csv")


@register("full_refresh", TABLE_COUNTS_SQL)
def q_full_refresh(spark, sf_dir):
    """Versioned, checked, idempotent reload -- run twice, count the published book."""
    book = _book(spark, sf_dir)
    target = scratch_path(spark, "book")
    sio.full_refresh(spark, book, target)
    sio.full_refresh(spark, book, target)
    return sio.table_counts(sio.read_published(spark, target))


# The delinquency view through the SQL API on named views.
DELINQUENCY_SPARK_SQL = """
WITH pay AS (
  SELECT loan_id, COUNT(*) AS n, COUNT_IF(days_late > 0) AS late,
    SUM(CAST(days_late AS BIGINT)) AS s, COUNT(days_late) AS nv, MAX(days_late) AS mx,
    MAX_BY(days_late, unix_date(due_date) * 4294967296L + days_late) AS recent
  FROM {p}payment_history GROUP BY loan_id)
SELECT l.loan_id, l.customer_id, l.status, l.principal, l.interest_rate, l.term_months, l.origination_date,
  COALESCE(p.n, 0) AS total_payments_made,
  COALESCE(p.late, 0) AS late_payment_count,
  CAST((2000 * COALESCE(p.late, 0) + GREATEST(COALESCE(p.n, 0), 1))
       DIV (2 * GREATEST(COALESCE(p.n, 0), 1)) AS DOUBLE) / 1000D AS pct_payments_late,
  CASE WHEN p.nv > 0 THEN CAST((20 * p.s + p.nv) DIV (2 * p.nv) AS DOUBLE) / 10D END AS avg_days_late,
  p.mx AS max_days_late_ever,
  p.recent AS most_recent_days_late
FROM {p}loans l LEFT JOIN pay p ON p.loan_id = l.loan_id
"""


@register("loan_delinquency_sql", O.with_book(DELINQUENCY_SQL_BODY, "loans", "payment_history"))
def q_loan_delinquency_sql(spark, sf_dir):
    prefix = f"arrears_{uuid.uuid4().hex[:8]}_"
    sio.register_views(spark, _book(spark, sf_dir), prefix)
    view = spark.sql(DELINQUENCY_SPARK_SQL.format(p=prefix))
    for name in TABLES:
        spark.catalog.dropTempView(f"{prefix}{name}")
    return view


@register("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    """S12 (rows only): dense ids for the collection actions, no global sort."""
    acts = _book(spark, sf_dir).actions
    return qa.dense_ids(acts.select("action_id", "loan_id"), "surrogate_id")


# ---------------------------------------------------------------- model (rows-only checks)


def _training_run(spark, sf_dir) -> "ml.TrainingRun":
    return ml.train_and_evaluate(_split(spark, sf_dir), ml.ForestParams())


@register("rf_scores")
def q_rf_scores(spark, sf_dir):
    """M5/M6: P(default) and predicted class for every held-out loan."""
    return _training_run(spark, sf_dir).scored_test.select(
        "loan_id", "is_default", "prediction", "probability_of_default")


@register("rf_confusion_matrix")
def q_rf_confusion_matrix(spark, sf_dir):
    """M9 for the forest's held-out predictions."""
    return ev.confusion_matrix(_training_run(spark, sf_dir).scored_test)


@register("rf_class_report")
def q_rf_class_report(spark, sf_dir):
    """M10 for the forest's held-out predictions."""
    return ev.class_report(_training_run(spark, sf_dir).scored_test)


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """The ten most important of the 17 model inputs."""
    return ml.feature_importance(_training_run(spark, sf_dir).model, top=10)


@register("run_metrics")
def q_run_metrics(spark, sf_dir):
    """Parameters and held-out metrics of the training run, appended to a
    run-metrics table in the shared folder and read back."""
    return ml.append_run_metrics(_training_run(spark, sf_dir), scratch_path(spark, "run-metrics"))


# ---------------------------------------------------------------- streaming refresh


def _streamed_rates(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    table = scratch_path(spark, "rates")
    _book(spark, sf_dir).actions.write.parquet(landing)
    q = rr.start_refresh(spark, landing, table, scratch_path(spark, "rates-ckpt"))
    q.awaitTermination()
    return rr.read_rates(spark, table)


@register("streamed_success_rates", ORACLE["action_success_rates"])
def q_streamed_success_rates(spark, sf_dir):
    """R10 as a stream: actions land as files, the refresh job publishes the rates."""
    return (_streamed_rates(spark, sf_dir).select("action_type", "total_actions", "success_rate")
            .orderBy(F.desc("success_rate"), "action_type"))


@register("streamed_rates_redelivered", ORACLE["action_success_rates"])
def q_streamed_rates_redelivered(spark, sf_dir):
    """R10 under repeated delivery: all actions, a third of them again at once, all again in a later run."""
    landing, table, checkpoint = (scratch_path(spark, f"redelivered-{n}") for n in ("landing", "rates", "ckpt"))
    actions = _book(spark, sf_dir).actions
    actions.write.parquet(landing)
    actions.where(F.col("action_id") % 3 == 0).write.mode("append").parquet(landing)
    rr.start_refresh(spark, landing, table, checkpoint).awaitTermination()
    actions.write.mode("append").parquet(landing)
    rr.start_refresh(spark, landing, table, checkpoint, max_files_per_trigger=4).awaitTermination()
    return (rr.read_rates(spark, table).select("action_type", "total_actions", "success_rate")
            .orderBy(F.desc("success_rate"), "action_type"))


@register("surrogate_key_summary", O.with_book("""
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) AS BIGINT) AS n_distinct_ids,
  CAST(1 AS BIGINT) AS min_id, CAST(COUNT(*) AS BIGINT) AS max_id
FROM collection_actions""", "collection_actions"))
def q_surrogate_key_summary(spark, sf_dir):
    """S12 checked against SQL: the ids are exactly 1..n (dense and unique)."""
    ids = q_surrogate_keys(spark, sf_dir)
    return ids.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                   F.count_distinct("surrogate_id").cast("bigint").alias("n_distinct_ids"),
                   F.min("surrogate_id").cast("bigint").alias("min_id"),
                   F.max("surrogate_id").cast("bigint").alias("max_id"))


@register("bucketed_delinquency", O.with_book(DELINQUENCY_SQL_BODY, "loans", "payment_history"))
def q_bucketed_delinquency(spark, sf_dir):
    """A13 on a bucketed layout: aggregation and join read co-partitioned tables."""
    prefix = f"arrears_b{uuid.uuid4().hex[:8]}_"
    book = _book(spark, sf_dir)
    used = ("loans", "payment_history")
    buckets = sio.bucket_count(max(sio.planned_bytes(book.table(n)) for n in used))
    tables = sio.write_bucketed_book(spark, book, scratch_path(spark, "bucketed"), buckets, prefix, used)
    view = dq.loan_delinquency(tables["loans"], tables["payment_history"])
    sio.drop_tables(spark, [prefix + n for n in used])
    return view


@register("incremental_delinquency", O.with_book(DELINQUENCY_SQL_BODY, "loans", "payment_history"))
def q_incremental_delinquency(spark, sf_dir):
    """The view from a state that all payments were merged into, in three increments, one of them sent twice."""
    book, target = _book(spark, sf_dir), scratch_path(spark, "delinquency-state")
    ds.create(spark, target, 2 * sio.bucket_count(sio.planned_bytes(book.payments)))
    for k in (0, 1, 1, 2):
        ds.merge(spark, target, book.payments.where(F.pmod("payment_id", F.lit(3)) == k), f"part {k}")
    return ds.view(spark, target, book.loans)


# ---------------------------------------------------------------- forest over the whole book, run record, reload


def _whole_book(spark, sf_dir):
    """Every loan with the forest's probability and the recommendation made from it."""
    run = _training_run(spark, sf_dir)
    scored = ml.score(run.model, _features(spark, sf_dir)).select(
        "loan_id", "principal", "term_months", "loan_age_months", "probability_of_default", "prediction")
    with shuffles_dropped(spark):
        scored = materialise(scored, "book-scores")
    return scored, rc.best_actions(scored)


@register("rf_book_recommendations")
def q_rf_book_recommendations(spark, sf_dir):
    """P10 + M6 + G1: score all loans with the forest, recommend for all."""
    return _whole_book(spark, sf_dir)[1]


@register("rf_book_check", O.with_book("""
SELECT n AS n_loans, n AS n_probabilities, n AS n_classes, n AS n_tiers, n AS n_values
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n FROM loans)""", "loans"))
def q_rf_book_check(spark, sf_dir):
    """Properties of the whole-book recommendation, recomputed from the written scores."""
    scored, best = _whole_book(spark, sf_dir)
    p = F.col("probability_of_default")
    j = best.drop("probability_of_default").join(scored.select("loan_id", "probability_of_default", "prediction"), "loan_id")
    tier = F.when(p >= 0.5, "High").when(p >= 0.2, "Medium").otherwise("Low")
    risk = F.floor(p * (F.col("estimated_outstanding_balance") * 100).cast("double") * F.lit(0.6) + F.lit(0.5))
    value = F.round(F.col("recommended_success_rate") * risk / 100 - F.col("recommended_cost").cast("double"), 2)
    holds = {"n_probabilities": (p >= 0) & (p <= 1), "n_classes": F.col("prediction") == (p >= 0.5).cast("int"),
             "n_tiers": F.col("risk_tier") == tier,
             "n_values": F.abs(value - F.col("recommended_expected_value").cast("double")) < 0.011}
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("n_loans"),
                 *[F.count_if(c).cast("bigint").alias(n) for n, c in holds.items()])


@register("rf_label_counts", _feature_sql("""
SELECT is_default AS actual, CAST(COUNT(*) AS BIGINT) AS n FROM split WHERE split = 'test' GROUP BY is_default"""))
def q_rf_label_counts(spark, sf_dir):
    """The row sums of the forest's confusion matrix are the test labels of the split."""
    m = ev.confusion_matrix(_training_run(spark, sf_dir).scored_test)
    return m.select("actual", (F.col("pred_0") + F.col("pred_1")).alias("n")).where("n > 0")


@register("run_record", O.with_book("""
SELECT kind, name, CAST(2 AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS n_runs FROM (VALUES
  ('param', 'n_estimators'), ('param', 'max_depth'), ('param', 'min_samples_leaf'), ('param', 'class_weight'),
  ('param', 'random_state'), ('metric', 'accuracy'), ('metric', 'precision'), ('metric', 'recall'),
  ('metric', 'f1'), ('metric', 'auc')) t(kind, name)""", "loans"))
def q_run_record(spark, sf_dir):
    """Two runs appended to one table."""
    path = scratch_path(spark, "run-metrics")
    run = _training_run(spark, sf_dir)
    ml.append_run_metrics(run, path)
    table = ml.append_run_metrics(dataclasses.replace(run, run_id=uuid.uuid4().hex), path)
    return table.groupBy("kind", "name").agg(F.count("value").cast("bigint").alias("n_rows"),
                                             F.count_distinct("run_id").cast("bigint").alias("n_runs"))


@register("rf_reloaded", O.with_book("""
SELECT CAST(COUNT(*) AS BIGINT) AS n_loans, CAST(COUNT(*) AS BIGINT) AS n_equal, 17 AS n_columns FROM loans""", "loans"))
def q_rf_reloaded(spark, sf_dir):
    """The saved forest scores every loan as the fitted one does."""
    path = scratch_path(spark, "model")
    model = _training_run(spark, sf_dir).model
    ml.save(model, path)
    f = _features(spark, sf_dir)
    again = ml.score(ml.load(path), ml.score(model, f).select(*f.columns, F.col("probability_of_default").alias("first")))
    n = len(ml.saved_feature_columns(path))
    return again.agg(F.count(F.lit(1)).cast("bigint").alias("n_loans"),
                     F.count_if(F.col("first") == F.col("probability_of_default")).cast("bigint").alias("n_equal"),
                     F.lit(n).alias("n_columns"))


@register("rf_node_walk", O.with_book("""
SELECT n AS n_loans, n AS n_equal_probability, n AS n_equal_class FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n FROM loans)""", "loans"))
def q_rf_node_walk(spark, sf_dir):
    """M5, M6: every loan walked down the table of nodes, against the model's own score, to the last bit."""
    params = ml.ForestParams()
    model = _training_run(spark, sf_dir).model
    with shuffles_dropped(spark):           # written once for the walk and the score
        inputs = materialise(_features(spark, sf_dir).select("loan_id", *ft.NUMERIC_FEATURES, "employment_status"), "book-inputs")
    walked = fo.probabilities(fo.node_table(model), ml.one_hot_stage().transform(inputs), ft.DESIGN_COLUMNS, params.max_depth)
    own = ml.score(model, inputs).select(
        "loan_id", F.col("probability_of_default").alias("p"), F.col("prediction").alias("c"))
    both = own.join(walked, "loan_id", "left")
    return both.agg(F.count(F.lit(1)).cast("bigint").alias("n_loans"),
                    F.count_if(F.col("p") == F.col("probability_of_default")).cast("bigint").alias("n_equal_probability"),
                    F.count_if(F.col("c") == F.col("prediction")).cast("bigint").alias("n_equal_class"))


_NODE_RULES = ["children exist", "rows add up", "class totals add up", "rows per child", "impurity is Gini",
               "gain is the drop of impurity", "one path from the root", "depth"]


@register("rf_node_rules", "SELECT rule, CAST(expected AS BIGINT) AS n FROM (VALUES " + ", ".join(
    f"('{r}: broken', 0)" for r in _NODE_RULES) + f", ('trees', {ml.ForestParams().num_trees}), "
    f"('importances: equal', {len(ft.DESIGN_COLUMNS)}), ('importances: in order', {len(ft.DESIGN_COLUMNS)})) t(rule, expected)")
def q_rf_node_rules(spark, sf_dir):
    """The rules of the splits, and the importances summed from the gains of the nodes."""
    params = ml.ForestParams()
    model = _training_run(spark, sf_dir).model
    nodes = materialise(fo.node_table(model), "forest-nodes")
    own = spark.createDataFrame(list(zip(ft.DESIGN_COLUMNS, model.stages[-1].featureImportances.toArray().tolist())),
                                "feature string, own double")                    # 17 rows
    summed = fo.importances(nodes, ft.DESIGN_COLUMNS).join(own, "feature")
    order = summed.withColumn("by_sum", F.row_number().over(Window.orderBy(F.desc(F.round("importance", 9)), "feature"))).withColumn(
        "by_own", F.row_number().over(Window.orderBy(F.desc(F.round("own", 9)), "feature")))
    counts = [
        fo.audit(nodes, params.max_depth, params.min_instances_per_node).select(
            F.concat("rule", F.lit(": broken")).alias("rule"), F.col("n_broken").alias("n")),
        nodes.where(F.col("node") == fo.ROOT).agg(F.count(F.lit(1)).alias("n")).select(F.lit("trees").alias("rule"), "n"),
        summed.agg(F.count_if(F.abs(F.col("importance") - F.col("own")) < 1e-9).alias("n")).select(
            F.lit("importances: equal").alias("rule"), "n"),
        order.agg(F.count_if(F.col("by_sum") == F.col("by_own")).alias("n")).select(F.lit("importances: in order").alias("rule"), "n")]
    return functools.reduce(lambda a, b: a.unionByName(b), counts).select("rule", F.col("n").cast("bigint").alias("n"))


@register("design_matrix", _feature_sql("SELECT loan_id, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ft.NUMERIC_FEATURES) + ", " + ", ".join(
    f"""CAST(employment_status = '{v}' AS DOUBLE) AS "{n}" """ for v, n in zip(ft.EMPLOYMENT_DUMMIES, ft.DUMMY_COLUMNS))
    + " FROM features"))
def q_design_matrix(spark, sf_dir):
    """The 17 model inputs as the assembler hands them to the forest."""
    vectors = ml.assembler().transform(ml.one_hot_stage().transform(_features(spark, sf_dir)))
    values = vectors.select("loan_id", vector_to_array("features").alias("x"))
    return values.select("loan_id", *[F.col("x")[i].alias(c) for i, c in enumerate(ft.DESIGN_COLUMNS)])


@register("recommendation_records", _reco_sql(f"""
SELECT r.loan_id, CASE WHEN r.p >= 0.5 THEN 'High' WHEN r.p >= 0.2 THEN 'Medium' ELSE 'Low' END AS risk_tier,
  round(r.p, 4) AS probability_of_default, {_money("r.bal_c")} AS estimated_outstanding_balance,
  {_money("r.var_c")} AS estimated_value_at_risk, b.action_type AS recommended_action, r.option_rank, r.action_type,
  CAST(r.rate_pm AS DOUBLE) / 1000.0 AS success_rate, {_money("r.cost_c", 10)} AS cost, {_money("r.ev_c")} AS expected_value,
  '{rc.ASSUMPTIONS_NOTE}' AS assumptions_note
FROM ranked r JOIN ranked b ON b.loan_id = r.loan_id AND b.option_rank = 1"""))
def q_recommendation_records(spark, sf_dir):
    """the nested record of every loan, one row per option."""
    return rc.flat_records(rc.recommend_actions(_scored(spark, sf_dir)))


@register("streamed_rates_recommendation", _reco_sql(BEST_BODY, ACTS_REFRESHED))
def q_streamed_rates_recommendation(spark, sf_dir):
    """R10 end to end: actions land as files, the stream publishes rates, the recommendation uses them."""
    return rc.best_actions(_scored(spark, sf_dir), actions=rc.refreshed_actions(
        _streamed_rates(spark, sf_dir).select("action_type", "rate_permille")))


# ---------------------------------------------------------------- round trips and bad rows


def _csv_round_trip(spark, df, name):
    path = scratch_path(spark, f"csv-{name}")
    sio.write_csv(df, path)
    return sio.read_csv(spark, path, df.schema)


def _register_csv(name: str, table: str, sql: str, frame) -> None:
    @register(name, sql)
    def q(spark, sf_dir):
        return _csv_round_trip(spark, frame(spark, sf_dir), table)
    q.__doc__ = f"S2/S3: {table} written as CSV and read back."


for _table in ("customers", "payment_history", "collection_actions"):
    _register_csv(f"csv_round_trip_{_table}", _table, O.with_book(f"SELECT * FROM {_table}", _table),
                  lambda spark, sf_dir, t=_table: _book(spark, sf_dir).table(t))
_register_csv("csv_round_trip_features", "features", _feature_sql("SELECT * FROM features"), _features)
_register_csv("csv_round_trip_training", "training", _feature_sql("SELECT * FROM training"),
              lambda spark, sf_dir: ft.training_population(_features(spark, sf_dir)))


# The test tables have no bad rows, so some are made from them by rules on the key.
BAD_CTES = """bad_loans AS (
  SELECT loan_id, CASE WHEN loan_id % 20 = 1 THEN customer_id + 1000000000 ELSE customer_id END AS customer_id, principal,
    CASE WHEN loan_id % 15 = 2 THEN NULL ELSE interest_rate END AS interest_rate, term_months, origination_date,
    CASE WHEN loan_id % 10 = 3 THEN NULL ELSE status END AS status FROM loans
  UNION ALL SELECT * FROM loans WHERE loan_id % 50 = 4),
bad_payments AS (
  SELECT payment_id, CASE WHEN payment_id % 30 = 1 THEN -loan_id ELSE loan_id END AS loan_id, due_date, amount_due,
    CASE WHEN payment_id % 7 = 2 THEN NULL ELSE amount_paid END AS amount_paid,
    CASE WHEN payment_id % 11 = 3 THEN NULL ELSE days_late END AS days_late FROM payment_history)"""
_BAD = {"customers": "customers", "loans": "bad_loans", "payment_history": "bad_payments",
        "collection_actions": "collection_actions"}


def _bad_book(spark, sf_dir) -> Book:
    b = _book(spark, sf_dir)

    def void(df, col, when):
        return df.withColumn(col, F.when(when, None).otherwise(F.col(col)))

    k = F.col("loan_id")
    loans = void(void(b.loans, "interest_rate", k % 15 == 2), "status", k % 10 == 3).withColumn(
        "customer_id", F.when(k % 20 == 1, F.col("customer_id") + 1_000_000_000).otherwise(F.col("customer_id")))
    loans = loans.select(*b.loans.columns).unionByName(b.loans.where(k % 50 == 4))
    i = F.col("payment_id")
    pays = void(void(b.payments, "amount_paid", i % 7 == 2), "days_late", i % 11 == 3).withColumn(
        "loan_id", F.when(i % 30 == 1, -k).otherwise(k))
    return Book(b.customers, loans, pays.select(*b.payments.columns), b.actions)


def _bad_sql(parts) -> str:
    return O.with_book("\nUNION ALL\n".join(parts), *_ALL, extra=BAD_CTES)


@register("null_violations_found", _bad_sql(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM {_BAD[t]}"
    for t in TABLES for c in TABLES[t].columns))
def q_null_violations_found(spark, sf_dir):
    return qa.null_violations(dict(_bad_book(spark, sf_dir).items()))


@register("pk_violations_found", _bad_sql(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(DISTINCT {s.primary_key}) AS BIGINT) AS n_keys, "
    f"CAST(COUNT(*) - COUNT(DISTINCT {s.primary_key}) AS BIGINT) AS n_duplicate_keys FROM {_BAD[t]}" for t, s in TABLES.items()))
def q_pk_violations_found(spark, sf_dir):
    return qa.pk_violations(dict(_bad_book(spark, sf_dir).items()))


@register("fk_violations_found", _bad_sql(
    f"SELECT '{c}' AS child_table, '{cc}' AS child_column, '{p}' AS parent_table, CAST(COUNT(*) AS BIGINT) AS orphan_rows, "
    f"CAST(COUNT(DISTINCT {cc}) AS BIGINT) AS orphan_keys FROM {_BAD[c]} WHERE {cc} IS NOT NULL AND {cc} NOT IN "
    f"(SELECT {pc} FROM {_BAD[p]})" for c, cc, p, pc in FOREIGN_KEYS))
def q_fk_violations_found(spark, sf_dir):
    return qa.fk_violations(dict(_bad_book(spark, sf_dir).items()))


@register("defaults_found", _bad_sql(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{v}' AS default_value, "
    f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_defaulted FROM {_BAD[t]}"
    for t, s in TABLES.items() for c, v in s.defaults.items()))
def q_defaults_found(spark, sf_dir):
    return qa.defaults_applied(dict(_bad_book(spark, sf_dir).items()))


def _gaps(spark, sf_dir) -> Book:
    """The book with missing values in every column that has a default."""
    b = _book(spark, sf_dir)
    frames = {}
    for name, df in b.items():
        key = F.col(TABLES[name].primary_key)
        for col in TABLES[name].defaults:
            df = df.withColumn(col, F.when(key % 6 == 5, None).otherwise(F.col(col)))
        frames[name] = df
    return Book(*(frames[n] for n in TABLES))


def _row_sql(t: str) -> str:
    spec = TABLES[t]

    def value(c):
        if c not in spec.defaults:
            return c
        v = spec.defaults[c]
        kind = spec.schema[c].dataType.simpleString().upper().replace("STRING", "VARCHAR").replace("INT", "INTEGER")
        return f"CASE WHEN {spec.primary_key} % 6 = 5 THEN CAST('{v}' AS {kind}) ELSE {c} END"

    text = " || '|' || ".join(f"coalesce(CAST({value(c)} AS VARCHAR), '')" for c in spec.columns)
    return f"SELECT '{t}' AS table_name, {text} AS content FROM {t}"


@register("full_refresh_rows", O.with_book("\nUNION ALL\n".join(_row_sql(t) for t in TABLES), *_ALL))
def q_full_refresh_rows(spark, sf_dir):
    """Every row of the reloaded book, missing values filled with their defaults."""
    target = scratch_path(spark, "book")
    sio.full_refresh(spark, _gaps(spark, sf_dir), target)
    published = sio.read_published(spark, target)
    rows = [df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TABLES[name].columns]).alias("content"))
        for name, df in published.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), rows)


@register("payment_sequence", O.with_book("""SELECT payment_id, loan_id,
  row_number() OVER (PARTITION BY loan_id ORDER BY due_date NULLS FIRST, payment_id) AS payment_no
FROM payment_history""", "payment_history"))
def q_payment_sequence(spark, sf_dir):
    """The number of each payment within its loan, in ranges that split a hot loan or day."""
    payments = _book(spark, sf_dir).payments.select("payment_id", "loan_id", "due_date")
    return row_number_in_ranges(payments, "loan_id", ["due_date", "payment_id"], "payment_no").drop("due_date")


@register("csv_quarantine", O.with_book("""SELECT loan_id, loan_id % 97 = 0 AS quarantined,
  CASE WHEN loan_id % 97 <> 0 THEN principal END AS principal FROM loans""", "loans"))
def q_csv_quarantine(spark, sf_dir):
    """The loans as CSV with values that do not parse, by a rule on the key; good rows and lines set aside."""
    loans = _book(spark, sf_dir).loans
    path, target = scratch_path(spark, "csv-bad"), scratch_path(spark, "csv-loaded")
    spoilt = F.when(F.col("loan_id") % 97 == 0, "n/a").otherwise(F.col("principal").cast("string"))
    sio.write_csv(loans.withColumn("principal", spoilt), path)
    sio.load_csv(spark, path, loans.schema, target, max_bad=0.1)
    good = sio.read_loaded(spark, target, loans.schema).select("loan_id", F.lit(False).alias("quarantined"), "principal")
    aside = sio.read_quarantine(spark, target, loans.schema).select(
        F.split("line", ",")[0].cast("bigint").alias("loan_id"), F.lit(True).alias("quarantined"))
    return good.unionByName(aside, allowMissingColumns=True)
