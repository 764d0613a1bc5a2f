"""Loan lifecycle reconstruction on observed tables.

Set operations over whole tables: instalment amounts and schedules (R1-R3), the
clamped running delinquency balance with and without collection-action effects
(R4, R5), escalation points (R6) and the derived status (R7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import cents, from_cents, idiv, round_half_up_div
from ..functions.scoring import as_of_date
from ..session import materialise

# Fixed values of the reference: delinquency-balance updates (days).
MISSED_DELTA = 30
LATE_GRACE = 5
ON_TIME_DELTA = -10
PAID_IN_FULL_DELTA = -45
PARTIAL_PAYMENT_DELTA = -15
DEFAULT_THRESHOLD = 110
# Fixed values of the reference: escalation ladder (balance threshold, action).
ESCALATION = [(15, "reminder_email"), (30, "phone_call"), (60, "payment_plan"), (90, "legal_notice")]
DAYS_PER_INSTALMENT = 30


# ------------------------------------------------------------------ R1-R3

def instalment_cents(principal: Column, interest_rate: Column, term_months: Column) -> Column:
    """round(principal * (1 + rate) / term, 2) in cents (flat interest)."""
    r4 = (interest_rate * 10000).cast("bigint")
    num = cents(principal) * (r4 + 10000)
    den = term_months.cast("bigint") * 10000
    return F.when(term_months > 0, round_half_up_div(num, den))


def instalment_amount(loans: DataFrame) -> DataFrame:
    return loans.select("loan_id", from_cents(instalment_cents(
        F.col("principal"), F.col("interest_rate"), F.col("term_months"))).alias("monthly_payment"))


def elapsed(origination: Column, term_months: Column, as_of) -> Column:
    """R2: min(term, max(0, days_since_origination div 30))."""
    days = F.datediff(as_of_date(as_of), origination)
    return F.least(term_months, F.greatest(F.lit(0), idiv(days, DAYS_PER_INSTALMENT).cast("int")))


def instalments_elapsed(loans: DataFrame, as_of) -> DataFrame:
    return loans.select("loan_id", elapsed(F.col("origination_date"), F.col("term_months"), as_of)
                        .cast("int").alias("instalments_elapsed"))


def payment_schedule(loans: DataFrame, as_of) -> DataFrame:
    """One row per elapsed instalment, due every 30 days after origination.

    A narrow explode: each loan expands to at most term_months rows in place.
    """
    n = elapsed(F.col("origination_date"), F.col("term_months"), as_of)
    seq = F.when(n >= 1, F.sequence(F.lit(1), n))
    # Per-loan values are computed once, before the rows multiply.
    per_loan = loans.select(
        "loan_id", "origination_date", seq.alias("_seq"),
        from_cents(instalment_cents(F.col("principal"), F.col("interest_rate"),
                                    F.col("term_months"))).alias("amount_due"))
    return (per_loan.select("loan_id", "origination_date", "amount_due",
                            F.explode("_seq").alias("instalment_no"))
            .select("loan_id", F.col("instalment_no").cast("int").alias("instalment_no"),
                    F.date_add("origination_date", F.col("instalment_no") * DAYS_PER_INSTALMENT)
                    .alias("due_date"),
                    "amount_due"))


# ------------------------------------------------------------------ R4, R5

def payment_delta(amount_paid: Column, days_late: Column) -> Column:
    """Missed (nothing paid, or the amount is missing: its default is 0) +30; late days_late - 5; on time -10."""
    return (F.when(F.coalesce(amount_paid, F.lit(0)) == 0, F.lit(MISSED_DELTA))
            .when(days_late > 0, days_late - LATE_GRACE)
            .otherwise(F.lit(ON_TIME_DELTA))).cast("bigint")


def action_delta(outcome: Column) -> Column:
    return (F.when(outcome == "paid_in_full", F.lit(PAID_IN_FULL_DELTA))
            .when(outcome == "partial_payment", F.lit(PARTIAL_PAYMENT_DELTA))
            .otherwise(F.lit(0))).cast("bigint")


def payment_events(payments: DataFrame) -> DataFrame:
    return payments.select("loan_id", F.col("due_date").alias("event_date"),
                           F.lit(0).alias("kind"), F.col("payment_id").alias("event_id"),
                           payment_delta(F.col("amount_paid"), F.col("days_late")).alias("delta"))


def action_events(actions: DataFrame) -> DataFrame:
    return actions.select("loan_id", F.col("action_date").alias("event_date"),
                          F.lit(1).alias("kind"), F.col("action_id").alias("event_id"),
                          action_delta(F.col("outcome")).alias("delta"))


_ORDER = ["loan_id", "event_date", "kind", "event_id"]     # ascending, NULLs first
_LOAN = ["_no_loan", "_loan"]              # the loan as a key that is never NULL
NO_DAY = -(1 << 31)                        # the day number of a missing date, before every real one


def _placed(events: DataFrame) -> DataFrame:
    """The events dealt out in ranges of (loan, date, kind, id) and written once.

    Ranges hold about equally many events whatever the loan or the day, so a loan
    or a single day with a third of all events lies in many ranges.
    """
    placed = events.repartitionByRange(*_ORDER).withColumn("_range", F.spark_partition_id())
    return materialise(placed.withColumns({
        "_no_loan": F.col("loan_id").isNull(), "_loan": F.coalesce("loan_id", F.lit(0)),
        "_day": F.coalesce(F.unix_date("event_date"), F.lit(NO_DAY))}), "events")


def _with_prefix(placed: DataFrame) -> DataFrame:
    """Inside each (loan, range): prefix sum ``_s``, its running minimum ``_m``, the next event's day ``_next``."""
    order = Window.partitionBy(*_LOAN, "_range").orderBy(*_ORDER[1:])
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (placed.withColumn("_s", F.sum("delta").over(upto)).withColumn("_m", F.min("_s").over(upto))
            .withColumn("_next", F.lead("_day").over(order)))


def _balances(events: DataFrame) -> DataFrame:
    """The events with their ``balance``, and whether they are the last of their loan's day (``_last``).

    With S the running sum, c = S - min(0, min prefix of S). Level 1 works inside
    (loan, range). Only the first and the last loan of a range can go on in
    another, so level 2, what a loan's earlier ranges add up to, has at most about
    two rows per range; that is what bounds its broadcast.
    """
    placed = _placed(events)
    key = F.struct(*_LOAN)
    ends = placed.groupBy("_range").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    ends = ends.select(F.explode(F.array("a", "b")).alias("e")).select("e.*").distinct()
    parts = (_with_prefix(placed.join(F.broadcast(ends), _LOAN, "left_semi"))
             .groupBy(*_LOAN, "_range").agg(F.sum("delta").alias("_t"), F.min("_s").alias("_low"), F.min("_day").alias("_first")))
    ranges = Window.partitionBy(*_LOAN).orderBy("_range")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    parts = (parts.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)))
             .withColumn("_pm", F.min(F.col("_off") + F.col("_low")).over(before))
             .withColumn("_then", F.lead("_first").over(ranges))
             .select(*_LOAN, "_range", "_off", "_pm", "_then"))
    j = _with_prefix(placed).join(F.broadcast(parts), [*_LOAN, "_range"], "left")
    off = F.coalesce("_off", F.lit(0))
    low = F.least(F.coalesce(F.col("_pm"), F.lit(0)), off + F.col("_m"), F.lit(0))
    after = F.coalesce("_next", "_then")
    return j.select(*events.columns, (off + F.col("_s") - low).cast("bigint").alias("balance"),
                    (after.isNull() | (after != F.col("_day"))).alias("_last"))


def clamped_balance(events: DataFrame) -> DataFrame:
    """Running balance c <- max(0, c + delta) per loan, in (date, kind, id) order, NULLs first.

    Events without a loan form a sequence of their own, events without a date come
    first. Returns the events with ``balance`` (bigint).
    """
    return _balances(events).drop("_last")


def end_of_day_balance(events: DataFrame) -> DataFrame:
    """Balance after the last event of each (loan, day): loan_id, event_date, balance."""
    return _balances(events).where("_last").select("loan_id", "event_date", "balance")


def running_delinquency(payments: DataFrame) -> DataFrame:
    """Cumulative days-late balance after each payment."""
    out = clamped_balance(payment_events(payments))
    return out.select(F.col("event_id").alias("payment_id"), "loan_id",
                      F.col("event_date").alias("due_date"), "delta",
                      F.col("balance").alias("delinquency_balance"))


def delinquency_with_actions(payments: DataFrame, actions: DataFrame) -> DataFrame:
    """The balance over payments and collection-action outcomes together;
    on the same day payments come before actions, then by id."""
    ev = payment_events(payments).unionByName(action_events(actions))
    out = clamped_balance(ev)
    return out.select("loan_id", "event_date", "kind", "event_id", "delta",
                      F.col("balance").alias("delinquency_balance"))


# ------------------------------------------------------------------ R6, R7

def escalation_points(payments: DataFrame) -> DataFrame:
    """First date the payment-driven balance reaches each escalation threshold.

    One aggregate per loan with a conditional minimum per threshold (no join to
    a threshold table), unpivoted to (loan, action_type, threshold, date).
    """
    bal = running_delinquency(payments)
    firsts = bal.groupBy("loan_id").agg(*[
        F.min(F.when(F.col("delinquency_balance") >= t, F.col("due_date"))).alias(f"_d{t}")
        for t, _ in ESCALATION])
    stacked = firsts.select("loan_id", F.explode(F.array(*[
        F.struct(F.lit(a).alias("action_type"), F.lit(t).alias("threshold"),
                 F.col(f"_d{t}").alias("escalation_date"))
        for t, a in ESCALATION])).alias("e"))
    return (stacked.select("loan_id", "e.action_type", "e.threshold", "e.escalation_date")
            .where(F.col("escalation_date").isNotNull()))


def derived_status(loans: DataFrame, payments: DataFrame, actions: DataFrame, as_of) -> DataFrame:
    """Defaulted if the end-of-day balance ever reaches 110; else paid_off
    when all instalments have elapsed; else active."""
    ev = payment_events(payments).unionByName(action_events(actions))
    peak = (end_of_day_balance(ev).groupBy("loan_id")
            .agg(F.max("balance").alias("_peak")))
    n = elapsed(F.col("origination_date"), F.col("term_months"), as_of)
    return (loans.select("loan_id", "origination_date", "term_months")
            .join(peak, "loan_id", "left")
            .select("loan_id",
                    F.when(F.coalesce(F.col("_peak"), F.lit(0)) >= DEFAULT_THRESHOLD, "defaulted")
                    .when(n >= F.col("term_months"), "paid_off")
                    .otherwise("active").alias("derived_status")))
