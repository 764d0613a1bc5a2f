"""Per-loan delinquency snapshot (A13) and latest payment per loan.

Plan: aggregate payments by loan_id first (partial aggregation before the
shuffle, so a loan with a huge history collapses map-side), then LEFT JOIN the
loans. The aggregate's output is already hash-partitioned on loan_id, so the
sort-merge join only exchanges the loans side. The "latest payment" scalar
subquery becomes one more aggregate in the same pass: the maximum of a packed
long key (due date, days late), which keeps HashAggregate + codegen instead of
a second scan, a window, or a SortAggregate on a struct key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import idiv, ratio

_SHIFT = 4294967296       # 2**32
_OFFSET = 2147483648      # 2**31: maps any int days_late into [0, 2**32)

LOAN_COLUMNS = ["loan_id", "customer_id", "status", "principal", "interest_rate",
                "term_months", "origination_date"]
PAYMENT_STAT_COLUMNS = ["total_payments_made", "late_payment_count", "pct_payments_late",
                        "avg_days_late", "max_days_late_ever", "most_recent_days_late"]


def recency_key(due_date: Column, days_late: Column) -> Column:
    """Total order on (due_date, days_late) packed in one long; NULL if either is NULL."""
    return (F.unix_date(due_date).cast("bigint") * _SHIFT
            + (days_late.cast("bigint") + _OFFSET))


def days_late_of(key: Column) -> Column:
    return (F.pmod(key, F.lit(_SHIFT)) - _OFFSET).cast("int")


def date_of(key: Column) -> Column:
    return F.date_from_unix_date(idiv(key - F.pmod(key, F.lit(_SHIFT)), _SHIFT).cast("int"))


def payment_stats(payments: DataFrame) -> DataFrame:
    """One row per loan with payments: counts, sums and the latest-payment key."""
    dl = F.col("days_late")
    return payments.groupBy("loan_id").agg(
        # payment_id is the NOT NULL primary key, so COUNT(payment_id) = COUNT(*);
        # not referencing it lets the optimizer drop any id computation upstream.
        F.count(F.lit(1)).alias("n_pay"),
        F.count_if(dl > 0).alias("n_late"),
        F.sum(dl.cast("bigint")).alias("sum_late"),
        F.count(dl).alias("n_late_vals"),
        F.max(dl).alias("max_late"),
        F.max(recency_key(F.col("due_date"), dl)).alias("recent_key"),
    )


def loan_delinquency(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """The delinquency view: one row per loan, loans without payments kept."""
    return with_stats(loans, payment_stats(payments))


def with_stats(loans: DataFrame, stats: DataFrame) -> DataFrame:
    """The view from the loans and their ``payment_stats``."""
    n = F.coalesce(F.col("n_pay"), F.lit(0)).cast("bigint")
    late = F.coalesce(F.col("n_late"), F.lit(0)).cast("bigint")
    return (
        loans.select(*LOAN_COLUMNS)
        .join(stats, "loan_id", "left")
        .select(
            *LOAN_COLUMNS,
            n.alias("total_payments_made"),
            late.alias("late_payment_count"),
            ratio(late, F.greatest(n, F.lit(1)), 3).alias("pct_payments_late"),
            ratio(F.col("sum_late"), F.col("n_late_vals"), 1).alias("avg_days_late"),
            F.col("max_late").cast("int").alias("max_days_late_ever"),
            days_late_of(F.col("recent_key")).alias("most_recent_days_late"),
        )
    )


def latest_payment(payments: DataFrame) -> DataFrame:
    """Latest payment per loan (top-1 by due date, ties by larger days_late)."""
    key = F.max(recency_key(F.col("due_date"), F.col("days_late"))).alias("k")
    return payments.groupBy("loan_id").agg(key).select(
        "loan_id",
        date_of(F.col("k")).alias("latest_due_date"),
        days_late_of(F.col("k")).alias("most_recent_days_late"),
    )
