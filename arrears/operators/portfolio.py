"""Portfolio analysis queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, ratio_units
from ..functions.scoring import credit_band
from ..sources.schemas import SUCCESS_OUTCOMES


def action_success_counts(actions: DataFrame) -> DataFrame:
    """action_type, total_actions, successes (successes = paid in full or partial)."""
    return actions.groupBy("action_type").agg(
        F.count(F.lit(1)).alias("total_actions"),
        F.count_if(F.col("outcome").isin(*SUCCESS_OUTCOMES)).alias("successes"),
    )


def action_success_rates(actions: DataFrame) -> DataFrame:
    """Historical success rate per action type, best first."""
    c = action_success_counts(actions)
    return (c.select(
        "action_type",
        F.col("total_actions").cast("bigint").alias("total_actions"),
        ratio(F.col("successes"), F.col("total_actions"), 3).alias("success_rate"),
    ).orderBy(F.desc("success_rate"), "action_type"))


def success_rate_permille(actions: DataFrame) -> DataFrame:
    """Rates as integer thousandths (exactly the 3-decimal rate), for R10."""
    c = action_success_counts(actions)
    return c.select("action_type",
                    ratio_units(F.col("successes"), F.col("total_actions"), 3)
                    .alias("rate_permille"))


def default_rate_by_credit_band(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Default rate per credit-score band, bands in score order.

    Loans are first reduced to one row per customer (partial aggregation
    before the shuffle: a customer holding a third of all loans collapses
    map-side), then joined to the customers on the already-partitioned key.
    """
    per_customer = loans.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") == "defaulted").alias("n_def"),
    )
    joined = per_customer.join(customers.select("customer_id", "credit_score"), "customer_id")
    grouped = joined.groupBy(credit_band(F.col("credit_score")).alias("credit_score_band")).agg(
        F.sum("n").cast("bigint").alias("total_loans"),
        F.sum("n_def").cast("bigint").alias("defaulted_loans"),
        F.min("credit_score").alias("_min_score"),
    )
    return (grouped.select(
        "credit_score_band", "total_loans", "defaulted_loans",
        ratio(F.col("defaulted_loans"), F.col("total_loans"), 3).alias("default_rate"),
        "_min_score",
    ).orderBy("_min_score").drop("_min_score"))


def status_mix(loans: DataFrame) -> DataFrame:
    """A10: frequency table of loan status, most frequent first."""
    return (loans.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("loan_count"))
            .orderBy(F.desc("loan_count"), "status"))


def success_flag_mean(actions: DataFrame) -> DataFrame:
    """Mean of the success flag per action type, rounded to 3 decimals."""
    flag = F.col("outcome").isin(*SUCCESS_OUTCOMES).cast("int")
    g = actions.groupBy("action_type").agg(F.sum(flag).alias("s"), F.count(flag).alias("n"))
    return g.select("action_type", ratio(F.col("s"), F.col("n"), 3).alias("success_mean"))


def portfolio_summary(customers: DataFrame, loans: DataFrame, payments: DataFrame,
                      actions: DataFrame) -> DataFrame:
    """One-row summary of the book.

    The four tables are projected to one tag column each and unioned, so a
    single global aggregate (partial per task, one tiny final merge) counts
    everything; no cross join of per-table results.
    """
    tagged = (
        customers.select(F.lit(0).alias("src"), F.lit(None).cast("string").alias("status"))
        .unionByName(loans.select(F.lit(1).alias("src"), F.col("status")))
        .unionByName(payments.select(F.lit(2).alias("src"), F.lit(None).cast("string").alias("status")))
        .unionByName(actions.select(F.lit(3).alias("src"), F.lit(None).cast("string").alias("status")))
    )
    src = F.col("src")
    agg = tagged.agg(
        F.count_if(src == 0).alias("n_customers"),
        F.count_if(src == 1).alias("n_loans"),
        F.count_if(src == 2).alias("n_payments"),
        F.count_if(src == 3).alias("n_actions"),
        F.count_if((src == 1) & (F.col("status") == "defaulted")).alias("n_defaulted"),
    )
    return agg.select(
        *[F.col(c).cast("bigint").alias(c) for c in
          ["n_customers", "n_loans", "n_payments", "n_actions", "n_defaulted"]],
        ratio(F.col("n_defaulted"), F.col("n_loans"), 3).alias("default_rate"),
    )
