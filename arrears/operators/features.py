"""Feature table, training population and model preparation
(F4, F5, J4, P1, P4-P6, P8-P10, M1, M3, M4).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..functions.scoring import loan_age_months
from ..session import discard, materialise, shuffles_dropped
from .delinquency import LOAN_COLUMNS, PAYMENT_STAT_COLUMNS

CUSTOMER_FEATURES = ["income", "employment_status", "age", "credit_score"]

# A loan without payments has 0 in these columns.
ZERO_FILL = ["late_payment_count", "pct_payments_late", "avg_days_late",
             "max_days_late_ever", "most_recent_days_late"]

# Fixed values of the reference: the frozen model inputs, in order.
NUMERIC_FEATURES = ["principal", "interest_rate", "term_months",
                    "total_payments_made", "late_payment_count", "pct_payments_late",
                    "avg_days_late", "max_days_late_ever", "most_recent_days_late",
                    "income", "age", "credit_score", "loan_age_months"]
# One-hot of employment_status with the first level (Full-time) dropped.
EMPLOYMENT_DUMMIES = ["Part-time", "Retired", "Self-employed", "Unemployed"]
DUMMY_COLUMNS = [f"employment_status_{v}" for v in EMPLOYMENT_DUMMIES]
DESIGN_COLUMNS = NUMERIC_FEATURES + DUMMY_COLUMNS

# Fixed value of the reference: months of history that make an unresolved loan a
# trustworthy negative example.
MATURITY_MONTHS = 18


def loan_features(delinquency: DataFrame, customers: DataFrame, as_of) -> DataFrame:
    """J4 + F5 + P6: one row per loan (the scoring population, P10)."""
    filled = {c: F.coalesce(F.col(c), F.lit(0).cast(delinquency.schema[c].dataType)).alias(c)
              for c in ZERO_FILL}
    joined = delinquency.join(customers.select("customer_id", *CUSTOMER_FEATURES), "customer_id")
    return joined.select(
        *[filled.get(c, F.col(c)) for c in LOAN_COLUMNS + PAYMENT_STAT_COLUMNS],
        *CUSTOMER_FEATURES,
        loan_age_months(F.col("origination_date"), as_of).alias("loan_age_months"),
    )


def scoring_base(loans: DataFrame, customers: DataFrame, as_of) -> DataFrame:
    """Loan and borrower columns of the scoring population, without the payment
    statistics: the same rows as ``loan_features`` (the delinquency view keeps
    every loan exactly once), for consumers that need no payment history."""
    return loans.join(customers.select("customer_id", *CUSTOMER_FEATURES), "customer_id").select(
        *LOAN_COLUMNS, *CUSTOMER_FEATURES,
        loan_age_months(F.col("origination_date"), as_of).alias("loan_age_months"))


def training_mask(maturity_months: float = MATURITY_MONTHS):
    """Resolved loans, or loans observed long enough to trust as negatives.

    NULL ages count as "not mature" (never NULL for the mask itself).
    """
    st = F.col("status")
    return F.coalesce(
        (st == "defaulted") | (st == "paid_off") | (F.col("loan_age_months") >= maturity_months),
        F.lit(False))


def training_population(features: DataFrame, maturity_months: float = MATURITY_MONTHS) -> DataFrame:
    """P4 + P5: training rows with the binary label ``is_default``."""
    return (features.where(training_mask(maturity_months))
            .withColumn("is_default", F.coalesce(F.col("status") == "defaulted", F.lit(False)).cast("int")))


def excluded_population(features: DataFrame, maturity_months: float = MATURITY_MONTHS) -> DataFrame:
    """Young unresolved loans, left out of training."""
    return features.where(~training_mask(maturity_months))


def population_summary(features: DataFrame, maturity_months: float = MATURITY_MONTHS) -> DataFrame:
    """A12 over the populations: sizes and the training default rate (one pass)."""
    m = training_mask(maturity_months)
    d = m & (F.col("status") == "defaulted")
    g = features.agg(F.count(F.lit(1)).alias("n_all"), F.count_if(m).alias("n_training"),
                     F.count_if(d).alias("n_defaulted"))
    return g.select(
        F.col("n_all").cast("bigint").alias("n_all"),
        F.col("n_training").cast("bigint").alias("n_training"),
        F.col("n_defaulted").cast("bigint").alias("n_defaulted"),
        ratio(F.col("n_defaulted"), F.col("n_training"), 3).alias("training_default_rate"),
        (F.col("n_all") - F.col("n_training")).cast("bigint").alias("n_excluded"),
    )


def one_hot_employment(df: DataFrame) -> DataFrame:
    """M1: four 0/1 indicator columns in the frozen order (Full-time is the base)."""
    return df.select("*", *[(F.col("employment_status") == v).cast("int").alias(n)
                            for v, n in zip(EMPLOYMENT_DUMMIES, DUMMY_COLUMNS)])


def split_hash(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def split_cuts(df: DataFrame, label: str = "is_default", id_col: str = "loan_id",
               test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """The last test row of each class: (class, cut_hash, cut_id), from narrow columns written once.

    Returned written; the narrow columns and the shuffles behind them are deleted by then.

    The hashes are uniform, so they are counted in about sqrt(n) equal slots per
    class; a running sum over the slots finds the one that holds the cut, and
    only its rows (about sqrt(n)) are ranked. A label has a handful of classes,
    which bounds the two broadcasts.
    """
    with shuffles_dropped(df.sparkSession):
        keys = materialise(df.select(F.col(label).alias("_class"), F.col(id_col).alias("_id"),
                                     split_hash(id_col, seed).alias("_h")), "split-keys")
        cuts = materialise(_last_of_each_class(keys, test_fraction), "split-cuts")
    discard(keys)
    return cuts


def _last_of_each_class(keys: DataFrame, test_fraction: float) -> DataFrame:
    """``split_cuts`` from (_class, _id, _h)."""
    plan = keys.groupBy("_class").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("_class").alias("_c"), F.ceil(F.col("_n") * F.lit(Decimal(str(test_fraction)))).alias("_n_test"),
        F.ceil(F.sqrt("_n")).cast("bigint").alias("_slots"))
    place = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint")
    keyed = (keys.join(F.broadcast(plan), F.col("_class").eqNullSafe(F.col("_c")))
             .withColumn("_slot", F.shiftright(place * F.col("_slots"), 32)))
    upto = F.sum("_cnt").over(Window.partitionBy("_class").orderBy("_slot"))
    cut = (keyed.groupBy("_class", "_slot").agg(F.count(F.lit(1)).alias("_cnt"), F.first("_n_test").alias("_t"))
           .withColumn("_upto", upto).where((F.col("_upto") - F.col("_cnt") < F.col("_t")) & (F.col("_t") <= F.col("_upto")))
           .select(F.col("_class").alias("_cc"), F.col("_slot").alias("_cs"),
                   (F.col("_t") - (F.col("_upto") - F.col("_cnt"))).alias("_need")))
    rank = F.row_number().over(Window.partitionBy("_class").orderBy("_h", "_id"))
    inside = keyed.join(F.broadcast(cut), F.col("_class").eqNullSafe(F.col("_cc")) & (F.col("_slot") == F.col("_cs")))
    return inside.withColumn("_rank", rank).where(F.col("_rank") == F.col("_need")).select(
        F.col("_class").alias("_at"), F.col("_h").alias("_cut_hash"), F.col("_id").alias("_cut_id"))


def stratified_split(df: DataFrame, label: str = "is_default", id_col: str = "loan_id",
                     test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """M3: deterministic stratified split; adds ``split`` = 'test' / 'train'.

    Within each class rows are ordered by md5(seed:id); the first
    ceil(test_fraction * n_class) rows are the test set. The rows themselves are
    only compared with the cut of their class: no window and no shuffle of them.
    """
    cuts = split_cuts(df, label, id_col, test_fraction, seed)
    h = split_hash(id_col, seed)
    test = (h < F.col("_cut_hash")) | ((h == F.col("_cut_hash")) & (F.col(id_col) <= F.col("_cut_id")))
    return (df.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_at")), "left")
            .select(*df.columns, F.when(test, "test").otherwise("train").alias("split")))


def class_weights(split_df: DataFrame, label: str = "is_default") -> DataFrame:
    """M4: balanced weights n / (2 * n_class) on the training split."""
    counts = (split_df.where(F.col("split") == "train").groupBy(label)
              .agg(F.count(F.lit(1)).cast("bigint").alias("n_class")))
    total = F.sum("n_class").over(Window.partitionBy(F.lit(0)))  # <= 2 rows
    return counts.select(label, "n_class",
                         (total.cast("double") / (F.col("n_class") * 2).cast("double"))
                         .alias("class_weight"))


def with_class_weight(split_df: DataFrame, weights: DataFrame, label: str = "is_default") -> DataFrame:
    """Attach ``class_weight`` (weights has at most two rows: broadcast)."""
    return split_df.join(F.broadcast(weights.select(label, "class_weight")), label, "left")
