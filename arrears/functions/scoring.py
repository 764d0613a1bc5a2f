"""Column expressions shared by several operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference: credit-score band labels and their upper cut points.
BAND_SUBPRIME = "300-579 (Subprime)"
BAND_FAIR = "580-669 (Fair)"
BAND_GOOD = "670-739 (Good)"
BAND_PRIME = "740-850 (Prime)"

# Fixed values of the reference: risk-tier thresholds (inclusive lower bounds).
HIGH_RISK_THRESHOLD = 0.50
MEDIUM_RISK_THRESHOLD = 0.20


def credit_band(score: Column) -> Column:
    """Searched CASE into four bands; NULL falls into the last band, as in SQL."""
    return (F.when(score < 580, BAND_SUBPRIME)
            .when(score < 670, BAND_FAIR)
            .when(score < 740, BAND_GOOD)
            .otherwise(BAND_PRIME))


def risk_tier(p: Column, high: float = HIGH_RISK_THRESHOLD,
              medium: float = MEDIUM_RISK_THRESHOLD) -> Column:
    return F.when(p >= high, "High").when(p >= medium, "Medium").otherwise("Low")


def as_of_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def loan_age_months(origination: Column, as_of) -> Column:
    """Age in 30-day months, one decimal: ``round(days / 30, 1)``.

    days/30 never falls on a rounding tie at one decimal (days/3 never ends in
    .5), so double rounding is exact here.
    """
    return F.round(F.datediff(as_of_date(as_of), origination) / F.lit(30.0), 1)
