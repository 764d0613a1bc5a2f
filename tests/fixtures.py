"""Hand-written domain rows for edge cases (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from arrears.sources.schemas import COLLECTION_ACTIONS, CUSTOMERS, LOANS, PAYMENT_HISTORY

AS_OF = dt.date(2024, 12, 31)
D = Decimal


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def customers(spark, rows):
    """rows: (customer_id, income, employment_status, credit_score)."""
    return spark.createDataFrame(
        [(cid, D(str(inc)), emp, 40, "C", "S", cs) for cid, inc, emp, cs in rows], CUSTOMERS.schema)


def loans(spark, rows):
    """rows: (loan_id, customer_id, principal, term, origination, status)."""
    return spark.createDataFrame(
        [(lid, cid, D(str(p)), D("0.1000"), term, orig, st) for lid, cid, p, term, orig, st in rows],
        LOANS.schema)


def payments(spark, rows):
    """rows: (payment_id, loan_id, due_date, amount_paid, days_late)."""
    return spark.createDataFrame(
        [(pid, lid, due, D("100.00"), D(str(paid)), late) for pid, lid, due, paid, late in rows],
        PAYMENT_HISTORY.schema)


def actions(spark, rows):
    """rows: (action_id, loan_id, action_date, action_type, outcome)."""
    return spark.createDataFrame(
        [(aid, lid, day, at, D("2.00"), out) for aid, lid, day, at, out in rows],
        COLLECTION_ACTIONS.schema)
