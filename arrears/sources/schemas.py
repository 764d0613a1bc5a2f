"""Declared schemas of the four domain tables and their keys.

Schemas are declared, never inferred. Every column is NOT NULL in the domain
model; ``nullable`` stays True in the StructTypes so that quality checks (S8)
can count violations instead of failing the read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: str
    # column -> default applied when the value is missing
    defaults: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMERS = TableSpec(
    "customers",
    _s(("customer_id", T.LongType()), ("income", T.DecimalType(12, 2)),
       ("employment_status", T.StringType()), ("age", T.IntegerType()),
       ("city", T.StringType()), ("state", T.StringType()),
       ("credit_score", T.IntegerType())),
    "customer_id",
)

LOANS = TableSpec(
    "loans",
    _s(("loan_id", T.LongType()), ("customer_id", T.LongType()),
       ("principal", T.DecimalType(12, 2)), ("interest_rate", T.DecimalType(5, 4)),
       ("term_months", T.IntegerType()), ("origination_date", T.DateType()),
       ("status", T.StringType())),
    "loan_id",
    {"status": "active"},
)

PAYMENT_HISTORY = TableSpec(
    "payment_history",
    _s(("payment_id", T.LongType()), ("loan_id", T.LongType()),
       ("due_date", T.DateType()), ("amount_due", T.DecimalType(12, 2)),
       ("amount_paid", T.DecimalType(12, 2)), ("days_late", T.IntegerType())),
    "payment_id",
    {"amount_paid": 0, "days_late": 0},
)

COLLECTION_ACTIONS = TableSpec(
    "collection_actions",
    _s(("action_id", T.LongType()), ("loan_id", T.LongType()),
       ("action_date", T.DateType()), ("action_type", T.StringType()),
       ("cost", T.DecimalType(10, 2)), ("outcome", T.StringType())),
    "action_id",
)

# Parent-first load order (a child never lands before its parent).
TABLES: dict[str, TableSpec] = {
    t.name: t for t in (CUSTOMERS, LOANS, PAYMENT_HISTORY, COLLECTION_ACTIONS)
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("loans", "customer_id", "customers", "customer_id"),
    ("payment_history", "loan_id", "loans", "loan_id"),
    ("collection_actions", "loan_id", "loans", "loan_id"),
]

# Fixed value domains of the reference (text columns, no CHECK constraints there).
ACTION_TYPES = ["reminder_email", "phone_call", "payment_plan", "legal_notice"]
OUTCOMES = ["paid_in_full", "partial_payment", "promised_to_pay", "no_response"]
SUCCESS_OUTCOMES = ["paid_in_full", "partial_payment"]
EMPLOYMENT_STATUSES = ["Full-time", "Part-time", "Self-employed", "Unemployed", "Retired"]
