"""Map the driver's TPC-H-like test tables onto the four domain tables.

The mapping is test-fixture plumbing (see FIXTURES.md §2): it is the only place
that knows the driver's table names. Everything downstream sees customers,
loans, payment_history and collection_actions with the declared schemas.
All mappings are narrow projections except two small dimension joins
(nation, region) and the payment id, a sequence number within each order.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import cached_property
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import row_number_within
from .schemas import TABLES


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    # Spark broadcasts nation and region as long as their files are small.
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    segment = F.col("c_mktsegment")
    out = (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, F.col("n_regionkey") == r.r_regionkey)
        .select(
            F.col("c_custkey").cast("bigint").alias("customer_id"),
            ((F.col("c_acctbal").cast("decimal(12,2)") + 1000) * 20 + 25000)
            .cast("decimal(12,2)").alias("income"),
            F.when(segment == "AUTOMOBILE", "Full-time")
            .when(segment == "BUILDING", "Part-time")
            .when(segment == "FURNITURE", "Self-employed")
            .when(segment == "HOUSEHOLD", "Retired")
            .otherwise("Unemployed").alias("employment_status"),
            (F.lit(21) + F.col("c_custkey") % 49).cast("int").alias("age"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            (F.lit(300) + (F.col("c_custkey") * 7919) % 551).cast("int").alias("credit_score"),
        )
    )
    return out


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").cast("bigint").alias("loan_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("principal"),
        (F.lit(Decimal("0.0450"))
         + F.lit(Decimal("0.0150")) * F.substring("o_orderpriority", 1, 1).cast("int"))
        .cast("decimal(5,4)").alias("interest_rate"),
        (F.lit(12) * (F.lit(1) + F.col("o_orderkey") % 5)).cast("int").alias("term_months"),
        F.col("o_orderdate").cast("date").alias("origination_date"),
        F.when(st == "F", "paid_off").when(st == "P", "defaulted").otherwise("active")
        .alias("status"),
    )


def payment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").withColumn("_due", F.col("l_shipdate").cast("date"))
    # payment_id = order key * 100 + position of the line within its order by
    # (ship date, quantity, line number, part, supplier, price). The position is
    # numbered per (order, day) and offset by the order's earlier days, so an
    # order with a huge number of lines is still spread over many tasks; the
    # rows come out partitioned by (loan, due date) for the per-day steps.
    li = row_number_within(li, "l_orderkey", "_due",
                           ["l_shipdate", "l_quantity", "l_linenumber", "l_partkey", "l_suppkey",
                            "l_extendedprice"], name="_seq")
    flag = F.col("l_returnflag")
    paid = F.when(flag == "R", F.lit(Decimal("0")).cast("decimal(18,4)")).otherwise(
        F.col("l_extendedprice").cast("decimal(12,2)")
        * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("_seq")).cast("bigint").alias("payment_id"),
        F.col("l_orderkey").cast("bigint").alias("loan_id"),
        F.col("_due").alias("due_date"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount_due"),
        paid.cast("decimal(12,2)").alias("amount_paid"),
        F.when(flag == "N", F.lit(0).cast("double"))
        .when(flag == "A", F.col("l_quantity"))
        .otherwise(F.greatest(F.lit(30).cast("double"), 2 * F.col("l_quantity")))
        .cast("int").alias("days_late"),
    )


def collection_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    et = F.col("event_type")
    v = F.col("value")
    return e.select(
        F.col("event_id").cast("bigint").alias("action_id"),
        (F.col("user_id") * 100 + F.col("event_id") % 100).cast("bigint").alias("loan_id"),
        F.date_add(F.lit(_dt.date(1995, 6, 1)), ((F.col("event_id") * 13) % 2300).cast("int"))
        .alias("action_date"),
        F.when(et == "view", "phone_call").when(et == "signup", "payment_plan")
        .when(et == "error", "legal_notice").otherwise("reminder_email").alias("action_type"),
        F.when(et == "view", 15).when(et == "signup", 40).when(et == "error", 150)
        .otherwise(2).cast("decimal(10,2)").alias("cost"),
        F.when(v < 10, "paid_in_full").when(v < 25, "partial_payment")
        .when(v < 60, "promised_to_pay").otherwise("no_response").alias("outcome"),
    )


@dataclass
class Book:
    """The four domain tables of one lending book (lazy DataFrames)."""

    customers: DataFrame
    loans: DataFrame
    payments: DataFrame
    actions: DataFrame

    def table(self, name: str) -> DataFrame:
        return {"customers": self.customers, "loans": self.loans,
                "payment_history": self.payments, "collection_actions": self.actions}[name]

    def items(self):
        return [(n, self.table(n)) for n in TABLES]


class TestdataBook(Book):
    """A Book whose tables are built from the test tables on first use, so a
    query touching only the actions never plans (or checks) the others."""

    def __init__(self, spark: SparkSession, sf_dir: str):  # noqa: D107
        self._spark, self._dir = spark, sf_dir

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self._spark, self._dir)

    @cached_property
    def loans(self) -> DataFrame:
        return loans(self._spark, self._dir)

    @cached_property
    def payments(self) -> DataFrame:
        return payment_history(self._spark, self._dir)

    @cached_property
    def actions(self) -> DataFrame:
        return collection_actions(self._spark, self._dir)


def book_from_testdata(spark: SparkSession, sf_dir: str) -> Book:
    return TestdataBook(spark, sf_dir)
