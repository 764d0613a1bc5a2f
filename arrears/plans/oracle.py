"""Independent SQL formulations of the registered queries (DuckDB dialect).

Each text runs on the driver's test tables (customer, orders, lineitem, ...),
rebuilding the four domain tables with the fixture mapping of FIXTURES.md as
CTEs, then states the result from its definition. Ratios and money use the same
integer half-up forms as the Spark code, since double rounding differs between
engines near ties.
"""

from __future__ import annotations

# Fixture mapping from the driver's tables to the domain tables (FIXTURES.md §2).
CTE_CUSTOMERS = """customers AS (
  select c_custkey as customer_id,
    cast((cast(c_acctbal as decimal(12,2)) + 1000) * 20 + 25000 as decimal(12,2)) as income,
    case c_mktsegment when 'AUTOMOBILE' then 'Full-time' when 'BUILDING' then 'Part-time'
      when 'FURNITURE' then 'Self-employed' when 'HOUSEHOLD' then 'Retired' else 'Unemployed' end as employment_status,
    cast(21 + c_custkey % 49 as int) as age, n_name as city, r_name as state,
    cast(300 + (c_custkey * 7919) % 551 as int) as credit_score
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

CTE_LOANS = """loans AS (
  select o_orderkey as loan_id, o_custkey as customer_id, cast(o_totalprice as decimal(12,2)) as principal,
    cast(0.0450 + 0.0150 * cast(substr(o_orderpriority,1,1) as int) as decimal(5,4)) as interest_rate,
    cast(12 * (1 + o_orderkey % 5) as int) as term_months, cast(o_orderdate as date) as origination_date,
    case o_orderstatus when 'F' then 'paid_off' when 'P' then 'defaulted' else 'active' end as status
  from orders)"""

CTE_PAYMENTS = """payment_history AS (
  select l_orderkey * 100 + row_number() over (partition by l_orderkey
      order by l_shipdate, l_quantity, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as payment_id,
    l_orderkey as loan_id, cast(l_shipdate as date) as due_date, cast(l_extendedprice as decimal(12,2)) as amount_due,
    cast(case when l_returnflag = 'R' then cast(0 as decimal(18,4))
      else cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) end as decimal(12,2)) as amount_paid,
    cast(case l_returnflag when 'N' then 0 when 'A' then l_quantity else greatest(30, 2 * l_quantity) end as int) as days_late
  from lineitem)"""

CTE_ACTIONS = """collection_actions AS (
  select event_id as action_id, user_id * 100 + event_id % 100 as loan_id,
    cast(date '1995-06-01' + cast((event_id * 13) % 2300 as int) as date) as action_date,
    case event_type when 'view' then 'phone_call' when 'signup' then 'payment_plan'
      when 'error' then 'legal_notice' else 'reminder_email' end as action_type,
    cast(case event_type when 'view' then 15 when 'signup' then 40 when 'error' then 150 else 2 end as decimal(10,2)) as cost,
    case when value < 10 then 'paid_in_full' when value < 25 then 'partial_payment'
      when value < 60 then 'promised_to_pay' else 'no_response' end as outcome
  from events)"""

_CTES = {"customers": CTE_CUSTOMERS, "loans": CTE_LOANS,
         "payment_history": CTE_PAYMENTS, "collection_actions": CTE_ACTIONS}


def with_book(body: str, *tables: str, extra: str = "", recursive: bool = False) -> str:
    """Prefix ``body`` with the domain-table CTEs it uses (plus extra CTEs)."""
    parts = [_CTES[t] for t in tables]
    if extra:
        parts.append(extra.strip().rstrip(","))
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body


def walk_ctes(src: str, tag: str) -> str:
    """The clamped balance as the plain loop c <- max(0, c + delta), one
    recursive step per event of a loan in (date, kind, id) order. Independent
    of the prefix-sum identity the Spark code uses. Defines ``walked_{tag}``."""
    return f"""walk_ev_{tag} AS (
  SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY event_date NULLS FIRST, kind, event_id) AS step
  FROM {src}),
walk_{tag}(loan_id, step, bal) AS (
  SELECT loan_id, step, CAST(greatest(0, delta) AS BIGINT) FROM walk_ev_{tag} WHERE step = 1
  UNION ALL
  SELECT e.loan_id, e.step, CAST(greatest(0, w.bal + e.delta) AS BIGINT)
  FROM walk_{tag} w JOIN walk_ev_{tag} e ON e.loan_id IS NOT DISTINCT FROM w.loan_id AND e.step = w.step + 1),
walked_{tag} AS (
  SELECT e.*, w.bal AS delinquency_balance
  FROM walk_ev_{tag} e JOIN walk_{tag} w ON e.loan_id IS NOT DISTINCT FROM w.loan_id AND e.step = w.step)"""


def half_up(num: str, den: str, scale: int) -> str:
    """round(num/den, scale) half away from zero for num >= 0, den > 0, as double."""
    m = 10 ** scale
    return (f"(CAST(({m * 2} * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / CAST({m} AS DOUBLE))")
