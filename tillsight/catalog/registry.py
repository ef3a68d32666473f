"""Registration of queries and building blocks for their expected-result SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under a name, with its SQL if there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


RETAIL_SQL = """
SELECT o.o_custkey AS customer_id,
  CAST(18 + c.c_custkey % 53 AS INT) AS age,
  CASE WHEN c.c_custkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  p.p_name AS item_purchased, p.p_type AS category,
  CAST(l.l_extendedprice AS DECIMAL(12,2)) AS purchase_amount,
  n.n_name AS location,
  CASE WHEN p.p_size <= 12 THEN 'S' WHEN p.p_size <= 25 THEN 'M'
       WHEN p.p_size <= 38 THEN 'L' ELSE 'XL' END AS size,
  p.p_brand AS color,
  CASE WHEN EXTRACT(MONTH FROM l.l_shipdate) IN (12, 1, 2) THEN 'Winter'
       WHEN EXTRACT(MONTH FROM l.l_shipdate) IN (3, 4, 5) THEN 'Spring'
       WHEN EXTRACT(MONTH FROM l.l_shipdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  CAST(CAST(25 + (l.l_partkey * 7 + l.l_linenumber) % 26 AS DOUBLE) / 10 AS DECIMAL(2,1)) AS review_rating,
  CASE WHEN c.c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS subscription_status,
  o.o_orderpriority AS shipping_type,
  CASE WHEN l.l_discount > 0.05 THEN 'Yes' ELSE 'No' END AS discount_applied,
  CASE WHEN l.l_tax > 0.04 THEN 'Yes' ELSE 'No' END AS promo_code_used,
  CAST(GREATEST(0, FLOOR(c.c_acctbal / 200)) AS INT) AS previous_purchases,
  l.l_returnflag || l.l_linestatus AS payment_method,
  c.c_mktsegment AS frequency_of_purchases,
  l.l_orderkey AS order_id
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

PURCHASE_STREAM_SQL = """
SELECT event_id, ts AS event_time, user_id AS customer_id,
  CAST(18 + user_id % 53 AS INT) AS age,
  CASE WHEN user_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  'item-' || CAST(event_id % 25 AS VARCHAR) AS item_purchased,
  event_type AS category,
  CAST(value AS DECIMAL(12,2)) AS purchase_amount,
  CAST(CAST(25 + event_id % 26 AS DOUBLE) / 10 AS DECIMAL(2,1)) AS review_rating,
  CASE WHEN user_id % 4 = 0 THEN 'Yes' ELSE 'No' END AS subscription_status,
  CASE WHEN event_id % 3 = 0 THEN 'Yes' ELSE 'No' END AS discount_applied,
  CAST(user_id % 50 AS INT) AS previous_purchases,
  event_type AS payment_method
FROM events
"""

GAPPY_STREAM_SQL = f"""
SELECT event_id, event_time, customer_id, gender, item_purchased, category, review_rating,
  CASE WHEN event_id % 17 <> 0 THEN purchase_amount END AS purchase_amount,
  CASE WHEN event_id % 23 <> 0 THEN age END AS age,
  event_time + CAST(event_id % 7 AS INT) * INTERVAL 1 SECOND AS processing_time,
  subscription_status, discount_applied, previous_purchases, payment_method
FROM ({PURCHASE_STREAM_SQL})
"""


def _over(name: str, source: str, body: str, ctes: dict[str, str]) -> str:
    parts = [f"{name} AS ({source})"] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return "WITH " + ", ".join(parts) + " " + body


def on_retail(body: str, **ctes: str) -> str:
    return _over("retail", RETAIL_SQL, body, ctes)


def on_purchases(body: str, **ctes: str) -> str:
    return _over("purchases", PURCHASE_STREAM_SQL, body, ctes)


def on_gappy(body: str, **ctes: str) -> str:
    return _over("purchases", GAPPY_STREAM_SQL, body, ctes)


def rnd(x: str, digits: int = 2) -> str:
    s = f"1e{digits}"
    return f"(SIGN({x}) * FLOOR(ABS({x}) * {s} + 5e-1) / {s} + 0e0)"


def avg(x: str, digits: int | None = 2) -> str:
    plain = f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"
    return plain if digits is None else rnd(plain, digits)


def pct(num: str, den: str, digits: int = 2) -> str:
    return rnd(f"(CAST({num} AS DOUBLE) * 1e2 / NULLIF(CAST({den} AS DOUBLE), 0e0))", digits)


def share(condition: str, digits: int = 2) -> str:
    return pct(f"COUNT(CASE WHEN {condition} THEN 1 END)", "COUNT(*)", digits)


def tot(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE)"


def sd(x: str, digits: int = 2) -> str:
    return rnd(f"STDDEV_SAMP(CAST({x} AS DOUBLE))", digits)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def age_case(bounds: list[tuple[int, str]], rest: str, null_label: str | None = None, col: str = "age") -> str:
    null = "NULL" if null_label is None else f"'{null_label}'"
    whens = " ".join(f"WHEN {col} < {b} THEN '{label}'" for b, label in bounds)
    return f"CASE WHEN {col} IS NULL THEN {null} {whens} ELSE '{rest}' END"


SIX_AGES = age_case(
    [
        (25, "18-24 (Gen Z)"),
        (35, "25-34 (Millennials)"),
        (45, "35-44 (Gen X)"),
        (55, "45-54 (Gen X)"),
        (65, "55-64 (Boomers)"),
    ],
    "65+ (Seniors)",
    "65+ (Seniors)",
)
_FIVE = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
FIVE_AGES = age_case(_FIVE, "55+")
FIVE_AGES_OPEN = age_case(_FIVE, "55+", "55+")
DECADES = age_case(
    [(20, "Under 20"), (30, "20-29"), (40, "30-39"), (50, "40-49"), (60, "50-59")], "60+"
)
LOYALTY = (
    "CASE WHEN previous_purchases = 0 THEN 'New Customer' WHEN previous_purchases BETWEEN 1 AND 10 THEN 'Regular (1-10)' "
    "WHEN previous_purchases BETWEEN 11 AND 25 THEN 'Loyal (11-25)' WHEN previous_purchases > 25 THEN 'VIP (25+)' END"
)


def quantile(source: str, group: str, value: str, probs: dict[str, float]) -> str:
    """Interpolated quantiles spelled out by position, so that no engine's rounding enters."""
    picks = []
    for name, p in probs.items():
        at = f"({p}e0 * (n - 1))"
        lo = f"MAX(CASE WHEN pos = FLOOR({at}) THEN v END)"
        hi = f"MAX(CASE WHEN pos = CEIL({at}) THEN v END)"
        picks.append(f"{lo} + ({hi} - {lo}) * (MAX({at}) - FLOOR(MAX({at}))) AS {name}")
    return (
        f"SELECT {group}, {', '.join(picks)} FROM (SELECT {group}, CAST({value} AS DOUBLE) AS v, "
        f"ROW_NUMBER() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS pos, "
        f"COUNT(*) OVER (PARTITION BY {group}) AS n FROM {source} WHERE {value} IS NOT NULL) GROUP BY {group}"
    )
