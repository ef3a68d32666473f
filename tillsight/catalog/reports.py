"""The business reports and the exploratory frames."""

from __future__ import annotations

from ..plans import explore, reports
from ..sources.files import read_csv, save
from ..sources.retail import from_flat_file, retail, to_display_names
from ..sources.shared import shared_folder
from .registry import (
    DECADES,
    FIVE_AGES,
    FIVE_AGES_OPEN,
    LOYALTY,
    ORACLE,
    SIX_AGES,
    avg,
    on_retail,
    pct,
    quantile,
    query,
    rnd,
    sd,
    share,
    tot,
)

AMOUNT, RATING, HISTORY = "purchase_amount", "review_rating", "previous_purchases"
_SUBSCRIBED = "subscription_status = 'Yes'"
_DISCOUNTED = "discount_applied = 'Yes'"
_MALE, _FEMALE = "gender = 'Male'", "gender = 'Female'"
_S_YES = "s = 'Yes'"


def _low_high(a: str = "min_purchase", b: str = "max_purchase") -> str:
    return f"CAST(MIN({AMOUNT}) AS DOUBLE) AS {a}, CAST(MAX({AMOUNT}) AS DOUBLE) AS {b}"


def _report(name: str, plan, sql: str) -> None:
    query(name, sql)(lambda spark, sf_dir: plan(retail(spark, sf_dir)))


_report(
    "report_top_categories",
    reports.top_categories,
    on_retail(
        "SELECT age_group, category, purchase_count, total_revenue, avg_purchase, avg_rating, percentage_of_age_group, CAST(popularity_rank AS INT) AS popularity_rank "
        f"FROM (SELECT *, {pct('purchase_count', 'SUM(purchase_count) OVER (PARTITION BY age_group)')} AS percentage_of_age_group, "
        "ROW_NUMBER() OVER (PARTITION BY age_group ORDER BY purchase_count DESC, category) AS popularity_rank FROM stats) "
        "WHERE popularity_rank <= 3 ORDER BY age_group, popularity_rank",
        stats=f"SELECT {SIX_AGES} AS age_group, category, COUNT(*) AS purchase_count, {tot(AMOUNT)} AS total_revenue, "
        f"{avg(AMOUNT)} AS avg_purchase, {avg(RATING)} AS avg_rating FROM retail GROUP BY 1, 2",
    ),
)



@query("report_from_flat_file", ORACLE["report_top_categories"])
def report_from_flat_file(spark, sf_dir):
    """From the flat file to the report: CSV with its header, read back with its schema, own names, top categories."""
    flat = to_display_names(retail(spark, sf_dir).drop("order_id"))
    path = shared_folder(spark)
    save(flat, path, "csv")
    return reports.top_categories(from_flat_file(read_csv(spark, path, flat.schema)))


_report(
    "report_subscription_frequency",
    reports.subscription_frequency,
    on_retail(
        "SELECT subscription_status, frequency_of_purchases, n AS customer_count, "
        f"{pct('n', 'SUM(n) OVER g')} AS pct_of_subscribers, {rnd('amount')} AS avg_purchase_amount, "
        f"{rnd('history')} AS avg_historical_purchases, avg_rating, avg_age, {rnd('(AVG(amount) OVER g)')} AS group_avg_purchase, "
        f"{rnd('(AVG(history) OVER g)')} AS group_avg_history FROM detail WINDOW g AS (PARTITION BY subscription_status)",
        detail=f"SELECT subscription_status, frequency_of_purchases, COUNT(*) AS n, {avg(AMOUNT, None)} AS amount, "
        f"{avg(HISTORY, None)} AS history, {avg(RATING)} AS avg_rating, {avg('age', 1)} AS avg_age FROM retail GROUP BY 1, 2",
    ),
)

_report(
    "report_subscription_summary",
    reports.subscription_summary,
    on_retail(
        f"SELECT subscription_status, COUNT(*) AS customers, {avg(AMOUNT)} AS avg_purchase, {avg(HISTORY)} AS avg_loyalty "
        "FROM retail GROUP BY 1 ORDER BY 1 DESC"
    ),
)

_report(
    "report_discount_promo",
    reports.discount_promo,
    on_retail(
        f"SELECT discount_applied, promo_code_used, n AS transaction_count, {rnd('amount')} AS avg_purchase, min_purchase, max_purchase, "
        f"stddev_purchase, total_revenue, avg_rating, subscriber_rate, {pct('n', '(SELECT COUNT(*) FROM retail)')} AS market_share_pct, "
        f"{rnd('((amount - base) / base * 1e2)')} AS vs_baseline_pct FROM stats, (SELECT {avg(AMOUNT, None)} AS base FROM retail "
        "WHERE discount_applied = 'No' AND promo_code_used = 'No') ORDER BY n DESC",
        stats=f"SELECT discount_applied, promo_code_used, COUNT(*) AS n, {avg(AMOUNT, None)} AS amount, {_low_high()}, "
        f"{sd(AMOUNT)} AS stddev_purchase, {tot(AMOUNT)} AS total_revenue, {avg(RATING)} AS avg_rating, "
        f"{share(_SUBSCRIBED)} AS subscriber_rate FROM retail GROUP BY 1, 2",
    ),
)

_report(
    "report_payment",
    reports.payment_performance,
    on_retail(
        f"SELECT s.payment_method, n AS transaction_count, avg_purchase, {rnd('m.median')} AS median_purchase, min_purchase, max_purchase, "
        f"stddev, total_revenue, avg_rating, avg_customer_age, subscriber_rate, {pct('n', 'SUM(n) OVER ()')} AS market_share, "
        "CAST(RANK() OVER (ORDER BY avg_purchase DESC) AS INT) AS spending_rank, CAST(RANK() OVER (ORDER BY n DESC) AS INT) AS popularity_rank "
        "FROM stats s JOIN medians m ON s.payment_method = m.payment_method",
        stats=f"SELECT payment_method, COUNT(*) AS n, {avg(AMOUNT)} AS avg_purchase, {_low_high()}, {sd(AMOUNT)} AS stddev, "
        f"{tot(AMOUNT)} AS total_revenue, {avg(RATING)} AS avg_rating, {avg('age', 1)} AS avg_customer_age, "
        f"{share(_SUBSCRIBED)} AS subscriber_rate FROM retail GROUP BY 1",
        medians=quantile("retail", "payment_method", AMOUNT, {"median": 0.5}),
    ),
)

_report(
    "report_seasonal",
    reports.seasonal_categories,
    on_retail(
        "SELECT * FROM (SELECT season, category, n AS sales_volume, revenue, avg_price, avg_rating, discount_rate, "
        f"{pct('n', 'SUM(n) OVER (PARTITION BY season)')} AS pct_of_season, "
        "CAST(RANK() OVER (PARTITION BY season ORDER BY revenue DESC) AS INT) AS revenue_rank FROM stats) WHERE revenue_rank <= 3",
        stats=f"SELECT season, category, COUNT(*) AS n, {tot(AMOUNT)} AS revenue, {avg(AMOUNT)} AS avg_price, "
        f"{avg(RATING)} AS avg_rating, {share(_DISCOUNTED)} AS discount_rate FROM retail GROUP BY 1, 2",
    ),
)

_report(
    "report_clv",
    reports.lifetime_value,
    on_retail(
        f"SELECT customer_segment, COUNT(*) AS customer_count, {avg('v')} AS avg_lifetime_value, {avg('n', 1)} AS avg_transactions, "
        f"{rnd('AVG(a)')} AS avg_transaction_size, {avg('age', 1)} AS avg_age, {avg('h', 1)} AS avg_loyalty_score, "
        f"{rnd('AVG(r)')} AS avg_rating, {share(_S_YES)} AS subscriber_rate, {tot('v')} AS segment_total_value, "
        f"{pct('SUM(v)', '(SELECT SUM(v) FROM metrics)')} AS pct_of_total_revenue FROM segments GROUP BY customer_segment",
        metrics=f"SELECT customer_id, COUNT(*) AS n, SUM({AMOUNT}) AS v, {avg(AMOUNT, None)} AS a, {avg(RATING, None)} AS r, "
        f"MAX(age) AS age, MAX({HISTORY}) AS h, MAX(subscription_status) AS s FROM retail GROUP BY customer_id",
        segments="SELECT *, CASE WHEN vq = 4 AND fq = 4 THEN 'VIP Champions' WHEN vq = 4 THEN 'High Spenders' "
        "WHEN fq = 4 THEN 'Frequent Buyers' WHEN hq = 4 THEN 'Loyal Customers' WHEN vq = 1 AND fq = 1 THEN 'At Risk' "
        "ELSE 'Regular Customers' END AS customer_segment FROM (SELECT *, NTILE(4) OVER (ORDER BY v, customer_id) AS vq, "
        "NTILE(4) OVER (ORDER BY n, customer_id) AS fq, NTILE(4) OVER (ORDER BY h, customer_id) AS hq FROM metrics)",
    ),
)

_report(
    "report_shipping",
    reports.shipping_preferences,
    on_retail(
        f"SELECT shipping_type, category, n AS order_count, {rnd('amount')} AS avg_order_value, total_revenue, avg_rating, "
        f"avg_customer_age, subscriber_rate, discount_rate, {pct('n', 'SUM(n) OVER g')} AS pct_of_shipping_type, "
        f"{rnd('(AVG(amount) OVER g)')} AS shipping_type_avg FROM detail WINDOW g AS (PARTITION BY shipping_type)",
        detail=f"SELECT shipping_type, category, COUNT(*) AS n, {avg(AMOUNT, None)} AS amount, {tot(AMOUNT)} AS total_revenue, "
        f"{avg(RATING)} AS avg_rating, {avg('age', 1)} AS avg_customer_age, {share(_SUBSCRIBED)} AS subscriber_rate, "
        f"{share(_DISCOUNTED)} AS discount_rate FROM retail GROUP BY 1, 2",
    ),
)

_report(
    "report_location",
    reports.location_markets,
    on_retail(
        "SELECT m.*, t.category AS top_category, "
        f"{rnd('(CAST(total_transactions AS DOUBLE) / unique_customers)')} AS transactions_per_customer, "
        f"{pct('total_revenue', '(SELECT SUM(total_revenue) FROM markets)')} AS revenue_market_share FROM markets m "
        "JOIN (SELECT location, category, ROW_NUMBER() OVER (PARTITION BY location ORDER BY COUNT(*) DESC, category) AS rn "
        "FROM retail GROUP BY location, category) t ON m.location = t.location AND t.rn = 1 "
        "ORDER BY total_revenue DESC, m.location LIMIT 20",
        markets=f"SELECT location, COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS total_transactions, "
        f"{tot(AMOUNT)} AS total_revenue, {avg(AMOUNT)} AS avg_transaction, {avg('age', 1)} AS avg_customer_age, "
        f"{avg(RATING)} AS avg_rating, {share(_SUBSCRIBED)} AS subscription_rate, {share(_MALE)} AS male_pct, "
        f"{share(_FEMALE)} AS female_pct, {avg(HISTORY, 1)} AS avg_loyalty FROM retail GROUP BY 1",
    ),
)


def _explore(name: str, plan, select: str, tail: str = "") -> None:
    _report(name, plan, on_retail(f"SELECT {select} FROM retail {tail}"))


_ALL = "(SELECT COUNT(*) FROM retail)"
_PCT = f"{pct('COUNT(*)', _ALL)} AS percentage"

_explore(
    "eda_age_stats",
    explore.age_stats,
    f"{avg('age')} AS avg_age, MIN(age) AS min_age, MAX(age) AS max_age, {sd('age')} AS stddev_age",
)
_explore("eda_age_groups", explore.age_groups, f"{FIVE_AGES} AS age_group, COUNT(*) AS customer_count, {_PCT}", "GROUP BY 1 ORDER BY 1")
_explore("eda_gender", explore.gender, f'gender, COUNT(*) AS "count", {_PCT}', "GROUP BY 1")
_explore(
    "eda_top_locations",
    explore.top_locations,
    "location, COUNT(*) AS customer_count",
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
_explore(
    "eda_revenue_metrics",
    explore.revenue_metrics,
    f"{avg(AMOUNT)} AS avg_purchase, {_low_high()}, {sd(AMOUNT)} AS stddev_purchase, {tot(AMOUNT)} AS total_revenue, "
    "COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS total_transactions",
)
_explore(
    "eda_category_revenue",
    explore.category_revenue,
    f"category, COUNT(*) AS purchase_count, {avg(AMOUNT)} AS avg_amount, {tot(AMOUNT)} AS total_revenue",
    "GROUP BY 1 ORDER BY 4 DESC",
)
_explore(
    "eda_top_items",
    explore.top_items,
    f"item_purchased, category, COUNT(*) AS purchase_count, {avg(AMOUNT)} AS avg_price",
    "GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15",
)
_explore(
    "eda_frequency",
    explore.frequency,
    f"frequency_of_purchases, COUNT(*) AS customer_count, {avg(AMOUNT)} AS avg_purchase_amount",
    "GROUP BY 1",
)
_explore(
    "eda_payment",
    explore.payment,
    f"payment_method, COUNT(*) AS transaction_count, {avg(AMOUNT)} AS avg_amount, {_PCT}",
    "GROUP BY 1",
)
_explore("eda_shipping", explore.shipping, f"shipping_type, COUNT(*) AS order_count, {_PCT}", "GROUP BY 1")
_explore(
    "eda_discount",
    explore.discount,
    f'discount_applied, promo_code_used, COUNT(*) AS "count", {avg(AMOUNT)} AS avg_purchase',
    "GROUP BY 1, 2",
)
_explore(
    "eda_subscription",
    explore.subscription,
    f"subscription_status, COUNT(*) AS customer_count, {avg(AMOUNT)} AS avg_purchase, {avg(HISTORY)} AS avg_previous_purchases",
    "GROUP BY 1",
)
_explore(
    "eda_loyalty",
    explore.loyalty,
    f"{LOYALTY} AS customer_segment, COUNT(*) AS customer_count, {avg(AMOUNT)} AS avg_purchase",
    "GROUP BY 1",
)
_explore("eda_rating", explore.rating, f'review_rating, COUNT(*) AS "count", {_PCT}', "GROUP BY 1 ORDER BY 1 DESC")
_explore(
    "eda_season_sales",
    explore.season_sales,
    f"season, COUNT(*) AS purchase_count, {avg(AMOUNT)} AS avg_purchase, {tot(AMOUNT)} AS total_revenue",
    "GROUP BY 1",
)
_explore("eda_season_category", explore.season_category, "season, category, COUNT(*) AS purchase_count", "GROUP BY 1, 2")
_explore(
    "eda_age_gender",
    explore.age_gender,
    f'{FIVE_AGES_OPEN} AS age_group, gender, {avg(AMOUNT)} AS avg_purchase, COUNT(*) AS "count"',
    "GROUP BY 1, 2",
)
_explore(
    "eda_color_size",
    explore.color_size,
    'color, size, COUNT(*) AS "count"',
    "GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15",
)
_explore(
    "eda_subscription_impact",
    explore.subscription_impact,
    f"subscription_status, COUNT(*) AS customer_count, {avg(AMOUNT)} AS avg_purchase, {avg(HISTORY)} AS avg_previous_purchases, "
    f"{avg(RATING)} AS avg_rating",
    "GROUP BY 1",
)
_explore(
    "eda_summary",
    explore.summary,
    f"COUNT(DISTINCT customer_id) AS total_customers, COUNT(*) AS total_transactions, {tot(AMOUNT)} AS total_revenue, "
    f"{avg(AMOUNT)} AS avg_transaction_value, {avg('age', 1)} AS avg_customer_age, {avg(RATING)} AS avg_rating, "
    "COUNT(DISTINCT category) AS total_categories, COUNT(DISTINCT item_purchased) AS total_unique_items",
)
_explore("eda_category_counts", explore.category_counts, 'category, COUNT(*) AS "count"', "GROUP BY 1")
_explore(
    "eda_age_decades",
    explore.age_decades,
    f"{DECADES} AS age_group, COUNT(*) AS customer_count, {avg(AMOUNT)} AS avg_purchase",
    "GROUP BY 1",
)
_explore(
    "eda_gender_revenue",
    explore.gender_revenue,
    f"gender, COUNT(*) AS total_purchases, {avg(AMOUNT)} AS avg_purchase, {tot(AMOUNT)} AS total_spent",
    "GROUP BY 1",
)
